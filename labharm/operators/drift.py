"""Kolmogorov-Smirnov tests: of each row's deciles against its concept's reference row, and of two whole samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labharm.functions.keys import keep_first, left_join
from labharm.operators.distributions import n_values
from labharm.operators.order import gaps


def distance(v: str, ref: str) -> Column:
    """Largest gap of two distribution functions known at nine deciles each, which come sorted; null unless both have nine values."""
    ok = (F.size(v) == 9) & (F.size(ref) == 9) & ~F.exists(v, lambda x: x.isNull()) & ~F.exists(ref, lambda x: x.isNull())
    below = lambda c, x: F.size(F.filter(c, lambda y: y <= x))
    gap = F.array_max(F.transform(F.array_distinct(F.concat(v, ref)), lambda x: F.abs(below(v, x) - below(ref, x)))) / 10.0
    return F.when(ok, gap)


def p_value(d: Column, n1: Column, n2: Column) -> Column:
    """From the first 100 terms of the asymptotic series; they cancel to 0 at distance 0."""
    lam = F.sqrt(n1 * n2 / (n1 + n2)) * d
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), lambda a, k: a + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam))
    return F.when(d.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series)))


def reference_rows(summary: DataFrame) -> DataFrame:
    """local_OMOP_CONCEPT_ID, reference_rowId: the approved row with a unit that has most records, of equal ones the earliest."""
    rows = summary.filter("status = 'APPROVED' and local_MEASUREMENT_UNIT is not null")
    return keep_first(rows, ["local_OMOP_CONCEPT_ID"], [F.desc_nulls_last("n_records"), F.col("rowId")]).select("local_OMOP_CONCEPT_ID", F.col("rowId").alias("reference_rowId"))


def test(summary: DataFrame) -> DataFrame:
    """summary (rowId, v, local_h, ...) with ks, p, ks_harmonized, p_harmonized and isNotHarmonised."""
    out = left_join(summary, reference_rows(summary), ["local_OMOP_CONCEPT_ID"])
    ref = summary.select(F.col("rowId").alias("ref"), F.col("v").alias("ref_v"), F.col("local_h").alias("ref_h"), n_values("distribution_values").alias("ref_n"))
    out = left_join(out, ref, {"ref": "reference_rowId"})
    out = out.withColumns({"n_values": n_values("distribution_values"), "isNotHarmonised": F.col("local_h").isNull(), "h_or_v": F.coalesce("local_h", "v")})
    enough = (F.col("n_values") >= 2) & (F.col("ref_n") >= 2)
    out = out.withColumns({"ks": F.when(enough, distance("v", "ref_v")), "ks_harmonized": F.when(enough, distance("h_or_v", "ref_h"))})
    p = lambda c: p_value(F.col(c), F.col("n_values").cast("double"), F.col("ref_n").cast("double"))
    return out.withColumns({"p": p("ks"), "p_harmonized": p("ks_harmonized")}).drop("ref_v", "ref_h", "h_or_v")


def band(d: str) -> Column:
    return F.when(F.col(d).isNull(), "NA").when(F.col(d) > 0.5, "red").when(F.col(d) > 0.2, "yellow").otherwise("green")


def neg_log10(p: str) -> Column:
    return F.when(F.col(p) <= 0, F.lit(float("inf"))).otherwise(-F.log10(p))


def two_samples(sample: DataFrame, reference: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """keys, ks, n_sample, n_reference: each key's values (keys, value) against the reference values (by, value) of its group by, in full."""
    return gaps(sample, reference, keys, by).withColumnRenamed("gap", "ks")


def injection(ks: DataFrame, below: float = 0.3) -> DataFrame:
    return ks.withColumn("decision", F.when(F.col("ks").isNull(), "no reference").when(F.col("ks") < below, "inject").otherwise("manual"))
