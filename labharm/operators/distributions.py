"""Distributions of value sources and outcomes by key: what is missing, all categories, nested tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labharm.functions.keys import K5, left_join

SOURCES = ["Missing", "Extracted", "Source", "QCOut"]
OUTCOMES = ["NA", "N", "A", "AA", "L", "LL", "H", "HH"]


def missing(totals: DataFrame, counts: DataFrame, name: str) -> DataFrame:
    """K5, value, n: records of a key that no count covers, suppressed ones included. totals: K5, n_records; counts: K5, value, n."""
    known = counts.groupBy(*K5).agg(F.sum("n").alias("known"))
    return left_join(totals.select(*K5, "n_records"), known, K5).select(*K5, F.lit(name).alias("value"), (F.coalesce("n_records", F.lit(0)) - F.coalesce("known", F.lit(0))).alias("n"))


def with_missing(totals: DataFrame, counts: DataFrame, name: str) -> DataFrame:
    return counts.select(*K5, "value", "n").unionByName(missing(totals, counts, name))


def densified(table: DataFrame, categories: list[str]) -> DataFrame:
    """Every key with every category, 0 where it has none."""
    sums = table.groupBy(*K5).agg(*(F.coalesce(F.sum(F.when(F.col("value") == c, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, c in enumerate(categories)))
    return sums.select(*K5, F.inline(F.array(*(F.struct(F.lit(c).alias("value"), F.col(f"n{i}").alias("n")) for i, c in enumerate(categories)))))


def nested(table: DataFrame, name: str) -> DataFrame:
    """K5 and an array of {value, n}, sorted by value."""
    return table.groupBy(*K5).agg(F.array_sort(F.collect_list(F.struct("value", "n"))).alias(name))


def n_values(distribution: str | Column, only: str | None = None) -> Column:
    """Records with values (all but Missing), or those of one source."""
    test = (lambda x: x["value"] == only) if only else (lambda x: x["value"] != "Missing")
    return F.aggregate(F.filter(distribution, test), F.lit(0).cast("long"), lambda a, x: a + x["n"])


def all_missing(distribution: str | Column) -> Column:
    total = F.aggregate(distribution, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return n_values(distribution, "Missing") == total


def text(distribution: str | Column) -> Column:
    return F.array_join(F.transform(distribution, lambda x: F.concat(x["value"], F.lit("="), x["n"].cast("string"))), "|")


def assemble(extracts: dict[str, DataFrame]) -> DataFrame:
    """One row a row of summaryTest, with both distributions and both decile lists nested."""
    tests = extracts["summaryTest"]
    totals = tests.groupBy(*K5).agg(F.sum("n_records").alias("n_records"))
    sources = extracts["summaryValuesSource"].select(*K5, F.col("MEASUREMENT_VALUE_TYPE").alias("value"), F.col("n_records").alias("n"))
    outcomes = extracts["summaryOutcomes"].select(*K5, F.col("TEST_OUTCOME").alias("value"), F.col("n_TEST_OUTCOME").alias("n"))
    values = extracts["summaryValues"].groupBy(*K5)
    column = lambda c: F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("decile", F.col(c).alias("value")))))
    values = values.agg(column("decile_MEASUREMENT_VALUE").alias("v"), column("decile_MEASUREMENT_VALUE_HARMONIZED").alias("h"))
    only = lambda c: F.when(F.size(c) > 0, F.transform(c, lambda x: x["value"])).alias(c)
    out = left_join(tests, nested(densified(with_missing(totals, sources, "Missing"), SOURCES), "distribution_values"), K5)
    out = left_join(out, values.select(*K5, only("v"), only("h")), K5)
    return left_join(out, nested(densified(with_missing(totals, outcomes, "NA"), OUTCOMES), "distribution_outcomes"), K5)
