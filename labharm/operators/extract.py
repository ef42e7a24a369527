"""From raw results to the four suppressed extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labharm.functions.keys import K5, left_join
from labharm.operators.order import quantiles

MIN_SUBJECTS = 5
DECILES = [i / 10 for i in range(1, 10)]


def measurement(raw: DataFrame) -> DataFrame:
    """raw results with IS_EXTRACTED, MEASUREMENT_VALUE_TYPE and MEASUREMENT_VALUE; results that failed quality control have no value."""
    extracted = F.col("cleaned_value").isNull() & F.col("extracted_value").isNotNull()
    kind = F.when(F.col("QC_PASS") == 0, "QCOut").when(extracted, "Extracted").when(F.col("cleaned_value").isNotNull(), "Source")
    value = F.when(kind == "Source", F.col("cleaned_value")).when(kind == "Extracted", F.col("extracted_value"))
    return raw.withColumns({"IS_EXTRACTED": extracted, "MEASUREMENT_VALUE_TYPE": kind, "MEASUREMENT_VALUE": value}).drop("cleaned_value", "extracted_value", "QC_PASS")


def suppressed(df: DataFrame, least: int = MIN_SUBJECTS) -> DataFrame:
    return df.filter(F.col("n_subjects") > least)


def counted(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_records"), F.countDistinct("subject").alias("n_subjects"))


def summary_test(m: DataFrame) -> DataFrame:
    return suppressed(counted(m, *K5, "MEASUREMENT_UNIT_HARMONIZED", "omopQuantity", "CONVERSION_FACTOR"))


def summary_values_source(m: DataFrame) -> DataFrame:
    return suppressed(counted(m.filter("MEASUREMENT_VALUE_TYPE is not null"), *K5, "MEASUREMENT_VALUE_TYPE"))


def summary_outcomes(m: DataFrame) -> DataFrame:
    found = m.filter("TEST_OUTCOME is not null").groupBy(*K5, "TEST_OUTCOME")
    return suppressed(found.agg(F.count("*").alias("n_TEST_OUTCOME"), F.countDistinct("subject").alias("n_subjects")))


#: What a record counts for: its test, value source, outcome and value (by subject), and its two values.
_TEST = ["MEASUREMENT_UNIT_HARMONIZED", "omopQuantity", "CONVERSION_FACTOR"]
KINDS = {"test": _TEST, "source": ["MEASUREMENT_VALUE_TYPE"], "outcome": ["TEST_OUTCOME"], "valued": [], "value": [], "harmonized": []}


#: Records whose facts one task counts before they are shuffled; a record's take some 600 bytes there.
TASK_RECORDS = 250_000


def facts(m: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """kind, K5, a, b, c (what else the kind is counted by), subject, value, n: all that the extracts need, in one scan.

    Records are dealt to tasks by their number first, as a file's parts may be of any size. Facts are dealt by subject and value, too, so a key that holds most
    records is added up in many tasks before its subjects are counted.
    """
    text = lambda x: x.cast("string")
    null, number = F.lit(None).cast("string"), F.lit(None).cast("double")

    def fact(kind: str) -> Column:
        more = [text(F.col(c)) for c in KINDS[kind]]
        known = {"source": "MEASUREMENT_VALUE_TYPE", "outcome": "TEST_OUTCOME", "valued": "MEASUREMENT_VALUE", "value": "MEASUREMENT_VALUE", "harmonized": "HARMONIZED_VALUE"}.get(kind)
        value = {"value": F.col("MEASUREMENT_VALUE"), "harmonized": F.when(F.col("MEASUREMENT_VALUE").isNotNull(), F.col("HARMONIZED_VALUE"))}.get(kind, number)
        subject = null if kind in ("value", "harmonized") else text(F.col("subject"))
        row = F.struct(F.lit(kind).alias("kind"), *((more[i] if i < len(more) else null).alias(c) for i, c in enumerate("abc")), subject.alias("subject"), value.alias("value"))
        return F.when(value.isNotNull() if kind == "harmonized" else F.col(known).isNotNull() if known else F.lit(True), row)

    tasks = max(1, -(-m.count() // TASK_RECORDS))  # of Parquet files, the count is in their footers
    long = m.repartition(tasks, "subject", "MEASUREMENT_VALUE", "TEST_OUTCOME").select(*K5, F.inline(F.filter(F.array(*map(fact, kinds or KINDS)), lambda x: x.isNotNull())))
    return long.groupBy("kind", *K5, "a", "b", "c", "subject", "value").agg(F.count("*").alias("n"))


def _counted(found: DataFrame, kind: str, n: str = "n_records") -> DataFrame:
    rows = found.filter(F.col("kind") == kind).groupBy(*K5, "a", "b", "c").agg(F.sum("n").alias(n), F.count("subject").alias("n_subjects"))
    return rows.withColumnsRenamed(dict(zip("abc", KINDS[kind]))).drop(*"abc")


def deciles(found: DataFrame) -> DataFrame:
    """K5, v, h: exact deciles of values and harmonised values out of the facts, in no task of which all values of a key meet."""
    q = quantiles(found.filter("kind in ('value', 'harmonized')").select("kind", *K5, "value", "n"), ["kind", *K5], DECILES)
    return q.groupBy(*K5).agg(F.first(F.when(F.col("kind") == "value", F.col("q")), ignorenulls=True).alias("v"), F.first(F.when(F.col("kind") == "harmonized", F.col("q")), ignorenulls=True).alias("h"))


def summary_values_wide(found: DataFrame) -> DataFrame:
    """K5, n_records, n_subjects, v, h out of the facts: counts divided by ten, then suppressed; both decile lists."""
    counts = _counted(found, "valued").withColumns({c: F.floor(F.col(c) / 10).cast("long") for c in ("n_records", "n_subjects")})
    return left_join(suppressed(counts), deciles(found), K5)


def summary_values(found: DataFrame) -> DataFrame:
    long = summary_values_wide(found).select(*K5, "n_subjects", "n_records", F.posexplode("v").alias("k", "decile_MEASUREMENT_VALUE"), "h")
    return long.select(*K5, "n_subjects", "n_records", ((F.col("k") + 1) / 10).alias("decile"), "decile_MEASUREMENT_VALUE", F.get("h", F.col("k")).alias("decile_MEASUREMENT_VALUE_HARMONIZED"))


def all_extracts(found: DataFrame) -> dict[str, DataFrame]:
    """The four extracts out of the facts, which should be a written table: then the records are scanned once."""
    values_source, outcomes = _counted(found, "source"), _counted(found, "outcome", "n_TEST_OUTCOME")
    return {"summaryTest": suppressed(_counted(found, "test")), "summaryValuesSource": suppressed(values_source), "summaryValues": summary_values(found), "summaryOutcomes": suppressed(outcomes)}


#: A sketch's size, and the rank error that it keeps to with near certainty (a little over twice the 1.33 % published for 99 %).
SKETCH_K, SKETCH_ERROR = 200, 0.03


def sketches(m: DataFrame, by: list[str]) -> DataFrame:
    """K5, by, n and sketch: a mergeable quantile sketch of the values of each key and part (of a month, of a file), to be stored and merged with later parts."""
    return m.filter("MEASUREMENT_VALUE is not null").groupBy(*K5, *by).agg(F.count("*").alias("n"), F.kll_sketch_agg_double("MEASUREMENT_VALUE", SKETCH_K).alias("sketch"))


def merged(parts: DataFrame) -> DataFrame:
    """K5, n, sketch of all parts together."""
    return parts.groupBy(*K5).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_deciles(found: DataFrame) -> DataFrame:
    """K5, n, decile, value as the sketches have it: its rank is off by SKETCH_ERROR of n at most."""
    values = F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, DECILES)))
    return found.select(*K5, "n", F.posexplode(values).alias("k", "value")).select(*K5, "n", ((F.col("k") + 1) / 10).alias("decile"), "value")
