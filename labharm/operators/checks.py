"""Preconditions that are part of a plan: conditions that end a job, and counts that come with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from labharm.functions.keys import K5
from labharm.operators.extract import DECILES, MIN_SUBJECTS


def demand(df: DataFrame, condition: Column, message: str | Column) -> DataFrame:
    """df, all of whose rows must meet a condition: a row that doesn't ends the job, with the message, when it is read."""
    return df.filter(F.when(F.coalesce(condition, F.lit(False)), True).otherwise(F.raise_error(message).cast("boolean")))


def observed(df: DataFrame, **breaches: Column) -> tuple[DataFrame, Observation]:
    """df and what the first job that runs over it counts: rows, and those in which each condition holds."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in breaches.items())), seen


def enough_subjects(df: DataFrame, least: int = MIN_SUBJECTS) -> DataFrame:
    """An extract, none of whose cells may be small."""
    return demand(df, F.col("n_subjects") > least, F.concat(F.lit("a cell of "), F.coalesce(F.col("n_subjects").cast("string"), F.lit("no")), F.lit(" subjects")))


def grids(values: DataFrame) -> DataFrame:
    """K5 and of each key's deciles: whole (the nine shares, once each), ordered (values don't fall), harmonized (all harmonised values are there)."""
    rows = values.groupBy(*K5).agg(F.array_sort(F.collect_list(F.struct(F.round("decile", 6).alias("decile"), "decile_MEASUREMENT_VALUE", "decile_MEASUREMENT_VALUE_HARMONIZED"))).alias("g"))  # nine a key
    x = F.col("g.decile_MEASUREMENT_VALUE")
    return rows.select(*K5, (F.col("g.decile") == F.array(*map(F.lit, DECILES))).alias("whole"), (F.array_sort(x) == x).alias("ordered"), (~F.exists("g.decile_MEASUREMENT_VALUE_HARMONIZED", lambda y: y.isNull())).alias("harmonized"))
