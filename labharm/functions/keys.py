"""Null-safe joins, deterministic keep-first, and column helpers that print and compare like the tables' makers do."""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labharm.functions import names

#: The key that the four extracts share.
K5 = ["OMOP_CONCEPT_ID", "TEST_NAME", "MEASUREMENT_UNIT_PREFIX", "MEASUREMENT_UNIT", "IS_EXTRACTED"]


def left_join(left: DataFrame, right: DataFrame, on: list[str] | dict[str, str], how: str = "left") -> DataFrame:
    """Left join in which nulls are equal. on: names, or left names by right ones. Spark broadcasts the right side where its size is known to be small."""
    on = on if isinstance(on, dict) else {c: c for c in on}
    right = right.withColumnsRenamed({r: f"__{r}" for r in on})
    at = F.lit(True)
    for r, l in on.items():  # noqa: E741
        at = at & F.col(l).eqNullSafe(F.col(f"__{r}"))
    return left.join(right, at, how).drop(*(f"__{r}" for r in on))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def na(x: str | Column) -> Column:
    """Text in which a missing value prints as NA."""
    return F.coalesce((F.col(x) if isinstance(x, str) else x).cast("string"), F.lit("NA"))


def regex_filter(column: str, pattern: str) -> Column:
    """Case-insensitive search; a pattern that is no regular expression keeps all rows."""
    try:
        SparkSession.active().sql("SELECT '' RLIKE :pattern", {"pattern": f"(?i){pattern}"}).collect()  # folded while it is planned, without a job
    except PySparkException:
        return F.lit(True)
    return F.coalesce(F.col(column).rlike(f"(?i){pattern}"), F.lit(False))


def numeric_filter(column: str, text: str, eps: float = 1e-9) -> Column:
    """A condition from a filter box: a-b, >=a, <=a, >a, <a, =a, a, na; anything else keeps every row that has a number."""
    x, v = re.sub(r"\s", "", text).lower(), F.col(column)
    number = r"-?\d+(?:\.\d+)?(?:e[+-]?\d+)?"
    if not x:
        return F.lit(True)
    if x in ("null", "na"):
        return v.isNull()
    if m := re.fullmatch(f"({number})-({number})", x):
        a, b = sorted(map(float, m.groups()))
        return v.isNotNull() & (v > a - eps) & (v < b + eps)
    if m := re.fullmatch(f"(>=|<=|>|<|=|)({number})", x):
        a = float(m[2])
        test = {">=": v >= a - eps, "<=": v <= a + eps, ">": v > a + eps, "<": v < a - eps}
        return v.isNotNull() & test.get(m[1], F.abs(v - a) < eps)
    return v.isNotNull()


def jaro(a: Column, b: Column) -> Column:
    """Jaro distance of two strings, whole Arrow batches at once."""

    @F.pandas_udf("double")
    def distance(x, y):
        import pandas as pd

        known = x.notna() & y.notna()
        out = pd.Series(None, index=x.index, dtype="float64")
        if known.any():
            out[known] = 1 - names.similarity(names.coded(x[known].tolist()), names.coded(y[known].tolist()))
        return out

    return distance(a, b)
