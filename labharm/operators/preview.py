"""Looking at tables: caps and samples for development, counts, lookups, and columns side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labharm.operators.order import numbered


def cap(df: DataFrame, n: int = 1_000_000) -> DataFrame:
    """Any n rows, to develop with."""
    return df.limit(n)


def sample(df: DataFrame, n: int, key: list[str], seed: int = 0) -> DataFrame:
    """n rows drawn without replacement: those with the smallest hashes of key and seed, the same ones each time."""
    return df.orderBy(F.md5(F.concat_ws("\x1f", F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key))), *key).limit(n)


def columns(df: DataFrame) -> DataFrame:
    """A row a column: name, type, how many values, how many of them are missing, and the smallest and largest as text."""
    counts = df.agg(*(x for i, f in enumerate(df.schema) for x in (F.count(F.lit(1)).alias(f"n{i}"), F.count_if(F.col(f.name).isNull()).alias(f"m{i}"), F.min(F.col(f.name).cast("string")).alias(f"a{i}"), F.max(F.col(f.name).cast("string")).alias(f"z{i}"))))
    rows = [F.struct(F.lit(i).alias("place"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"n{i}").alias("n"), F.col(f"m{i}").alias("n_missing"), F.col(f"a{i}").alias("smallest"), F.col(f"z{i}").alias("largest")) for i, f in enumerate(df.schema)]
    return counts.select(F.inline(F.array(*rows)))


def counts(df: DataFrame, key: list[str]) -> DataFrame:
    """n_rows and n_keys (different keys, nulls being a value): they agree where key is one."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys"))


def demand_same_rows(before: DataFrame, after: DataFrame) -> None:
    """Fails where a step has changed the number of rows."""
    n, m = before.count(), after.count()
    if n != m:
        raise ValueError(f"{n} rows have become {m}")


def look_up(df: DataFrame, most: int = 10, **values) -> DataFrame:
    """The first rows (by all columns) in which columns have the given values, None being missing."""
    at = F.lit(True)
    for c, v in values.items():
        at = at & F.col(c).eqNullSafe(F.lit(v))
    return df.filter(at).orderBy(*df.columns).limit(most)


def beside(left: DataFrame, right: DataFrame, left_order: list[Column], right_order: list[Column]) -> DataFrame:
    """Columns of two tables side by side, row by row in the given orders; the shorter one is filled with nulls."""
    return numbered(left, left_order, "__n").join(numbered(right, right_order, "__n"), "__n", "full").drop("__n")
