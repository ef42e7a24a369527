"""Order statistics of groups of any size: range partitions, sums by partition, and what lies before each partition.

A table is sorted over range partitions and written. Sums by partition and key, a row each, are added up along the partitions; so a running sum is what lies
in earlier partitions plus a sum within one, and no key's rows, however many, meet in one task. What a window sees is one partition's rows of a key, or a
key's partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labharm.functions.keys import left_join
from labharm.functions.store import cut


def ranged(df: DataFrame, order: list[str | Column], name: str = "ranged") -> DataFrame:
    """df sorted over range partitions, with __part, the partition's number, and __place, the row's place in it (from 0). Rows that are equal in order share a partition."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(dealt.withColumns({"__part": F.spark_partition_id(), "__place": F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))}), name)


def before(table: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """__part, keys and for each column of sums: here_<c> of this partition, before_<c> of the key's earlier ones, total_<c> of all."""
    parts = table.groupBy("__part", *keys).agg(*(F.sum(c).alias(f"here_{c}") for c in sums))
    whole = W.partitionBy(*keys)
    earlier = whole.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    return parts.withColumns({f"before_{c}": F.coalesce(F.sum(f"here_{c}").over(earlier), F.lit(0)) for c in sums} | {f"total_{c}": F.sum(f"here_{c}").over(whole) for c in sums})


def running(table: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """A ranged table with upto_<c>, the running sum within the key along the table's order, and total_<c>. table must be ranged by keys first."""
    here = W.partitionBy("__part", *keys).orderBy("__place").rowsBetween(W.unboundedPreceding, W.currentRow)
    out = left_join(table, before(table, keys, sums), ["__part", *keys])
    return out.withColumns({f"upto_{c}": F.col(f"before_{c}") + F.sum(c).over(here) for c in sums}).drop(*(f"{x}_{c}" for x in ("here", "before") for c in sums))


def quantiles(counts: DataFrame, keys: list[str], at: list[float], value: str = "value", n: str = "n") -> DataFrame:
    """keys and q, the quantiles at the given shares by linear interpolation, of values that occur n times each (keys, value, n; a row a key and value).

    Only partitions that hold a rank which is asked for are looked into.
    """
    rows = counts.select(*keys, F.col(value).cast("double").alias("value"), F.col(n).cast("long").alias("n")).filter("value is not null")
    table = ranged(rows, [*keys, "value"], "quantiles")
    parts = before(table, keys, ["n"])
    place = [F.lit(q) * (F.col("total_n") - 1) for q in at]
    ranks = F.array(*(F.struct(F.lit(i).alias("i"), p.alias("place"), side(p).cast("long").alias("rank")) for i, p in enumerate(place) for side in (F.floor, F.ceil)))
    wanted = parts.select("__part", *keys, F.col("before_n"), F.col("here_n"), F.inline(F.array_distinct(ranks))).filter("rank >= before_n and rank < before_n + here_n").drop("here_n")
    wanted = cut(wanted, "quantile-ranks")
    looked_into = left_join(table, wanted.select("__part", *keys).distinct(), ["__part", *keys], how="leftsemi")
    here = W.partitionBy("__part", *keys).orderBy("__place").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = left_join(looked_into.withColumn("upto", F.sum("n").over(here)), wanted, ["__part", *keys], how="inner")
    found = found.filter("rank >= before_n + upto - n and rank < before_n + upto")
    lower, upper = F.min("value"), F.max("value")
    found = found.groupBy(*keys, "i", "place").agg((lower + (upper - lower) * (F.col("place") - F.floor("place"))).alias("x"))
    return found.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("q"))


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with a column name: the row's number (from 1) in the given order. Rows that are equal in order share a partition and are numbered in any order."""
    table = ranged(df, order, "numbered")
    counts = sorted((r["__part"], r["count"]) for r in table.groupBy("__part").count().collect())  # a row a partition
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n
    at = F.broadcast(df.sparkSession.createDataFrame(starts, "__of int, __start long"))
    return table.join(at, F.col("__part") == F.col("__of")).withColumn(name, F.col("__start") + F.col("__place") + 1).drop("__part", "__place", "__of", "__start")


def gaps(sample: DataFrame, reference: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """keys, gap, n_sample, n_reference: the largest distance of two distribution functions, each key's values (keys, value) against those (by, value) of its group by."""
    zero = F.lit(0).cast("long")
    mine = sample.filter("value is not null").groupBy(*keys, "value").agg(F.count("*").alias("n")).withColumn("m", zero)
    theirs = reference.filter("value is not null").groupBy(*by, "value").agg(F.count("*").alias("m"))
    theirs = left_join(mine.select(*keys).distinct(), theirs, by, how="inner").withColumn("n", zero)
    both = mine.unionByName(theirs).groupBy(*keys, "value").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    both = running(ranged(both, [*keys, "value"], "gaps"), keys, ["n", "m"])
    gap = F.abs(F.col("upto_n") / F.col("total_n") - F.col("upto_m") / F.nullif(F.col("total_m"), zero))
    return both.groupBy(*keys).agg(F.max(gap).alias("gap"), F.max("total_n").alias("n_sample"), F.max("total_m").alias("n_reference"))
