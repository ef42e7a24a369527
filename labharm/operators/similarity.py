"""Suggestions for unmapped tests: the mapped names with the smallest Jaro distance.

Distances are bounded from below by lengths and by the letters that two names share, which are counted by class. Mapped names are sorted and taken in blocks
of BLOCK neighbours, for each of which the most letters of each class and the shortest and longest length are known. A name visits blocks in the order of
their bounds, names of a block only where their own bound permits, and stops where a bound is beyond its k-th distance; equal ones are visited for the sake of ties. So
distances are computed for few pairs, and the answer is the one that all pairs would give.

Both sides are vocabularies, but of any size: mapped names go to the tasks in groups of GROUP at most, unmapped ones are dealt over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labharm.functions import names as N
from labharm.functions.text import hyperlink, number

#: Mapped names that a task holds at once, and names of a block.
GROUP, BLOCK = 100_000, 32


def split_mapped(tests: DataFrame, above: int = 500) -> tuple[DataFrame, DataFrame]:
    """Mapped and unmapped rows of tests (name, concept, n); names that are missing or numbers, rows without concept and those of above records or fewer are in neither."""
    named = tests.filter("name is not null and try_cast(name as double) is null").filter(F.col("n") > above)
    return named.filter("concept >= 1"), named.filter("concept < 1")


class Mapped:
    """Sorted names with what the bounds need."""

    def __init__(self, texts: list[str]):
        self.texts = sorted(texts)
        self.names = N.coded(self.texts)
        self.counts = N.counts(self.names)
        starts = np.arange(0, len(texts), BLOCK)
        self.most = np.maximum.reduceat(self.counts, starts) if len(texts) else self.counts
        self.shortest, self.longest = (f.reduceat(self.names.length, starts) if len(texts) else self.names.length for f in (np.minimum, np.maximum))

    def nearest(self, text: str, k: int) -> tuple[list[tuple[str, float]], int]:
        """The k names with the smallest distances, and how many distances were computed."""
        name = N.coded([text])
        letters, length = N.counts(name)[0], name.length[0]
        block_bound = 1 - N.bound(np.minimum(self.most, letters).sum(1), length, self.shortest, self.longest)
        order = np.argsort(block_bound, kind="stable")
        best_d, best_i, done, step, compared = np.zeros(0), np.zeros(0, np.int64), 0, 8, 0
        while done < len(order):
            kth = best_d[k - 1] if len(best_d) >= k else np.inf
            blocks = order[done : done + step]
            blocks = blocks[block_bound[blocks] <= kth]
            if not len(blocks):
                break
            done, step = done + step, 2 * step
            at = (blocks[:, None] * BLOCK + np.arange(BLOCK)[None]).ravel()
            at = at[at < len(self.texts)]
            own = 1 - N.bound(np.minimum(self.counts[at], letters).sum(1), length, self.names.length[at], self.names.length[at])
            ordered = np.lexsort((at, own))
            at, own = at[ordered], own[ordered]
            i = 0
            while i < len(at):  # the likeliest first, so that they spare the others
                kth = best_d[k - 1] if len(best_d) >= k else np.inf
                wide = k + i
                some = at[i : i + wide][own[i : i + wide] <= kth]
                i += wide
                if not len(some):
                    break
                compared += len(some)
                d = np.concatenate([best_d, 1 - N.similarity(N.Names(np.repeat(name.letters, len(some), 0), np.repeat(name.length, len(some))), self.names.take(some))])
                found = np.concatenate([best_i, some])
                keep = np.lexsort((found, d))[:k]
                best_d, best_i = d[keep], found[keep]
        return [(self.texts[i], d) for i, d in zip(best_i.tolist(), best_d.tolist())], compared


def _groups(mapped: DataFrame, group: int) -> Iterator:
    """Broadcasts of the mapped names, group of them at most each."""
    spark, others = mapped.sparkSession, mapped.select("name").filter("name is not null").distinct()
    n = max(1, -(-others.count() // group))
    for g in range(n):
        part = others.filter(F.pmod(F.xxhash64("name"), F.lit(n)) == g) if n > 1 else others
        yield spark.sparkContext.broadcast(Mapped([r.name for r in part.collect()]))  # of vocabulary size, and one group at a time


def _frame(rows: list[tuple[str, str, float]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ([], [], []), (pa.string(), pa.string(), pa.float64()))], names=["name", "other", "distance"])


def _search(batches: Iterator[pa.RecordBatch], mapped, k: int, compared) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, n = [], 0
        for text in batch.column(0).to_pylist():
            found, some = mapped.value.nearest(text, k)
            rows += [(text, other, d) for other, d in found]
            n += some
        compared.add(n)
        yield _frame(rows)


def nearest(mapped: DataFrame, unmapped: DataFrame, k: int = 10, group: int = GROUP, compared=None) -> DataFrame:
    """name, rank, other, concept, distance: for each unmapped name (name) the k nearest mapped ones (name, concept); equal distances by other and concept.

    compared, an accumulator, counts the distances that are computed.
    """
    compared = compared or mapped.sparkSession.sparkContext.accumulator(0)
    left, found = unmapped.select("name").filter("name is not null").distinct(), None
    for names in _groups(mapped, group):
        got = left.mapInArrow(lambda batches, names=names: _search(batches, names, k, compared), "name string, other string, distance double")
        found = got if found is None else found.unionByName(got)
    ranked = lambda df, *order: df.withColumn("rank", F.row_number().over(W.partitionBy("name").orderBy(*order))).filter(F.col("rank") <= k)
    found = ranked(found, "distance", "other").drop("rank").join(mapped.select(F.col("name").alias("other"), "concept").distinct(), "other")
    return ranked(found, "distance", "other", "concept").select("name", "rank", "other", "concept", "distance")


def _all(batches: Iterator[pa.RecordBatch], mapped) -> Iterator[pa.RecordBatch]:
    m = mapped.value
    step = max(1, N.CELLS // max(1, m.names.letters.shape[1]))
    for batch in batches:
        for text in batch.column(0).to_pylist():
            name = N.coded([text])
            for i in range(0, len(m.texts), step):
                part = N.Names(m.names.letters[i : i + step], m.names.length[i : i + step])
                n = len(part.length)
                d = 1 - N.similarity(N.Names(np.repeat(name.letters, n, 0), np.repeat(name.length, n)), part)
                yield pa.RecordBatch.from_arrays([pa.array([text] * n, pa.string()), pa.array(m.texts[i : i + step], pa.string()), pa.array(d)], names=["name", "other", "distance"])


def matrix(mapped: DataFrame, unmapped: DataFrame, group: int = GROUP) -> DataFrame:
    """name, other, concept, distance: the whole distance matrix, where that is what is asked for."""
    left, found = unmapped.select("name").filter("name is not null").distinct(), None
    for names in _groups(mapped, group):
        got = left.mapInArrow(lambda batches, names=names: _all(batches, names), "name string, other string, distance double")
        found = got if found is None else found.unionByName(got)
    return found.join(mapped.select(F.col("name").alias("other"), "concept").distinct(), "other").select("name", "concept", "other", "distance")


def by_concept(near: DataFrame) -> DataFrame:
    return near.groupBy("name", "concept").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("other")), " | ").alias("names"), F.avg("distance").alias("mean_distance"))


def formulas(rolled: DataFrame, base: str, k: int = 3) -> DataFrame:
    """name, closest_1, ...: a spreadsheet link to each of a name's k closest concepts, with the names that speak for it and their mean distance."""
    text = hyperlink(F.concat(F.lit(base), F.col("concept").cast("string")), [F.col("concept"), F.concat(F.col("n").cast("string"), F.lit(" testIds: "), F.col("names")), F.concat(F.lit("distance: "), number(F.round("mean_distance", 3)))])
    top = rolled.withColumn("r", F.row_number().over(W.partitionBy("name").orderBy("mean_distance", "concept"))).filter(F.col("r") <= k).withColumn("formula", text)
    return top.groupBy("name").agg(*(F.max(F.when(F.col("r") == i, F.col("formula"))).alias(f"closest_{i}") for i in range(1, k + 1)))


def wide(rolled: DataFrame, k: int = 3) -> DataFrame:
    """A row a name with its k closest concepts side by side."""
    top = rolled.withColumn("r", F.row_number().over(W.partitionBy("name").orderBy("mean_distance", "concept"))).filter(F.col("r") <= k)
    return top.groupBy("name").agg(*(F.max(F.when(F.col("r") == i, F.col(c))).alias(f"{c}_{i}") for i in range(1, k + 1) for c in ("concept", "mean_distance")))
