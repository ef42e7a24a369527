"""Hard negatives by inverted lists with stored radii: an exact search for maximum inner products within windows.

Components become floor(SCALE * x), scores are integer inner products, higher ones first, ties by smaller vec_id. An anchor's positives are its best
rows of the same label, its own id left out. Around each positive's score lies a window, low percent of it up to itself; the best rows of other labels
within it are that pair's negatives. A window around a negative score is empty.

K-means on SAMPLE vectors at most (smallest hashes of vec_id) gives the centres of CLUSTERS lists; every row is put into the list of its nearest centre,
and each list's radius, its farthest row's distance, is stored. For an anchor a and a list with centre c and radius r, all scores lie within a.c - |a|r and
a.c + |a|r (Cauchy-Schwarz). Lists whose interval misses the window are skipped. The PROBES lists with the highest upper bounds are visited first, which gives
each search a k-th score; of the other lists those are visited whose upper bound isn't strictly below it, and while a task goes on, its own k-th score
counts, too. So nothing is lost, however loose the bounds are; on equality a list is visited for the sake of ties.

The index lies sorted by list; rows of one list, however many, are spread over partitions by vec_id. Anchors are searched for in blocks of ANCHOR_BLOCK: a
block's vectors, windows and k-th scores are what the driver and each task hold besides a batch of rows. Tasks give k rows a search at most.

Rows without label, vec_id or vector, with null or non-finite components, with components beyond +-LARGEST after scaling (products needn't fit a long), or of another length than the
most frequent one take no part. vec_id is a key: of several rows with one vec_id the least (label, then vector) stands. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labharm.llm.common import cut, sample, shared_dir

SCALE, SAMPLE, CLUSTERS, ROUNDS, PROBES, ANCHOR_BLOCK = 256, 20_000, 256, 10, 8, 20_000
LARGEST = 1 << 26
#: Searches and rows whose scores are in memory at once.
WIDE, DEEP = 4096, 512
NONE = np.iinfo(np.int64)
FOUND = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


class Lists(NamedTuple):
    """Centres (list, component) and radii of the lists."""

    centres: np.ndarray
    radii: np.ndarray


class Searches(NamedTuple):
    """Vectors by anchor; and by search: its anchor, label, whether that label is sought, the window, what it stands for, and the k-th score and id so far."""

    vectors: np.ndarray
    of: np.ndarray
    label: np.ndarray
    same: bool
    low: np.ndarray
    high: np.ndarray
    anchor_id: np.ndarray
    positive_id: np.ndarray
    positive_score: np.ndarray
    kth: np.ndarray
    kth_id: np.ndarray


def usable(vectors: DataFrame, label: Column) -> DataFrame:
    """vec_id, label and v (whole components as longs) of the rows that take part, a row a vec_id, but for their length."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > LARGEST / SCALE))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad & (F.size("v") > 0))
    rows = rows.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("least")).select("vec_id", "least.label", "least.v")


def matrix(vectors: pa.Array, size: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None]


def kmeans(x: np.ndarray, clusters: int = CLUSTERS) -> np.ndarray:
    """Centres; fewer where fewer vectors differ."""
    x = np.unique(x, axis=0) if len(x) else x
    centres = x[np.random.default_rng(5).permutation(len(x))[:clusters]].copy()
    for _ in range(ROUNDS):
        nearest = distances(x, centres).argmin(1) if len(x) else np.zeros(0, int)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        counts = np.bincount(nearest, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _listed(batches: Iterator[pa.RecordBatch], centres, size: int) -> Iterator[pa.RecordBatch]:
    """vec_id, label, v -> the same, list and gap, the distance to its centre."""
    for batch in batches:
        x = matrix(batch.column(2), size)
        nearest = np.concatenate([distances(x[i : i + 8192], centres.value).argmin(1) for i in range(0, len(x), 8192)] or [np.zeros(0, int)])
        gap = np.sqrt(((x - centres.value[nearest]) ** 2).sum(1)) if len(x) else np.zeros(0)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest, pa.int32()), pa.array(gap, pa.float64())], names=["vec_id", "label", "v", "list", "gap"])


def index(rows: DataFrame, size: int) -> tuple[DataFrame, Lists]:
    """The rows sorted by list (vec_id, label, v, list), and the lists."""
    spark = rows.sparkSession
    known = sample(rows, "vec_id", SAMPLE).orderBy("vec_id").select("v").toArrow().column(0).combine_chunks()
    centres = kmeans(matrix(known, size))
    if not len(centres):
        centres = np.zeros((1, size))
    sent = spark.sparkContext.broadcast(centres)
    listed = rows.mapInArrow(lambda batches: _listed(batches, sent, size), "vec_id long, label long, v array<long>, list int, gap double")
    at = cut(listed.repartitionByRange("list", "vec_id").sortWithinPartitions("list", "vec_id"), "negatives-index")
    radii = np.full(len(centres), -1.0)  # -1: no row
    for r in at.groupBy("list").agg(F.max("gap").alias("gap")).collect():  # a row a list
        radii[r.list] = r.gap
    return at, Lists(centres, radii)


def exact(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Products of whole numbers kept as doubles; where they could pass 2**53, in 64-bit integers."""
    if not a.size or not x.size or np.abs(a).max() * np.abs(x).max() * a.shape[1] < 2**53:
        return (a @ x.T).astype(np.int64)
    return a.astype(np.int64) @ x.astype(np.int64).T


def bounds(a: np.ndarray, lists: Lists, at) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of the scores of vectors a with the rows of list(s) at, a little wider than rounding may err."""
    centre, radius = lists.centres[at], lists.radii[at]
    length = np.sqrt((a * a).sum(1))
    middle = a @ centre.T
    length, reach = (length[:, None], np.sqrt((centre * centre).sum(1))[None]) if middle.ndim == 2 else (length, np.sqrt((centre * centre).sum()))
    slack = 1e-9 * (1 + length * (reach + radius))
    return middle - length * radius - slack, middle + length * radius + slack


def first_lists(s: Searches, lists: Lists, probes: int) -> np.ndarray:
    """Which lists a search visits first (search, list): of those that meet its window the ones with the highest upper bounds."""
    out = np.zeros((len(s.of), len(lists.radii)), bool)
    for i in range(0, len(s.of), WIDE):
        low, high = bounds(s.vectors[s.of[i : i + WIDE]], lists, slice(None))
        meets = (high >= s.low[i : i + WIDE, None]) & (low <= s.high[i : i + WIDE, None]) & (lists.radii >= 0)[None]
        high = np.where(meets, high, -np.inf)
        best = np.argsort(-high, axis=1, kind="stable")[:, :probes]
        np.put_along_axis(out[i : i + WIDE], best, True, axis=1)
        out[i : i + WIDE] &= meets
    return out


class Best:
    """The k best (score, id) of each search found in a task."""

    def __init__(self, n: int, k: int):
        self.k, self.score, self.id = k, np.full((n, k), NONE.min), np.full((n, k), NONE.max)

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        mine = np.unique(q)
        q = np.concatenate([q, np.repeat(mine, self.k)])
        score, ids = np.concatenate([score, self.score[mine].ravel()]), np.concatenate([ids, self.id[mine].ravel()])
        order = np.lexsort((ids, ~score, q))
        q, score, ids = q[order], score[order], ids[order]
        start = np.searchsorted(q, mine)
        take = start[:, None] + np.arange(self.k)[None]  # each search has k entries at least
        self.score[mine], self.id[mine] = score[take], ids[take]


def _search(batches: Iterator[pa.RecordBatch], searches, lists, size: int, k: int, probes: int, later: bool, scored) -> Iterator[pa.RecordBatch]:
    """vec_id, label, v, list -> FOUND: what the rows here add to each search. later: the lists that weren't visited first."""
    s, ls = searches.value, lists.value
    first, best, compared = None, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if first is None:
            first, best = first_lists(s, ls, probes), Best(len(s.of), k)
        ids, label, at = (batch.column(c).to_numpy() for c in (0, 1, 3))
        x = matrix(batch.column(2), size)
        edges = np.flatnonzero(np.diff(at, prepend=-1, append=-1))
        for i, j in zip(edges[:-1], edges[1:]):
            low, high = (b[s.of] for b in bounds(s.vectors, ls, at[i]))
            visits = (high >= s.low) & (low <= s.high) & (first[:, at[i]] != later)
            if later:
                visits &= high >= np.maximum(s.kth, best.score[:, k - 1])
            todo = np.flatnonzero(visits)
            for b in range(0, len(todo), WIDE):
                for d in range(i, j, DEEP):
                    q, r = todo[b : b + WIDE], slice(d, min(j, d + DEEP))
                    anchors, place = np.unique(s.of[q], return_inverse=True)
                    compared += len(anchors) * (r.stop - r.start)
                    score = exact(s.vectors[anchors], x[r])[place]
                    fits = ((label[r][None] == s.label[q][:, None]) == s.same) & (score >= s.low[q][:, None]) & (score <= s.high[q][:, None]) & (ids[r][None] != s.anchor_id[q][:, None])
                    for kth, kth_id in ((s.kth[q], s.kth_id[q]), (best.score[q, k - 1], best.id[q, k - 1])):
                        fits &= (score > kth[:, None]) | (score == kth[:, None]) & (ids[r][None] < kth_id[:, None])
                    row, col = np.nonzero(fits)
                    if len(row):
                        best.add(q[row], score[row, col], ids[r][col])
    scored.add(compared)
    if best is not None:
        q, c = np.nonzero(best.id != NONE.max)
        columns = (s.anchor_id[q], s.positive_id[q], s.positive_score[q], best.id[q, c], best.score[q, c])
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in columns], names=["anchor_id", "positive_id", "positive_score", "vec_id", "score"])


def top(found: DataFrame, k: int) -> DataFrame:
    place = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def find(at: DataFrame, lists: Lists, s: Searches, size: int, k: int, probes: int, scored) -> DataFrame:
    """FOUND and rank: the k best rows of each search, in two turns."""
    spark = at.sparkSession
    sent = spark.sparkContext.broadcast(lists)

    def turn(searches: Searches, later: bool) -> DataFrame:
        block = spark.sparkContext.broadcast(searches)
        return at.mapInArrow(lambda batches: _search(batches, block, sent, size, k, probes, later, scored), FOUND)

    early = cut(top(turn(s, False), k), "negatives-first")
    last = early.filter(F.col("rank") == k).select("anchor_id", "positive_id", "score", "vec_id").toArrow()  # a row a search of this block
    known = {(a, p): (score, i) for a, p, score, i in zip(*(c.to_pylist() for c in last.columns))}
    kth = [known.get((a, p), (NONE.min, NONE.max)) for a, p in zip(s.anchor_id.tolist(), s.positive_id.tolist())]
    kth = np.array(kth, np.int64).reshape(-1, 2)
    return cut(top(early.drop("rank").unionByName(turn(s._replace(kth=kth[:, 0], kth_id=kth[:, 1]), True)), k), "negatives-found")


def _searches(vectors: np.ndarray, of: np.ndarray, label: np.ndarray, same: bool, low, high, anchor_id: np.ndarray, positive_id, positive_score) -> Searches:
    whole = lambda x: np.array(x, np.int64).reshape(len(of))
    return Searches(vectors, of, label, same, whole(low), whole(high), anchor_id, whole(positive_id), whole(positive_score), np.full(len(of), NONE.min), np.full(len(of), NONE.max))


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, k: int = 5, low: int = 80, probes: int = PROBES, block: int = ANCHOR_BLOCK, scored=None) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score of the rows of vectors (vec_id, embedding, label) for which is_anchor holds.

    label replaces the column label; low is the window's lower end in percent of the positive's score; scored, an accumulator, counts the pairs whose score was computed.
    """
    spark = vectors.sparkSession
    scored = scored or spark.sparkContext.accumulator(0)
    rows = usable(vectors, F.col("label") if label is None else label)
    frequent = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = frequent.n if frequent else 1
    at, lists = index(rows.filter(F.size("v") == size), size)
    anchors = at.filter(is_anchor).select("vec_id", "label", "v")
    blocks = max(1, -(-anchors.count() // block))
    path = shared_dir(spark, "negatives-anchors")
    anchors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).write.partitionBy("block").parquet(path)
    anchors = spark.read.schema("vec_id long, label long, v array<long>, block int").parquet(path)
    out = spark.createDataFrame([], f"{FOUND}, rank int")
    for b in range(blocks):
        part = anchors.filter(F.col("block") == b).toArrow()
        ids, labels = (part.column(c).to_numpy() for c in (0, 1))
        x, n = matrix(part.column(2).combine_chunks(), size), len(ids)
        whole = _searches(x, np.arange(n), labels, True, [NONE.min] * n, [NONE.max] * n, ids, [0] * n, [0] * n)
        near = find(at, lists, whole, size, positives, probes, scored).select("anchor_id", "vec_id", "score").toArrow()  # positives of this block
        a, p, score = (c.to_pylist() for c in near.columns)
        kept = [i for i, v in enumerate(score) if v >= 0]
        place = {v: i for i, v in enumerate(ids.tolist())}
        of = np.array([place[a[i]] for i in kept], np.int64)
        scores = [score[i] for i in kept]
        windows = _searches(x, of, labels[of], False, [-(-low * v // 100) for v in scores], scores, ids[of], [p[i] for i in kept], scores)
        out = out.unionByName(find(at, lists, windows, size, k, probes, scored))
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
