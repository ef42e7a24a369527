"""Approximate nearest neighbours by largest cosine: score-aware anisotropic quantisation, four-bit table scans, exact reranking.

Vectors are scaled to length 1, so the largest cosine is the largest inner product. Each pair of dimensions has a codebook of
16 centres, thus a 4-bit code. Codebooks and codes minimise |r|^2 + (eta - 1) (r . u)^2, where r is the residual and u the vector's direction:
error along the vector changes the products that are large, so it costs eta times as much. eta follows from
THRESHOLD, the cosine from which scores matter. Codes are chosen by coordinate descent, centres by least squares.

Codebooks are fitted on SAMPLE rows at most (smallest hashes of vec_id); every row is encoded. A task scans its rows in blocks of an Arrow batch
against tables of the queries' products with all centres (two codes, a byte, at a time). Of each block a query's RERANK best and
all that are less than twice the quantisation's error below the k-th get their exact cosine in double precision; a task hands on
each query's k best. Equal vectors of a block
are scanned once and expanded to their k + 1 smallest ids, so copies displace nothing. Queries are taken in
blocks of at most QUERY_BLOCK, whose tables take TABLE_BYTES of a task's memory at most; a block is what goes to the driver and to every task.

A cosine is summed up row by row in the order of the dimensions, so that equal vectors have equal scores wherever they stand.

Vectors that are null, zero or of another length than the most frequent one, and those with null or non-finite components, take no part.
A query doesn't meet rows with its own id. Rows that repeat a query's id are one query (the least vector); repeated candidates count each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labharm.llm.common import cut, sample, shared_dir

SAMPLE, ROUNDS, THRESHOLD = 20_000, 8, 0.3
RERANK, QUERY_BLOCK, TABLE_BYTES = 128, 20_000, 128 << 20
#: Queries whose scores are in memory at once.
WIDE = 128


class Quantiser:
    """Codebooks (pair of dimensions, 16 centres, 2)."""

    def __init__(self, size: int):
        self.size, self.pairs = size, -(-size // 2)
        self.pairs += self.pairs % 2  # two codes make a byte
        self.eta = max(1.0, (size - 1) * THRESHOLD**2 / (1 - THRESHOLD**2))
        self.books = np.zeros((self.pairs, 16, 2), np.float32)
        self.error = 0.0  # what quantisation changes a score by, as a root mean square

    def _parts(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors as (pair, row, 2)."""
        out = np.zeros((len(x), 2 * self.pairs), np.float32)
        out[:, : self.size] = x
        return np.ascontiguousarray(out.reshape(len(x), self.pairs, 2).transpose(1, 0, 2))

    def _choose(self, parts: np.ndarray, codes: np.ndarray, along: np.ndarray) -> None:
        """One turn of coordinate descent over all pairs; along is the residual's product with the vector."""
        rows = np.arange(parts.shape[1])
        for s in range(self.pairs):
            r = parts[s][:, None, :] - self.books[s][None]
            u = (r * parts[s][:, None, :]).sum(2)
            rest = along - u[rows, codes[s]]
            codes[s] = ((r**2).sum(2) + (self.eta - 1) * (rest[:, None] + u) ** 2).argmin(1)
            along[:] = rest + u[rows, codes[s]]

    def _codes(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes = np.stack([((parts[s][:, None, :] - self.books[s][None]) ** 2).sum(2).argmin(1) for s in range(self.pairs)])
        along = sum(((parts[s] - self.books[s][codes[s]]) * parts[s]).sum(1) for s in range(self.pairs))
        return codes, along

    def fit(self, x: np.ndarray) -> Quantiser:
        parts = self._parts(x)
        rng = np.random.default_rng(11)
        for s in range(self.pairs):
            self.books[s] = parts[s][rng.integers(len(x), size=16)]
        codes, along = self._codes(parts)
        for _ in range(ROUNDS):
            for s in range(self.pairs):
                p, c = parts[s], codes[s]
                gap = along - ((p - self.books[s][c]) * p).sum(1) + (p * p).sum(1)  # what this pair's centre should make up for
                for j in np.unique(c):
                    mine, want = p[c == j], gap[c == j]
                    left = len(mine) * np.eye(2) + (self.eta - 1) * mine.T @ mine
                    self.books[s, j] = np.linalg.solve(left, mine.sum(0) + (self.eta - 1) * want @ mine)
                along = gap - (self.books[s][c] * p).sum(1)
            self._choose(parts, codes, along)
        residual = sum(((parts[s] - self.books[s][codes[s]]) ** 2).sum(1).mean() for s in range(self.pairs))
        self.error = float(np.sqrt(residual / self.size))
        return self

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Two codes a byte, (row, pairs / 2)."""
        out = []
        for i in range(0, len(x), 4096):
            parts = self._parts(x[i : i + 4096])
            codes, along = self._codes(parts)
            for _ in range(2):
                self._choose(parts, codes, along)
            out.append((codes[::2] | codes[1::2] << 4).T.astype(np.uint8))
        return np.concatenate(out) if out else np.zeros((0, self.pairs // 2), np.uint8)

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Products of queries with all pairs of centres: (byte of a code, its value, query)."""
        one = np.einsum("sjd,sqd->sjq", self.books, self._parts(q))
        byte = np.arange(256)
        return one[::2][:, byte & 15] + one[1::2][:, byte >> 4]


def unit(x: np.ndarray) -> np.ndarray:
    return (x / np.sqrt((x * x).sum(1))[:, None]).astype(np.float32)


def matrix(vectors: pa.Array, size: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def encode(batches: Iterator[pa.RecordBatch], quantiser, size: int) -> Iterator[pa.RecordBatch]:
    """vec_id, embedding -> the same and code."""
    for batch in batches:
        codes = quantiser.value.encode(unit(matrix(batch.column(1), size)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary())], names=["vec_id", "embedding", "code"])


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The product of each row with q, in double precision, summed up from left to right: it doesn't depend on the other rows."""
    total = np.zeros(len(x))
    for d in range(x.shape[1]):
        total += x[:, d] * q[..., d]
    return total


def near_ties(scores: np.ndarray, most: int) -> np.ndarray:
    """The rows with the largest scores, with all that tie with the last of them."""
    if len(scores) <= most:
        return np.arange(len(scores))
    return np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])


def scan(batches: Iterator[pa.RecordBatch], quantiser, queries, size: int, k: int, rerank: int) -> Iterator[pa.RecordBatch]:
    """vec_id, embedding, code -> query_id, vec_id, score of each query's k best rows here."""
    query_ids, q = queries.value
    norm, tables = np.sqrt(products(q, q)), None
    best: list[list[tuple[float, int]]] = [[] for _ in query_ids]  # -score, vec_id
    for batch in batches:
        if not batch.num_rows:
            continue
        if tables is None:
            tables = [quantiser.value.tables(unit(q[i : i + WIDE])) for i in range(0, len(q), WIDE)]
        x = matrix(batch.column(1), size)
        # equal vectors once, with their smallest ids
        row = np.ascontiguousarray(x).view(f"V{8 * size}").ravel()
        _, first, same = np.unique(row, return_index=True, return_inverse=True)
        ids = batch.column(0).to_numpy()
        order = np.lexsort((ids, same))
        start = np.searchsorted(same[order], np.arange(len(first) + 1))
        x, ids = x[first], ids[order]
        length = np.sqrt(products(x, x))
        code = np.frombuffer(b"".join(batch.column(2).take(pa.array(first)).to_pylist()), np.uint8).reshape(len(first), -1)
        for b, table in enumerate(tables):
            score = np.zeros((len(x), table.shape[2]), np.float32)
            for p in range(table.shape[0]):
                score += table[p].take(code[:, p], axis=0)
            for j, mine in enumerate(np.ascontiguousarray(score.T)):
                i = b * WIDE + j
                rows = near_ties(mine, max(rerank, k))
                exact = products(x[rows], q[i]) / (length[rows] * norm[i])
                if len(rows) < len(x):  # where many are as near, all that their error may hide
                    kth = max(np.partition(exact, len(exact) - k)[len(exact) - k], -best[i][k - 1][0] if len(best[i]) == k else -1.0)
                    if kth - 2 * quantiser.value.error < mine[rows].min():
                        rows = np.flatnonzero(mine >= kth - 2 * quantiser.value.error)
                        exact = products(x[rows], q[i]) / (length[rows] * norm[i])
                some = near_ties(exact, k + 1)
                found = best[i]
                for e, r in zip(exact[some].tolist(), rows[some].tolist()):
                    copies = ids[start[r] : min(start[r + 1], start[r] + k + 1)].tolist()
                    found += [(-e, v) for v in copies if v != query_ids[i]]
                best[i] = sorted(found)[:k]
    out = [(int(query_ids[i]), v, -s) for i, found in enumerate(best) for s, v in found]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part, but for their length."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad & F.exists("embedding", lambda x: x != 0))


def search(vectors: DataFrame, is_query, k: int = 5, rerank: int = RERANK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine): the k nearest of each row of vectors (vec_id, embedding) for which the condition is_query holds."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    frequent = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = frequent.n if frequent else 1
    rows = rows.filter(F.size("embedding") == size)
    known = sample(rows, "vec_id", SAMPLE).orderBy("vec_id").select("embedding").toArrow().column(0).combine_chunks()
    quantiser = Quantiser(size)
    if len(known):
        quantiser.fit(unit(matrix(known, size)))
    sent = spark.sparkContext.broadcast(quantiser)
    index = cut(rows.mapInArrow(lambda it: encode(it, sent, size), "vec_id long, embedding array<double>, code binary"), "nearest-index")
    queries = index.filter(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    most = max(1, min(QUERY_BLOCK, TABLE_BYTES // (quantiser.pairs // 2 * 256 * 4)))
    blocks = max(1, -(-queries.count() // most))
    path = shared_dir(spark, "nearest-queries")
    queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).write.partitionBy("block").parquet(path)
    queries = spark.read.schema("vec_id long, embedding array<double>, block int").parquet(path)
    found = None
    for b in range(blocks):
        part = queries.filter(F.col("block") == b).toArrow()
        block = spark.sparkContext.broadcast((part.column(0).to_numpy(), matrix(part.column(1).combine_chunks(), size)))
        got = index.mapInArrow(lambda it, block=block: scan(it, sent, block, size, k, rerank), "query_id long, vec_id long, score double")
        found = got if found is None else found.union(got)
    place = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
