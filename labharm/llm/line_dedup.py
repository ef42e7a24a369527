"""Line dedup: sharded cuckoo filters over exact reference counts.

State, in a folder that driver and executors share, one subfolder a version:
    refs      digest, refs: for every line key the number of documents that hold it (exact, 128-bit digests)
    filters   shard, slots: a cuckoo filter a shard of the keys that stand in at least min_docs documents
    state     version, shards, min_docs, min_chars; written last, so a version that a lost job left unfinished counts for nothing

`insert` and `delete` add documents to the counts or take them out, and move the keys that cross the threshold into or
out of the filters. Because the counts are exact and cuckoo filters can delete, deleting what was inserted leads back
to the state before. `apply` drops lines: a line goes if its shard's filter holds its key. What a filter wrongly says
to hold is found beforehand, by probing it with every other key of the exact table; so the result is exact.

Filters are broadcast while they have at most BROADCAST_BYTES in all; beyond that lines meet the exact table in a join.

A line's key is the line without white space at both ends, A-Z lower-cased. Null and empty texts are one empty line.
Keys shorter than min_chars code points are never counted nor dropped. Each row is a document of its own, repeated
rows and null doc_ids included. Columns other than text stay as they are; those named as what `apply` adds (ADDED) are refused.

A folder that holds a state is opened at its last version and must have been made with the same parameters. Deleting documents that hold a line more often than
it was inserted is refused, and leaves the state as it is. (Documents that were never inserted, but whose lines were by others, can't be told apart.)
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labharm.llm.common import LOWER, SPACE, UPPER, mix, shared_dir

BROADCAST_BYTES = 64 << 20
#: Keys that a shard holds at about this number of shards; slots of a bucket; the fullest that a filter is planned.
SHARD_KEYS, SLOTS, LOAD = 500_000, 4, 0.7
#: Columns of `apply`, its own ones included.
ADDED = ("n_lines", "n_dropped", "kept", "__mask", "__row", "__at")
#: Keys wrongly held by the filters, at most, for the broadcast way.
WRONG_KEYS = 100_000


class Cuckoo:
    """A cuckoo filter with 32-bit fingerprints; all operations take arrays of 128-bit digests as (n, 2) uint64."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots.reshape(-1, SLOTS)

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = 1
        while buckets * SLOTS * LOAD < keys:
            buckets *= 2
        return cls(np.zeros(buckets * SLOTS, np.uint32))

    def _marks(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(digests[:, 0])
        return np.maximum(h.astype(np.uint32), 1), ((h >> np.uint64(32)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _other(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(mark.astype(np.uint64)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def holds(self, digests: np.ndarray) -> np.ndarray:
        mark, bucket = self._marks(digests)
        there = (self.slots[bucket] == mark[:, None]).any(1)
        return there | (self.slots[self._other(mark, bucket)] == mark[:, None]).any(1)

    def _settle(self, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Puts marks into free slots of their buckets; returns which found none."""
        order = np.argsort(bucket, kind="stable")
        b = bucket[order]
        rank = np.arange(len(b)) - np.searchsorted(b, b)
        free = self.slots == 0
        places = np.argsort(~free[b], axis=1, kind="stable")  # a bucket's free slots first
        fits = rank < free[b].sum(1)
        self.slots[b[fits], places[fits, rank[fits]]] = mark[order[fits]]
        left = np.ones(len(b), bool)
        left[order[fits]] = False
        return left

    def insert(self, digests: np.ndarray) -> bool:
        """False if the filter is too full; it is then to be built anew, larger."""
        mark, bucket = self._marks(digests)
        rng = np.random.default_rng(7)
        for turn in range(500):
            left = self._settle(mark, bucket)
            mark, bucket = mark[left], bucket[left]
            if not len(mark):
                return True
            if turn == 0:
                bucket = self._other(mark, bucket)
                continue
            # both buckets are full: one mark a bucket takes the place of another, which goes on to its other bucket
            _, one = np.unique(bucket, return_index=True)
            slot = rng.integers(SLOTS, size=len(one))
            out = self.slots[bucket[one], slot]
            self.slots[bucket[one], slot] = mark[one]
            mark[one], bucket[one] = out, self._other(out, bucket[one])
        return False

    def delete(self, digests: np.ndarray) -> None:
        """Takes out keys that were inserted."""
        mark, bucket = self._marks(digests)
        for turn in range(2):
            while len(mark):
                _, one = np.unique(bucket * (1 << 32) + mark, return_index=True)
                at = self.slots[bucket[one]] == mark[one, None]
                found = at.any(1)
                self.slots[bucket[one[found]], at[found].argmax(1)] = 0
                gone = np.zeros(len(mark), bool)
                gone[one[found]] = True
                if not found.any():
                    break
                mark, bucket = mark[~gone], bucket[~gone]
            bucket = self._other(mark, bucket)


def keys(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    return F.transform(lines(text), lambda x: F.translate(F.btrim(x, F.lit(SPACE)), UPPER, LOWER))


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def digests(text: Column, min_chars: int) -> Column:
    """128-bit digests of the keys, empty for keys that are too short to count."""
    return F.transform(keys(text), lambda k: F.when(F.char_length(k) >= min_chars, F.unhex(F.md5(k))).otherwise(F.unhex(F.lit(""))))


def as_ints(values: pa.Array) -> np.ndarray:
    """Digests of 16 bytes as rows of two uint64; there must be no others among them."""
    return np.frombuffer(b"".join(values.to_pylist()), np.uint64).reshape(-1, 2)


def shard_of(d: np.ndarray, shards: int) -> np.ndarray:
    return (d[:, 1] % np.uint64(shards)).astype(np.int32)


def probe(d: np.ndarray, filters: dict[int, np.ndarray], shards: int) -> np.ndarray:
    held = np.zeros(len(d), bool)
    shard = shard_of(d, shards)
    order = np.argsort(shard, kind="stable")
    at = np.searchsorted(shard[order], np.arange(shards + 1))
    for k, slots in filters.items():
        rows = order[at[k] : at[k + 1]]
        if len(rows):
            held[rows] = Cuckoo(slots).holds(d[rows])
    return held


class LineDedup:
    def __init__(self, spark: SparkSession, folder: str | None = None, min_docs: int = 10, min_chars: int = 1):
        self.spark, self.min_docs, self.min_chars = spark, min_docs, min_chars
        self.folder = folder or shared_dir(spark, "line-dedup")
        self.version, self.shards = 0, 0
        if folder:
            self._open()

    def _open(self) -> None:
        try:
            last = self.spark.read.parquet(f"{self.folder}/state").orderBy(F.desc("version")).first()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        if last:
            if (last.min_docs, last.min_chars) != (self.min_docs, self.min_chars):
                raise ValueError(f"{self.folder} was made with min_docs={last.min_docs}, min_chars={last.min_chars}")
            self.version, self.shards = last.version, last.shards

    def _path(self, name: str, version: int | None = None) -> str:
        return f"{self.folder}/{name}-{self.version if version is None else version}"

    @property
    def refs(self) -> DataFrame:
        return self.spark.read.schema("digest binary, refs long").parquet(self._path("refs"))

    @property
    def filters(self) -> DataFrame:
        return self.spark.read.schema("shard int, slots binary").parquet(self._path("filters"))

    def _counts(self, docs: DataFrame) -> DataFrame:
        once = docs.select(F.explode(F.array_distinct(digests(F.col("text"), self.min_chars))).alias("digest"))
        return once.filter("length(digest) > 0").groupBy("digest").agg(F.count("*").alias("refs"))

    def insert(self, docs: DataFrame) -> LineDedup:
        return self._move(self._counts(docs))

    def delete(self, docs: DataFrame) -> LineDedup:
        """Takes out documents that were inserted before."""
        return self._move(self._counts(docs).withColumn("refs", -F.col("refs")), less=True)

    def _move(self, change: DataFrame, less: bool = False) -> LineDedup:
        first, old, new = self.version == 0, self.version, self.version + 1
        if not first:
            before = self.refs
            change = before.withColumn("was", F.col("refs")).union(change.withColumn("was", F.lit(0).cast("long"))).groupBy("digest").agg(F.sum("refs").alias("refs"), F.sum("was").alias("was")).filter("refs <> 0 or was > 0")
        else:
            change = change.withColumn("was", F.lit(0).cast("long"))
        path = self._path("moved", new)
        change.write.mode("overwrite").parquet(path)  # what a lost job left of this version goes
        moved = self.spark.read.schema("digest binary, refs long, was long").parquet(path)
        if less and moved.filter("refs < 0").limit(1).count():
            raise ValueError("documents are to be deleted that hold lines which were never inserted so often")
        moved.filter("refs > 0").select("digest", "refs").write.mode("overwrite").parquet(self._path("refs", new))
        previous = None if first else self.filters
        self.version = new
        try:
            if first or not self._update(moved, previous):
                self._rebuild()
            self.spark.createDataFrame([(new, self.shards, self.min_docs, self.min_chars)], "version int, shards int, min_docs int, min_chars int").coalesce(1).write.mode("append").parquet(f"{self.folder}/state")
        except BaseException:
            self.version = old
            raise
        return self

    def _rebuild(self) -> None:
        hot = self.refs.filter(F.col("refs") >= self.min_docs)
        self.shards = max(8, hot.count() // SHARD_KEYS + 1)
        shards = self.shards

        def build(d: pd.DataFrame) -> pd.DataFrame:
            k = as_ints(pa.array(d.digest))
            size = len(k)
            while not (filter_ := Cuckoo.sized(size)).insert(k):
                size = 2 * size + 1
            return pd.DataFrame({"shard": [int(d.shard.iloc[0])], "slots": [filter_.slots.tobytes()]})

        self._sharded(hot).groupBy("shard").applyInPandas(build, "shard int, slots binary").write.mode("overwrite").parquet(self._path("filters"))

    def _sharded(self, df: DataFrame) -> DataFrame:
        shards = self.shards

        @F.pandas_udf("int")
        def shard(d: pd.Series) -> pd.Series:
            return pd.Series(shard_of(as_ints(pa.array(d)), shards))

        return df.withColumn("shard", shard("digest"))

    def _update(self, moved: DataFrame, previous: DataFrame) -> bool:
        """Moves keys into and out of the filters; False if a filter is too full."""
        n = self.min_docs
        crossed = self._sharded(moved.filter((F.col("refs") >= n) != (F.col("was") >= n)).select("digest", (F.col("refs") >= n).alias("up")))

        def move(old: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
            shard = int((old if len(old) else d).shard.iloc[0])
            up, down = (as_ints(pa.array(d.digest[d.up == x])) if len(d) else np.zeros((0, 2), np.uint64) for x in (True, False))
            filter_ = Cuckoo(np.frombuffer(old.slots.iloc[0], np.uint32).copy()) if len(old) else Cuckoo.sized(2 * len(up))
            filter_.delete(down)
            room = np.count_nonzero(filter_.slots) + len(up) <= LOAD * filter_.slots.size
            whole = bool(room and filter_.insert(up))
            return pd.DataFrame({"shard": [shard], "slots": [filter_.slots.tobytes() if whole else None]})

        previous.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(move, "shard int, slots binary").write.mode("overwrite").parquet(self._path("filters"))
        return self.filters.filter("slots is null").limit(1).count() == 0

    def apply(self, docs: DataFrame) -> DataFrame:
        """docs with n_lines, n_dropped and kept; the documents must be among those inserted."""
        taken = set(ADDED) & set(docs.columns)
        if taken:
            raise ValueError(f"columns that are added are there already: {sorted(taken)}")
        size = self.filters.agg(F.sum(F.length("slots"))).first()[0] or 0
        held = self._held() if size <= BROADCAST_BYTES else None
        return self._by_filters(docs, *held) if held is not None else self._by_join(docs)

    def _held(self):
        """Broadcast filters, and the keys below the threshold that they wrongly hold (None: too many)."""
        filters = {r.shard: np.frombuffer(r.slots, np.uint32) for r in self.filters.collect()}
        sent, shards = self.spark.sparkContext.broadcast(filters), self.shards

        @F.pandas_udf("boolean")
        def hit(d: pd.Series) -> pd.Series:
            return pd.Series(probe(as_ints(pa.array(d)), sent.value, shards))

        wrong = [bytes(r.digest) for r in self.refs.filter(F.col("refs") < self.min_docs).filter(hit("digest")).select("digest").limit(WRONG_KEYS + 1).collect()]
        return None if len(wrong) > WRONG_KEYS else (sent, self.spark.sparkContext.broadcast(frozenset(wrong)))

    def _by_filters(self, docs: DataFrame, sent, wrong) -> DataFrame:
        shards = self.shards

        @F.arrow_udf("array<boolean>")
        def mask(lists: pa.Array) -> pa.Array:
            flat = lists.flatten()
            sizes = np.fromiter((len(x) for x in flat.to_pylist()), np.int64, len(flat))
            out = np.zeros(len(flat), bool)
            rows = np.flatnonzero(sizes == 16)
            out[rows] = probe(as_ints(flat), sent.value, shards)
            if wrong.value:
                for i in rows[out[rows]]:
                    out[i] = flat[int(i)].as_py() not in wrong.value
            offsets = lists.offsets.to_numpy()
            return pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pa.array(out))

        return self._drop(docs.withColumn("__mask", mask(digests(F.col("text"), self.min_chars))))

    def _by_join(self, docs: DataFrame) -> DataFrame:
        """The exact way without filters in memory: lines meet the exact table, documents get their line numbers back."""
        path = shared_dir(self.spark, "line-dedup-docs")
        docs.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
        docs = self.spark.read.parquet(path)
        hot = self.refs.filter(F.col("refs") >= self.min_docs).select("digest")
        found = docs.select("__row", F.posexplode(digests(F.col("text"), self.min_chars)).alias("pos", "digest")).join(hot, "digest", "left_semi")
        found = found.groupBy("__row").agg(F.collect_list("pos").alias("__at"))
        marked = docs.join(found, "__row", "left")
        n = F.size(lines(F.col("text")))
        return self._drop(marked.withColumn("__mask", F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array_contains(F.coalesce("__at", F.array().cast("array<int>")), i))).drop("__row", "__at"))

    def _drop(self, docs: DataFrame) -> DataFrame:
        kept = F.filter(lines(F.col("text")), lambda x, i: ~F.get("__mask", i))
        return docs.withColumns({"n_lines": F.size("__mask").cast("long"), "n_dropped": F.size(F.filter("__mask", lambda x: x)).cast("long"), "kept": F.array_join(kept, "\n")}).drop("__mask")
