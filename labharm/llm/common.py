"""What several operators need: the shared folder, tables that cut lineage, and words as integer arrays."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that ends a word: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text that one vectorised step takes; a longer text is a step of its own.
STEP_BYTES = 1_000_000
#: Bytes of an Arrow batch between an executor and its Python workers, which both hold it, some of it twice.
BATCH_BYTES = 2 << 20
#: Bounds of what an executor holds of a table of texts that it reads or writes: rows of a batch, bytes of a row group and of one read, which isn't of a whole row group.
TABLE_BOUNDS = {"spark.sql.parquet.columnarReaderBatchSize": 1024, "parquet.block.size": 4 << 20, "parquet.read.allocation.size": 1 << 18, "parquet.hadoop.vectored.io.enabled": "false"}

_own: dict[str, str] = {}
#: What operators keep in a Python worker from one task to the next: operator, dictionary.
_kept: list[tuple[str, dict]] = []
#: Gives freed memory back to the system, where the C library has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which the driver and all executors see.

    Only where that is unset and all runs in this process (tests) a temporary folder takes its place, and goes at exit.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if "base" not in _own:
            _own["base"] = tempfile.mkdtemp(prefix="labharm-")
            atexit.register(shutil.rmtree, _own["base"], ignore_errors=True)
        base = f"file://{_own['base']}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: lineage ends at files that outlive an executor."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Deletes the files of a table that `cut` made and nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        at, path = fs.FileSystem.from_uri(folder)
        at.delete_dir(path)


def small(df: DataFrame, most_bytes: int) -> DataFrame:
    """Hints a broadcast if df, which is cheap to read, takes most_bytes at most: 8 a column and row, and its texts' own; else leaves it to Spark."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.simpleString() in ("string", "binary")]
    size = df.agg(F.coalesce(F.sum(sum(texts, F.lit(8 * len(df.columns) + 8).cast("long"))), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= most_bytes else df


def sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """The rows of the most (or fewer) smallest hashes of column key, one row a hash; only hashes are sorted, only sampled rows are shuffled."""
    hashed = df.withColumn("__h", F.xxhash64(key))
    last = hashed.select("__h").distinct().orderBy("__h").limit(most).agg(F.max("__h")).first()[0]
    return hashed.filter(F.col("__h") <= F.lit(last)).dropDuplicates(["__h"]).drop("__h")


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers one to one (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def small_batches(spark: SparkSession) -> None:
    """Has the session bound Arrow batches by BATCH_BYTES and Parquet tables by TABLE_BOUNDS, unless it already has a bound of its own: 10,000 texts may be of any size."""
    for key, bound in {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES, **TABLE_BOUNDS}.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, bound)


def keep(operator: str) -> dict:
    """A dictionary for what this operator keeps in a Python worker. It is emptied when another one takes `steps` there: workers are used again, and would end up with the memory of all operators."""
    _kept.append((operator, {}))
    return _kept[-1][1]


def let_go(but: str | None = None) -> None:
    """Empties what operators, but for one, keep in this worker."""
    for operator, what in _kept:
        if operator != but:
            what.clear()


def give_back() -> None:
    """Gives freed memory back: a worker lives on and would keep what its largest batch took."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def steps(texts: pa.Array, most: int | None = None, operator: str | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of rows with most (STEP_BYTES) bytes of text, or one row each, for an operator that may `keep` something."""
    let_go(operator)
    most = most or STEP_BYTES
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += int(n)
    if len(sizes) > start:
        yield start, len(sizes)
    give_back()


def words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words [^\\x20\\x09-\\x0D]+ of each text (null: none), A-Z lower-cased if asked.

    Returns where each text's words begin (and the end), a code for each word, and the words by code.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten()
    flat = pc.ascii_lower(flat) if lower else flat  # after splitting: on a slice it would take the wrong bytes
    begin = parts.offsets.to_numpy().astype(np.int64)
    begin = begin - begin[0]
    kept = pc.binary_length(flat).to_numpy() > 0
    if not kept.all():  # splitting leaves an empty word at either end of a padded text
        begin = np.concatenate([[0], np.cumsum(kept)])[begin]
        flat = flat.filter(pa.array(kept))
    coded = flat.dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    return begin, coded.indices.to_numpy(), coded.dictionary


def hashes(distinct: pa.Array) -> np.ndarray:
    """64-bit hashes of strings."""
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))


def shingles(begin: np.ndarray, word: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's windows of size words, a shorter text being one window, and their number by text."""
    counts = np.diff(begin)
    n = len(word)
    with np.errstate(over="ignore"):
        out = np.zeros(max(n, 1), np.uint64)[:n]
        for k in range(min(size, n)):
            out[: n - k] += mix(word[k:] + np.uint64(k + 1)) * np.uint64(2 * k + 0x9E3779B97F4A7C15)
    made = np.where(counts >= size, counts - size + 1, 0)
    keep = np.zeros(n, bool)
    starts = begin[:-1]
    if n:
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, starts[made > 0], 1)
        np.add.at(edge, (starts + made)[made > 0], -1)
        keep = np.cumsum(edge[:-1]) > 0
    got = mix(out[keep])
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        at = np.concatenate([[0], np.cumsum(made)])
        whole = [mix(np.array([xxhash.xxh64_intdigest(word[begin[i] : begin[i + 1]].tobytes(), seed=1)], np.uint64))[0] for i in short]
        got = np.insert(got, at[short], whole)
        made[short] = 1
    return got, made


def frame(columns: dict[str, tuple[object, pa.DataType]]) -> pa.RecordBatch:
    """A record batch from arrays or lists with their types."""
    return pa.RecordBatch.from_arrays([pa.array(v, t) if not isinstance(v, pa.Array) else v.cast(t) for v, t in columns.values()], names=list(columns))
