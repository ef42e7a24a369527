"""Token-ID output: documents as token ids in sorted-string-table shards, and lookups in them.

A shard holds documents in ascending key order:

    data blocks   zstd frames of entries: varint shared, varint fresh, varint size, fresh key bytes, ids
    block index   per block its first key, offset and size (sparse: one entry a block)
    Bloom filter  BITS bits a key, PROBES probes
    footer        fixed size, with the places of index and filter, counts, id width and MAGIC

A key is the doc_id as 9 bytes that sort like it, null first; each entry shares a prefix with the one before, and a
block's first entry shares nothing. Ids are little-endian, 2 bytes wide if the vocabulary fits, else 4.

Documents are range-partitioned by doc_id, so shard k's keys precede shard k + 1's. A task writes its shard under a
name of its own and moves it into place, so a task that runs again or twice leaves one whole shard.

A null or empty text is the end id alone. Repeated doc_ids are all kept, in the order of their texts. Further columns are ignored.
"""

from __future__ import annotations

import bisect
import itertools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labharm.llm.common import keep, steps, words

MAGIC = b"LHSST1\0\0"
FOOTER = struct.Struct("<QQQQQQI4x8s")
BLOCK_BYTES, BITS, PROBES = 1 << 18, 10, 7
#: Words that a Python worker keeps with their ids, at some 30 bytes a word.
CACHE_WORDS = 2_000_000
#: Bytes of text encoded at once: the more, the fewer words to look up.
ENCODE_BYTES = 4_000_000

_tokenizers: dict[str, object] = keep("token_tables")
_cache: dict[tuple[str, int], Known] = keep("token_tables")


def key_of(doc_id: int | None) -> bytes:
    return b"\0" * 9 if doc_id is None else b"\1" + struct.pack(">Q", doc_id + 2**63)


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key[1:])[0] - 2**63 if key[0] else None


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: memoryview, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        byte = data[at]
        n |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return n, at


def bloom_bits(keys: list[bytes], size: int) -> np.ndarray:
    """The bit numbers of keys in a filter of size bits, a row each."""
    h = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))
    with np.errstate(over="ignore"):
        return (h[:, None] + np.arange(PROBES, dtype=np.uint64) * ((h >> np.uint64(32)) | np.uint64(1))[:, None]) % np.uint64(size)


class Writer:
    """Writes one shard to a file-like sink; keys must come in ascending order."""

    def __init__(self, sink, width: int):
        self.sink, self.width, self.at = sink, width, 0
        self.block, self.first, self.last = bytearray(), b"", b""
        self.index: list[tuple[bytes, int, int]] = []
        self.keys: list[bytes] = []
        self.tokens = 0
        self.pack = zstandard.ZstdCompressor(level=1)

    def add(self, key: bytes, ids: np.ndarray) -> None:
        if key < self.last:
            raise ValueError("keys must ascend")
        shared = 0
        if self.block:
            while shared < len(key) and key[shared] == self.last[shared]:
                shared += 1
        else:
            self.first = key
        value = ids.astype(f"<u{self.width}").tobytes()
        self.block += varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:] + value
        self.last = key
        self.keys.append(key)
        self.tokens += len(ids)
        if len(self.block) >= BLOCK_BYTES:
            self._flush()

    def _put(self, data: bytes) -> tuple[int, int]:
        self.sink.write(data)
        self.at += len(data)
        return self.at - len(data), len(data)

    def _flush(self) -> None:
        if self.block:
            self.index.append((self.first, *self._put(self.pack.compress(bytes(self.block)))))
            self.block = bytearray()

    def finish(self) -> None:
        self._flush()
        index = self._put(b"".join(k + struct.pack("<QQ", *place) for k, *place in self.index))
        bits = np.zeros(max(64, BITS * len(self.keys)) // 8 * 8, bool)
        for i in range(0, len(self.keys), 1 << 16):
            bits[bloom_bits(self.keys[i : i + (1 << 16)], len(bits))] = True
        bloom = self._put(np.packbits(bits).tobytes())
        self._put(FOOTER.pack(*index, *bloom, len(self.keys), self.tokens, self.width, MAGIC))


class Reader:
    """Reads one shard: get() by key, scan() in order."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        *places, self.n_docs, self.n_tokens, self.width, magic = FOOTER.unpack(file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard")
        index = file.read_at(places[1], places[0])
        self.index = [(index[i : i + 9], *struct.unpack("<QQ", index[i + 9 : i + 25])) for i in range(0, len(index), 25)]
        self.bloom = np.frombuffer(file.read_at(places[3], places[2]), np.uint8)

    def may_hold(self, key: bytes) -> bool:
        bits = bloom_bits([key], 8 * len(self.bloom))[0].astype(np.int64)
        return bool((self.bloom[bits >> 3] >> (7 - (bits & 7)) & 1).all())

    def _entries(self, block: int) -> Iterator[tuple[bytes, np.ndarray]]:
        data = memoryview(zstandard.ZstdDecompressor().decompress(self.file.read_at(self.index[block][2], self.index[block][1])))
        at, key = 0, b""
        while at < len(data):
            shared, at = read_varint(data, at)
            fresh, at = read_varint(data, at)
            size, at = read_varint(data, at)
            key = key[:shared] + bytes(data[at : at + fresh])
            at += fresh
            yield key, np.frombuffer(data[at : at + size], f"<u{self.width}")
            at += size

    def scan(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for block in range(len(self.index)):
            yield from self._entries(block)

    def get(self, key: bytes) -> list[np.ndarray]:
        """The ids of every document with this key."""
        if not self.index or not self.may_hold(key):
            return []
        found = []
        firsts = [x[0] for x in self.index]
        block = max(0, bisect.bisect_left(firsts, key) - 1)  # a repeated key may have begun in the block before
        while block < len(self.index) and firsts[block] <= key:
            found += [ids for k, ids in self._entries(block) if k == key]
            block += 1
        return found


def tokenizer(path: str):
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        _tokenizers[path] = Tokenizer.from_file(path)
    return _tokenizers[path]


class Known:
    """Ids of words by the words' 128-bit digests, in sorted runs each of which is at least twice as long as the next."""

    def __init__(self, kind: str):
        self.ids, self.used, self.words = np.zeros(1 << 16, kind), 0, 0
        self.runs: list[tuple[np.ndarray, ...]] = []

    def find(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each word begin (-1: not known) and how many they are."""
        at, size = np.full(len(digests), -1, np.int64), np.zeros(len(digests), np.int64)
        todo = np.arange(len(digests))
        for first, second, start, n in self.runs:
            place = np.minimum(np.searchsorted(first, digests[todo, 0]), len(first) - 1)
            same = (first[place] == digests[todo, 0]) & (second[place] == digests[todo, 1])
            at[todo[same]], size[todo[same]] = start[place[same]], n[place[same]]
            todo = todo[~same]
        return at, size

    def add(self, digests: np.ndarray, fresh: np.ndarray, sizes: np.ndarray) -> None:
        """fresh: the ids of all these words, one after another."""
        start = self.used + np.concatenate([[0], np.cumsum(sizes[:-1])]).astype(np.int64)
        while self.used + len(fresh) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(fresh)] = fresh
        self.used, self.words = self.used + len(fresh), self.words + len(sizes)
        parts = [(digests[:, 0], digests[:, 1], start.astype(np.uint32 if self.used < 1 << 32 else np.int64), sizes.astype(np.int32))]
        total = len(sizes)
        while self.runs and len(self.runs[-1][0]) < 2 * total:
            parts.append(self.runs.pop())
            total += len(parts[-1][0])
        columns = [list(x) for x in zip(*parts)]
        del parts
        order, run = np.argsort(np.concatenate(columns[0]), kind="stable"), []
        while columns:  # one after another, so that no two columns are there twice
            run.append(np.concatenate(columns.pop(0))[order])
        self.runs.append(tuple(run))


def _encoded(missing: list[str], t, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of single words, one after another, and how many each has; some thousands at a time."""
    flat, sizes = [], []
    for i in range(0, len(missing), 4000):
        ids = [x.ids for x in t.encode_batch_fast(missing[i : i + 4000], add_special_tokens=False)]
        sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        flat.append(np.fromiter(itertools.chain.from_iterable(ids), kind, int(sizes[-1].sum())))
    return np.concatenate(flat), np.concatenate(sizes)


def encode(texts: pa.Array, path: str, width: int, by_word: bool) -> Iterator[np.ndarray]:
    """Token ids of each text. by_word: for tokenizers that drop white space and never join over it, words once seen are looked up."""
    t, kind = tokenizer(path), f"<u{width}"
    if not by_word:
        for x in t.encode_batch_fast([x or "" for x in texts.to_pylist()], add_special_tokens=False):
            yield np.array(x.ids, kind)
        return
    cache = _cache.setdefault((path, width), Known(kind))
    begin, code, vocabulary = words(texts, lower=False)
    known = vocabulary.to_pylist()
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, known)), ">u8").reshape(-1, 2).astype(np.uint64)
    if cache.words + len(known) > CACHE_WORDS:
        cache = _cache[path, width] = Known(kind)
    at, sizes = cache.find(digests)
    missing = np.flatnonzero(at < 0)
    if len(missing):
        cache.add(digests[missing], *_encoded([known[i] for i in missing], t, kind))
        at[missing], sizes[missing] = cache.find(digests[missing])
    flat = cache.ids
    counts = sizes[code]
    ends = np.concatenate([[0], np.cumsum(counts)])
    out = flat[np.repeat(at[code] - ends[:-1], counts) + np.arange(ends[-1])] if len(code) else flat[:0]
    for a, z in itertools.pairwise(begin):
        yield out[ends[a] : ends[z]]


def place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_shard(batches: Iterator[pa.RecordBatch], uri: str, path: str, end_id: int, width: int, by_word: bool) -> Iterator[pa.RecordBatch]:
    """doc_id, text in order -> one shard; yields its manifest row, or none if no document came."""
    shard = TaskContext.get().partitionId()
    store, folder = place(uri)
    mine, final = f"{folder}/.{shard:06d}-{uuid.uuid4().hex}", f"{folder}/shard-{shard:06d}.sst"
    end = np.array([end_id], f"<u{width}")
    writer = sink = None
    for batch in batches:
        for a, z in steps(batch.column(1), ENCODE_BYTES, "token_tables"):
            if writer is None:
                store.create_dir(folder, recursive=True)
                sink = store.open_output_stream(mine)
                writer = Writer(sink, width)
            for doc_id, ids in zip(batch.column(0)[a:z].to_pylist(), encode(batch.column(1)[a:z], path, width, by_word)):
                writer.add(key_of(doc_id), np.concatenate([ids, end]))
    if writer is not None:
        writer.finish()
        sink.close()
        store.move(mine, final)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [len(writer.keys)], "n_tokens": [writer.tokens], "bytes": [writer.at], "first": [writer.keys[0]], "last": [writer.last]}, schema=MANIFEST)


MANIFEST = pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("bytes", pa.int64()), ("first", pa.binary()), ("last", pa.binary())])


def write(docs: DataFrame, uri: str, tokenizer_path: str, end_id: int, by_word: bool = False) -> list:
    """Encodes docs (doc_id long, text) into shards at uri, a folder that driver and executors share; returns the manifest, a row a shard."""
    width = 2 if max(tokenizer(tokenizer_path).get_vocab_size(), end_id) < 65_536 else 4
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")  # an id with very many texts is spread over shards
    made = rows.mapInArrow(lambda it: write_shard(it, uri, tokenizer_path, end_id, width, by_word), "shard int, n_docs long, n_tokens long, bytes long, first binary, last binary")
    return sorted(made.collect(), key=lambda r: r.shard)


#: Documents that are read before they are handed on.
ROWS = 10_000


def _places(rows: list[tuple[int | None, int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_shard(batches: Iterator[pa.RecordBatch], uri: str) -> Iterator[pa.RecordBatch]:
    """shard, start -> doc_id, start, n_tokens, ids_crc32 of its documents."""
    store, folder = place(uri)
    for batch in batches:
        for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            with store.open_input_file(f"{folder}/shard-{shard:06d}.sst") as file:
                rows = []
                for key, ids in Reader(file).scan():
                    rows.append((id_of(key), start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(rows) == ROWS:
                        yield _places(rows)
                        rows = []
                if rows:
                    yield _places(rows)


def read(spark: SparkSession, uri: str, manifest: list) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, read back from the shards."""
    starts = itertools.accumulate([r.n_tokens for r in manifest], initial=0)
    places = spark.createDataFrame([(r.shard, s) for r, s in zip(manifest, starts)], "shard int, start long")
    return places.repartition(max(1, len(manifest)), "shard").mapInArrow(lambda it: read_shard(it, uri), "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(uri: str, manifest: list, doc_id: int | None) -> list[np.ndarray]:
    """The ids of a document: binary search over shards, then block index, Bloom filter and block."""
    store, folder = place(uri)
    key = key_of(doc_id)
    at = bisect.bisect_left([bytes(r["last"]) for r in manifest], key)
    found = []
    while at < len(manifest) and bytes(manifest[at]["first"]) <= key:
        with store.open_input_file(f"{folder}/shard-{manifest[at]['shard']:06d}.sst") as file:
            found += Reader(file).get(key)
        at += 1
    return found
