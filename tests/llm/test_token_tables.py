import functools
import io
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from labharm.llm import token_tables as T
from labharm.llm.common import shared_dir

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", "  ", "Hello  world's\t\x0bend", "ÀÉ Σίσυφος ς <|endoftext|>x", "a b \x01 c\x01", "é ́x", "can't 1234 日本語 ☃☃", "word " * 30_000]


loaded = functools.cache(Tokenizer.from_file)


def order_of(text):
    """As Spark hashes it, signed."""
    h = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def ids(text, name=PATH):
    return [*loaded(name).encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("by_word,name", [(True, "word_bpe_49k.json"), (False, "word_bpe_49k.json"), (False, "byte_bpe_50k.json")])
def test_round_trip(spark, by_word, name):
    path = public_tokenizers.path(name)
    rows = [(i * 3 - 9, t) for i, t in enumerate(TEXTS)] + [(3, "again"), (None, "no id")]
    random.Random(1).shuffle(rows)
    uri = shared_dir(spark, "sst")
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, start string, shard int").repartition(3)
    manifest = T.write(docs, uri, path, 2, by_word)
    got = sorted((tuple(r) for r in T.read(spark, uri, manifest).collect()), key=lambda r: r[1])
    want, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, order_of(r[1]))):
        x = ids(t, path)
        want.append((d, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    assert got == want
    assert [x.tolist() for x in T.lookup(uri, manifest, 3)] == [ids(t, path) for t in sorted((t for d, t in rows if d == 3), key=order_of)]
    assert [x.tolist() for x in T.lookup(uri, manifest, None)] == [ids("no id", path)]
    assert T.lookup(uri, manifest, 10**12) == [] == T.lookup(uri, manifest, 4)


def test_empty(spark):
    uri = shared_dir(spark, "sst")
    manifest = T.write(spark.createDataFrame([], "doc_id long, text string"), uri, PATH, 2)
    assert manifest == [] and T.read(spark, uri, manifest).collect() == []


def test_blocks_index_and_bloom():
    sink = io.BytesIO()
    w = T.Writer(sink, 2)
    keys = [T.key_of(i * 7 - 5000) for i in range(4000)]
    for i, k in enumerate(keys):
        w.add(k, np.arange(i % 300))
    with pytest.raises(ValueError):
        w.add(keys[0], np.arange(1))
    w.finish()
    r = T.Reader(pa.BufferReader(sink.getvalue()))
    assert len(r.index) > 3 and r.n_docs == 4000
    assert [k for k, _ in r.scan()] == keys
    assert all(r.get(k)[0].tolist() == list(range(i % 300)) for i, k in enumerate(keys) if i % 97 == 0)
    assert sum(r.may_hold(T.key_of(i * 7 - 4999)) for i in range(2000)) < 100


def test_by_word_equals_whole_on_documents(spark):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").toPandas().text
    whole = [x.tolist() for x in T.encode(pa.array(texts), PATH, 2, False)]
    assert whole == [x.tolist() for x in T.encode(pa.array(texts), PATH, 2, True)]


def test_one_id_in_many_shards(spark):
    """A third of the rows have one id: its texts lie in several shards, and all are found."""
    rows = [(5 if i % 3 == 0 else i, f"text {i} of many " * (i % 4)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    uri = shared_dir(spark, "sst")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        manifest = T.write(docs, uri, PATH, 2, True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(manifest) > 5 and sum(r.n_docs for r in manifest) == 900 and max(r.n_docs for r in manifest) < 300
    assert sorted(x.tolist() for x in T.lookup(uri, manifest, 5)) == sorted(ids(t) for d, t in rows if d == 5)
    assert [x.tolist() for x in T.lookup(uri, manifest, 7)] == [ids(rows[7][1])]
    got = T.read(spark, uri, manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(d for d, _ in rows) and [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(900)]


def test_words_are_kept_and_forgotten(monkeypatch):
    """Whatever is known already and however little may be kept, ids are the tokenizer's."""
    monkeypatch.setattr(T, "CACHE_WORDS", 60)
    monkeypatch.setattr(T, "_cache", {})
    rnd = random.Random(3)
    pool = [f"word{i}" for i in range(90)] + ["a", "\x01", "x\x01y", "ß😀", "don't"]
    for n in (1, 40, 3, 40, 200, 0):
        texts = [" ".join(rnd.choices(pool, k=rnd.randint(0, 9))) for _ in range(n)] + [None, ""]
        got = [x.tolist() for x in T.encode(pa.array(texts, pa.string()), PATH, 2, True)]
        assert got == [ids(t)[:-1] for t in texts]
    known = T._cache[PATH, 2]
    assert all(len(a[0]) >= 2 * len(b[0]) for a, b in zip(known.runs, known.runs[1:])) and sum(len(r[0]) for r in known.runs) == known.words
