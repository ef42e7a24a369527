import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from labharm.llm import line_dedup as L


def key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(base, rows, min_docs, min_chars):
    n = Counter(k for t in base for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = []
    for t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if n[key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def texts(seed, n=60):
    rnd = random.Random(seed)
    pool = ["Common Line", " common line\t", "é", "É", "", "  ", "a", "b\r", "\x0bB", "x ", "long " * 3000, *[f"line {i}" for i in range(40)]]
    return [None, "", "\n", "\n\n", *("\n".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 9))) for _ in range(n))] * 2


def frame(spark, rows):
    return spark.createDataFrame([(i % 7 or None, t, "x", 1, b"") for i, t in enumerate(rows)], "doc_id long, text string, digest string, shard int, refs binary").repartition(3)


def result(df):
    return sorted((r.n_lines, r.n_dropped, r.kept) for r in df.select("n_lines", "n_dropped", "kept").collect())


@pytest.mark.parametrize("min_chars", [1, 3])
@pytest.mark.parametrize("broadcast", [1 << 20, -1])
def test_brute_force(spark, monkeypatch, min_chars, broadcast):
    monkeypatch.setattr(L, "BROADCAST_BYTES", broadcast)
    rows = texts(min_chars)
    docs = frame(spark, rows)
    out = L.LineDedup(spark, min_docs=4, min_chars=min_chars).insert(docs).apply(docs)
    assert result(out) == brute(rows, rows, 4, min_chars)
    assert {"digest", "shard", "refs"} <= set(out.columns)


def test_deletion_leads_back(spark):
    a, b = texts(1), texts(2)
    da, db = frame(spark, a), frame(spark, b)
    state = L.LineDedup(spark, min_docs=9).insert(da)
    before = sorted((bytes(r.digest), r.refs) for r in state.refs.collect())
    state.insert(db)
    assert result(state.apply(da)) == brute(a + b, a, 9, 1)
    state.delete(db)
    assert sorted((bytes(r.digest), r.refs) for r in state.refs.collect()) == before
    assert result(state.apply(da)) == brute(a, a, 9, 1)


def test_empty(spark):
    empty = frame(spark, [""]).limit(0)
    state = L.LineDedup(spark).insert(empty)
    assert state.apply(empty).collect() == []


def test_wrongly_held_keys_stay(spark, monkeypatch):
    """Filters that hold cold keys, too, still drop only what the exact table says."""
    rows = texts(3) + [f"cold {i}\nCommon Line" for i in range(12)]
    docs = frame(spark, rows)
    state = L.LineDedup(spark, min_docs=4).insert(docs)
    cold = np.frombuffer(b"".join(bytes(r.digest) for r in state.refs.filter("refs < 4").collect()), np.uint64).reshape(-1, 2)
    wrong = []
    for r in state.filters.collect():
        mine = cold[L.shard_of(cold, state.shards) == r.shard]
        bigger = L.Cuckoo.sized(4 * (len(mine) + len(r.slots)))
        hot = np.frombuffer(b"".join(bytes(x.digest) for x in state.refs.filter("refs >= 4").collect()), np.uint64).reshape(-1, 2)
        assert bigger.insert(hot[L.shard_of(hot, state.shards) == r.shard]) and bigger.insert(mine)
        wrong.append((r.shard, bigger.slots.tobytes()))
    assert len(cold) > 3
    spark.createDataFrame(wrong, "shard int, slots binary").write.mode("overwrite").parquet(state._path("filters"))
    assert L.probe(cold, {k: np.frombuffer(v, np.uint32) for k, v in wrong}, state.shards).sum() == sum(int(x) in dict(wrong) for x in L.shard_of(cold, state.shards))
    assert result(state.apply(docs)) == brute(rows, rows, 4, 1)
    monkeypatch.setattr(L, "WRONG_KEYS", 2)  # more than the broadcast way takes
    assert result(state.apply(docs)) == brute(rows, rows, 4, 1)


def test_state_opens_again(spark, tmp_path):
    a, b = texts(4), texts(5)
    da, db = frame(spark, a), frame(spark, b)
    L.LineDedup(spark, f"{tmp_path}/s", min_docs=6).insert(da)
    again = L.LineDedup(spark, f"{tmp_path}/s", min_docs=6)
    assert again.version == 1 and result(again.apply(da)) == brute(a, a, 6, 1)
    again.insert(db)
    third = L.LineDedup(spark, f"{tmp_path}/s", min_docs=6)
    assert third.version == 2 and result(third.apply(db)) == brute(a + b, b, 6, 1)
    third.delete(da)
    assert result(L.LineDedup(spark, f"{tmp_path}/s", min_docs=6).apply(db)) == brute(b, b, 6, 1)
    with pytest.raises(ValueError, match="min_docs=6"):
        L.LineDedup(spark, f"{tmp_path}/s", min_docs=7)


def test_unfinished_version_counts_for_nothing(spark, tmp_path, monkeypatch):
    a = texts(6)
    da = frame(spark, a)
    state = L.LineDedup(spark, f"{tmp_path}/s", min_docs=4).insert(da)

    def lost(self, *args):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(L.LineDedup, "_update", lost)
        with pytest.raises(RuntimeError):
            state.insert(da)
    again = L.LineDedup(spark, f"{tmp_path}/s", min_docs=4)
    assert state.version == again.version == 1 and result(again.apply(da)) == brute(a, a, 4, 1)
    assert result(again.insert(da).apply(da)) == brute(a + a, a, 4, 1)


def test_refusals(spark):
    a = texts(7)
    da = frame(spark, a)
    state = L.LineDedup(spark, min_docs=4).insert(da)
    with pytest.raises(ValueError, match="never inserted"):
        state.delete(spark.createDataFrame([(1, "a line of nobody")], "doc_id long, text string"))
    assert state.version == 1 and result(state.apply(da)) == brute(a, a, 4, 1)
    for name in ("kept", "n_lines", "__row"):
        with pytest.raises(ValueError, match=name):
            state.apply(da.withColumn(name, da.shard))


def test_twin_counts_rows(spark, tmp_path):
    from twins import compare

    docs = spark.createDataFrame([(i % 3 or None, t) for i, t in enumerate(texts(8))], "doc_id long, text string")
    compare(spark, tmp_path, "op1_line_dedup", documents=docs)


def test_cuckoo_insert_delete():
    d = np.frombuffer(b"".join(hashlib.md5(str(i).encode()).digest() for i in range(60_000)), np.uint64).reshape(-1, 2)
    c = L.Cuckoo.sized(45_000)
    assert c.insert(d[:45_000]) and c.holds(d[:45_000]).all()
    assert c.holds(d[45_000:]).mean() < 1e-3
    c.delete(d[:20_000])
    assert c.holds(d[20_000:45_000]).all() and c.holds(d[:20_000]).mean() < 1e-3
    assert np.count_nonzero(c.slots) == 25_000
    assert not L.Cuckoo(np.zeros(64, np.uint32)).insert(d[:100])
