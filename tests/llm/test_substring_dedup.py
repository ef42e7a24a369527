import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from labharm.llm import substring_dedup as S


def say(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghijé") for _ in range(rnd.randrange(2, 9))) for _ in range(n))


def slow_boundaries(texts, reach):
    """The same by trying every stretch of reach words."""
    out, base = [], 0
    for word in texts:
        gear = [int(x) for x in S.mix(np.array(word, np.uint64) + np.uint64(1))]
        rolled = [sum(gear[j - i] << 64 // S.GEAR_WORDS * i for i in range(min(S.GEAR_WORDS, j + 1))) % 2**64 for j in range(len(word))]
        found = {0} if word else set()
        for p in range(len(word) - reach + 1):
            found.add(min(range(p, p + reach), key=lambda j: (rolled[j], j)))
        out += [base + j for j in sorted(found)]
        base += len(word)
    return out


@pytest.mark.parametrize("reach", [1, 3, 12])
def test_boundaries(reach):
    rnd = random.Random(reach)
    texts = [[rnd.randrange(50) for _ in range(rnd.choice((reach, 20, 90)))] for _ in range(40)] + [[1, 2] * 30, [7] * 40]
    begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    word = np.array([w for t in texts for w in t], np.uint64)
    got = S.boundaries(begin, word, reach)
    assert got.tolist() == slow_boundaries(texts, reach)
    assert np.diff(got).max() <= reach and S.boundaries(np.array([0]), word[:0], reach).tolist() == []


def test_shift():
    """An insertion moves no chunk beyond its neighbourhood."""
    rnd = random.Random(1)
    text = [rnd.randrange(1000) for _ in range(500)]
    chunks = []
    for t in (text, [5, 6, 7, *text], text[:250] + [1, 2, 3] + text[250:]):
        chunks.append(set(S.chunk(np.array([0, len(t)]), np.array(t, np.uint64), 12)[1].tolist()))
    assert len(chunks[0] - chunks[1]) <= 3 and len(chunks[0] - chunks[2]) <= 5 and len(chunks[0]) > 60


def plain(rows, k):
    """(doc, text) -> words that stay, and the longest passage, by comparing all windows of k words."""
    texts = sorted({(S.NO_ID if d is None else d, t) for d, t in rows if t}, key=lambda x: x[0])
    holders = defaultdict(set)
    for d, t in texts:
        w = t.split()
        for i in range(len(w) - k + 1):
            holders[tuple(w[i : i + k])].add((d, t))
    out = {}
    for d, t in texts:
        w, gone, longest, run = t.split(), set(), 0, 0
        for i in range(len(w) - k + 1):
            who = holders[tuple(w[i : i + k])]
            run = run + 1 if len(who) > 1 else 0
            longest = max(longest, run and run + k - 1)
            if min(x[0] for x in who) < d:
                gone |= set(range(i, i + k))
        if longest:
            out[d, t] = [x for i, x in enumerate(w) if i not in gone], longest
    return out


def compare(spark, rows, k):
    df = spark.createDataFrame([(*r, 1, b"x", 2) for r in rows], "doc_id long, text string, k int, digest binary, key int").repartition(3)
    want = plain(rows, k)
    got = {r.doc_id: r for r in S.summary(df, k).collect()}
    by_doc = defaultdict(lambda: (0, 0))
    for (d, t), (left, n) in want.items():
        d = None if d == S.NO_ID else d
        by_doc[d] = (max(by_doc[d][0], n), by_doc[d][1] + len(t.split()) - len(left))
    assert {d: (r.longest_words, r.removed_words) for d, r in got.items()} == dict(by_doc)
    out = S.dedup(df, k)
    assert out.columns == df.columns
    texts = sorted((str(r.doc_id), " ".join((r.text or "").split())) for r in out.collect())
    assert texts == sorted((str(d), " ".join(want.get((S.NO_ID if d is None else d, t), ((t or "").split(),))[0])) for d, t in rows)
    return want, got


@pytest.fixture(scope="module")
def docs():
    rnd = random.Random(5)
    passage = [say(rnd, n) for n in (51, 60, 80, 200)]
    rows = [(1, None), (2, ""), (3, " "), (4, "x" * 50_000), (5, say(rnd, 20_000))]
    for d in range(10, 50):
        part = [say(rnd, rnd.randrange(5, 90))]
        if d % 2:
            part += [passage[d // 2 % 4], say(rnd, rnd.randrange(1, 60))]
        rows.append((d, " ".join(part)))
    return rows + [(50, rows[4][1]), (51, say(rnd, 30) + " " + rows[4][1][3000:90_000]), (60, passage[3]), (61, passage[3]), (62, say(rnd, 20)), (63, passage[1]), (12, dict(rows)[12])]


@pytest.mark.parametrize("k", [50, 25, 6])
def test_brute_force(spark, docs, k):
    rows = docs + [(64, docs[-3][1])]
    want, got = compare(spark, rows, k)
    assert {d for d, t in rows if t and len(t.split()) >= k and d % 2 and 11 <= d < 50} <= set(got)
    if k >= 50:
        assert not {d for d in range(14, 50, 2)} & set(got) and 62 not in got


def test_hot_chunks_and_copies(spark, docs, monkeypatch):
    """The way of hot chunks gives the same; these values are read on the driver."""
    monkeypatch.setattr(S, "HOT", 3)
    monkeypatch.setattr(S, "GROUP", 3)
    compare(spark, docs, 50)
    monkeypatch.setattr(S, "MOST_HOT", 10**9)
    monkeypatch.setattr(S, "SALTS", 2)
    compare(spark, docs, 30)


def test_whole_passages(spark):
    """Passages of just min_words words, periodic ones, ones with a word changed, and phrases of several documents one after the other, which are none."""
    rnd = random.Random(8)
    exact, long = say(rnd, 25), say(rnd, 70)
    phrases = [say(rnd, 12) for _ in range(6)]
    changed = long.split()
    changed[40] = changed[40] + "x"
    rows = [(k, f"{say(rnd, 9)} {p} {say(rnd, 9)}") for k, p in enumerate(phrases)]
    rows += [(10, f"{say(rnd, 7)} {exact} {say(rnd, 7)}"), (11, f"{say(rnd, 3)}  {exact}\n{say(rnd, 3)}"), (12, f"{say(rnd, 3)} {' '.join(exact.split()[:24])} {say(rnd, 3)}")]
    rows += [(13, say(rnd, 2) + " 1 2" * 40), (14, say(rnd, 3) + " 1 2" * 30 + " " + say(rnd, 2)), (20, " ".join(phrases))]
    rows += [(21, long), (22, f"{' '.join(long.split()[20:])} {exact}"), (0, exact.split()[0]), (30, " ".join(changed))]
    want, _ = compare(spark, rows, 25)
    assert {d for d, _ in want} == {10, 11, 13, 14, 21, 22, 30}
    assert want[30, " ".join(changed)][0] == [changed[40]]


def test_rows_with_one_id(spark):
    """Different texts of one doc_id, or of none, are documents of their own; one of them keeps a passage."""
    rnd = random.Random(9)
    a, b, c = (say(rnd, 30) for _ in range(3))
    rows = [(None, f"{a} {say(rnd, 5)}"), (None, say(rnd, 60)), (1, f"{say(rnd, 4)} {b}"), (1, say(rnd, 60)), (1, f"{b} {say(rnd, 8)}"), (7, f"{a} tail"), (7, c), (7, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = sorted((r.doc_id or 0, r.text) for r in S.dedup(df, 25).collect())
    texts = [t for _, t in out]
    assert len(out) == len(rows) and texts.count(c) == 2 and {rows[1][1], rows[3][1], f"{a} tail"} <= set(texts)
    assert sum(b in t for t in texts) == sum(a in t for t in texts) == 1
    assert sum(len(t.split()) for t in texts) == sum(len(t.split()) for _, t in rows) - 60
    assert {r.doc_id for r in S.summary(df, 25).collect()} == {None, 1, 7}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.summary(df).collect() == [] and S.dedup(df).collect() == []
    df = spark.createDataFrame([(1, None), (2, None), (3, "")], "doc_id long, text string")
    assert S.summary(df).collect() == [] and S.dedup(df).count() == 3


def test_batches():
    """A digest's rows may go on in the next batch."""
    rows = [(d, k, k, 10 * k, list(range(100 * d, 100 * d + 3))) for d in range(5) for k in range(4)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())))], names=["digest", "doc", "key", "at", "windows"])
    whole = pa.Table.from_batches(S.meet(iter([batch])))
    for n in (1, 3, 7):
        parts = pa.Table.from_batches(S.meet(batch[i : i + n] for i in range(0, len(rows), n)))
        assert parts.to_pylist() == whole.to_pylist()
    assert whole.num_rows == 20 and set(whole.column("first_doc").to_pylist()) == {0}
