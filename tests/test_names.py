"""Jaro on batches and the search for nearest names, against plain loops and the whole matrix."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from labharm.functions import names as N
from labharm.operators import similarity


def plain(p, q):
    if not p or not q:
        return float(p == q)
    reach, taken, mine = max(0, max(len(p), len(q)) // 2 - 1), [False] * len(q), []
    for i, c in enumerate(p):
        for j in range(max(0, i - reach), min(len(q), i + reach + 1)):
            if not taken[j] and q[j] == c:
                taken[j] = True
                mine.append(c)
                break
    m = len(mine)
    moved = sum(x != y for x, y in zip(mine, (c for c, t in zip(q, taken) if t))) // 2
    return (m / len(p) + m / len(q) + (m - moved) / m) / 3 if m else 0.0


word = st.text(st.sampled_from("abcü😀 -[]"), max_size=14)


@settings(deadline=None, max_examples=150)
@given(st.lists(st.tuples(word, word), max_size=8))
def test_batches(pairs):
    p, q = (N.coded([x[i] for x in pairs]) for i in (0, 1))
    got = N.similarity(p, q)
    assert got.tolist() == [plain(a, b) for a, b in pairs]
    shared = np.minimum(N.counts(p), N.counts(q)).sum(1)
    assert (N.bound(shared, p.length, q.length, q.length) >= got).all()


def test_steps_of_long_names(monkeypatch):
    monkeypatch.setattr(N, "CELLS", 50)
    texts = ["x" * i + "abc" for i in (0, 3, 60, 1, 200, 7)]
    assert N.similarity(N.coded(texts), N.coded(texts[::-1])).tolist() == [plain(a, b) for a, b in zip(texts, texts[::-1])]


def vocabulary(spark, n, m, seed=1):
    rng = random.Random(seed)
    syllables = ["krea", "gluk", "na", "kal", "hb", "lym", "tro", "pla", "ure", "tsh", "fos", "mag", "zin", "fer"]
    name = lambda: "-".join(rng.choices(syllables, k=rng.randint(1, 4))) + f" {rng.randint(1, 60)} []"
    mapped = [(name(), rng.randint(1, 300)) for _ in range(m)]
    return spark.createDataFrame(mapped + [(None, 5)], "name string, concept int"), spark.createDataFrame([(name(), 0) for _ in range(n)] + [(None, 0), ("", 0)], "name string, concept int")


def ranked(matrix, k):
    rows, out = {}, set()
    for r in matrix.collect():
        rows.setdefault(r.name, []).append((r.distance, r.other, r.concept))
    for name, found in rows.items():
        out |= {(name, i + 1, o, c, d) for i, (d, o, c) in enumerate(sorted(found)[:k])}
    return out


def test_nearest_without_all_pairs(spark):
    mapped, unmapped = vocabulary(spark, 300, 4000)
    compared = spark.sparkContext.accumulator(0)
    got = similarity.nearest(mapped, unmapped, 10, compared=compared)
    assert {tuple(r) for r in got.collect()} == ranked(similarity.matrix(mapped, unmapped), 10)
    pairs = mapped.select("name").distinct().count() * unmapped.select("name").distinct().count()
    assert 0 < compared.value < 0.1 * pairs


@pytest.mark.parametrize("n,m", [(30, 23), (0, 23), (37, 0), (5, 1)])
def test_groups(spark, n, m):
    mapped, unmapped = vocabulary(spark, n, m)
    want = ranked(similarity.matrix(mapped, unmapped), 4)
    assert {tuple(r) for r in similarity.nearest(mapped, unmapped, 4, group=7).collect()} == want
    assert ranked(similarity.matrix(mapped, unmapped, group=5), 4) == want
