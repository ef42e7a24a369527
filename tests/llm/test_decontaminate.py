import random
from collections import Counter

import numpy as np
import pytest

from labharm.llm import decontaminate as D


def W(text):
    return [x for x in (D.strip(w.lower() if w.isascii() else w) for w in (text or "").split()) if x]


def sim(p, q, k=5):
    g = lambda w: Counter(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else Counter()
    a, b = g(p), g(q)
    both = sum((a & b).values())
    return both / (a.total() + b.total() - both) if both else 0.0


def brute(docs, items):
    """Every text of about the item's length, everywhere."""
    out = set()
    for d, t in docs:
        w = W(t)
        for i, x in items:
            v = W(x)
            if v and any(sim(w[a:z], v) >= 0.8 for a in range(len(w)) for z in range(a + max(1, len(v) - 2), min(len(w), a + len(v) + 2) + 1)):
                out.add((d, i))
    return out


@pytest.fixture(scope="module")
def case():
    rnd = random.Random(3)
    vocabulary = ["the", "of", "and", *("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(300))]
    say = lambda n: [rnd.choice(vocabulary[:3] if rnd.random() < 0.3 else vocabulary) for _ in range(n)]
    items = [(k, " ".join(say(rnd.choice([14, 20, 33, 47, 58])))) for k in range(30)] + [(100, None), (101, ""), (102, "tiny item"), (103, "...")]
    docs = [(1, None), (2, ""), (3, " "), (4, "a tiny item, here"), (5, items[3][1]), (5, items[3][1])]
    for d in range(10, 60):
        words = say(rnd.randrange(20, 120))
        if d % 2:
            part = items[d % 30][1].split()
            if d % 3 == 0:
                part[len(part) // 2 if len(part) > 50 else 0] = "changed"
            if d % 5 == 0:
                part = [w.upper() + "," for w in part]
            at = rnd.randrange(len(words))
            words[at:at] = part
        docs.append((d, " ".join(words)))
    docs.append((None, items[4][1]))
    return docs, items


def test_brute_force(spark, case):
    docs, items = case
    got = D.find(spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, item_id long, similarity string").repartition(2), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute(docs, items)
    assert len(got) == len(brute(docs, items)) + 1  # document 5 is there twice
    by = dict(docs)
    for r in got:
        assert r.similarity == sim(W(by[r.doc_id])[r.start_word : r.end_word], W(dict(items)[r.item_id])) >= 0.8


def test_blocks_of_items_and_empty_tables(spark, case):
    docs, items = case
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {tuple(r)[:2] for r in D.find(d, b, block_words=300).collect()} == {tuple(r)[:2] for r in D.find(d, b).collect()}
    assert D.find(d.limit(0), b).collect() == [] == D.find(d, b.limit(0)).collect()


def test_multi_index_misses_nothing():
    rng = np.random.default_rng(1)
    a = rng.integers(2**63, size=300).astype(np.uint64)
    for x in a[:50]:
        flips = rng.choice(64, D.RADIUS, replace=False)
        y = x ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64))
        assert any(bin((int(x) >> 16 * b & 65535) ^ (int(y) >> 16 * b & 65535)).count("1") <= D.RADIUS // D.BLOCKS for b in range(4))
    assert len(D.near(16, 2)) == 137


def brute_all(words, item, least=0.8):
    """The largest similarity of the item and a text of any length that may reach least."""
    n = len(item)
    return max((sim(words[a:z], item) for z in range(len(words) + 1) for a in range(max(0, z - int(n / least) - 5), z - int(least * n) + 5) if a < z), default=0.0)


@pytest.mark.parametrize("n,insert,delete", [(100, 15, 0), (100, 0, 12), (60, 5, 0), (60, 0, 4)])
def test_longer_and_shorter_copies(spark, n, insert, delete):
    """A phrase put into or taken out of a copy, up to the threshold."""
    rnd = random.Random(n + insert + delete)
    say = lambda m: ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(m)]
    items = [(k, say(n)) for k in range(4)]
    docs = []
    for k, item in items:
        at = rnd.randrange(n // 4, n - n // 4 - delete)
        docs.append((k, say(rnd.randrange(30)) + item[:at] + say(insert) + item[at + delete :] + say(rnd.randrange(30))))
    got = D.find(spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string"), spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")).collect()
    want = {d: brute_all(w, items[d][1]) for d, w in docs}
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == {(d, d): s for d, s in want.items() if s >= 0.8}
    assert len(got) == 4
    for r in got:
        assert r.similarity == sim(docs[r.doc_id][1][r.start_word : r.end_word], items[r.item_id][1])


@pytest.mark.parametrize("n,replaced", [(100, 6), (200, 17), (300, 28), (340, 33)])
def test_recall_at_the_threshold(spark, n, replaced):
    """One run of words in the middle replaced, so that the similarity is just above 0.8: every such copy is found."""
    rnd = random.Random(n)
    say = lambda m: ["".join(rnd.choice("abcdefgh") for _ in range(7)) for _ in range(m)]
    items = [(k, say(n)) for k in range(60)]
    a = (n - replaced) // 2
    docs = [(k, say(rnd.randrange(40)) + w[:a] + say(replaced) + w[a + replaced :] + say(rnd.randrange(40))) for k, w in items]
    got = D.find(spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string"), spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")).collect()
    least = (n - 4 - replaced - 4) / (n - 4 + replaced + 4)
    assert 0.8 <= least < 0.83 and sorted((r.doc_id, r.item_id, r.similarity) for r in got) == [(k, k, least) for k in range(60)]


@pytest.mark.parametrize("n,replaced,least", [(100, 6, 0.97), (200, 17, 0.93), (300, 28, 0.85)])
def test_recall_of_fingerprints_alone(n, replaced, least):
    """Copies at the edge of similarity 0.8, one run of words replaced, among other words: how many some window finds without the rarest shingles' help, and that all are found with it."""
    import pyarrow as pa

    rnd = random.Random(n)
    say = lambda k: ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(k)]
    items = [say(n) for _ in range(100)]
    texts = []
    for x in items:
        at = rnd.randrange(n - replaced)
        copy = x[:at] + say(replaced) + x[at + replaced :]
        assert sim(copy, x) >= 0.8
        texts.append(" ".join(say(rnd.randint(0, 80)) + copy + say(rnd.randint(0, 80))))
    index = D.Index([(i, " ".join(x)) for i, x in enumerate(items)], 5, 0.8)
    docs = pa.array(texts, pa.string())
    hits = {(int(t), int(i)) for t, i in index.hits(*D.plain_words(docs)).T}
    assert sum((i, i) in hits for i in range(100)) >= 100 * least
    assert {(t, i) for t, i in D.found_in(docs, index, 0.8)} == {(i, i) for i in range(100)}
