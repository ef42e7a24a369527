import math

import numpy as np
import pytest

from labharm.llm import nearest
from labharm.llm.catalog import op2_nearest


def brute(rows, query_ids, k=5):
    rows = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for q, x in rows:
        if q in query_ids:
            scored = sorted((-float(x @ y) / float(np.sqrt(x @ x) * np.sqrt(y @ y)), i) for i, y in rows if i != q)
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def as_dict(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall(spark):
    sf = "/root/testdata/sf0.1"
    got = as_dict(op2_nearest(spark, sf))
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows, {i for i, _ in rows if i % 50 == 0})
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))
    for q in want:
        exact = dict(brute([r for r in rows if r[0] in {q, *(i for i, _ in got[q])}], {q}, 10)[q])
        assert all(s == pytest.approx(exact[i], abs=1e-12) for i, s in got[q])


@pytest.mark.parametrize("rerank", [1, 128])
def test_copies_and_near_copies(spark, rerank):
    """Large groups of copies and of near copies: the nearest and the smallest ids are found although few candidates get an exact score at first."""
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=8), rng.normal(size=8)
    rows = [(i, a.tolist()) for i in range(300, 0, -1)] + [(1000 + i, (b + 0.1 * rng.normal(size=8)).tolist()) for i in range(300)] + [(0, a.tolist()), (2000, b.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got, want = as_dict(nearest.search(df, "vec_id in (0, 2000)", rerank=rerank)), brute(rows, {0, 2000})
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5]
    assert [i for i, _ in got[2000]] == [i for i, _ in want[2000]]


def test_edges(spark):
    rows = [(0, [1.0, 0.0, 0.0], "x"), (1, [0.0, 0.0, 0.0], "x"), (2, None, "x"), (3, [1.0, None, 0.0], "x"), (4, [1.0, math.nan, 0.0], "x"), (5, [math.inf, 1.0, 0.0], "x"), (6, [2.0, 0.0, 0.0], None), (7, [0.0, 3.0, 0.0], "x"), (7, [0.0, 3.0, 0.0], "x"), (8, [1.0], "x"), (None, [1.0, 1.0, 1.0], "x"), (50, [0.0, 0.0, -1.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, code string")
    got = as_dict(nearest.search(df, "vec_id % 50 = 0"))
    assert got == {0: [(6, 1.0), (7, 0.0), (7, 0.0), (50, 0.0)], 50: [(0, 0.0), (6, 0.0), (7, 0.0), (7, 0.0)]}
    assert nearest.search(df.limit(0), "vec_id % 50 = 0").collect() == []
    assert nearest.search(df.filter("vec_id = 0"), "vec_id % 50 = 0").collect() == []
    one = spark.createDataFrame([(0, [1.0]), (1, [-2.0])], "vec_id long, embedding array<double>")
    assert as_dict(nearest.search(one, "vec_id = 0")) == {0: [(1, -1.0)]}


@pytest.mark.parametrize("size", [3, 8, 16, 100])
def test_copies_over_batches(spark, size):
    """Copies of one vector come in the order of their ids, whatever stands beside them in a batch."""
    rng = np.random.default_rng(size)
    one = rng.normal(size=size)
    rows = [(i, one.tolist()) for i in (3, 7, 1, 2, 4, 6)] + [(100 + i, (one + rng.normal(size=size)).tolist()) for i in range(80)]
    for parts in (1, 2, 5, 11):
        df = spark.createDataFrame(rows + [(0, one.tolist())], "vec_id long, embedding array<double>").repartition(parts)
        got = as_dict(nearest.search(df, "vec_id = 0"))[0]
        assert [i for i, _ in got] == [1, 2, 3, 4, 6] and len({s for _, s in got}) == 1
    x, q = rng.normal(size=(50, size)), rng.normal(size=size)
    assert all(nearest.products(x[i : i + 1], q)[0] == nearest.products(x, q)[i] for i in range(50))


def test_query_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = as_dict(nearest.search(df, "vec_id % 3 = 0"))
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 7)
    assert as_dict(nearest.search(df, "vec_id % 3 = 0")) == whole and len(whole) == 40


def test_error_along_the_vector_costs_more():
    rng = np.random.default_rng(1)
    x = nearest.unit(rng.normal(size=(2000, 16)))

    def errors(eta):
        q = nearest.Quantiser(16)
        q.eta = eta
        codes = q.fit(x).encode(x)
        both = np.stack([codes & 15, codes >> 4], axis=2).reshape(len(x), -1)
        back = np.concatenate([q.books[s][both[:, s]] for s in range(q.pairs)], axis=1)
        r = x - back
        along = (r * x).sum(1)
        return (along**2).mean(), (r**2).sum(1).mean()

    plain, aware = errors(1.0), errors(6.0)
    assert aware[0] < 0.7 * plain[0] and aware[1] > plain[1]
