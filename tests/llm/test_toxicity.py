import random

import pytest

from labharm.llm import toxicity as T
from labharm.llm.catalog import op8_toxicity


def brute_segments(seq):
    """All maximal segments by definition: take the best, split there, go on at either side."""
    out = []

    def go(a, z):
        best = max(((sum(seq[i:j]), -(j - i), i, j) for i in range(a, z) for j in range(i + 1, z + 1)), default=(0,))
        if best[0] > 0:
            out.append((best[0], best[2], best[3]))
            go(a, best[2])
            go(best[3], z)

    go(0, len(seq))
    return sorted(out, key=lambda x: x[1])


@pytest.mark.parametrize("seed", range(30))
def test_segments(seed):
    rnd = random.Random(seed)
    seq = [rnd.choice([-T.DRIFT, -T.DRIFT, 2.25, 0.5, -3.125, 1.5 + rnd.random()]) for _ in range(30)]
    got = T.segments([v for v in seq if v != -T.DRIFT], [i for i, v in enumerate(seq) if v != -T.DRIFT])
    want = brute_segments(seq)
    assert [(b, e) for _, b, e in got] == [(b, e) for _, b, e in want]
    assert [s for s, _, _ in got] == pytest.approx([s for s, _, _ in want])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op8_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").select("predicted", "toxic", "score").collect()
    assert got.count() == 10_000 and len(rows) > 600
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit >= 0.93 * sum(r.toxic for r in rows) and hit >= 0.98 * sum(r.predicted for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "fine words here", 0.5), (3, "fine words here", 0.5), (None, "bad bad", 0.5), (4, "w " * 50_000, 0.5)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = T.fit(docs, none)
    assert sorted((r.doc_id or 0, r.score) for r in T.score(docs, model).collect()) == [(d, 0.0) for d in (0, 1, 2, 3, 3, 4)]
    assert T.score(docs.limit(0), model).collect() == []
    many = spark.createDataFrame([(i, ("bad evil thing " if i % 2 else "good nice thing ") + f"other{i} " * 5) for i in range(400)], "doc_id long, text string")
    model = T.fit(many, many.selectExpr("doc_id", "cast(doc_id % 2 as int) toxic"))
    got = {r.doc_id: r for r in T.score(docs.union(many.selectExpr("doc_id + 1000", "text", "0D")), model).collect()}
    assert all((got[1000 + i].score >= 0.5) == (i % 2 == 1) for i in range(400))
    assert got[1].score < 0.5 and got[2].score < 0.5 and got[3].score < 0.5
    assert got[1001].passages[0].begin == 0 and got[1001].passages[0].end == 2


def test_one_document_a_label(spark, monkeypatch):
    """An id that stands in very many rows adds one document to the sample, and changes nothing."""
    monkeypatch.setattr(T, "SAMPLE", 300)
    docs = spark.createDataFrame([(i, ("bad evil thing " if i % 2 else "good nice thing ") + f"other{i} " * 5) for i in range(400)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) toxic")
    chosen = labels.selectExpr("doc_id", "xxhash64(doc_id) h").orderBy("h").limit(1).first().doc_id
    hot = docs.unionByName(docs.filter(f"doc_id = {chosen}").crossJoin(spark.range(5000)).select("doc_id", "text"))
    seen, cut = [], T.cut

    def counted(df, name):
        out = cut(df, name)
        seen.append(out.count())
        return out

    monkeypatch.setattr(T, "cut", counted)
    plain, repeated = T.fit(docs, labels), T.fit(hot, labels)
    assert seen == [300, 300] and plain.__dict__.keys() == repeated.__dict__.keys()
    some = docs.limit(50)
    assert sorted(map(str, T.score(some, plain).collect())) == sorted(map(str, T.score(some, repeated).collect()))
