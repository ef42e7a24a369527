import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from labharm.llm import mixing as M


def fill(budget, children):
    """Water-filling by definition: hand out by weight, give back what children can't take, go on. children: name -> (weight, supply)."""
    given, left, open_ = {}, budget, dict(children)
    while open_:
        total = sum(w for w, _ in open_.values())
        level = left / total if total else 0.0
        done = {n for n, (w, s) in open_.items() if s <= w * level}
        if not done:
            return given | {n: min(s, math.floor(w * level)) for n, (w, s) in open_.items()}
        for n in done:
            given[n] = open_.pop(n)[1]
            left -= given[n]
    return given


def brute(rows, weights, share, epochs, seed):
    n = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    docs = [(d, t, ("d" if s else None, l, s), n(t)) for d, t, l, s in rows]
    tokens = defaultdict(int)
    for _, _, leaf, k in docs:
        tokens[leaf] += k
    budgets = {(): math.floor(share * sum(tokens.values()))}
    for depth, level in enumerate(M.LEVELS):
        after = {}
        for node, b in budgets.items():
            children = defaultdict(int)
            for leaf, k in tokens.items():
                if leaf[:depth] == node:
                    children[leaf[depth]] += k * epochs
            got = fill(b, {c: (weights.get(level, {}).get(c, 1), s) for c, s in children.items()})
            after |= {(*node, c): g for c, g in got.items()}
        budgets = after
    out = []
    for leaf, b in budgets.items():
        if not b:
            continue
        whole, rest = divmod(b, tokens[leaf])
        mine = [d for d in docs if d[2] == leaf]
        out += [(d[0], *leaf, e, d[3]) for d in mine for e in range(whole)]
        md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
        key = lambda d: md5(f"{seed}:{whole}:{'' if d[0] is None else d[0]}:{md5(d[1] or '')}")
        before = 0
        for d in sorted(mine, key=key):
            if before < rest:
                out.append((d[0], *leaf, whole, d[3]))
            before += d[3]
    return sorted(out, key=str)


WEIGHTS = {"lang": {"en": 5, "de": 0}, "source": {"s1": 3}}


@pytest.mark.parametrize("share,epochs", [(0.3, 1), (0.9, 2), (1.9, 2), (1.0, 1), (5.0, 3), (0.0, 1)])
def test_brute_force(spark, monkeypatch, share, epochs):
    monkeypatch.setattr(M, "BUCKET_ROWS", 4)
    rnd = random.Random(round(10 * share))
    rows = [(i, " ".join(["w"] * rnd.choice([0, 1, 3, 20, 90])), rnd.choice(["en", "en", "en", "de", "fr", None]), rnd.choice(["s1"] * 6 + ["s2", "s3", None])) for i in range(300)]
    rows += [(7, "a b c", "en", "s1")] * 40 + [(None, None, "en", "s1"), (None, "x", None, None), (900, "long " * 20_000, "fr", "s2"), (901, "\u00a0", "xx", "s9"), (902, "", "yy", "s9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).withColumn("epoch", F.lit("mine")).withColumn("tokens", F.lit(3))
    got = M.mix(docs, F.when(F.col("source").isNotNull(), "d"), WEIGHTS, share, epochs, 4)
    assert "tokens" in got.columns
    got = got.select("doc_id", "domain", "lang", "source", "epoch", "n_tokens")
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows, WEIGHTS, share, epochs, 4)


def test_shortage_goes_to_siblings_first(spark):
    """A language short of one source is made up for by its other source, not by another language."""
    rows = [(i, "w " * 10, "en", "big") for i in range(100)] + [(1000 + i, "w " * 10, "en", "small") for i in range(5)] + [(2000 + i, "w " * 10, "fr", "big") for i in range(105)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {(r.lang, r.source): r.n for r in M.mix(docs, F.lit("d"), {}, 0.5, 1).groupBy("lang", "source").agg(F.sum("n_tokens").alias("n")).collect()}
    assert got == {("en", "small"): 50, ("en", "big"): 480, ("fr", "big"): 530} or got == {("en", "small"): 50, ("en", "big"): 480, ("fr", "big"): 525 + 5}


def test_own_columns(spark):
    with pytest.raises(ValueError, match="__key"):
        M.mix(spark.createDataFrame([], "doc_id long, text string, lang string, source string, __key int"), F.lit("d"), {}, 0.5)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert M.mix(docs, F.lit(None).cast("string"), {}, 0.5).collect() == []
    nothing = spark.createDataFrame([(1, None, None, None)], docs.schema)
    assert M.mix(nothing, F.lit(None).cast("string"), {}, 0.5).collect() == []
