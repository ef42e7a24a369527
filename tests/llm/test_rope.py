import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from twins import compare

from labharm.llm import rope as R

LINES = re.compile(r"[^\n]*\n|[^\n]+")
texts = st.lists(st.sampled_from(["a", "bc", "\n", "ü", "😀", "\n\n", "<", "P>", " "]), max_size=60).map("".join)


@pytest.fixture(params=[1, 3, 2048])
def leaf(request, monkeypatch):
    monkeypatch.setattr(R, "LEAF", request.param)


def balanced(node):
    if node.piece is None:
        assert abs(node.left.depth - node.right.depth) <= 2 and node.depth == 1 + max(node.left.depth, node.right.depth)
        assert (node.chars, node.ends) == (node.left.chars + node.right.chars, node.left.ends + node.right.ends)
        balanced(node.left), balanced(node.right)


@settings(deadline=None, max_examples=60)
@given(text=texts, rank=st.integers(0, 100))
def test_splits(text, rank):
    for size in (1, 3, 2048):
        before, R.LEAF = R.LEAF, size
        units, whole = LINES.findall(text), R.rope(text)
        R.LEAF = before
        k = rank % (len(units) + 1)
        assert R.units(whole, text) == len(units) and R.text_of(whole) == text
        a, b = R.at_unit(whole, k)
        assert (R.text_of(a), R.text_of(b)) == ("".join(units[:k]), "".join(units[k:]))
        a, b = R.split(whole, c := rank % (len(text) + 1))
        assert (R.text_of(a), R.text_of(b)) == (text[:c], text[c:])
        balanced(R.join(b, a))
        assert R.text_of(R.join(b, a)) == text[c:] + text[:c]


@settings(deadline=None, max_examples=100)
@given(text=texts, key=st.one_of(st.none(), st.integers()))
def test_round_trip(text, key):
    n, form, prefix, middle, output = R.rearrange(key, text, R.Settings())
    assert R.rebuild(output, form) == text and n == len(LINES.findall(text))
    assert (form == "plain") == (not text or any(x in text for x in ("<P>", "<S>", "<M>"))) == (prefix is None)


def test_long_texts_keep_ropes_shallow():
    text = "line\n" * 400_000
    whole = R.rope(text)
    part = whole
    for k in (399_999, 1, 200_000, 7):
        a, b = R.at_unit(part, k % (part.ends + 1))
        part = R.join(b, a)
    assert part.chars == len(text) and part.depth <= 3 + 2 * (len(text) // R.LEAF).bit_length()


def test_all_plain_and_one_form(spark):
    docs = spark.createDataFrame([(i, "a\nb\nc") for i in range(50)], "doc_id long, text string")
    assert {r.form for r in R.transform(docs, R.Settings(rate=0)).collect()} == {"plain"}
    assert {r.form for r in R.transform(docs, R.Settings(spm=100)).collect()} == {"spm"}


def test_columns(spark):
    docs = spark.createDataFrame([(1, "a\nb", "x", [1, 2])], "doc_id long, text string, source string, more array<int>")
    row = R.restore(R.transform(docs)).first()
    assert (row.doc_id, row.text, row.source, row.more) == (1, "a\nb", "x", [1, 2])
    with pytest.raises(ValueError, match="form"):
        R.transform(docs.withColumnRenamed("source", "form"))
    with pytest.raises(ValueError, match="text"):
        R.restore(docs)


def test_edges(spark, tmp_path):
    rows = [(1, None), (2, ""), (None, "a\nb\n"), (None, None), (3, "\n"), (4, "x <S> y\nz"), (5, "no end"), (5, "no end"), (5, "other\n"), (6, "long " * 200_000 + "\nend"), (7, "l\n" * 50_000), (-8, "é\n😀\r\n\x0b\n")] + [(0, f"same id {i}\n{i}") for i in range(8)]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, form string, n int")
    got = compare(spark, tmp_path, "op11_fill_in_middle", documents=docs)
    assert len(got) == len(rows) and set(got.form) == {"plain", "psm", "spm"}
    assert len(compare(spark, tmp_path, "op11_fill_in_middle", documents=docs.limit(0))) == 0


def test_given_tables(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert set(compare(spark, tmp_path, "op11_fill_in_middle", documents=docs).form) == {"psm", "spm"}
