import os

import pytest
from pyspark.sql import functions as F

from labharm.functions import text
from labharm.functions.keys import regex_filter
from labharm.operators import preview
from labharm.sources import tables


def test_numbers_and_links(spark):
    rows = spark.createDataFrame([(500.0,), (1e-6,), (0.25,), (-3.5,), (0.0,), (None,)], "x double")
    assert [r.t for r in rows.select(text.number("x").alias("t")).collect()][:5] == ["500", "0.000001", "0.25", "-3.5", "0"]
    small = spark.createDataFrame([(1e-9,), (4e-7,), (-1e-7,), (-0.0,), (1e15,), (1e22,)], "x double")
    assert [r.t for r in small.select(text.number("x").alias("t")).collect()] == ["0.000000001", "0.0000004", "-0.0000001", "0", "1000000000000000", "1.0E22"]
    got = spark.range(1).select(text.hyperlink(F.lit("https://example.org/1"), [F.lit('a "b"'), F.lit(3)]).alias("t")).first().t
    assert got == '=HYPERLINK("https://example.org/1", "a ""b"""&CHAR(10)&"3")'


def test_java_patterns(spark):
    df = spark.createDataFrame([("Abc",), ("x",)], "t string")
    assert df.filter(regex_filter("t", "(?P<a>x)")).count() == 2 and df.filter(regex_filter("t", "(?<a>X)")).count() == 1


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "a", b', None), (2, None, "x")], "id int, t string, u string")
    tables.write_csv(df, f"{tmp_path}/csv")
    assert sorted(map(tuple, spark.read.schema(df.schema).option("header", True).option("escape", '"').csv(f"{tmp_path}/csv").collect())) == sorted(map(tuple, df.collect()))
    tables.write_text(spark, "ERROR", f"{tmp_path}/status")
    assert [r.value for r in spark.read.text(f"{tmp_path}/status").collect()] == ["ERROR"]


def test_malformed_lines_are_kept_beside(spark, tmp_path):
    (tmp_path / "raw.tsv").write_text("a\tb\n1\tNA\nbroken\n2\tx\n1\t2\t3\n")
    tables.text_to_parquet(spark, f"{tmp_path}/raw.tsv", f"{tmp_path}/out")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()), key=str) == [("1", None), ("2", "x")]
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/out-malformed").collect()) == ["1\t2\t3", "broken"]


def test_lines_of_empty_cells_are_rows(spark, tmp_path):
    """A tab-separated line whose cells are all empty is a row; an empty line is none."""
    rows = [("a", 1, None)] + 3 * [(None, None, None)] + [(" ", None, " ")]
    tables.write_tsv(spark.createDataFrame(rows, "t string, n int, u string").repartition(2), f"{tmp_path}/tsv")
    assert sorted(map(tuple, tables.read_tsv(spark, f"{tmp_path}/tsv", "t string, n int, u string").collect()), key=str) == sorted(rows, key=str)
    (tmp_path / "raw.tsv").write_text("a\tb\n1\tNA\n\t\n\n\t\t\n")
    tables.text_to_parquet(spark, f"{tmp_path}/raw.tsv", f"{tmp_path}/out")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()), key=str) == [("1", None), (None, None)]
    assert [r.value for r in spark.read.text(f"{tmp_path}/out-malformed").collect()] == ["\t\t"]


def test_counts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "k int, u string")
    assert tuple(preview.counts(df, ["k", "u"]).first()) == (3, 2) and preview.look_up(df, u=None).count() == 2
    preview.demand_same_rows(df, df)
    with pytest.raises(ValueError, match="3 rows have become 2"):
        preview.demand_same_rows(df, df.distinct())
    assert preview.sample(df, 2, ["k", "u"], 5).collect() == preview.sample(df.orderBy("u"), 2, ["k", "u"], 5).collect()
    assert [r.n_missing for r in preview.columns(df).orderBy("place").collect()] == [0, 2]


def mapping_file(spark, path, n=40):
    rows = [(f"code {i}", "FLAGGED" if i % 3 else "APPROVED", 'say "x",\ny' if i == 7 else None) for i in range(n)]
    df = spark.createDataFrame(rows, "sourceCode string, mappingStatus string, note string")
    tables.write_csv(df.repartitionByRange(3, "sourceCode"), path)
    return lambda: spark.read.option("header", True).option("nullValue", "").option("multiLine", True).option("escape", '"').csv(path)


def test_replaced_in_place(spark, tmp_path):
    path = f"{tmp_path}/mapping"
    read = mapping_file(spark, path)
    before = sorted(map(tuple, read().collect()))
    tables.replace_csv(read().withColumn("mappingStatus", F.when(F.col("mappingStatus") == "FLAGGED", "UNCHECKED").otherwise(F.col("mappingStatus"))), path, ["sourceCode"])
    after = sorted(map(tuple, read().collect()))
    assert len(after) == 40 and after == [(c, "UNCHECKED" if s == "FLAGGED" else s, n) for c, s, n in before]
    assert sorted(os.listdir(tmp_path)) == ["mapping"]
    with pytest.raises(ValueError, match="keys are there twice"):
        tables.replace_csv(read().union(read()), path, ["sourceCode"])
    assert sorted(map(tuple, read().collect())) == after and sorted(os.listdir(tmp_path)) == ["mapping"]
    with pytest.raises(Exception, match="no such thing"):  # the job dies while it writes
        tables.replace_csv(read().withColumn("note", F.raise_error(F.lit("no such thing")).cast("string")), path)
    assert sorted(map(tuple, read().collect())) == after
    tables.recover(spark, path)
    assert sorted(os.listdir(tmp_path)) == ["mapping"]


@pytest.mark.parametrize("renamed,want", [((), 40), (("old",), 2), (("old", "new"), 2)])
def test_a_swap_that_died_is_ended(spark, tmp_path, renamed, want):
    path = f"{tmp_path}/mapping"
    mapping_file(spark, path), mapping_file(spark, f"{path}.__new", 2)
    if "old" in renamed:
        os.rename(path, f"{path}.__old")
    if "new" in renamed:
        os.rename(f"{path}.__new", path)
    tables.recover(spark, path)
    assert sorted(os.listdir(tmp_path)) == ["mapping"]
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).count() == want


def test_lines_over_several_files(spark, tmp_path):
    path = f"{tmp_path}/mapping"
    names = ["conceptId", "sourceCode", "ADD_INFO:testNameAbbreviation", "ADD_INFO:measurementUnit", "conceptName", "ADD_INFO:omopQuantity", "ADD_INFO:validationMessages", "mappingStatus", "ADD_INFO:ignoreReason"]
    rows = [(str(i), f"code {i:03}", "t", "u", "n", "q", "two\nlines", "APPROVED", None) for i in range(90)]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in names))
    tables.write_csv(df.repartitionByRange(4, "sourceCode").sortWithinPartitions("sourceCode"), path)
    assert [(r.line, r.sourceCode) for r in tables.read_mapping(spark, path).orderBy("line").collect()] == [(i + 1, f"code {i:03}") for i in range(90)]
