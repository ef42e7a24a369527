import pytest
from pyspark.sql import functions as F

from labharm.functions.keys import jaro, left_join, numeric_filter, regex_filter
from labharm.operators import drift, extract, harmonise
from labharm.sources import tables


def test_value_types(spark):
    raw = spark.createDataFrame([(1, 5.0, None, 0), (2, 5.0, None, None), (3, None, 7.0, 1), (4, None, None, 1)], "id int, cleaned_value double, extracted_value double, QC_PASS int")
    got = [tuple(r) for r in extract.measurement(raw).orderBy("id").collect()]
    assert got == [(1, False, "QCOut", None), (2, False, "Source", 5.0), (3, True, "Extracted", 7.0), (4, False, None, None)]


def test_null_keys_meet(spark):
    a, b = spark.createDataFrame([("x", None), ("x", "u")], "k string, u string"), spark.createDataFrame([("x", None, 1)], "k string, u string, n int")
    assert sorted(left_join(a, b, ["k", "u"]).collect(), key=str) == sorted([("x", None, 1), ("x", "u", None)], key=str)


@pytest.mark.parametrize("text,want", [("", [None, -1.5, 0.1, 0.3, 0.5, 3.0]), ("0.5-0.1", [0.1, 0.3, 0.5]), ("na", [None]), ("==3", [-1.5, 0.1, 0.3, 0.5, 3.0]), ("3", [3.0]), (" > 0.3", [0.5, 3.0]), (">=.3", [-1.5, 0.1, 0.3, 0.5, 3.0]), ("<= 1e-1", [-1.5, 0.1]), ("-2--1", [-1.5])])
def test_numeric_filter(spark, text, want):
    df = spark.createDataFrame([(x,) for x in (None, -1.5, 0.1, 0.3, 0.5, 3.0)], "v double")
    assert sorted((r.v for r in df.filter(numeric_filter("v", text)).collect()), key=lambda x: (x is not None, x)) == want


def test_regex_filter(spark):
    df = spark.createDataFrame([("Abc",), ("x",), (None,)], "t string")
    assert [r.t for r in df.filter(regex_filter("t", "^aB")).collect()] == ["Abc"] and df.filter(regex_filter("t", "(")).count() == 3


@pytest.mark.parametrize("v,ref,d", [(range(1, 10), range(1, 10), 0.0), (range(1, 10), range(2, 11), 0.1), (range(1, 10), range(100, 109), 0.9), (range(1, 9), range(1, 10), None), (None, range(1, 10), None)])
def test_distance(spark, v, ref, d):
    rows = [(None if v is None else [float(x) for x in v], [float(x) for x in ref])]
    got = spark.createDataFrame(rows, "v array<double>, r array<double>").select(drift.distance("v", "r").alias("d"), drift.distance("r", "v").alias("e")).first()
    assert got.d == got.e == d


def test_p_value(spark):
    got = spark.range(1).select(drift.p_value(F.lit(0.0), F.lit(9.0), F.lit(9.0)), drift.p_value(F.lit(0.9), F.lit(1e4), F.lit(1e4)), drift.p_value(F.lit(0.1), F.lit(2.0), F.lit(2.0))).first()
    assert got[0] == pytest.approx(0, abs=1e-9) and got[1] == pytest.approx(0, abs=1e-9) and got[2] == pytest.approx(1)


def test_conversion_factors(spark):
    df = spark.createDataFrame([("10.93*X-23.50",), ("1000",), ("0.000000001",), (None,), ("odd",)], "f string")
    a, b = harmonise.linear("f")
    assert [tuple(r) for r in df.select(a, b).collect()] == [(10.93, -23.5), (1000.0, 0.0), (1e-9, 0.0), (None, None), (None, None)]
    a, b = harmonise.linear("f", affine=False)
    assert df.select((a * 10.0 + b).alias("x")).first().x is None


def test_jaro(spark):
    df = spark.createDataFrame([("MARTHA", "MARHTA"), ("DIXON", "DICKSONX"), ("", ""), ("a", ""), (None, "a"), ("abc", "xyz")], "a string, b string")
    got = [r[0] for r in df.select(jaro(F.col("a"), F.col("b"))).collect()]
    assert got[:4] == [pytest.approx(1 - 17 / 18), pytest.approx(1 - 0.7666666667), 0.0, 1.0] and got[4] is None and got[5] == 1.0


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "NA", None), (2, None, "x")], "n int, a string, b string")
    tables.write_tsv(df, str(tmp_path / "t"))
    assert sorted(tables.read_tsv(spark, str(tmp_path / "t"), df.schema).collect()) == sorted(df.collect())
    assert [r.a for r in tables.read_tsv(spark, str(tmp_path / "t"), df.schema, na_text=True).orderBy("n").collect()] == [None, None]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_extracts(spark, str(tmp_path / "none"))
