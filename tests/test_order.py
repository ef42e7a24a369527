"""Order statistics against whole sorted lists, with one key that holds nine tenths of all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labharm.functions.keys import K5
from labharm.operators import drift, extract, order


@pytest.fixture
def spread(spark):
    """Range partitions stay as many as they are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def hot(spark, n=20_000, seed=1):
    rng = np.random.default_rng(seed)
    keys = [None if x < 0.05 else "hot" if x < 0.95 else f"k{int(x * 1000) % 7}" for x in rng.random(n)]
    values = [float(v) for v in np.round(rng.normal(size=n), 3)]
    return keys, values, spark.createDataFrame(list(zip(keys, values)), "k string, value double").repartition(5)


def test_quantiles(spread):
    keys, values, df = hot(spread)
    at = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    counts = df.groupBy("k", "value").agg(F.count("*").alias("n"))
    got = {r.k: r.q for r in order.quantiles(counts, ["k"], at).collect()}
    for k in set(keys):
        want = np.quantile([v for x, v in zip(keys, values) if x == k], at)
        assert got[k] == pytest.approx(want, abs=1e-12)
    table = order.ranged(counts, ["k", "value"])
    parts = order.before(table, ["k"], ["n"]).filter("k = 'hot'").collect()
    assert len(parts) > 3 and max(p.here_n for p in parts) < 0.5 * sum(p.here_n for p in parts)  # the hot key lies in many partitions
    assert order.quantiles(counts.limit(0), ["k"], at).count() == 0


def test_one_value_and_missing_ones(spread):
    df = spread.createDataFrame([("a", 1.0, 1), ("b", 2.0, 3), ("b", 5.0, 1), ("c", None, 4)], "k string, value double, n int")
    assert {r.k: r.q for r in order.quantiles(df, ["k"], [0.1, 0.5, 1.0]).collect()} == {"a": [1.0] * 3, "b": [2.0, 2.0, 5.0]}


def test_numbers(spread):
    keys, values, df = hot(spread, 3000)
    got = order.numbered(df.withColumn("id", F.monotonically_increasing_id()), [F.desc("value"), F.asc_nulls_first("k"), F.col("id")], "n")
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    rows = got.orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, 3001))
    assert [(-r.value, r.k or "") for r in rows] == sorted((-v, k or "") for k, v in zip(keys, values))


def test_gaps(spread):
    keys, values, df = hot(spread, 8000)
    by = F.when(F.col("k") == "hot", "x").otherwise("y")
    sample = df.withColumn("by", by)
    reference = spread.createDataFrame([("x", float(v) / 500) for v in range(-900, 1100)] + [("z", 1.0)], "by string, value double")
    got = {r.k: r for r in order.gaps(sample, reference, ["k", "by"], ["by"]).collect()}
    mine, theirs = np.sort([v for k, v in zip(keys, values) if k == "hot"]), np.arange(-900, 1100) / 500
    grid = np.concatenate([mine, theirs])
    want = np.abs(np.searchsorted(mine, grid, "right") / len(mine) - np.searchsorted(theirs, grid, "right") / len(theirs)).max()
    assert got["hot"].gap == pytest.approx(want, abs=1e-12) and (got["hot"].n_sample, got["hot"].n_reference) == (len(mine), len(theirs))
    assert got[None].gap is None and got[None].n_reference == 0
    assert {r.k: r.ks for r in drift.two_samples(sample, reference, ["k", "by"], ["by"]).collect()}["hot"] == got["hot"].gap


def results(spark, n=4000):
    rng = np.random.default_rng(4)
    rows = [(f"s{int(rng.integers(400))}", 1, "t" if i % 10 else f"t{i % 3}", "u", "u", bool(i % 10 == 9), "mmol/l", None, "1", "Source" if i % 4 else None, ("N", "H", None)[i % 3], float(rng.normal()) if i % 4 else None, float(rng.normal()) if i % 8 else None) for i in range(n)]
    return spark.createDataFrame(rows, "subject string, OMOP_CONCEPT_ID int, TEST_NAME string, MEASUREMENT_UNIT_PREFIX string, MEASUREMENT_UNIT string, IS_EXTRACTED boolean, MEASUREMENT_UNIT_HARMONIZED string, omopQuantity string, CONVERSION_FACTOR string, MEASUREMENT_VALUE_TYPE string, TEST_OUTCOME string, MEASUREMENT_VALUE double, HARMONIZED_VALUE double")


def test_extracts_from_one_scan(spark, tmp_path):
    results(spark).write.parquet(f"{tmp_path}/m")
    m = spark.read.parquet(f"{tmp_path}/m")
    facts = extract.facts(m)
    assert facts._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    got = extract.all_extracts(facts)
    for name, want in (("summaryTest", extract.summary_test(m)), ("summaryValuesSource", extract.summary_values_source(m)), ("summaryOutcomes", extract.summary_outcomes(m))):
        assert sorted(map(str, got[name].select(*want.columns).collect())) == sorted(map(str, want.collect())) and want.count() > 1
    values = got["summaryValues"].collect()
    plain = m.filter("MEASUREMENT_VALUE is not null").groupBy(*K5).agg(F.countDistinct("subject").alias("s"), F.percentile("HARMONIZED_VALUE", F.lit(0.3)).alias("h"), F.percentile("MEASUREMENT_VALUE", F.lit(0.3)).alias("v")).filter("s >= 60").collect()
    assert len(values) == 9 * len(plain) and {tuple(r[c] for c in K5): (pytest.approx(r.v), pytest.approx(r.h)) for r in plain} == {tuple(r[c] for c in K5): (r.decile_MEASUREMENT_VALUE, r.decile_MEASUREMENT_VALUE_HARMONIZED) for r in values if abs(r.decile - 0.3) < 1e-9}


def test_facts_are_counted_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    """However few parts the input has, no task counts many more than TASK_RECORDS records before their facts are shuffled."""
    results(spark).coalesce(1).write.parquet(f"{tmp_path}/m")
    m = spark.read.parquet(f"{tmp_path}/m")
    whole = extract.facts(m)
    monkeypatch.setattr(extract, "TASK_RECORDS", 500)
    found = extract.facts(m)
    assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    counted, dealt = plan.index("partial_count(1)"), plan.index(", 8), REPARTITION_BY_NUM")
    assert counted < dealt < plan.index("FileScan")


def test_injection_reads_written_values(spark, monkeypatch):
    """Both samples come from a written table, not from filters on the records' nested expressions."""
    from labharm import catalog
    from labharm.functions import store

    store.forget()
    seen = []
    two = drift.two_samples
    monkeypatch.setattr(drift, "two_samples", lambda a, b, *keys: seen.extend((a, b)) or two(a, b, *keys))
    assert catalog.QUERIES["unit_injection_ks"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(seen) == 2 and not any("get_json_object" in df._jdf.queryExecution().optimizedPlan().toString() for df in seen)


def test_sketches_merge(spark):
    m = results(spark).withColumn("month", F.pmod(F.hash("MEASUREMENT_VALUE"), F.lit(5)))
    rows = extract.sketched_deciles(extract.merged(extract.sketches(m, ["month"]))).filter("TEST_NAME = 't'").collect()
    values = sorted(r.MEASUREMENT_VALUE for r in m.filter("TEST_NAME = 't' and not IS_EXTRACTED and MEASUREMENT_VALUE is not null").collect())
    assert rows and all(r.n == len(values) and abs(np.searchsorted(values, r.value) / len(values) - r.decile) <= extract.SKETCH_ERROR for r in rows if not r.IS_EXTRACTED)
