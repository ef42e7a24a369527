import numpy as np
from pyspark.sql import functions as F
from twins import compare

from labharm.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def clustered(spark, n=4000, size=16, seed=3):
    """Rows around 40 directions, with labels by direction, some of them wrong."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, size))
    at = rng.integers(40, size=n)
    x = centres[at] + 0.05 * rng.normal(size=(n, size))
    labels = np.where(rng.random(n) < 0.3, rng.integers(10, size=n), at % 10)
    return spark.createDataFrame([(i, [float(v) for v in x[i]], int(labels[i])) for i in range(n)], SCHEMA)


def test_lists_are_skipped_and_nothing_is_lost(spark, tmp_path):
    rows = clustered(spark)
    got = compare(spark, tmp_path, "op13_hard_negatives", embeddings=rows)
    assert len(got) > 100
    scored = spark.sparkContext.accumulator(0)
    N.mine(rows, F.col("vec_id") % 100 == 0, scored=scored).collect()
    assert 0 < scored.value < 0.5 * 2 * 40 * 4000  # pairs compared, of those that two scans of everything would take


def test_probes_and_blocks_change_nothing(spark):
    rows = clustered(spark, 1500)
    find = lambda **more: sorted(map(tuple, N.mine(rows, F.col("vec_id") % 50 == 0, **more).collect()))
    want = find()
    assert want and find(probes=1) == want and find(probes=256) == want and find(block=7) == want


def test_hot_vectors_and_ties(spark, tmp_path):
    rows = [(i, [0.5, 0.25, 0.0, 0.125], i % 3) for i in range(700)] + [(i, [0.5 - 1e-3 * (i % 90), 0.25, 0.1, 0.0], i % 4) for i in range(700, 1500)]
    got = compare(spark, tmp_path, "op13_hard_negatives", embeddings=spark.createDataFrame(rows, SCHEMA))
    assert set(got["rank"]) == {1, 2, 3, 4, 5}


def test_large_components_stay_exact(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=4) * 3e4], int(rng.integers(3))) for i in range(500)]
    compare(spark, tmp_path, "op13_hard_negatives", embeddings=spark.createDataFrame(rows, SCHEMA))


def test_edges(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(size=3)], i % 2) for i in range(60)]
    bad = [(100, [1.0, 1.0, 1.0], None), (200, None, 1), (300, [1.0, None, 1.0], 1), (400, [1.0, float("nan"), 1.0], 1), (500, [float("inf"), 1.0, 1.0], 0), (600, [1.0, 1.0], 0), (700, [], 0), (None, [1.0, 1.0, 1.0], 1), (800, [0.0, 0.0, 0.0], 1), (900, [1e9, 1.0, 1.0], 1)]
    repeated = [(0, [2.0, 2.0, 2.0], 1), (0, [2.0, 2.0, 2.0], 1), (1000, [1.0, 2.0, 3.0], 0), (1000, [1.0, 2.0, 3.0], 0), (1000, [1.0, 2.0, 2.0], 0)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows + bad + repeated], f"{SCHEMA}, list int, rank int")
    got = compare(spark, tmp_path, "op13_hard_negatives", embeddings=df)
    assert {0, 1000} <= set(got.anchor_id) and not set(got.anchor_id) & {100, 200, 300, 400, 500, 600, 700, 900}
    assert len(compare(spark, tmp_path, "op13_hard_negatives", embeddings=df.limit(0))) == 0
    one_label = df.filter("label = 1")
    assert len(compare(spark, tmp_path, "op13_hard_negatives", embeddings=one_label.filter("vec_id % 7 <> 0"))) == 0


def test_given_tables(spark, tmp_path):
    compare(spark, tmp_path, "op13_hard_negatives", embeddings=spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"))
