import random
from types import SimpleNamespace

import corpus_pipeline as P
import pyarrow as pa
import pyarrow.parquet as pq
from labharm.llm import catalog, common, decontaminate, ngram_join, toxicity
from labharm.llm.ngram_join import join

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = catalog.table(spark, SF, "documents")
    names, functions = zip(*P.STAGES)
    assert names == ("toxicity", "ngram_join", "decontaminate", "mixing", "token_tables")
    kept = [docs]
    for f in functions[:-1]:
        kept.append(f(spark, kept[-1], SF).cache())
        assert kept[-1].columns == docs.columns
        ids = [r.doc_id for r in kept[-1].select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= {r.doc_id for r in kept[-2].select("doc_id").collect()}
    _, clean, single, free, mixed = kept
    model = toxicity.fit(docs, catalog.table(spark, SF, "labels").filter("crc32(cast(doc_id as string)) % 5 <> 0"))
    toxic = {r.doc_id for r in toxicity.score(docs, model).filter("score >= 0.5").collect()}
    assert {r.doc_id for r in docs.collect()} - toxic == {r.doc_id for r in clean.collect()}
    groups = join(clean).collect()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in groups}
    hit = {r.doc_id for r in decontaminate.find(single, catalog.table(spark, SF, "benchmark")).collect()}
    assert {r.doc_id for r in free.collect()} == {r.doc_id for r in single.collect()} - hit
    assert 0 < mixed.count() < free.count()
    out = functions[-1](spark, mixed, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in mixed.collect())


def test_edges(spark):
    """Nulls, empty texts, repeated rows and an empty table pass every stage."""
    schema = catalog.table(spark, SF, "documents").schema
    rows = [(None, None, None, None, None), (None, "", None, None, 0), (1, "same words stand here twice", "en", "src1", 27), (1, "same words stand here twice", "en", "src1", 27), (2, "\t", "en", None, 1)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, f in P.STAGES[:-1]:
            docs = f(spark, docs, SF)
            assert docs.columns == schema.names
        assert P.STAGES[-1][1](spark, docs, SF).count() == docs.count() <= 1


def test_rows_of_one_id(spark):
    """Rows that share a doc_id, or have none, are judged one by one."""
    rnd = random.Random(4)
    say = lambda n: ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    a, b, c, d, e, item = ([say(60) for _ in range(6)])
    near = lambda w: [*w[:-1], "other"]
    rows = [(1, a), (1, b), (1, near(a)), (2, near(a)), (3, near(b)), (None, c), (None, near(c)), (None, d), (4, e), (5, []), (5, []), (None, [])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(3)
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.dedup(docs).collect()), key=str)
    group = lambda i, t: (i, min(t[:20], t))
    assert sorted((group(i, t) for i, t in kept), key=str) == sorted((group(i, " ".join(w)) for i, w in [(1, a), (1, b), (None, c), (None, d), (4, e), (5, []), (None, [])]), key=str)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in [(None, a), (None, b + item + c), (7, d), (7, item)]], "doc_id long, text string")
    free = decontaminate.without(docs, spark.createDataFrame([(1, " ".join(item)), (2, "x y z")], "item_id long, text string"), block_words=1)
    assert {(r.doc_id, r.text) for r in free.collect()} == {(None, " ".join(a)), (7, " ".join(d))}


def test_texts_come_in_small_batches(spark):
    """10,000 long texts are no single Arrow batch once a stage has been called."""
    docs = spark.range(3000, numPartitions=1).selectExpr("id AS doc_id", "repeat('some words ', 1000) AS text")
    decontaminated = P.without_benchmark(spark, docs, SF)
    try:
        sizes = decontaminated.select("text").mapInArrow(lambda batches: (b.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()
        assert sum(r.n for r in sizes) > 30_000_000 and max(r.n for r in sizes) < 6_000_000
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")


def test_tables_of_texts_have_small_row_groups(spark, tmp_path):
    """Neither a writer nor a reader of a stage's table holds all texts of a file."""
    docs = spark.range(3000, numPartitions=1).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 100), x -> sha2(concat(id, ' ', x), 256)), ' ') AS text")
    P.small_batches(spark)
    try:
        docs.write.parquet(f"file://{tmp_path}/texts")
        (file,) = tmp_path.glob("texts/*.parquet")
        groups = pq.ParquetFile(file).metadata
        sizes = [groups.row_group(i).total_byte_size for i in range(groups.num_row_groups)]
        assert sum(sizes) > 15_000_000 and max(sizes) < 6_000_000
        assert spark.read.parquet(f"file://{tmp_path}/texts").exceptAll(docs).count() == 0
    finally:
        for key in ("spark.sql.execution.arrow.maxBytesPerBatch", *common.TABLE_BOUNDS):
            spark.conf.unset(key)


def test_a_session_keeps_bounds_of_its_own(spark):
    spark.conf.set("parquet.block.size", 1 << 20)
    try:
        P.small_batches(spark)
        assert spark.conf.get("parquet.block.size") == str(1 << 20) and spark.conf.get("parquet.read.allocation.size") == str(1 << 18)
    finally:
        for key in ("spark.sql.execution.arrow.maxBytesPerBatch", *common.TABLE_BOUNDS):
            spark.conf.unset(key)


def test_a_cleaned_task_leaves_no_words_behind():
    """Mixing runs no Python: what a worker kept of decontaminate would lie there through it."""
    index = decontaminate.Index([(1, "one two three four five six seven eight")], 5, 0.8)
    batch = pa.RecordBatch.from_pydict({"text": ["zero one two three four five six seven eight nine", "none of these", None]})
    (left,) = decontaminate.clean(iter([batch]), 0, SimpleNamespace(value=index), 0.8)
    assert left.column(0).to_pylist() == ["none of these", None]
    assert not decontaminate._hashes
