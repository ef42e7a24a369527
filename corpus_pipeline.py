"""The corpus pipeline: documents without toxic ones, near copies and benchmark items, mixed to target weights, as token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; what a stage returns is written as Parquet and read again.
All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labharm.llm import catalog, decontaminate, mixing, ngram_join, token_tables, toxicity
from labharm.llm.common import cut, shared_dir, small_batches

#: The share of the tokens that the mixture may take; each document is used once at most.
BUDGET_SHARE = 0.8


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.clean(docs, toxicity.fit(docs, catalog.table(spark, sf_dir, "labels").filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_join.dedup(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return decontaminate.without(docs, catalog.table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return mixing.mix(docs, catalog.domain(), catalog.WEIGHTS, BUDGET_SHARE, 1, catalog.SEED).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    uri = shared_dir(spark, "pipeline-tokens")
    return token_tables.read(spark, uri, token_tables.write(docs, uri, public_tokenizers.path("word_bpe_49k.json"), 2, by_word=True))


STAGES = [("toxicity", without_toxic), ("ngram_join", without_near_copies), ("decontaminate", without_benchmark), ("mixing", mixed), ("token_tables", token_ids)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = catalog.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
