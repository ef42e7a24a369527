"""Vocabulary tables of any size, projected from part, supplier and customer as results are from events: SQL that either engine reads.

They hold every kind of row that the rules and upkeep steps look for: missing and odd codes, repeated keys, wrong units, outdated concepts, lost parents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labharm.functions import store
from labharm.sources import tables

_TEST = "CASE WHEN p_partkey % 211 = 9 THEN NULL ELSE replace(p_name, ' ', '-') || '-' || CAST(p_partkey % 12 AS STRING) END"
_UNIT = "CASE p_partkey % 8 WHEN 0 THEN 'mmol/l' WHEN 1 THEN 'umol/l' WHEN 2 THEN '%' WHEN 3 THEN 'form' WHEN 4 THEN 'e9/l' WHEN 5 THEN 'mmol/l' WHEN 6 THEN 'odd unit' END"

#: Name -> the given table that it is projected from, and how.
TABLES = {
    "mapping": (
        "part",
        f"""
SELECT line, sourceCode, sourceName, sourceFrequency, testNameAbbreviation, measurementUnit, conceptId, conceptName, omopQuantity, validationMessages, mappingStatus, ignoreReason,
  sourceConceptId, sourceConceptClass, sourceDomain, validStart, validEnd,
  CASE k % 9 WHEN 0 THEN 'no such code' WHEN 1 THEN sourceCode WHEN 2 THEN '' WHEN 3 THEN testNameAbbreviation || '[]' END AS parentCode
FROM (
  SELECT *, CASE WHEN k % 101 = 3 THEN NULL WHEN k % 103 = 4 THEN '  ' WHEN k % 107 = 5 THEN testNameAbbreviation WHEN k % 109 = 6 THEN 'a code of more letters than fifty, which is too many [' || testNameAbbreviation || ']'
      ELSE testNameAbbreviation || '[' || coalesce(measurementUnit, '') || ']' END AS sourceCode,
    CASE WHEN k % 17 = 0 THEN 'Mass fraction' WHEN measurementUnit IN ('mmol/l', 'umol/l') THEN 'Substance Concentration' WHEN measurementUnit = '%' THEN 'Mass fraction' WHEN measurementUnit IN ('form', 'e9/l') THEN 'Number' END AS omopQuantity,
    CASE WHEN conceptId = 0 THEN '' ELSE p_type || ' ' || CAST(conceptId AS STRING) END AS conceptName
  FROM (
    SELECT p_partkey AS k, p_type, CAST(p_partkey + 1 AS INT) AS line, {_TEST} AS testNameAbbreviation, {_UNIT} AS measurementUnit,
      CAST(CASE WHEN p_size % 10 = 0 THEN 0 WHEN p_partkey % 5 = 0 THEN 1 + p_partkey % 120 ELSE 1 + p_partkey % 12 END AS INT) AS conceptId,
      CASE WHEN p_partkey % 113 = 7 THEN NULL WHEN p_partkey % 127 = 8 THEN 'MAYBE' WHEN p_partkey % 131 = 9 THEN ' ' WHEN p_size % 6 < 3 THEN 'APPROVED' WHEN p_size % 6 = 3 THEN 'UNCHECKED' WHEN p_size % 6 = 4 THEN 'FLAGGED' ELSE 'INVALID_TARGET' END AS mappingStatus,
      CASE p_partkey % 19 WHEN 0 THEN 'see #' || CAST(p_size AS STRING) || ' and #81' WHEN 1 THEN 'WARNING: low coverage #12' WHEN 2 THEN 'ERROR: "units", odd' WHEN 3 THEN 'Source value' END AS validationMessages,
      CASE WHEN p_partkey % 23 = 0 THEN 'Not a lab test' END AS ignoreReason,
      CASE WHEN p_partkey % 41 = 0 THEN '' WHEN p_partkey % 43 = 0 THEN repeat(p_name, 60) ELSE p_name END AS sourceName, CAST(CASE WHEN p_partkey % 47 <> 0 THEN p_partkey % 900 END AS INT) AS sourceFrequency,
      CAST(CASE WHEN p_partkey % 53 = 0 THEN NULL WHEN p_partkey % 59 = 0 THEN 2002399999 ELSE 2002400000 + p_partkey END AS BIGINT) AS sourceConceptId,
      CASE WHEN p_partkey % 61 = 0 THEN NULL WHEN p_partkey % 67 = 0 THEN 'A class with a long name' ELSE 'Lab' END AS sourceConceptClass,
      CASE WHEN p_partkey % 71 = 0 THEN NULL WHEN p_partkey % 73 = 0 THEN 'Meas' ELSE 'Measurement' END AS sourceDomain,
      CASE WHEN p_partkey % 79 = 0 THEN '2020-01-01' ELSE '1970-01-01' END AS validStart, CASE WHEN p_partkey % 79 = 0 THEN '2019-12-31' WHEN p_partkey % 83 <> 0 THEN '2099-12-31' END AS validEnd
    FROM part
  ) a
) b
""",
    ),
    "concepts": ("supplier", "SELECT CAST(s_suppkey + 1 AS INT) AS conceptId, CASE WHEN s_suppkey % 11 = 3 THEN 'Drug' WHEN s_suppkey % 7 = 2 THEN 'Condition' WHEN s_suppkey % 13 <> 5 THEN 'Measurement' END AS domainId, CASE WHEN s_suppkey % 9 = 4 THEN 'U' WHEN s_suppkey % 17 = 4 THEN 'D' END AS invalidReason FROM supplier"),
    "conversion": (
        "customer",
        """
SELECT omop_quantity, source_unit_valid, to_source_unit_valid, conversion, only_to_omop_concepts FROM (
  SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN 'Substance Concentration' WHEN 1 THEN 'Mass fraction' ELSE 'Number' END AS omop_quantity,
    CASE c_custkey % 7 WHEN 0 THEN 'mmol/l' WHEN 1 THEN 'umol/l' WHEN 2 THEN '%' WHEN 3 THEN 'form' WHEN 4 THEN 'e6/l' WHEN 5 THEN '' END AS source_unit_valid,
    CASE c_custkey % 5 WHEN 0 THEN 'mmol/l' WHEN 1 THEN 'umol/l' WHEN 2 THEN '%' WHEN 3 THEN 'form' END AS to_source_unit_valid,
    CASE c_custkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '1000' WHEN 2 THEN '0.001' ELSE '10.93*X-23.50' END AS conversion, CASE WHEN c_custkey % 31 = 0 THEN CAST(c_custkey % 120 AS STRING) WHEN c_custkey % 37 = 0 THEN 'all' END AS only_to_omop_concepts FROM customer
) a WHERE k < 105 OR k % 900 = 0
""",
    ),
    "unit_fix": (
        "part",
        f"""
SELECT CASE WHEN k % 151 = 1 THEN '' WHEN k % 157 = 2 THEN 'no such test' ELSE test END AS TEST_NAME_ABBREVIATION, CASE WHEN k % 4 <> 1 THEN 'raw ' || CAST(k % 6 AS STRING) END AS source_unit_clean, CASE WHEN k % 29 <> 4 THEN unit END AS source_unit_clean_fix
FROM (SELECT p_partkey AS k, {_TEST} AS test, {_UNIT} AS unit FROM part WHERE p_partkey % 3 = 1) a
""",
    ),
    "ignored": ("part", f"SELECT {_TEST} AS TEST_NAME, CASE WHEN p_partkey % 9 = 0 THEN 'panel' WHEN p_size % 2 = 0 THEN 'a; b' ELSE 'Not a lab test' END AS REASON FROM part WHERE p_partkey % 5 = 2"),
}
#: Names of a mapping file's columns that aren't those of the table.
ADDED = {c: f"ADD_INFO:{c}" for c in ("testNameAbbreviation", "measurementUnit", "omopQuantity", "validationMessages", "ignoreReason")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, query = TABLES[name]
    return spark.sql(query.replace(f"FROM {source}", "FROM {" + source + "}"), **{source: spark.read.parquet(f"{sf_dir}/{source}.parquet")})


def sql(*names: str) -> str:
    """The tables as common table expressions."""
    return ",\n".join(f"{name} AS ({TABLES[name][1]})" for name in names or TABLES)


def files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The tables as the files that the readers are made for; written once a session."""

    def write() -> str:
        at = store.folder(spark, "vocabulary")
        text = lambda *names: [f"CAST(NULL AS STRING) AS {n}" for n in names]
        tables.write_tsv(table(spark, sf_dir, "unit_fix").selectExpr("*", *text("notes", "validation_messages")), f"{at}/unit_fix")
        tables.write_tsv(table(spark, sf_dir, "conversion").selectExpr("*", *text("validation_messages")), f"{at}/conversion")
        ignored = table(spark, sf_dir, "ignored").selectExpr("TEST_NAME", *text("ORIGINAL_NAME", "MEASUREMENT_UNIT", "CATEGORY"), "REASON", *text("HAD_LEADING_DASH", "ENGLISH_TRANSLATION"))
        tables.write_tsv(ignored, f"{at}/ignored", sep=";")
        tables.write_csv(table(spark, sf_dir, "mapping").orderBy("line").drop("line").withColumnsRenamed(ADDED), f"{at}/mapping")
        tables.write_tsv(table(spark, sf_dir, "concepts"), f"{at}/CONCEPT.csv")
        return at

    at = store.once(spark, "vocabulary", sf_dir, write)
    return {n: f"{at}/{n}" for n in ("unit_fix", "conversion", "ignored", "mapping")} | {"folder": at}


def malformed_text(spark: SparkSession, sf_dir: str) -> str:
    """Names and prices of parts as gzipped tab-separated text, with NA for what is missing and lines of too few and too many cells, then as Parquet. Returns the Parquet table's path."""

    def write() -> str:
        at = store.folder(spark, "raw-text")
        parts = spark.read.parquet(f"{sf_dir}/part.parquet")
        line = "CASE WHEN p_partkey % 50 = 7 THEN p_name WHEN p_partkey % 50 = 8 THEN concat_ws('\\t', p_name, p_brand, 'more') ELSE concat_ws('\\t', p_name || ' ' || p_partkey, CASE WHEN p_size % 4 = 0 THEN 'NA' ELSE p_brand END) END AS value"
        head = spark.sql("SELECT -1L AS k, 'name\\tbrand' AS value")
        lines = head.unionByName(parts.selectExpr("p_partkey AS k", line)).repartitionByRange(1, "k").sortWithinPartitions("k")  # one file, its header first
        lines.select("value").write.option("compression", "gzip").text(f"{at}/raw")
        tables.text_to_parquet(spark, f"{at}/raw", f"{at}/parquet")
        return f"{at}/parquet"

    return store.once(spark, "raw-text", sf_dir, write)
