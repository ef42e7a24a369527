"""The example domain: raw results projected from the events table, and small vocabulary tables, for Spark and as SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labharm.functions import store
from labharm.operators import checks, extract
from labharm.sources import tables

#: Raw results out of events; {k} is the number in props, as either engine reads it.
RAW = """
SELECT subject, TEST_OUTCOME, TEST_NAME, MEASUREMENT_UNIT_PREFIX, MEASUREMENT_UNIT, cleaned_value, extracted_value, QC_PASS, OMOP_CONCEPT_ID, omopQuantity, MEASUREMENT_UNIT_HARMONIZED, CONVERSION_FACTOR,
  (CASE WHEN QC_PASS = 0 THEN NULL WHEN cleaned_value IS NOT NULL THEN cleaned_value ELSE extracted_value END) * CAST(CONVERSION_FACTOR AS DOUBLE) AS HARMONIZED_VALUE
FROM (
  SELECT *, CASE WHEN MEASUREMENT_UNIT_HARMONIZED = MEASUREMENT_UNIT THEN '1' WHEN MEASUREMENT_UNIT_HARMONIZED = 'mmol/l' AND MEASUREMENT_UNIT = 'umol/l' THEN '0.001' WHEN MEASUREMENT_UNIT_HARMONIZED = 'umol/l' AND MEASUREMENT_UNIT = 'mmol/l' THEN '1000' END AS CONVERSION_FACTOR
  FROM (
    SELECT *, CASE OMOP_CONCEPT_ID WHEN 103 THEN 'umol/l' WHEN 104 THEN '%' WHEN 101 THEN 'mmol/l' WHEN 102 THEN 'mmol/l' END AS MEASUREMENT_UNIT_HARMONIZED,
      CASE WHEN OMOP_CONCEPT_ID = 104 THEN 'Mass fraction' WHEN OMOP_CONCEPT_ID IS NOT NULL THEN 'Substance Concentration' END AS omopQuantity
    FROM (
      SELECT subject, TEST_OUTCOME, TEST_NAME, unit AS MEASUREMENT_UNIT_PREFIX, unit AS MEASUREMENT_UNIT, cleaned_value, extracted_value, QC_PASS,
        CASE WHEN unit IS NULL THEN NULL WHEN TEST_NAME = 'click' THEN 101 WHEN TEST_NAME = 'view' THEN 102 WHEN TEST_NAME = 'purchase' THEN 103 WHEN TEST_NAME = 'signup' THEN 104 END AS OMOP_CONCEPT_ID
      FROM (
        SELECT CAST(user_id AS STRING) AS subject, event_type AS TEST_NAME,
          CASE event_id % 7 WHEN 0 THEN 'N' WHEN 1 THEN 'A' WHEN 2 THEN 'L' WHEN 3 THEN 'H' WHEN 4 THEN 'HH' END AS TEST_OUTCOME,
          CASE {k} % 5 WHEN 0 THEN 'mmol/l' WHEN 1 THEN 'umol/l' WHEN 2 THEN 'form' WHEN 3 THEN '%' END AS unit,
          CASE WHEN event_id % 10 < 7 AND NOT (event_type = 'error' AND {k} % 5 = 2) THEN value END AS cleaned_value,
          CASE WHEN event_id % 10 BETWEEN 5 AND 8 AND NOT (event_type = 'error' AND {k} % 5 = 2) THEN value * 1.1 END AS extracted_value,
          CASE WHEN event_id % 37 = 0 THEN 0 WHEN event_id % 41 = 0 THEN NULL ELSE 1 END AS QC_PASS
        FROM events
      ) a
    ) b
  ) c
) d
"""

#: What the chain maps the results' tests with: columns (as DDL) and rows.
TABLES = {
    "unit_fix": ("TEST_NAME_ABBREVIATION string, source_unit_clean string, source_unit_clean_fix string", [("click", "form", "umol/l"), ("view", None, "mmol/l"), ("purchase", "form", None), ("signup", None, "%"), ("error", "%", "form"), ("", "x", "y"), ("click", "form2", "pH")]),
    "mapping": (
        "line int, sourceCode string, testNameAbbreviation string, measurementUnit string, conceptId int, conceptName string, omopQuantity string, validationMessages string, mappingStatus string, ignoreReason string",
        [
            (1, "click[mmol/l]", "click", "mmol/l", 101, "Click moles", "Substance Concentration", None, "APPROVED", None),
            (2, "click[umol/l]", "click", "umol/l", 101, "Click moles", "Substance Concentration", "Missing value in part", "APPROVED", "kept anyway"),
            (3, "click[mmol/l]", "click", "mmol/l", 999, "Other", "Substance Concentration", None, "APPROVED", None),
            (4, "view[mmol/l]", "view", "mmol/l", 102, "View moles", "Substance Concentration", "WARNING: low coverage #12", "APPROVED", None),
            (5, "view[umol/l]", "view", "umol/l", 102, "View moles", "Substance Concentration", None, "FLAGGED", None),
            (6, "purchase[umol/l]", "purchase", "umol/l", 113, "Purchase moles", "Substance Concentration", None, "APPROVED", None),
            (7, "purchase[mmol/l]", "purchase", "mmol/l", 113, "Purchase moles", "Substance Concentration", "see #7 and #81", "APPROVED", None),
            (8, "purchase[form]", "purchase", "form", 0, "", None, None, "UNCHECKED", "Not a lab test"),
            (9, "signup[%]", "signup", "%", 104, "Signup share", "Mass fraction", "Extracted value, Source value", "APPROVED", None),
            (10, "signup[mmol/l]", "signup", "mmol/l", 104, "Signup share", "Mass fraction", "ERROR: units", "APPROVED", None),
            (11, "signup[umol/l]", "signup", "umol/l", 104, "Signup share", "Mass fraction", "Source value", "APPROVED", None),
            (12, "error", "error", None, 0, "", None, None, "INVALID_TARGET", None),
            (13, "error[form]", "error", "form", 105, "Error forms", "Number", "WARNING: no values", "APPROVED", None),
            (14, "error[%]", "error", "%", 0, "None", "Number", "odd", "UNCHECKED", "panel"),
        ],
    ),
    "conversion": (
        "omop_quantity string, source_unit_valid string, to_source_unit_valid string, conversion string, only_to_omop_concepts string",
        [
            ("Substance Concentration", "mmol/l", "mmol/l", "1", None), ("Substance Concentration", "umol/l", "mmol/l", "0.001", None), ("Substance Concentration", "mmol/l", "umol/l", "1000", None), ("Substance Concentration", "umol/l", "umol/l", "1", None),
            ("Substance Concentration", None, "mmol/l", "1", None), ("Mass fraction", "%", "%", "1", None), ("Mass fraction", "mmol/l", "%", "10.93*X-23.50", None), ("Mass fraction", "umol/l", "%", "0.0001", "999"), ("Number", "form", "form", "1", None), ("Number", "e9/l", "e6/l", "1000", None), ("Number", "e6/l", "e9/l", "1000", None),
        ],
    ),
}


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW.format(k="CAST(get_json_object(props, '$.k') AS INT)").replace("FROM events", "FROM {events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def vocabulary(spark: SparkSession, name: str) -> DataFrame:
    schema, rows = TABLES[name]
    return spark.createDataFrame(rows, schema)


def sql_value(x) -> str:
    return "NULL" if x is None else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"


def sql_tables() -> str:
    """The vocabulary tables as common table expressions."""
    out = []
    for name, (schema, rows) in TABLES.items():
        columns = [c.split() for c in schema.split(", ")]
        casts = ", ".join(f"CAST({c} AS {'INTEGER' if t == 'int' else 'VARCHAR'}) AS {c}" for c, t in columns)
        values = ", ".join("(" + ", ".join(map(sql_value, r)) + ")" for r in rows)
        out.append(f"{name} AS (SELECT {casts} FROM (VALUES {values}) t({', '.join(c for c, _ in columns)}))")
    return ",\n".join(out)


def extract_files(spark: SparkSession, sf_dir: str, extracts: Callable[[], dict[str, DataFrame]]) -> str:
    """The folder with the four extracts as tab-separated files, written once a session."""

    def write() -> str:
        at = store.folder(spark, "extracts")
        for name, df in extracts().items():
            columns = df.select(*(c.split()[0] for c in tables.SCHEMAS[name].split(", ")))
            written, seen = checks.observed(checks.enough_subjects(columns))
            tables.write_tsv(written, f"{at}/{name}.tsv")
            again, small = checks.observed(tables.read_tsv(spark, f"{at}/{name}.tsv", tables.SCHEMAS[name]), small=F.col("n_subjects") < extract.MIN_SUBJECTS)
            again.write.format("noop").mode("overwrite").save()
            if small.get["small"] or small.get["rows"] != seen.get["rows"]:
                raise ValueError(f"{name}: {seen.get['rows']} rows were written, {small.get['rows']} read again, {small.get['small']} of them of too few subjects")
        return at

    return store.once(spark, "extract-files", sf_dir, write)
