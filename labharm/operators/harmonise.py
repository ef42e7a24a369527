"""Unit fix, mapping and status, target units, conversion of deciles, and what differs from a release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labharm.functions.keys import keep_first, left_join, na
from labharm.operators.distributions import all_missing
from labharm.operators.order import numbered

AFFINE = r"^\s*(-?[0-9.]+(?:[eE][+-]?[0-9]+)?)\*X([+-][0-9.]+)\s*$"


def fix_units(summary: DataFrame, unit_fix: DataFrame) -> DataFrame:
    """local_MEASUREMENT_UNIT: the rule's unit for the test name and the unit as it came, else the unit; extracted rows are never fixed."""
    rules = unit_fix.select("TEST_NAME_ABBREVIATION", "source_unit_clean", F.col("source_unit_clean_fix").alias("__fix"), F.lit(False).alias("__plain"))
    out = left_join(summary, rules, {"TEST_NAME_ABBREVIATION": "TEST_NAME", "source_unit_clean": "MEASUREMENT_UNIT_PREFIX", "__plain": "IS_EXTRACTED"})
    return out.withColumn("local_MEASUREMENT_UNIT", F.coalesce("__fix", "MEASUREMENT_UNIT_PREFIX")).drop("__fix")


def mapping_rows(mapping: DataFrame) -> DataFrame:
    """One row for each test name and unit: the first in the file."""
    return keep_first(mapping, ["testNameAbbreviation", "measurementUnit"], [F.col("line")]).drop("line")


def map_concepts(summary: DataFrame, mapping: DataFrame) -> DataFrame:
    """Local concept, quantity, status and message by test name and local unit."""
    rows = mapping_rows(mapping).select("testNameAbbreviation", "measurementUnit", F.col("conceptId").alias("local_OMOP_CONCEPT_ID"), F.col("conceptName").alias("local_OMOP_CONCEPT_NAME"), F.col("omopQuantity").alias("local_omopQuantity"), F.col("validationMessages").alias("message"), "mappingStatus", "ignoreReason")
    out = left_join(summary, rows, {"testNameAbbreviation": "TEST_NAME", "measurementUnit": "local_MEASUREMENT_UNIT"})
    ignored = F.col("ignoreReason").isNotNull()
    status = F.when(F.col("mappingStatus") == "APPROVED", "APPROVED").when(ignored, "IGNORED").when(F.col("mappingStatus").isNotNull(), F.col("mappingStatus")).otherwise("NOT-FOUND")
    message = F.when(ignored, F.concat(F.lit("IGNORED: "), F.col("ignoreReason"), F.lit("; "), na("message"))).otherwise(F.col("message"))
    return out.withColumns({"status": status, "message": message}).drop("mappingStatus", "ignoreReason")


def common_units(summary: DataFrame) -> DataFrame:
    """local_OMOP_CONCEPT_ID, target_unit: the unit with most records of approved rows; of equal ones the first by name."""
    used = summary.filter("status = 'APPROVED' and local_MEASUREMENT_UNIT is not null").groupBy("local_OMOP_CONCEPT_ID", "local_MEASUREMENT_UNIT").agg(F.sum("n_records").alias("n"))
    return keep_first(used, ["local_OMOP_CONCEPT_ID"], [F.desc("n"), F.col("local_MEASUREMENT_UNIT")]).select("local_OMOP_CONCEPT_ID", F.col("local_MEASUREMENT_UNIT").alias("target_unit"))


def valid_rules(conversion: DataFrame) -> DataFrame:
    return conversion.filter("source_unit_valid is not null and to_source_unit_valid is not null")


def convert(summary: DataFrame, conversion: DataFrame, blank_units: bool = False) -> DataFrame:
    """Target unit, factor and harmonised unit, by quantity, unit and target. blank_units: rules without a unit count too."""
    out = left_join(summary, common_units(summary), ["local_OMOP_CONCEPT_ID"])
    rules = (conversion if blank_units else valid_rules(conversion)).select("omop_quantity", "source_unit_valid", "to_source_unit_valid", F.col("conversion").alias("__factor"), F.col("only_to_omop_concepts").cast("int").alias("__only"))
    out = left_join(out, rules, {"omop_quantity": "local_omopQuantity", "source_unit_valid": "local_MEASUREMENT_UNIT", "to_source_unit_valid": "target_unit"})
    fits = F.col("__only").isNull() | (F.col("__only") == F.col("local_OMOP_CONCEPT_ID"))
    factor = F.when(fits, F.col("__factor"))
    target = F.when(F.col("local_MEASUREMENT_UNIT").isNotNull(), F.col("target_unit"))
    out = out.withColumns({"local_CONVERSION_FACTOR": factor, "local_MEASUREMENT_UNIT_HARMONIZED_target": target}).drop("__factor", "__only", "target_unit")
    empty = F.coalesce(all_missing("distribution_values"), F.lit(False))
    factor = F.when(~empty, F.col("local_CONVERSION_FACTOR"))
    return out.withColumns({"local_CONVERSION_FACTOR": factor, "local_MEASUREMENT_UNIT_HARMONIZED": F.when(factor.isNotNull(), F.col("local_MEASUREMENT_UNIT_HARMONIZED_target"))})


def linear(factor: str, affine: bool = True) -> tuple[Column, Column]:
    """Slope and offset of a factor: a number, or a*X+b (null if affine is off)."""
    f = F.col(factor)
    number = f.try_cast("double")
    if not affine:
        return number, F.lit(0.0)
    part = lambda i: F.nullif(F.regexp_extract(f, AFFINE, i), F.lit("")).try_cast("double")
    return F.coalesce(number, part(1)), F.coalesce(F.when(number.isNotNull(), F.lit(0.0)), part(2))


def rescale(summary: DataFrame, affine: bool = True) -> DataFrame:
    """local_h: the deciles in the target unit."""
    a, b = linear("local_CONVERSION_FACTOR", affine)
    return summary.withColumns({"__a": a, "__b": b}).withColumn("local_h", F.when(F.col("__a").isNotNull(), F.transform("v", lambda x: x * F.col("__a") + F.col("__b")))).drop("__a", "__b")


def differences(summary: DataFrame) -> DataFrame:
    """What the release says where it differs, for approved rows."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    approved = F.col("status") == "APPROVED"
    differ = lambda l, r: F.when(approved & (text(l) != text(r)), F.concat(F.lit(f"{r}: "), na(r)))  # noqa: E731, E741
    concept = F.when(approved & F.coalesce(F.col("local_OMOP_CONCEPT_ID") != F.col("OMOP_CONCEPT_ID"), F.lit(False)), F.concat(F.lit("OMOP_CONCEPT_ID: "), na("OMOP_CONCEPT_ID")))
    parts = [concept, differ("local_omopQuantity", "omopQuantity"), differ("local_CONVERSION_FACTOR", "CONVERSION_FACTOR"), differ("local_MEASUREMENT_UNIT_HARMONIZED", "MEASUREMENT_UNIT_HARMONIZED")]
    joined = F.concat(*(F.coalesce(F.concat(p, F.lit("<br>")) if i < 3 else p, F.lit("")) for i, p in enumerate(parts)))
    return summary.withColumns({"diff_measurement_unit": F.coalesce(differ("local_MEASUREMENT_UNIT", "MEASUREMENT_UNIT"), F.lit("")), "differences": joined})


def ignore_list_join(mapping: DataFrame, ignored: DataFrame) -> DataFrame:
    rows = ignored.select("TEST_NAME", F.col("REASON").alias("ignoreReasonNew")).distinct()
    return left_join(mapping, rows, {"TEST_NAME": "testNameAbbreviation"})


def ignore_conflicts(mapping: DataFrame, ignored: DataFrame) -> DataFrame:
    """TEST_NAME, problem: names with two reasons, and ignored names that are approved."""
    two = ignored.select("TEST_NAME", "REASON").distinct().groupBy("TEST_NAME").count().filter("count > 1").select("TEST_NAME", F.lit("two reasons").alias("problem"))
    approved = mapping.filter("mappingStatus = 'APPROVED'").join(ignored.select("TEST_NAME"), F.col("testNameAbbreviation") == F.col("TEST_NAME"), "left_semi").select(F.col("testNameAbbreviation").alias("TEST_NAME"), F.lit("approved").alias("problem")).distinct()
    return two.union(approved)


def recode_status(mapping: DataFrame) -> DataFrame:
    return mapping.withColumn("mappingStatus", F.when(F.col("mappingStatus").isin("FLAGGED", "INVALID_TARGET"), "UNCHECKED").otherwise(F.col("mappingStatus")))


def inherit_concepts(mapping: DataFrame) -> DataFrame:
    """testNameAbbreviation, conceptId for tests all of whose approved units have one concept: a row without unit may take it."""
    return mapping.filter("mappingStatus = 'APPROVED'").groupBy("testNameAbbreviation").agg(F.countDistinct("conceptId").alias("n"), F.min("conceptId").alias("conceptId")).filter("n = 1").drop("n")


def row_ids(summary: DataFrame, order: list[Column]) -> DataFrame:
    """A number for each row of the summary in a stated order."""
    return numbered(summary, order, "rowId")
