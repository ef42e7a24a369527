"""Rules and preconditions: missing columns are logged, hot keys are added up, conditions end jobs."""

import pytest
from pyspark.sql import functions as F

from labharm.operators import checks, validate
from labharm.plans import vocabulary

SF = "/root/testdata/sf0.01"


def tables(spark):
    return [vocabulary.table(spark, SF, n) for n in ("mapping", "conversion", "concepts", "unit_fix")]


def test_each_kind_of_breach_is_there(spark):
    log = {r.step: r for r in validate.log("LAB", *tables(spark)).collect()}
    assert list(map(str, sorted(log))) == sorted(r.step for r in validate.RULES) and len(log) == 36
    silent = {s for s, r in log.items() if not r.n}
    assert silent == {s for s in log if s.startswith("Missing")}
    assert all(r.type == ("SUCCESS" if not r.n else next(x.severity for x in validate.RULES if x.step == r.step)) for r in log.values())
    assert log["LAB: not APPROVED Invalid lab unit"].message == f"Found {log['LAB: not APPROVED Invalid lab unit'].n} not APPROVED lab source codes where unit is not in validUnitsList or is NA"


def test_one_scan_a_table(spark):
    plan = validate.log("LAB", *tables(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 4


def test_missing_columns_are_logged(spark):
    mapping, conversion, concepts, fix = tables(spark)
    whole = {r.step: r for r in validate.log("LAB", mapping, conversion, concepts, fix).collect()}
    log = {r.step: r for r in validate.log("LAB", mapping.drop("sourceCode", "validStart", "parentCode", "sourceDomain"), conversion, concepts, fix.drop("source_unit_clean")).collect()}
    assert [(log[s].type, log[s].message) for s in ("Missing default columns", "Missing C&CR columns", "Missing date columns", "Missing parent columns", "Missing required columns")] == [("ERROR", f"Found 1 missing columns: {c}") for c in ("sourceCode", "sourceDomain", "validStart", "parentCode", "source_unit_clean")]
    assert log["SourceCode is empty"].n == mapping.count() and log["Invalid parent concept code"].n == log["SourceValidStartDate is after SourceValidEndDate"].n == 0
    assert all(log[s].n == whole[s].n for s in ("MappingStatus is not valid", "LAB: APPROVED Invalid lab quantity", "TEST_NAME_ABBREVIATION is empty", "LAB: Invalid lab mapped domain"))


def test_no_rows(spark):
    log = validate.log("LAB", *(t.limit(0) for t in tables(spark)))
    assert log.filter("n > 0").count() == 0 and validate.final_status(log).first()[0] == "SUCCESS"


def test_page(spark):
    log = validate.log("LAB", *tables(spark))
    lines = [r.line for r in validate.page(log).orderBy("place").collect()]
    assert lines[0] == "# Vocabularies Validation Status" and lines[4:6] == ["|context|SUCCESS|WARNING|ERROR|", "|:--|--:|--:|--:|"] and lines[6].startswith("|LAB|5|")
    assert lines[10] == "|context|type|step|message|" and lines[12] == "|LAB|SUCCESS|Missing default columns||" and len(lines) == 12 + 36


def test_demands(spark):
    df = spark.range(100).withColumn("n_subjects", F.col("id") + 6)
    assert checks.enough_subjects(df).count() == 100
    with pytest.raises(Exception, match="a cell of 5 subjects"):
        checks.enough_subjects(df.unionByName(spark.range(1).withColumn("n_subjects", F.lit(5)))).collect()
    with pytest.raises(Exception, match="a cell of no subjects"):
        checks.enough_subjects(df.withColumn("n_subjects", F.lit(None).cast("long"))).write.format("noop").mode("overwrite").save()
    out, seen = checks.observed(df, even=F.col("id") % 2 == 0, none=F.col("id") < 0)
    out.collect()
    assert seen.get == {"rows": 100, "even": 50, "none": 0}
