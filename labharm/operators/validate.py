"""Rules for the vocabulary tables, the log they give, its roll-up and its page.

All rules are judged in one pass: each row of a table gives a fact for every row rule that it breaks, and facts by key for the rules about keys (is a code
there twice, is a unit known, which domains do a code's targets have). One aggregation by rule and key, with partial sums before the shuffle, and one
over its keys make the log. So each table is scanned once, nothing is broadcast by hint, and a key that most rows share is added up where the rows are.

The rules' names are published (fixed values); their conditions are read off the names. A table that lacks columns is logged by the schema rules, and judged as if
they were all missing values.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labharm.operators.harmonise import valid_rules

STATUSES = ["APPROVED", "IGNORED", "UNCHECKED", "FLAGGED", "INVALID_TARGET"]
SEVERITY = ["SUCCESS", "WARNING", "ERROR"]
#: Ids that source codes may have: the first, and how many there are.
FIRST_ID, IDS = 2_002_400_000, 100_000
#: Domains of the common data model, and those which the targets of one code may have together.
DOMAINS = ["Condition", "Device", "Drug", "Measurement", "Observation", "Procedure", "Specimen", "Unit", "Visit"]
TOGETHER = ["Condition|Measurement", "Condition|Observation", "Condition|Procedure", "Measurement|Observation", "Measurement|Procedure", "Observation|Procedure"]

#: Columns that each table should have, by schema rule.
DEFAULT = ["sourceCode", "sourceName", "sourceFrequency", "conceptId", "conceptName", "mappingStatus"]
CONCEPT_CLASS = ["sourceConceptId", "sourceConceptClass", "sourceDomain"]
DATES, PARENTS, LAB = ["validStart", "validEnd"], ["parentCode"], ["testNameAbbreviation", "measurementUnit", "omopQuantity"]
FIX = ["TEST_NAME_ABBREVIATION", "source_unit_clean", "source_unit_clean_fix"]


class Rule(NamedTuple):
    """Published name, what a breach means, and what the message says after "Found n"."""

    step: str
    severity: str = "ERROR"
    found: str = "rows"


#: Names (and the four known messages) of the rules, in the published order.
RULES = [
    Rule("Missing default columns", found="missing columns"),
    Rule("SourceCode is empty"),
    Rule("SourceCode and conceptId are not unique", found="repeated pairs"),
    Rule("SourceCode is more than 50 characters"),
    Rule("SourceName is empty"),
    Rule("SourceName is more than 255 characters"),
    Rule("SourceFrequency is not empty"),
    Rule("MappingStatus is empty"),
    Rule("MappingStatus is not valid"),
    Rule("APPROVED mappingStatus conceptId is 0"),
    Rule("APPROVED mappingStatus with concepts outdated"),
    Rule("Not APPROVED mappingStatus with concepts outdated", "WARNING"),
    Rule("Missing C&CR columns", found="missing columns"),
    Rule("SourceConceptId is empty"),
    Rule("SourceConceptId is not a number on the range"),
    Rule("SourceConceptClass is empty"),
    Rule("SourceConceptClass is more than 20 characters"),
    Rule("SourceDomain is empty"),
    Rule("SourceDomain is not a valid domain"),
    Rule("Not APPROVED mappingStatus with valid domain combination", "WARNING", "codes"),
    Rule("APPROVED mappingStatus with valid domain combination", found="codes"),
    Rule("Missing date columns", found="missing columns"),
    Rule("SourceValidStartDate is after SourceValidEndDate"),
    Rule("Missing parent columns", found="missing columns"),
    Rule("Invalid parent concept code"),
    Rule("LAB: Invalid lab source name format"),
    Rule("LAB: APPROVED Invalid lab unit", found="APPROVED lab source codes where unit is not in validUnitsList or is NA"),
    Rule("LAB: not APPROVED Invalid lab unit", "WARNING", "not APPROVED lab source codes where unit is not in validUnitsList or is NA"),
    Rule("LAB: Invalid lab mapped domain", "WARNING", "mapped lab source codes where domain is not 'Measurement'"),
    Rule("LAB: APPROVED Invalid lab quantity", found="APPROVED lab source codes where test unit does not agree with omop_quantity"),
    Rule("LAB: not APPROVED Invalid lab quantity", "WARNING", "not APPROVED lab source codes where test unit does not agree with omop_quantity"),
    Rule("LAB: TestName with same quantity maps to different concept ids", "WARNING", "codes with testName with same quantity maps to different concept ids"),
    Rule("Missing required columns", found="missing columns"),
    Rule("TEST_NAME_ABBREVIATION source_unit_clean is unique", found="repeated pairs"),
    Rule("TEST_NAME_ABBREVIATION is empty"),
    Rule("TEST_NAME_ABBREVIATION source_unit_clean_fix pair valid", "WARNING", "pairs that aren't mapped"),
]
_FACT = "struct<rule:string,key:array<string>,has:int,n:int,value:string>"


def empty(c: str) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def twice(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once."""
    return df.groupBy(*keys).count().filter("count > 1").drop("count")


def completed(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with those of the columns that it lacks as missing values."""
    return df.withColumns({c: F.lit(None).cast("string") for c in columns if c not in df.columns})


def _fact(rule: str, when: Column | None = None, key: list | None = None, has: int = 0, n: int = 0, value: Column | None = None) -> Column:
    """A fact where a condition holds. has: the key is there; n: it is referred to; value: what is compared among a key's facts."""
    names = F.array(*(F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in key or []))
    fact = F.struct(F.lit(rule).alias("rule"), names.alias("key"), F.lit(has).alias("has"), F.lit(n).alias("n"), (F.lit(None) if value is None else value).cast("string").alias("value")).cast(_FACT)
    return fact if when is None else F.when(when, fact)


def _facts(df: DataFrame, facts: list[Column]) -> DataFrame:
    return df.select(F.inline(F.filter(F.array(*facts), lambda x: x.isNotNull())))


def _mapping_facts(mapping: DataFrame, concepts: DataFrame, first_id: int, ids: int) -> DataFrame:
    known = concepts.select(F.col("conceptId").cast("string").alias("conceptId"), "domainId", "invalidReason", F.lit(True).alias("__known"))
    target = F.nullif(F.col("conceptId").cast("string"), F.lit("0"))
    spread = F.concat(F.lit("none "), F.xxhash64(*mapping.columns).cast("string"))  # rows without a concept, which may be most, don't share a key
    df = mapping.withColumn("__target", F.coalesce(target, spread)).join(known.withColumnRenamed("conceptId", "__target"), "__target", "left")
    approved = F.coalesce(F.col("mappingStatus") == "APPROVED", F.lit(False))
    mapped = target.isNotNull()
    outdated = mapped & (F.col("__known").isNull() | F.col("invalidReason").isNotNull())
    number, date = F.col("sourceConceptId").try_cast("long"), lambda c: F.col(c).try_cast("date")
    rows = {
        "SourceCode is empty": empty("sourceCode"),
        "SourceCode is more than 50 characters": F.length("sourceCode") > 50,
        "SourceName is empty": empty("sourceName"),
        "SourceName is more than 255 characters": F.length("sourceName") > 255,
        "SourceFrequency is not empty": F.col("sourceFrequency").isNull(),
        "MappingStatus is empty": empty("mappingStatus"),
        "MappingStatus is not valid": ~F.col("mappingStatus").isin(STATUSES),
        "APPROVED mappingStatus conceptId is 0": approved & (F.col("conceptId").cast("string") == "0"),
        "APPROVED mappingStatus with concepts outdated": approved & outdated,
        "Not APPROVED mappingStatus with concepts outdated": ~approved & outdated,
        "SourceConceptId is empty": empty("sourceConceptId"),
        "SourceConceptId is not a number on the range": ~empty("sourceConceptId") & ~F.coalesce(number.between(first_id, first_id + ids - 1), F.lit(False)),
        "SourceConceptClass is empty": empty("sourceConceptClass"),
        "SourceConceptClass is more than 20 characters": F.length("sourceConceptClass") > 20,
        "SourceDomain is empty": empty("sourceDomain"),
        "SourceDomain is not a valid domain": ~empty("sourceDomain") & ~F.col("sourceDomain").isin(DOMAINS),
        "SourceValidStartDate is after SourceValidEndDate": date("validStart") > date("validEnd"),
        "LAB: Invalid lab source name format": ~F.coalesce(F.col("sourceCode").rlike(r"^[^\[\]]+\[[^\[\]]*\]$"), F.lit(False)),
        "LAB: Invalid lab mapped domain": mapped & (F.col("domainId") != "Measurement"),
    }
    by = lambda one, other: ((one, approved), (other, ~approved))
    keys = [
        _fact("SourceCode and conceptId are not unique", key=["sourceCode", "conceptId"], n=1),
        _fact("LAB: TestName with same quantity maps to different concept ids", approved, ["testNameAbbreviation", "omopQuantity"], value=F.col("conceptId")),
        _fact("Invalid parent concept code", key=["sourceCode"], has=1),
        _fact("Invalid parent concept code", ~empty("parentCode"), ["parentCode"], n=1),
        *(_fact(rule, when & F.col("domainId").isNotNull(), ["sourceCode"], value=F.col("domainId")) for rule, when in by("APPROVED mappingStatus with valid domain combination", "Not APPROVED mappingStatus with valid domain combination")),
        *(_fact(rule, when, ["measurementUnit"], n=1) for rule, when in by("LAB: APPROVED Invalid lab unit", "LAB: not APPROVED Invalid lab unit")),
        *(_fact(rule, when, ["omopQuantity", "measurementUnit"], n=1) for rule, when in by("LAB: APPROVED Invalid lab quantity", "LAB: not APPROVED Invalid lab quantity")),
        _fact("TEST_NAME_ABBREVIATION source_unit_clean_fix pair valid", key=["testNameAbbreviation", "measurementUnit"], has=1),
    ]
    return _facts(df, [_fact(rule, F.coalesce(when.cast("boolean"), F.lit(False)), n=1) for rule, when in rows.items()] + keys)


def _conversion_facts(conversion: DataFrame) -> DataFrame:
    both = F.col("source_unit_valid").isNotNull() & F.col("to_source_unit_valid").isNotNull() & F.col("omop_quantity").isNotNull()
    kinds = ("APPROVED", "not APPROVED")
    units = [_fact(f"LAB: {k} Invalid lab unit", F.col("source_unit_valid").isNotNull(), ["source_unit_valid"], has=1) for k in kinds]
    return _facts(conversion, units + [_fact(f"LAB: {k} Invalid lab quantity", both, ["omop_quantity", "source_unit_valid"], has=1) for k in kinds])


def _fix_facts(unit_fix: DataFrame) -> DataFrame:
    return _facts(
        unit_fix,
        [
            _fact("TEST_NAME_ABBREVIATION source_unit_clean is unique", key=["TEST_NAME_ABBREVIATION", "source_unit_clean"], n=1),
            _fact("TEST_NAME_ABBREVIATION is empty", empty("TEST_NAME_ABBREVIATION"), n=1),
            _fact("TEST_NAME_ABBREVIATION source_unit_clean_fix pair valid", key=["TEST_NAME_ABBREVIATION", "source_unit_clean_fix"], n=1),
        ],
    )


def log(context: str, mapping: DataFrame, conversion: DataFrame, concepts: DataFrame, unit_fix: DataFrame, first_id: int = FIRST_ID, ids: int = IDS) -> DataFrame:
    """context, type, step, message, n, a row a rule: type is SUCCESS where nothing breaks the rule, else its severity.

    mapping: the columns named above; conversion: omop_quantity, source_unit_valid, to_source_unit_valid; concepts: conceptId, domainId, invalidReason.
    """
    absent = lambda df, columns: [c for c in columns if c not in df.columns]
    schema = {"Missing default columns": absent(mapping, DEFAULT), "Missing C&CR columns": absent(mapping, CONCEPT_CLASS), "Missing date columns": absent(mapping, DATES), "Missing parent columns": absent(mapping, PARENTS), "Missing required columns": absent(unit_fix, FIX)}
    whole = completed(mapping, DEFAULT + CONCEPT_CLASS + DATES + PARENTS + LAB)
    facts = _mapping_facts(whole, concepts, first_id, ids).union(_conversion_facts(conversion)).union(_fix_facts(completed(unit_fix, FIX)))
    keyed = facts.groupBy("rule", "key").agg(F.sum("has").alias("has"), F.sum("n").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"), F.array_sort(F.collect_set(F.when(F.col("rule").contains("domain combination"), F.col("value")))).alias("domains"))
    rule, repeated = F.col("rule"), (F.col("n") > 1).cast("long")
    joined = F.array_join("domains", "|")
    n = (
        F.when(rule.isin("SourceCode and conceptId are not unique", "TEST_NAME_ABBREVIATION source_unit_clean is unique"), repeated)
        .when(rule.contains("same quantity"), (F.col("least") != F.col("most")).cast("long"))
        .when(rule.contains("domain combination"), ((F.size("domains") > 1) & ~joined.isin(TOGETHER)).cast("long"))
        .when(F.col("has") > 0, F.lit(0))  # what is referred to is there
        .otherwise(F.col("n"))
    )
    counts = keyed.groupBy("rule").agg(F.sum(F.coalesce(n, F.lit(0))).alias("n"))
    steps = mapping.sparkSession.createDataFrame([(i, r.step, r.severity, r.found, len(schema.get(r.step, [])), ": " + ", ".join(schema[r.step]) if schema.get(r.step) else "") for i, r in enumerate(RULES)], "place int, step string, severity string, found string, absent int, which string")
    out = steps.join(F.broadcast(counts), F.col("step") == F.col("rule"), "left").withColumn("n", F.coalesce("n", "absent").cast("long"))  # a row a rule
    broken = F.col("n") > 0
    message = F.when(broken, F.concat(F.lit("Found "), F.col("n").cast("string"), F.lit(" "), "found", "which")).otherwise("")
    return out.select(F.lit(context).alias("context"), F.when(broken, F.col("severity")).otherwise("SUCCESS").alias("type"), "step", message.alias("message"), "n", "place")


def rollup(logs: DataFrame) -> DataFrame:
    return logs.groupBy("context").pivot("type", SEVERITY).agg(F.count(F.lit(1))).na.fill(0)


def page(logs: DataFrame) -> DataFrame:
    """place, line: the roll-up and the whole log as a markdown page."""
    row = lambda *cells: F.concat(F.lit("|"), F.concat_ws("|", *(F.col(c).cast("string") for c in cells)), F.lit("|"))
    head = lambda place, *lines: [(place + i / 10, line) for i, line in enumerate(lines)]
    columns = ["context", "type", "step", "message"]
    fixed = head(0.0, "# Vocabularies Validation Status", "", "### Summary", "", "|context|" + "|".join(SEVERITY) + "|", "|:--|--:|--:|--:|") + head(2.0, "", "### Full log", "", f"|{'|'.join(columns)}|", "|:--|:--|:--|:--|")
    counts = rollup(logs).select(F.lit(1.0).alias("place"), row("context", *SEVERITY).alias("line"))
    whole = logs.select((F.col("place") + 3.0).alias("place"), row(*columns).alias("line"))
    return logs.sparkSession.createDataFrame(fixed, "place double, line string").union(counts).union(whole)


def final_status(logs: DataFrame) -> DataFrame:
    """The gravest type there is."""
    at = F.max(F.array_position(F.array(*map(F.lit, SEVERITY)), F.col("type")))
    return logs.agg(F.element_at(F.array(*map(F.lit, SEVERITY)), F.coalesce(at, F.lit(1)).cast("int")).alias("final_status"))


def one_way_rules(conversion: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """Pairs of conversion rules between two units that don't undo each other."""
    a = valid_rules(conversion).select("omop_quantity", "source_unit_valid", "to_source_unit_valid", F.col("conversion").try_cast("double").alias("there"))
    b = a.select("omop_quantity", F.col("to_source_unit_valid").alias("source_unit_valid"), F.col("source_unit_valid").alias("to_source_unit_valid"), F.col("there").alias("back"))
    return a.join(b, ["omop_quantity", "source_unit_valid", "to_source_unit_valid"]).filter((F.col("source_unit_valid") < F.col("to_source_unit_valid")) & (F.abs(F.col("there") * F.col("back") - 1) > tolerance))
