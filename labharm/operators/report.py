"""Report columns, status roll-ups and the interactive filters' tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labharm.functions.keys import na
from labharm.operators import distributions as D

#: Which columns a view takes, by mode.
VIEW = {
    "OMOP_CONCEPT_ID": ("local_OMOP_CONCEPT_ID", "OMOP_CONCEPT_ID"),
    "OMOP_CONCEPT_NAME": ("local_OMOP_CONCEPT_NAME", "local_OMOP_CONCEPT_NAME"),
    "omopQuantity": ("local_omopQuantity", "omopQuantity"),
    "MEASUREMENT_UNIT": ("local_MEASUREMENT_UNIT", "MEASUREMENT_UNIT"),
    "MEASUREMENT_UNIT_HARMONIZED": ("local_MEASUREMENT_UNIT_HARMONIZED", "MEASUREMENT_UNIT_HARMONIZED"),
    "CONVERSION_FACTOR": ("local_CONVERSION_FACTOR", "CONVERSION_FACTOR"),
    "decilesHarmonized": ("local_h", "h"),
}
#: Colours of statuses, outcomes and value sources.
COLOURS = {"APPROVED": "#74de74", "IGNORED": "#7b7b7b", "UNCHECKED": "#cccccc", "FLAGGED": "#d75e5e", "INVALID_TARGET": "#fffecc", "NOT-FOUND": "#deb074"}
OUTCOME_COLOURS = {"NA": "#D3D3D3", "N": "#808080", "A": "#CD853F", "AA": "#DEB887", "L": "#9370DB", "LL": "#DDA0DD", "H": "#DC143C", "HH": "#8B0000"}
SOURCE_COLOURS = {"Missing": "#D3D3D3", "Extracted": "#808080", "Source": "#0000FF"}


def of(name: str, local: bool) -> str:
    return VIEW[name][0 if local else 1]


def view(summary: DataFrame, local: bool) -> DataFrame:
    return summary.select("rowId", *(F.col(c[0] if local else c[1]).alias(name) for name, c in VIEW.items()))


def test_id(name: str = "TEST_NAME", unit: str = "MEASUREMENT_UNIT", extracted: str = "IS_EXTRACTED") -> Column:
    return F.concat(na(name), F.lit(" ["), F.coalesce(F.col(unit), F.lit("")), F.lit("]"), F.when(F.col(extracted), " (Extracted)").otherwise(""))


def unit_change(local: bool = True) -> Column:
    """How a unit became its fixed one, empty where it didn't change."""
    prefix, unit = F.coalesce("MEASUREMENT_UNIT_PREFIX", F.lit("")), F.coalesce(of("MEASUREMENT_UNIT", local), F.lit(""))
    return F.when(prefix != unit, F.concat(prefix, F.lit(" -> "), unit)).otherwise("")


def value_unit_change(local: bool = True) -> Column:
    """How values changed to the target unit; empty without harmonised deciles."""
    unit, target, made = (F.coalesce(c, F.lit("")) for c in (of("MEASUREMENT_UNIT", local), "local_MEASUREMENT_UNIT_HARMONIZED_target", of("MEASUREMENT_UNIT_HARMONIZED", local)))
    factor = F.coalesce(F.concat(F.lit(" *"), of("CONVERSION_FACTOR", local)), F.lit(""))
    text = F.concat(F.when(made != target, "MISSING: ").otherwise(""), F.when(unit != target, F.concat(unit, F.lit(" -> "), target)).otherwise(""), factor)
    return F.when(F.col(of("decilesHarmonized", local)).isNull(), "").otherwise(text)


def issue_links(message: str, base: str) -> Column:
    return F.regexp_replace(message, r"#(\d+)", f'<a href="{base}$1">#$1</a>')


def ordered(distribution: str | Column, order: list[str]) -> Column:
    """The distribution's entries in a given order of categories, unknown ones last by name."""
    place = lambda x: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), x["value"]), F.lit(0)), F.lit(len(order) + 1))
    return F.transform(F.array_sort(F.transform(distribution, lambda x: F.struct(place(x).alias("k"), x["value"].alias("value"), x["n"].alias("n")))), lambda x: F.struct(x["value"], x["n"]))


def distribution_text(distribution: str | Column, order: list[str]) -> Column:
    """[ p1, p2, ... ]% in the given order; missing if there are no records."""
    rows = ordered(distribution, order)
    total = F.aggregate(rows, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    return F.when(total > 0, F.concat(F.lit("[ "), F.array_join(F.transform(rows, lambda x: F.format_string("%.1f", F.floor(1000.0 * x["n"] / total + 0.5) / 10)), ", "), F.lit(" ]%")))


def running_percent(distribution: str | Column, order: list[str]) -> Column:
    """The running share of one distribution's categories in a given order, in percent; null without records."""
    rows = ordered(distribution, order)
    sums = F.transform(rows, lambda x, i: F.aggregate(F.slice(rows, 1, i + 1), F.lit(0).cast("long"), lambda a, y: a + y["n"]))
    total = F.element_at(sums, -1)
    return F.when(total > 0, F.transform(sums, lambda x: F.floor(1000.0 * x / total + 0.5) / 10))


def distribution_json(distribution: str | Column, order: list[str], colours: dict[str, str]) -> Column:
    """A JSON array of value, n, percent and colour in a given order of categories."""
    rows = ordered(distribution, order)
    total = F.aggregate(rows, F.lit(0).cast("long"), lambda a, x: a + x["n"])
    percent = lambda x: F.format_string("%.1f", F.floor(1000.0 * x["n"] / F.greatest(total, F.lit(1)) + 0.5) / 10)
    return F.to_json(F.transform(rows, lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n"), percent(x).alias("percent"), colour(x["value"], colours).alias("colour"))))


def decile_text(values: str, unit: str) -> Column:
    return F.when(F.col(values).isNotNull(), F.concat(F.lit("[ "), F.array_join(F.transform(values, lambda x: F.format_string("%.2f", F.floor(x * 100 + 0.5) / 100)), ", "), F.lit(" "), na(unit), F.lit(" ]")))


def colour(category: Column, colours: dict[str, str] = COLOURS) -> Column:
    table = F.create_map(*(F.lit(x) for kv in colours.items() for x in kv))
    return F.coalesce(F.element_at(table, category), F.lit("#CCCCCC"))


def table(summary: DataFrame, local: bool = True, issues: str | None = None) -> DataFrame:
    """The report's rows in the view of the local vocabulary or of the release, most records first."""
    message = F.col("message") if issues is None else issue_links(F.col("message"), issues)
    log_p = lambda p: F.round(-F.log10(F.nullif(F.col(p), F.lit(0.0))), 2)
    return summary.select(
        "rowId", "status", F.col(of("OMOP_CONCEPT_ID", local)).alias("conceptId"), F.col("local_OMOP_CONCEPT_NAME").alias("conceptName"), F.col(of("omopQuantity", local)).alias("omopQuantity"),
        unit_change(local).alias("unitChange"), test_id(unit=of("MEASUREMENT_UNIT", local)).alias("testId"), F.col("n_subjects").alias("nPeople"), F.col("n_records").alias("nRecords"),
        distribution_text("distribution_values", D.SOURCES).alias("values"), distribution_text("distribution_outcomes", D.OUTCOMES).alias("outcomes"), decile_text("v", of("MEASUREMENT_UNIT", local)).alias("deciles"),
        F.round("ks", 2).alias("ks"), log_p("p").alias("ksLogP"), value_unit_change(local).alias("valueUnitChange"), decile_text(of("decilesHarmonized", local), of("MEASUREMENT_UNIT_HARMONIZED", local)).alias("decilesHarmonized"),
        F.round("ks_harmonized", 2).alias("ksHarmonized"), log_p("p_harmonized").alias("ksHarmonizedLogP"), message.alias("message"), "differences", "isNotHarmonised",
    ).orderBy(F.desc_nulls_last("nRecords"), "rowId")


def text_table(summary: DataFrame, local: bool = True) -> DataFrame:
    """The report as plain cells for a tab-separated file, with the tests' p-values."""
    rows = table(summary, local).select("rowId", "status", "conceptId", "conceptName", "omopQuantity", "testId", "nPeople", "nRecords", "values", "outcomes", "deciles", "ks", "decilesHarmonized", "ksHarmonized", "message", "differences")
    tests = summary.select("rowId", F.round("p", 2).alias("pValue"), F.round("p_harmonized", 2).alias("pValueHarmonized"))
    return rows.join(tests, "rowId").orderBy(F.desc_nulls_last("nRecords"), "rowId")


def status_rollup(summary: DataFrame) -> DataFrame:
    return summary.groupBy("status").agg(F.count_if(F.coalesce(F.col("message").contains("WARNING"), F.lit(False))).alias("n_warnings"), F.count("*").alias("n_tests"), F.sum("n_subjects").alias("n_subjects"), F.sum("n_records").alias("n_records"))


def status_share(summary: DataFrame) -> DataFrame:
    """The roll-up with shares of the grand totals and the running share, largest first."""
    rolled = status_rollup(summary)
    whole = W.partitionBy(F.lit(0))
    running = whole.orderBy(F.desc("n_records"), "status").rowsBetween(W.unboundedPreceding, W.currentRow)
    share = lambda c: F.round(100.0 * F.col(c) / F.sum(c).over(whole), 4)
    return rolled.withColumns({"p_tests": share("n_tests"), "p_records": share("n_records"), "p_running": F.round(100.0 * F.sum("n_records").over(running) / F.sum("n_records").over(whole), 4)})


def source_rollup(summary: DataFrame) -> DataFrame:
    """Records by concept and value source, a column a source."""
    long = summary.select("local_OMOP_CONCEPT_ID", F.inline("distribution_values"))
    return long.groupBy("local_OMOP_CONCEPT_ID").pivot("value", D.SOURCES).agg(F.sum("n"))


#: What messages say of values.
MESSAGES = {"n_values_missing": "Missing value", "n_values_extracted": "Extracted value", "n_values": "Source value"}


def message_rollup(summary: DataFrame, texts: dict[str, str] = MESSAGES) -> DataFrame:
    """Per concept: tests, subjects, records, and tests whose message holds each text."""
    return summary.groupBy("local_OMOP_CONCEPT_ID").agg(F.count("*").alias("n_tests"), F.sum("n_subjects").alias("n_subjects"), F.sum("n_records").alias("n_records"), *(F.count_if(F.coalesce(F.col("message").contains(t), F.lit(False))).alias(n) for n, t in texts.items()))
