"""Query catalogue: name -> (spark, sf_dir) -> DataFrame, and the SQL twin of each."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labharm.functions import store, text
from labharm.functions.keys import K5, left_join, numeric_filter, regex_filter
from labharm.operators import distributions as D
from labharm.operators import checks, drift, extract, preview, report, similarity, validate
from labharm.operators import harmonise as H
from labharm.plans import lab, vocabulary
from labharm.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

K = ", ".join(K5)


def same(a: str, b: str, keys=K5) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in keys)


def rounded(*names: str) -> list:
    return [F.round(c, 6).alias(c) for c in names]


# ---- the tables of the chain, in Spark


def measurement(spark: SparkSession, sf: str) -> DataFrame:
    return extract.measurement(lab.raw(spark, sf))


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """What the extracts are made of; the records are scanned once for them."""
    return store.once(spark, "facts", sf, lambda: extract.facts(measurement(spark, sf)))


def summary(spark: SparkSession, sf: str) -> DataFrame:
    """The assembled summary; it has a row a key, and is written once a session."""
    order = [F.desc_nulls_last("n_records"), *(F.asc_nulls_first(c) for c in [*K5, "MEASUREMENT_UNIT_HARMONIZED", "omopQuantity", "CONVERSION_FACTOR"])]
    return store.once(spark, "summary", sf, lambda: H.row_ids(D.assemble(extract.all_extracts(facts(spark, sf))), order), written=True)


def mapped(spark: SparkSession, sf: str) -> DataFrame:
    return H.map_concepts(H.fix_units(summary(spark, sf), lab.vocabulary(spark, "unit_fix")), lab.vocabulary(spark, "mapping"))


def converted(spark: SparkSession, sf: str) -> DataFrame:
    return H.rescale(H.convert(mapped(spark, sf), lab.vocabulary(spark, "conversion")))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain."""
    return H.differences(drift.test(converted(spark, sf)))


# ---- the same tables as SQL


def _text_sql(column: str, order: list[str]) -> str:
    rows = f"list_transform([{', '.join(repr(c) for c in order)}], lambda c: coalesce({column}[c], 0))"
    return f"CASE WHEN list_sum({rows}) > 0 THEN '[ ' || array_to_string(list_transform({rows}, lambda n: format('{{:.1f}}', floor(1000.0::DOUBLE * n / list_sum({rows}) + 0.5) / 10)), ', ') || ' ]%' END"


def _ks_sql(v: str, r: str) -> str:
    return f"list_max(list_transform(list_distinct(list_concat({v}, {r})), lambda x: abs(len(list_filter({v}, lambda y: y <= x)) - len(list_filter({r}, lambda y: y <= x))))) / 10.0::DOUBLE"


def _p_sql(d: str) -> str:
    lam2 = f"(n_values::DOUBLE * ref_n / (n_values + ref_n)) * {d} * {d}"
    return f"greatest(0, least(1, 2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0 END) * exp(-2.0::DOUBLE * k * k * {lam2})))))"


def _dense_sql(name: str, counts: str, missing: str, categories: list[str]) -> str:
    return f"""{name}_missing AS (SELECT {", ".join("t." + c for c in K5)}, '{missing}' AS value, (t.n_records - coalesce(k.known, 0))::BIGINT AS n FROM totals t LEFT JOIN (SELECT {K}, sum(n) AS known FROM ({counts}) GROUP BY {K}) k ON {same("t", "k")}),
{name}_both AS (SELECT {K}, value, n FROM ({counts}) UNION ALL SELECT * FROM {name}_missing),
{name}_dense AS (SELECT {", ".join("g." + c for c in K5)}, g.value, coalesce(sum(b.n), 0)::BIGINT AS n FROM (SELECT {K}, value FROM totals, (VALUES {", ".join(f"('{c}')" for c in categories)}) v(value)) g LEFT JOIN {name}_both b ON {same("g", "b")} AND g.value = b.value GROUP BY ALL),
{name}_map AS (SELECT {K}, map_from_entries(list((value, n) ORDER BY value)) AS {name}, string_agg(value || '=' || n, '|' ORDER BY value) AS {name}_text FROM {name}_dense GROUP BY {K})"""


CHAIN = f"""WITH {lab.sql_tables()},
raw AS ({lab.RAW.format(k="CAST(json_extract_string(props, '$.k') AS INT)")}),
m AS (
  SELECT *, CASE WHEN MEASUREMENT_VALUE_TYPE = 'Source' THEN cleaned_value WHEN MEASUREMENT_VALUE_TYPE = 'Extracted' THEN extracted_value END AS MEASUREMENT_VALUE
  FROM (SELECT *, cleaned_value IS NULL AND extracted_value IS NOT NULL AS IS_EXTRACTED, CASE WHEN QC_PASS = 0 THEN 'QCOut' WHEN cleaned_value IS NULL AND extracted_value IS NOT NULL THEN 'Extracted' WHEN cleaned_value IS NOT NULL THEN 'Source' END AS MEASUREMENT_VALUE_TYPE FROM raw)
),
tests AS (SELECT {K}, MEASUREMENT_UNIT_HARMONIZED, omopQuantity, CONVERSION_FACTOR, count(*) AS n_records, count(DISTINCT subject) AS n_subjects FROM m GROUP BY ALL HAVING count(DISTINCT subject) > 5),
sources AS (SELECT {K}, MEASUREMENT_VALUE_TYPE, count(*) AS n_records, count(DISTINCT subject) AS n_subjects FROM m WHERE MEASUREMENT_VALUE_TYPE IS NOT NULL GROUP BY ALL HAVING count(DISTINCT subject) > 5),
outcomes AS (SELECT {K}, TEST_OUTCOME, count(*) AS n_TEST_OUTCOME, count(DISTINCT subject) AS n_subjects FROM m WHERE TEST_OUTCOME IS NOT NULL GROUP BY ALL HAVING count(DISTINCT subject) > 5),
wide AS (SELECT {K}, count(*) // 10 AS n_records, count(DISTINCT subject) // 10 AS n_subjects, quantile_cont(MEASUREMENT_VALUE, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS v, quantile_cont(HARMONIZED_VALUE, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS h FROM m WHERE MEASUREMENT_VALUE IS NOT NULL GROUP BY {K} HAVING count(DISTINCT subject) // 10 > 5),
vals AS (SELECT {K}, n_subjects, n_records, unnest(range(1, 10)) / 10 AS decile, unnest(v) AS decile_MEASUREMENT_VALUE, unnest(h) AS decile_MEASUREMENT_VALUE_HARMONIZED FROM wide),
totals AS (SELECT {K}, sum(n_records)::BIGINT AS n_records FROM tests GROUP BY {K}),
{_dense_sql("dv", f"SELECT {K}, MEASUREMENT_VALUE_TYPE AS value, n_records AS n FROM sources", "Missing", D.SOURCES)},
{_dense_sql("dx", f"SELECT {K}, TEST_OUTCOME AS value, n_TEST_OUTCOME AS n FROM outcomes", "NA", D.OUTCOMES)},
summary AS (
  SELECT t.*, dv, dv_text, dx, dx_text, w.v, w.h, row_number() OVER (ORDER BY t.n_records DESC NULLS LAST, {", ".join(f"t.{c} ASC NULLS FIRST" for c in [*K5, "MEASUREMENT_UNIT_HARMONIZED", "omopQuantity", "CONVERSION_FACTOR"])}) AS rowId
  FROM tests t LEFT JOIN dv_map a ON {same("t", "a")} LEFT JOIN dx_map b ON {same("t", "b")} LEFT JOIN wide w ON {same("t", "w")}
),
fixed AS (SELECT s.*, coalesce(u.source_unit_clean_fix, s.MEASUREMENT_UNIT_PREFIX) AS local_MEASUREMENT_UNIT FROM summary s LEFT JOIN unit_fix u ON s.TEST_NAME = u.TEST_NAME_ABBREVIATION AND s.MEASUREMENT_UNIT_PREFIX IS NOT DISTINCT FROM u.source_unit_clean AND NOT s.IS_EXTRACTED),
mapping_first AS (SELECT * FROM mapping QUALIFY row_number() OVER (PARTITION BY testNameAbbreviation, measurementUnit ORDER BY line) = 1),
mapped AS (
  SELECT f.*, c.conceptId AS local_OMOP_CONCEPT_ID, c.conceptName AS local_OMOP_CONCEPT_NAME, c.omopQuantity AS local_omopQuantity,
    CASE WHEN mappingStatus = 'APPROVED' THEN 'APPROVED' WHEN ignoreReason IS NOT NULL THEN 'IGNORED' WHEN mappingStatus IS NOT NULL THEN mappingStatus ELSE 'NOT-FOUND' END AS status,
    CASE WHEN ignoreReason IS NOT NULL THEN 'IGNORED: ' || ignoreReason || '; ' || coalesce(validationMessages, 'NA') ELSE validationMessages END AS message
  FROM fixed f LEFT JOIN mapping_first c ON f.TEST_NAME IS NOT DISTINCT FROM c.testNameAbbreviation AND f.local_MEASUREMENT_UNIT IS NOT DISTINCT FROM c.measurementUnit
),
common AS (
  SELECT local_OMOP_CONCEPT_ID, local_MEASUREMENT_UNIT AS target_unit FROM (SELECT local_OMOP_CONCEPT_ID, local_MEASUREMENT_UNIT, sum(n_records) AS n FROM mapped WHERE status = 'APPROVED' AND local_MEASUREMENT_UNIT IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY local_OMOP_CONCEPT_ID ORDER BY n DESC, local_MEASUREMENT_UNIT) = 1
),
rules AS (SELECT * FROM conversion WHERE source_unit_valid IS NOT NULL AND to_source_unit_valid IS NOT NULL),
found AS (
  SELECT p.*, CASE WHEN r.only_to_omop_concepts IS NULL OR r.only_to_omop_concepts::INT = p.local_OMOP_CONCEPT_ID THEN r.conversion END AS factor, CASE WHEN p.local_MEASUREMENT_UNIT IS NOT NULL THEN c.target_unit END AS local_MEASUREMENT_UNIT_HARMONIZED_target
  FROM mapped p LEFT JOIN common c ON p.local_OMOP_CONCEPT_ID IS NOT DISTINCT FROM c.local_OMOP_CONCEPT_ID
  LEFT JOIN rules r ON p.local_omopQuantity = r.omop_quantity AND p.local_MEASUREMENT_UNIT = r.source_unit_valid AND c.target_unit = r.to_source_unit_valid
),
gated AS (SELECT *, CASE WHEN NOT (dv['Missing'] = list_sum(map_values(dv))) THEN factor END AS local_CONVERSION_FACTOR FROM found),
converted AS (
  SELECT *, CASE WHEN a IS NOT NULL THEN list_transform(v, lambda x: x * a + b) END AS local_h, CASE WHEN local_CONVERSION_FACTOR IS NOT NULL THEN local_MEASUREMENT_UNIT_HARMONIZED_target END AS local_MEASUREMENT_UNIT_HARMONIZED
  FROM (SELECT *, coalesce(try_cast(local_CONVERSION_FACTOR AS DOUBLE), try_cast(regexp_extract(local_CONVERSION_FACTOR, '^([-0-9.]+)\\*X([+-][0-9.]+)$', 1) AS DOUBLE)) AS a,
    CASE WHEN try_cast(local_CONVERSION_FACTOR AS DOUBLE) IS NOT NULL THEN 0 ELSE try_cast(regexp_extract(local_CONVERSION_FACTOR, '^([-0-9.]+)\\*X([+-][0-9.]+)$', 2) AS DOUBLE) END AS b FROM gated)
),
counted AS (SELECT *, (list_sum(map_values(dv)) - dv['Missing'])::BIGINT AS n_values FROM converted),
refs AS (SELECT local_OMOP_CONCEPT_ID, rowId AS reference_rowId, v AS ref_v, local_h AS ref_h, n_values AS ref_n FROM counted WHERE status = 'APPROVED' AND local_MEASUREMENT_UNIT IS NOT NULL QUALIFY row_number() OVER (PARTITION BY local_OMOP_CONCEPT_ID ORDER BY n_records DESC NULLS LAST, rowId) = 1),
ks AS (
  SELECT c.*, r.reference_rowId, r.ref_n, local_h IS NULL AS isNotHarmonised, CASE WHEN len(v) = 9 AND len(ref_v) = 9 AND n_values >= 2 AND ref_n >= 2 THEN {_ks_sql("v", "ref_v")} END AS ks,
    CASE WHEN len(v) = 9 AND len(ref_h) = 9 AND n_values >= 2 AND ref_n >= 2 THEN {_ks_sql("coalesce(local_h, v)", "ref_h")} END AS ks_harmonized
  FROM counted c LEFT JOIN refs r ON c.local_OMOP_CONCEPT_ID IS NOT DISTINCT FROM r.local_OMOP_CONCEPT_ID
),
tested AS (SELECT *, CASE WHEN ks IS NOT NULL THEN {_p_sql("ks")} END AS p, CASE WHEN ks_harmonized IS NOT NULL THEN {_p_sql("ks_harmonized")} END AS p_harmonized FROM ks),
enriched AS (
  SELECT *, CASE WHEN status = 'APPROVED' AND coalesce(local_MEASUREMENT_UNIT, '') <> coalesce(MEASUREMENT_UNIT, '') THEN 'MEASUREMENT_UNIT: ' || coalesce(MEASUREMENT_UNIT, 'NA') ELSE '' END AS diff_measurement_unit,
    CASE WHEN status = 'APPROVED' THEN (CASE WHEN local_OMOP_CONCEPT_ID <> OMOP_CONCEPT_ID THEN 'OMOP_CONCEPT_ID: ' || OMOP_CONCEPT_ID || '<br>' ELSE '' END)
      || (CASE WHEN coalesce(local_omopQuantity, '') <> coalesce(omopQuantity, '') THEN 'omopQuantity: ' || coalesce(omopQuantity, 'NA') || '<br>' ELSE '' END)
      || (CASE WHEN coalesce(local_CONVERSION_FACTOR, '') <> coalesce(CONVERSION_FACTOR, '') THEN 'CONVERSION_FACTOR: ' || coalesce(CONVERSION_FACTOR, 'NA') || '<br>' ELSE '' END)
      || (CASE WHEN coalesce(local_MEASUREMENT_UNIT_HARMONIZED, '') <> coalesce(MEASUREMENT_UNIT_HARMONIZED, '') THEN 'MEASUREMENT_UNIT_HARMONIZED: ' || coalesce(MEASUREMENT_UNIT_HARMONIZED, 'NA') ELSE '' END) ELSE '' END AS differences
  FROM tested
)
"""


def add(name: str, run: Callable[[SparkSession, str], DataFrame], sql: str, own: bool = False) -> None:
    """sql reads the chain's tables, or, with own, stands alone."""
    QUERIES[name] = run
    ORACLE_SQL[name] = sql if own else CHAIN + sql



def voc(*names: str) -> str:
    return f"WITH {vocabulary.sql(*names)} "


# ---- extracts
ROUND_M = f"SELECT subject, {K}, MEASUREMENT_VALUE_TYPE, round(MEASUREMENT_VALUE, 6) AS MEASUREMENT_VALUE, round(HARMONIZED_VALUE, 6) AS HARMONIZED_VALUE FROM m"
add("measurement_projection", lambda s, d: measurement(s, d).select("subject", *K5, "MEASUREMENT_VALUE_TYPE", *rounded("MEASUREMENT_VALUE", "HARMONIZED_VALUE")), ROUND_M)
add("is_extracted", lambda s, d: measurement(s, d).groupBy("IS_EXTRACTED").agg(F.count("*").alias("n")), "SELECT IS_EXTRACTED, count(*) AS n FROM m GROUP BY 1")
add("value_type", lambda s, d: measurement(s, d).groupBy("MEASUREMENT_VALUE_TYPE").agg(F.count("*").alias("n")), "SELECT MEASUREMENT_VALUE_TYPE, count(*) AS n FROM m GROUP BY 1")
add("measurement_value", lambda s, d: measurement(s, d).groupBy("MEASUREMENT_VALUE_TYPE").agg(F.count("MEASUREMENT_VALUE").alias("n"), F.round(F.sum("MEASUREMENT_VALUE"), 4).alias("total")), "SELECT MEASUREMENT_VALUE_TYPE, count(MEASUREMENT_VALUE) AS n, round(sum(MEASUREMENT_VALUE), 4) AS total FROM m GROUP BY 1")
add("summary_test", lambda s, d: extract.summary_test(measurement(s, d)), "SELECT * FROM tests")
add("summary_values_source", lambda s, d: extract.summary_values_source(measurement(s, d)), "SELECT * FROM sources")
add("summary_outcomes", lambda s, d: extract.summary_outcomes(measurement(s, d)), "SELECT * FROM outcomes")
VALS = "n_subjects, n_records, round(decile, 1) AS decile, round(decile_MEASUREMENT_VALUE, 6) AS decile_MEASUREMENT_VALUE, round(decile_MEASUREMENT_VALUE_HARMONIZED, 6) AS decile_MEASUREMENT_VALUE_HARMONIZED"
add("summary_values", lambda s, d: extract.summary_values(facts(s, d)).select(*K5, "n_subjects", "n_records", F.round("decile", 1).alias("decile"), *rounded("decile_MEASUREMENT_VALUE", "decile_MEASUREMENT_VALUE_HARMONIZED")), f"SELECT {K}, {VALS} FROM vals")
add("deciles_wide", lambda s, d: extract.summary_values_wide(facts(s, d)).select(*K5, *(F.round(F.get("v", F.lit(i)), 6).alias(f"v{i + 1}") for i in range(9))), f"SELECT {K}, {', '.join(f'round(v[{i}], 6) AS v{i}' for i in range(1, 10))} FROM wide")
add("scaled_suppression", lambda s, d: extract.summary_values_wide(facts(s, d)).select(*K5, "n_records", "n_subjects"), f"SELECT {K}, n_records, n_subjects FROM wide")
add("suppress_small_cells", lambda s, d: extract.suppressed(extract.counted(measurement(s, d), "TEST_NAME", "MEASUREMENT_UNIT", "IS_EXTRACTED", "MEASUREMENT_VALUE_TYPE", "TEST_OUTCOME")), "SELECT TEST_NAME, MEASUREMENT_UNIT, IS_EXTRACTED, MEASUREMENT_VALUE_TYPE, TEST_OUTCOME, count(*) AS n_records, count(DISTINCT subject) AS n_subjects FROM m GROUP BY ALL HAVING count(DISTINCT subject) > 5")
add("distinct_keys", lambda s, d: measurement(s, d).select(*K5).distinct(), f"SELECT DISTINCT {K} FROM m")
add("duplicate_keys", lambda s, d: validate.twice(extract.summary_values_source(measurement(s, d)), K5), f"SELECT {K} FROM sources GROUP BY {K} HAVING count(*) > 1")


# ---- distributions
def _parts(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    m = measurement(s, d)
    totals = extract.summary_test(m).groupBy(*K5).agg(F.sum("n_records").alias("n_records"))
    sources = extract.summary_values_source(m).select(*K5, F.col("MEASUREMENT_VALUE_TYPE").alias("value"), F.col("n_records").alias("n"))
    outcomes = extract.summary_outcomes(m).select(*K5, F.col("TEST_OUTCOME").alias("value"), F.col("n_TEST_OUTCOME").alias("n"))
    return totals, sources, outcomes


def _values(s, d):
    totals, sources, _ = _parts(s, d)
    return D.with_missing(totals, sources, "Missing")


def _outcomes(s, d):
    totals, _, outcomes = _parts(s, d)
    return D.with_missing(totals, outcomes, "NA")


add("missing_values", lambda s, d: D.missing(*_parts(s, d)[:2], "Missing"), "SELECT * FROM dv_missing")
add("missing_outcomes", lambda s, d: D.missing(*_parts(s, d)[::2], "NA"), "SELECT * FROM dx_missing")
add("union_missing", _values, "SELECT * FROM dv_both")
add("densified_values", lambda s, d: D.densified(_values(s, d), D.SOURCES), "SELECT * FROM dv_dense")
add("densified_outcomes", lambda s, d: D.densified(_outcomes(s, d), D.OUTCOMES), "SELECT * FROM dx_dense")
add("densify_crossjoin", lambda s, d: D.densified(_values(s, d), D.SOURCES).select(*K5, "value"), f"SELECT {K}, value FROM dv_dense")
add("nested_distribution", lambda s, d: D.nested(D.densified(_values(s, d), D.SOURCES), "dv").select(*K5, D.text("dv").alias("dv_text")), f"SELECT {K}, dv_text FROM dv_map")
add("unnest_distribution", lambda s, d: summary(s, d).select("rowId", F.inline("distribution_values")), f"SELECT s.rowId, g.value, g.n FROM summary s JOIN dv_dense g ON {same('s', 'g')}")
add("n_values", lambda s, d: summary(s, d).select("rowId", D.n_values("distribution_values").alias("n_values"), D.n_values("distribution_values", "Source").alias("n_source")), "SELECT rowId, (list_sum(map_values(dv)) - dv['Missing'])::BIGINT AS n_values, dv['Source'] AS n_source FROM summary")
add("all_missing", lambda s, d: summary(s, d).select("rowId", D.all_missing("distribution_values").alias("all_missing")), "SELECT rowId, dv['Missing'] = list_sum(map_values(dv)) AS all_missing FROM summary")
add("summary_assembly", lambda s, d: summary(s, d).select("rowId", *K5, "n_records", "n_subjects", D.text("distribution_values").alias("dv_text"), D.text("distribution_outcomes").alias("dx_text"), F.round(F.get("v", F.lit(4)), 6).alias("median")), f"SELECT rowId, {K}, n_records, n_subjects, dv_text, dx_text, round(v[5], 6) AS median FROM summary")
add("row_id", lambda s, d: summary(s, d).select("rowId", *K5, "n_records"), f"SELECT rowId, {K}, n_records FROM summary")

# ---- harmonisation
add("unit_fix", lambda s, d: H.fix_units(summary(s, d), lab.vocabulary(s, "unit_fix")).select("rowId", "MEASUREMENT_UNIT_PREFIX", "local_MEASUREMENT_UNIT"), "SELECT rowId, MEASUREMENT_UNIT_PREFIX, local_MEASUREMENT_UNIT FROM fixed")
add("mapping_dedup", lambda s, d: H.mapping_rows(vocabulary.table(s, d, "mapping")).select("sourceCode", "testNameAbbreviation", "measurementUnit", "conceptId", "mappingStatus"), voc("mapping") + "SELECT sourceCode, testNameAbbreviation, measurementUnit, conceptId, mappingStatus FROM mapping QUALIFY row_number() OVER (PARTITION BY testNameAbbreviation, measurementUnit ORDER BY line) = 1", own=True)
add("mapping_lookup", lambda s, d: mapped(s, d).select("rowId", "local_OMOP_CONCEPT_ID", "local_OMOP_CONCEPT_NAME", "local_omopQuantity"), "SELECT rowId, local_OMOP_CONCEPT_ID, local_OMOP_CONCEPT_NAME, local_omopQuantity FROM mapped")
add("mapping_status", lambda s, d: mapped(s, d).select("rowId", "status"), "SELECT rowId, status FROM mapped")
add("ignore_message", lambda s, d: mapped(s, d).select("rowId", "message"), "SELECT rowId, message FROM mapped")
add("most_common_unit", lambda s, d: H.common_units(mapped(s, d)), "SELECT * FROM common")
CONVERTED = ["rowId", "local_MEASUREMENT_UNIT_HARMONIZED_target", "local_CONVERSION_FACTOR", "local_MEASUREMENT_UNIT_HARMONIZED"]
add("target_unit_join", lambda s, d: converted(s, d).select(*CONVERTED[:2]), f"SELECT {', '.join(CONVERTED[:2])} FROM converted")
add("conversion_valid_rules", lambda s, d: H.valid_rules(vocabulary.table(s, d, "conversion")), voc("conversion") + "SELECT * FROM conversion WHERE source_unit_valid IS NOT NULL AND to_source_unit_valid IS NOT NULL", own=True)
add("conversion_lookup", lambda s, d: converted(s, d).select(*CONVERTED), f"SELECT {', '.join(CONVERTED)} FROM converted")
H9_SQL = ", ".join(f"round(local_h[{i}], 6) AS h{i}" for i in range(1, 10))
for _name, _where in (("harmonised_deciles", "true"), ("conversion_linear", "try_cast(local_CONVERSION_FACTOR as double) is not null"), ("conversion_affine", "local_CONVERSION_FACTOR like '%X%'"), ("conversion_restricted", "local_CONVERSION_FACTOR is null and local_OMOP_CONCEPT_ID = 104")):
    add(_name, lambda s, d, w=_where: converted(s, d).filter(w).select("rowId", "local_CONVERSION_FACTOR", *(F.round(F.get("local_h", F.lit(i)), 6).alias(f"h{i + 1}") for i in range(9))), f"SELECT rowId, local_CONVERSION_FACTOR, {H9_SQL} FROM converted WHERE {_where}")

# ---- drift
add("reference_row", lambda s, d: drift.reference_rows(mapped(s, d)), "SELECT local_OMOP_CONCEPT_ID, reference_rowId FROM refs")
add("ks_decile", lambda s, d: enriched(s, d).select("rowId", "n_values", *rounded("ks")), "SELECT rowId, n_values, round(ks, 6) AS ks FROM enriched")
add("ks_pvalue", lambda s, d: enriched(s, d).select("rowId", *rounded("p")), "SELECT rowId, round(p, 6) AS p FROM enriched")
add("ks_harmonised", lambda s, d: enriched(s, d).select("rowId", "isNotHarmonised", *rounded("ks_harmonized", "p_harmonized")), "SELECT rowId, isNotHarmonised, round(ks_harmonized, 6) AS ks_harmonized, round(p_harmonized, 6) AS p_harmonized FROM enriched")
BAND_SQL = "CASE WHEN {0} IS NULL THEN 'NA' WHEN {0} > 0.5 THEN 'red' WHEN {0} > 0.2 THEN 'yellow' ELSE 'green' END"
add("ks_band", lambda s, d: enriched(s, d).select("rowId", drift.band("ks").alias("band"), drift.band("ks_harmonized").alias("band_harmonized")), f"SELECT rowId, {BAND_SQL.format('ks')} AS band, {BAND_SQL.format('ks_harmonized')} AS band_harmonized FROM enriched")
add("neg_log10_p", lambda s, d: enriched(s, d).select("rowId", F.round(F.nullif(drift.neg_log10("p"), F.lit(float("inf"))), 4).alias("neg_log10_p"), (F.col("p") <= 0).alias("p_is_zero")), "SELECT rowId, CASE WHEN p > 0 THEN round(-log10(p), 4) END AS neg_log10_p, p <= 0 AS p_is_zero FROM enriched")


def _injection(s: SparkSession, d: str) -> DataFrame:
    # written first: a filter that Spark pushes down to the records works out the nested expressions it reads again for each place where it reads them
    m = store.once(s, "injection", d, lambda: measurement(s, d).select("OMOP_CONCEPT_ID", "TEST_NAME", "MEASUREMENT_UNIT", "MEASUREMENT_VALUE", "HARMONIZED_VALUE"))
    sample = m.filter("HARMONIZED_VALUE is null and OMOP_CONCEPT_ID is not null").select("OMOP_CONCEPT_ID", "TEST_NAME", "MEASUREMENT_UNIT", F.col("MEASUREMENT_VALUE").alias("value"))
    reference = m.select("OMOP_CONCEPT_ID", F.col("HARMONIZED_VALUE").alias("value"))
    return drift.injection(drift.two_samples(sample, reference, ["OMOP_CONCEPT_ID", "TEST_NAME", "MEASUREMENT_UNIT"], ["OMOP_CONCEPT_ID"]))


INJECTION_SQL = """, samples AS (SELECT OMOP_CONCEPT_ID, TEST_NAME, MEASUREMENT_UNIT, MEASUREMENT_VALUE AS value FROM m WHERE HARMONIZED_VALUE IS NULL AND OMOP_CONCEPT_ID IS NOT NULL AND MEASUREMENT_VALUE IS NOT NULL),
points AS (SELECT *, 1 AS n, 0 AS m FROM samples UNION ALL SELECT k.OMOP_CONCEPT_ID, k.TEST_NAME, k.MEASUREMENT_UNIT, m.HARMONIZED_VALUE, 0, 1 FROM (SELECT DISTINCT OMOP_CONCEPT_ID, TEST_NAME, MEASUREMENT_UNIT FROM samples) k JOIN m ON m.OMOP_CONCEPT_ID = k.OMOP_CONCEPT_ID WHERE m.HARMONIZED_VALUE IS NOT NULL),
curves AS (SELECT OMOP_CONCEPT_ID, TEST_NAME, MEASUREMENT_UNIT, sum(n) OVER w AS a, sum(m) OVER w AS b, sum(n) OVER p AS n_sample, sum(m) OVER p AS n_reference FROM points WINDOW p AS (PARTITION BY OMOP_CONCEPT_ID, TEST_NAME, MEASUREMENT_UNIT), w AS (PARTITION BY OMOP_CONCEPT_ID, TEST_NAME, MEASUREMENT_UNIT ORDER BY value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
injected AS (SELECT OMOP_CONCEPT_ID, TEST_NAME, MEASUREMENT_UNIT, max(abs(a::DOUBLE / n_sample - b::DOUBLE / nullif(n_reference, 0))) AS ks, max(n_sample)::BIGINT AS n_sample, max(n_reference)::BIGINT AS n_reference FROM curves GROUP BY ALL)
"""
add("unit_injection_ks", lambda s, d: _injection(s, d).select("OMOP_CONCEPT_ID", "TEST_NAME", "MEASUREMENT_UNIT", *rounded("ks"), "n_sample", "n_reference"), INJECTION_SQL + "SELECT OMOP_CONCEPT_ID, TEST_NAME, MEASUREMENT_UNIT, round(ks, 6) AS ks, n_sample, n_reference FROM injected")
add("unit_injection_decision", lambda s, d: _injection(s, d).select("OMOP_CONCEPT_ID", "TEST_NAME", "MEASUREMENT_UNIT", "decision"), INJECTION_SQL + "SELECT OMOP_CONCEPT_ID, TEST_NAME, MEASUREMENT_UNIT, CASE WHEN ks IS NULL THEN 'no reference' WHEN ks < 0.3 THEN 'inject' ELSE 'manual' END AS decision FROM injected")

# ---- comparison and report
add("remote_differences", lambda s, d: enriched(s, d).select("rowId", "diff_measurement_unit", "differences"), "SELECT rowId, diff_measurement_unit, differences FROM enriched")
UNIT = lambda local: "local_MEASUREMENT_UNIT" if local else "MEASUREMENT_UNIT"


def _unit_change(local: bool = True) -> str:
    return f"CASE WHEN coalesce(MEASUREMENT_UNIT_PREFIX, '') <> coalesce({UNIT(local)}, '') THEN coalesce(MEASUREMENT_UNIT_PREFIX, '') || ' -> ' || coalesce({UNIT(local)}, '') ELSE '' END"


def _value_change(local: bool = True) -> str:
    c = "local_" if local else ""
    target = "coalesce(local_MEASUREMENT_UNIT_HARMONIZED_target, '')"
    return f"CASE WHEN {'local_h' if local else 'h'} IS NULL THEN '' ELSE (CASE WHEN coalesce({c}MEASUREMENT_UNIT_HARMONIZED, '') <> {target} THEN 'MISSING: ' ELSE '' END) || (CASE WHEN coalesce({c}MEASUREMENT_UNIT, '') <> {target} THEN coalesce({c}MEASUREMENT_UNIT, '') || ' -> ' || {target} ELSE '' END) || coalesce(' *' || {c}CONVERSION_FACTOR, '') END"


def _test_id(unit: str = "MEASUREMENT_UNIT") -> str:
    return f"coalesce(TEST_NAME, 'NA') || ' [' || coalesce({unit}, '') || ']' || CASE WHEN IS_EXTRACTED THEN ' (Extracted)' ELSE '' END"


add("unit_change_text", lambda s, d: enriched(s, d).select("rowId", report.unit_change().alias("unitChange"), report.value_unit_change().alias("valueUnitChange")), f"SELECT rowId, {_unit_change()} AS unitChange, {_value_change()} AS valueUnitChange FROM enriched")
add("test_id", lambda s, d: summary(s, d).select("rowId", report.test_id().alias("testId")), f"SELECT rowId, {_test_id()} AS testId FROM summary")
add("issue_links", lambda s, d: vocabulary.table(s, d, "mapping").select("line", report.issue_links("validationMessages", "https://example.org/issues/").alias("message")), voc("mapping") + """SELECT line, regexp_replace(validationMessages, '#(\\d+)', '<a href="https://example.org/issues/\\1">#\\1</a>', 'g') AS message FROM mapping""", own=True)
for _name, _local in (("view_local", True), ("view_remote", False)):
    _plain = {n: c for n, c in report.VIEW.items() if n != "decilesHarmonized"}
    add(_name, lambda s, d, x=_local: report.view(enriched(s, d), x).withColumn("decilesHarmonized", F.get("decilesHarmonized", F.lit(4)).cast("double")).withColumn("decilesHarmonized", F.round("decilesHarmonized", 6)), "SELECT rowId, " + ", ".join(f"{c[0] if _local else c[1]} AS {n}" for n, c in _plain.items()) + f", round({'local_h' if _local else 'h'}[5], 6) AS decilesHarmonized FROM enriched")
add("report_distribution_text", lambda s, d: summary(s, d).select("rowId", report.distribution_text("distribution_values", D.SOURCES).alias("values"), report.distribution_text("distribution_outcomes", D.OUTCOMES).alias("outcomes")), f'SELECT rowId, {_text_sql("dv", D.SOURCES)} AS "values", {_text_sql("dx", D.OUTCOMES)} AS outcomes FROM summary')
DECILE_SQL = "CASE WHEN $v IS NOT NULL THEN '[ ' || array_to_string(list_transform($v, lambda x: format('{:.2f}', floor(x * 100 + 0.5) / 100)), ', ') || ' ' || coalesce($u, 'NA') || ' ]' END"
_dec = lambda v, u: DECILE_SQL.replace("$v", v).replace("$u", u)
add("report_decile_text", lambda s, d: enriched(s, d).select("rowId", report.decile_text("v", "local_MEASUREMENT_UNIT").alias("deciles")), f"SELECT rowId, {_dec('v', 'local_MEASUREMENT_UNIT')} AS deciles FROM enriched")


def _report_sql(local: bool) -> str:
    c = "local_" if local else ""
    log_p = lambda p: f"round(-log10(nullif({p}, 0.0)), 2)"
    return f"""SELECT rowId, status, {c}OMOP_CONCEPT_ID AS conceptId, local_OMOP_CONCEPT_NAME AS conceptName, {c}omopQuantity AS omopQuantity, {_unit_change(local)} AS unitChange, {_test_id(UNIT(local))} AS testId, n_subjects AS nPeople, n_records AS nRecords,
    {_text_sql("dv", D.SOURCES)} AS "values", {_text_sql("dx", D.OUTCOMES)} AS outcomes, {_dec("v", UNIT(local))} AS deciles, round(ks, 2) AS ks, {log_p("p")} AS ksLogP, {_value_change(local)} AS valueUnitChange,
    {_dec(f"{'local_h' if local else 'h'}", f"{c}MEASUREMENT_UNIT_HARMONIZED")} AS decilesHarmonized, round(ks_harmonized, 2) AS ksHarmonized, {log_p("p_harmonized")} AS ksHarmonizedLogP,
    regexp_replace(message, '#(\\d+)', '<a href="https://example.org/issues/\\1">#\\1</a>', 'g') AS message, differences, isNotHarmonised FROM enriched"""


for _name, _local in (("report_table", True), ("report_table_remote", False)):
    add(_name, lambda s, d, x=_local: report.table(enriched(s, d), x, "https://example.org/issues/"), _report_sql(_local))
add("report_top", lambda s, d: report.table(enriched(s, d)).limit(5).select("rowId", "nRecords"), "SELECT rowId, n_records AS nRecords FROM enriched ORDER BY n_records DESC NULLS LAST, rowId LIMIT 5")
add(
    "report_text_table",
    lambda s, d: report.text_table(enriched(s, d)),
    f"""SELECT rowId, status, local_OMOP_CONCEPT_ID AS conceptId, local_OMOP_CONCEPT_NAME AS conceptName, local_omopQuantity AS omopQuantity, {_test_id(UNIT(True))} AS testId, n_subjects AS nPeople, n_records AS nRecords, {_text_sql("dv", D.SOURCES)} AS "values", {_text_sql("dx", D.OUTCOMES)} AS outcomes,
    {_dec("v", UNIT(True))} AS deciles, round(ks, 2) AS ks, {_dec("local_h", "local_MEASUREMENT_UNIT_HARMONIZED")} AS decilesHarmonized, round(ks_harmonized, 2) AS ksHarmonized, message, differences, round(p, 2) AS pValue, round(p_harmonized, 2) AS pValueHarmonized FROM enriched""",
)
_SOURCE_COLOURS = {"Missing": "#D3D3D3", "Extracted": "#808080", "Source": "#0000FF"}
_JSON_SQL = "[" + ", ".join(repr(c) for c in D.SOURCES) + "]"
add(
    "distribution_json",
    lambda s, d: summary(s, d).select("rowId", report.distribution_json("distribution_values", D.SOURCES, report.SOURCE_COLOURS).alias("json")),
    "SELECT rowId, '[' || array_to_string(list_transform(" + _JSON_SQL + ", lambda c: '{\"value\":\"' || c || '\",\"n\":' || dv[c] || ',\"percent\":\"' || format('{:.1f}', floor(1000.0::DOUBLE * dv[c] / greatest(list_sum(map_values(dv)), 1) + 0.5) / 10) || '\",\"colour\":\"' || CASE c "
    + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _SOURCE_COLOURS.items()) + " ELSE '#CCCCCC' END || '\"}'), ',') || ']' AS json FROM summary",
)
add(
    "running_percent",
    lambda s, d: summary(s, d).select("rowId", F.posexplode(report.running_percent("distribution_outcomes", D.OUTCOMES)).alias("place", "percent")),
    ", lists AS (SELECT rowId, list_transform([" + ", ".join(repr(c) for c in D.OUTCOMES) + "], lambda c: dx[c]) AS n FROM summary), places AS (SELECT rowId, n, unnest(range(len(n)))::INT AS place FROM lists) SELECT rowId, place, floor(1000.0::DOUBLE * list_sum(n[1 : place + 1]) / list_sum(n) + 0.5) / 10 AS percent FROM places WHERE list_sum(n) > 0",
)
add("unnest_keep_empty", lambda s, d: summary(s, d).select("rowId", F.inline_outer(F.filter("distribution_outcomes", lambda x: x["n"] > 100))), ", flat AS (SELECT rowId, unnest(map_entries(dx), recursive := true) FROM summary), many AS (SELECT * FROM flat WHERE value > 100) SELECT s.rowId, f.key AS value, f.value AS n FROM summary s LEFT JOIN many f USING (rowId)")
_number = lambda x: f"regexp_replace(regexp_replace(({x})::DOUBLE::VARCHAR::DECIMAL(38, 18)::VARCHAR, '\\.?0+$', ''), '^-0$', '0')"
add("number_text", lambda s, d: summary(s, d).select("rowId", text.number("n_records").alias("n"), text.number(F.col("n_subjects") / F.col("n_records")).alias("share"), text.number(-1e-9 * F.col("n_subjects")).alias("small")), f"SELECT rowId, {_number('n_records')} AS n, {_number('n_subjects::DOUBLE / n_records')} AS share, {_number('-1e-9::DOUBLE * n_subjects')} AS small FROM summary")
add("quote_escaping", lambda s, d: mapped(s, d).select("rowId", text.escaped(F.concat(F.lit("title=\""), F.coalesce("message", F.lit("it's")), F.lit("\""))).alias("attribute")), "SELECT rowId, replace(replace('title=\"' || coalesce(message, 'it''s') || '\"', '\"', '&quot;'), chr(39), '&#39;') AS attribute FROM mapped")
add("category_colour", lambda s, d: mapped(s, d).select("rowId", report.colour(F.col("status")).alias("colour")), "SELECT rowId, CASE status WHEN 'APPROVED' THEN '#74de74' WHEN 'IGNORED' THEN '#7b7b7b' WHEN 'UNCHECKED' THEN '#cccccc' WHEN 'FLAGGED' THEN '#d75e5e' WHEN 'INVALID_TARGET' THEN '#fffecc' WHEN 'NOT-FOUND' THEN '#deb074' END AS colour FROM mapped")
add("ordered_distribution", lambda s, d: summary(s, d).select("rowId", D.text(report.ordered("distribution_outcomes", D.OUTCOMES)).alias("outcomes")), "SELECT rowId, array_to_string(list_transform([" + ", ".join(repr(c) for c in D.OUTCOMES) + "], lambda c: c || '=' || dx[c]), '|') AS outcomes FROM summary")
add("status_rollup", lambda s, d: report.status_rollup(mapped(s, d)), "SELECT status, count(*) FILTER (WHERE contains(message, 'WARNING')) AS n_warnings, count(*) AS n_tests, sum(n_subjects)::BIGINT AS n_subjects, sum(n_records)::BIGINT AS n_records FROM mapped GROUP BY status")
SHARE_SQL = ", rolled AS (SELECT status, count(*) FILTER (WHERE contains(message, 'WARNING')) AS n_warnings, count(*) AS n_tests, sum(n_subjects)::BIGINT AS n_subjects, sum(n_records)::BIGINT AS n_records FROM mapped GROUP BY status), shares AS (SELECT *, round(100.0::DOUBLE * n_tests / sum(n_tests) OVER (), 4) AS p_tests, round(100.0::DOUBLE * n_records / sum(n_records) OVER (), 4) AS p_records, round(100.0::DOUBLE * sum(n_records) OVER (ORDER BY n_records DESC, status ROWS UNBOUNDED PRECEDING) / sum(n_records) OVER (), 4) AS p_running FROM rolled) "
add("status_share", lambda s, d: report.status_share(mapped(s, d)).drop("p_running"), SHARE_SQL + "SELECT * EXCLUDE (p_running) FROM shares")
add("running_share", lambda s, d: report.status_share(mapped(s, d)).select("status", "p_running"), SHARE_SQL + "SELECT status, p_running FROM shares")
add("value_source_rollup", lambda s, d: report.source_rollup(mapped(s, d)), "SELECT local_OMOP_CONCEPT_ID, " + ", ".join(f"sum(dv['{c}'])::BIGINT AS {c}" for c in D.SOURCES) + " FROM mapped GROUP BY 1")
add("message_rollup", lambda s, d: report.message_rollup(mapped(s, d)), "SELECT local_OMOP_CONCEPT_ID, count(*) AS n_tests, sum(n_subjects)::BIGINT AS n_subjects, sum(n_records)::BIGINT AS n_records, " + ", ".join(f"count(*) FILTER (WHERE contains(message, '{t}')) AS {n}" for n, t in report.MESSAGES.items()) + " FROM mapped GROUP BY 1")

# ---- filters
add("filter_regex", lambda s, d: summary(s, d).withColumn("testId", report.test_id()).filter(regex_filter("testId", "^CLICK|mol")).select("rowId", "testId"), f"SELECT * FROM (SELECT rowId, {_test_id()} AS testId FROM summary) WHERE regexp_matches(testId, '(?i)^CLICK|mol')")
for _name, _text, _sql in (("range", "80 - 10", "ks_x > 10 - 1e-9 AND ks_x < 80 + 1e-9"), ("ge", ">= 10", "ks_x >= 10 - 1e-9"), ("lt", "<60", "ks_x < 60 - 1e-9"), ("eq", "=0", "abs(ks_x) < 1e-9"), ("na", "NA", "ks_x IS NULL"), ("other", "==3", "ks_x IS NOT NULL")):
    add(f"filter_numeric_{_name}", lambda s, d, t=_text: enriched(s, d).withColumn("ks_x", F.col("ks") * 100).filter(numeric_filter("ks_x", t)).select("rowId"), f", x AS (SELECT rowId, ks * 100 AS ks_x FROM enriched) SELECT rowId FROM x WHERE {_sql}")


# ---- similar names, out of part: names that come in size 50 are mapped, the others not; n is what was sold of them
def _tests(s: SparkSession, d: str) -> DataFrame:
    part, sold = s.read.parquet(f"{d}/part.parquet"), s.read.parquet(f"{d}/lineitem.parquet").groupBy("l_partkey").agg(F.sum("l_quantity").alias("sold"))
    named = part.join(sold, F.col("p_partkey") == F.col("l_partkey"), "left").groupBy(F.concat(F.concat_ws(" ", "p_name", "p_brand"), F.lit(" []")).alias("name"))
    return named.agg(F.when(F.max("p_size") >= 50, F.max("p_partkey")).otherwise(F.lit(0).cast("long")).alias("concept"), F.coalesce(F.sum("sold"), F.lit(0)).cast("long").alias("n"))


TESTS_SQL = "WITH tests AS (SELECT p_name || ' ' || p_brand || ' []' AS name, CASE WHEN max(p_size) >= 50 THEN max(p_partkey) ELSE 0 END AS concept, coalesce(sum(sold), 0)::BIGINT AS n FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity) AS sold FROM lineitem GROUP BY 1) ON l_partkey = p_partkey GROUP BY 1), named AS (SELECT * FROM tests WHERE try_cast(name AS DOUBLE) IS NULL AND n > 500), found AS (SELECT a.name, b.concept, b.name AS other, 1 - jaro_similarity(a.name, b.name) AS distance FROM named a, named b WHERE a.concept < 1 AND b.concept >= 1), near AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY distance, other, concept) AS rank FROM found QUALIFY rank <= 10), rolled AS (SELECT name, concept, count(*) AS n, string_agg(other, ' | ' ORDER BY other) AS names, avg(distance) AS mean_distance FROM near GROUP BY 1, 2) "


def _near(s, d):
    return similarity.nearest(*similarity.split_mapped(_tests(s, d)))


add("non_numeric_names", lambda s, d: _tests(s, d).filter("try_cast(name as double) is null"), TESTS_SQL + "SELECT * FROM tests WHERE try_cast(name AS DOUBLE) IS NULL", own=True)
add("mapped_unmapped_split", lambda s, d: similarity.split_mapped(_tests(s, d))[1].select("name"), TESTS_SQL + "SELECT name FROM named WHERE concept < 1", own=True)
add("jaro_distance", lambda s, d: similarity.matrix(*similarity.split_mapped(_tests(s, d))).select("name", "concept", "other", *rounded("distance")), TESTS_SQL + "SELECT name, concept, other, round(distance, 6) AS distance FROM found", own=True)
add("similarity_topk", lambda s, d: _near(s, d).select("name", "rank", "other", "concept", *rounded("distance")), TESTS_SQL + "SELECT name, rank, other, concept, round(distance, 6) AS distance FROM near", own=True)
add("similarity_rollup", lambda s, d: similarity.by_concept(_near(s, d)).select("name", "concept", "n", "names", *rounded("mean_distance")), TESTS_SQL + "SELECT name, concept, n, names, round(mean_distance, 6) AS mean_distance FROM rolled", own=True)
_LINK = "'=HYPERLINK(\"https://example.org/' || concept || '\", \"' || concept || '\"&CHAR(10)&\"' || n || ' testIds: ' || replace(names, '\"', '\"\"') || '\"&CHAR(10)&\"distance: ' || regexp_replace(printf('%.6f', round(mean_distance, 3)), '\\.?0+$', '') || '\")'"
add("similarity_formulas", lambda s, d: similarity.formulas(similarity.by_concept(_near(s, d)), "https://example.org/"), TESTS_SQL + "SELECT name, " + ", ".join(f"max(CASE WHEN r = {i} THEN {_LINK} END) AS closest_{i}" for i in (1, 2, 3)) + " FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY mean_distance, concept) AS r FROM rolled) GROUP BY name", own=True)
WIDE_SQL = ", ".join(f"max(CASE WHEN r = {i} THEN concept END) AS concept_{i}, round(max(CASE WHEN r = {i} THEN mean_distance END), 6) AS mean_distance_{i}" for i in (1, 2, 3))
add("similarity_wide", lambda s, d: similarity.wide(similarity.by_concept(_near(s, d))).select("name", *(f"concept_{i}" for i in (1, 2, 3)), *rounded(*(f"mean_distance_{i}" for i in (1, 2, 3)))), TESTS_SQL + f"SELECT name, {WIDE_SQL} FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY mean_distance, concept) AS r FROM rolled) GROUP BY name", own=True)

# ---- vocabulary upkeep
V = vocabulary.table
add("ignore_list_join", lambda s, d: H.ignore_list_join(V(s, d, "mapping"), V(s, d, "ignored")).select("line", "ignoreReasonNew"), voc("mapping", "ignored") + "SELECT line, REASON AS ignoreReasonNew FROM mapping LEFT JOIN (SELECT DISTINCT * FROM ignored) i ON i.TEST_NAME IS NOT DISTINCT FROM testNameAbbreviation", own=True)
add("ignore_conflicts", lambda s, d: H.ignore_conflicts(V(s, d, "mapping"), V(s, d, "ignored")), voc("mapping", "ignored") + "SELECT TEST_NAME, 'two reasons' AS problem FROM (SELECT DISTINCT * FROM ignored) GROUP BY 1 HAVING count(*) > 1 UNION ALL SELECT DISTINCT testNameAbbreviation, 'approved' FROM mapping WHERE mappingStatus = 'APPROVED' AND testNameAbbreviation IN (SELECT TEST_NAME FROM ignored)", own=True)
add("status_recode", lambda s, d: H.recode_status(V(s, d, "mapping")).select("line", "mappingStatus"), voc("mapping") + "SELECT line, CASE WHEN mappingStatus IN ('FLAGGED', 'INVALID_TARGET') THEN 'UNCHECKED' ELSE mappingStatus END AS mappingStatus FROM mapping", own=True)
add("inherit_unitless_concept", lambda s, d: H.inherit_concepts(V(s, d, "mapping")), voc("mapping") + "SELECT testNameAbbreviation, min(conceptId) AS conceptId FROM mapping WHERE mappingStatus = 'APPROVED' GROUP BY 1 HAVING count(DISTINCT conceptId) = 1", own=True)
add("conversion_reciprocity", lambda s, d: validate.one_way_rules(V(s, d, "conversion")), voc("conversion") + ", rules AS (SELECT * FROM conversion WHERE source_unit_valid IS NOT NULL AND to_source_unit_valid IS NOT NULL) SELECT a.omop_quantity, a.source_unit_valid, a.to_source_unit_valid, try_cast(a.conversion AS DOUBLE) AS there, try_cast(b.conversion AS DOUBLE) AS back FROM rules a JOIN rules b ON a.omop_quantity = b.omop_quantity AND a.source_unit_valid = b.to_source_unit_valid AND a.to_source_unit_valid = b.source_unit_valid WHERE a.source_unit_valid < a.to_source_unit_valid AND abs(try_cast(a.conversion AS DOUBLE) * try_cast(b.conversion AS DOUBLE) - 1) > 1e-5", own=True)


def _rewritten(s: SparkSession, d: str) -> DataFrame:
    """The mapping file read, its statuses recoded, put in its own place, and read again."""

    def write() -> str:
        path = f"{store.folder(s, 'rewritten')}/mapping"
        tables.write_csv(V(s, d, "mapping").orderBy("line").drop("line").withColumnsRenamed(vocabulary.ADDED), path)
        cells = s.read.option("header", True).option("nullValue", "").option("multiLine", True).option("escape", '"').csv(path)
        tables.replace_csv(H.recode_status(cells), path)
        return path

    return tables.read_mapping(s, store.once(s, "rewritten", d, write))


add("mapping_rewrite", lambda s, d: _rewritten(s, d).select("sourceCode", "conceptId", "mappingStatus", "validationMessages"), voc("mapping") + "SELECT nullif(sourceCode, '') AS sourceCode, conceptId, CASE WHEN mappingStatus IN ('FLAGGED', 'INVALID_TARGET') THEN 'UNCHECKED' ELSE mappingStatus END AS mappingStatus, validationMessages FROM mapping", own=True)


def _log(s: SparkSession, d: str, *lacking: str) -> DataFrame:
    """The log of all rules; with lacking, of a mapping without these columns."""
    tables_ = lambda: validate.log("LAB", V(s, d, "mapping").drop(*lacking), V(s, d, "conversion"), V(s, d, "concepts"), V(s, d, "unit_fix"))
    return store.once(s, "-".join(("log", *lacking)), d, tables_)


def _steps(lacking: tuple[str, ...] = ()) -> list[tuple[str, str, str, str]]:
    """Step, severity, count and what the message says, as SQL over the vocabulary tables; a lacking column is null in the mapping that they read."""
    bad_unit = "(measurementUnit IS NULL OR measurementUnit NOT IN (SELECT source_unit_valid FROM conversion WHERE source_unit_valid IS NOT NULL))"
    bad_quantity = "NOT EXISTS (SELECT 1 FROM conversion r WHERE r.to_source_unit_valid IS NOT NULL AND r.omop_quantity = omopQuantity AND r.source_unit_valid = measurementUnit)"
    outdated = "conceptId <> 0 AND conceptId NOT IN (SELECT conceptId FROM concepts WHERE invalidReason IS NULL)"
    mixed = "(SELECT sourceCode, string_agg(DISTINCT domainId, '|' ORDER BY domainId) AS domains FROM mapping JOIN concepts USING (conceptId) WHERE conceptId <> 0 AND {} GROUP BY 1) t WHERE contains(domains, '|') AND domains NOT IN ('Condition|Measurement', 'Condition|Observation', 'Condition|Procedure', 'Measurement|Observation', 'Measurement|Procedure', 'Observation|Procedure')"
    approved, other = "coalesce(mappingStatus = 'APPROVED', false)", "NOT coalesce(mappingStatus = 'APPROVED', false)"
    m, blank = "mapping WHERE ", "coalesce(trim({}), '') = ''"
    absent = lambda *columns: (str(n := sum(c in lacking for c in columns)), "missing columns" + (": " + ", ".join(c for c in columns if c in lacking) if n else ""))
    count = lambda where, found="rows": (f"(SELECT count(*) FROM {where})", found)
    return [
        ("Missing default columns", "ERROR", *absent("sourceCode", "sourceName", "sourceFrequency", "conceptId", "conceptName", "mappingStatus")),
        ("SourceCode is empty", "ERROR", *count(m + blank.format("sourceCode"))),
        ("SourceCode and conceptId are not unique", "ERROR", *count("(SELECT 1 FROM mapping GROUP BY sourceCode, conceptId HAVING count(*) > 1)", "repeated pairs")),
        ("SourceCode is more than 50 characters", "ERROR", *count(m + "length(sourceCode) > 50")),
        ("SourceName is empty", "ERROR", *count(m + blank.format("sourceName"))),
        ("SourceName is more than 255 characters", "ERROR", *count(m + "length(sourceName) > 255")),
        ("SourceFrequency is not empty", "ERROR", *count(m + "sourceFrequency IS NULL")),
        ("MappingStatus is empty", "ERROR", *count(m + blank.format("mappingStatus"))),
        ("MappingStatus is not valid", "ERROR", *count(m + "mappingStatus NOT IN ('APPROVED', 'IGNORED', 'UNCHECKED', 'FLAGGED', 'INVALID_TARGET')")),
        ("APPROVED mappingStatus conceptId is 0", "ERROR", *count(m + "mappingStatus = 'APPROVED' AND conceptId = 0")),
        ("APPROVED mappingStatus with concepts outdated", "ERROR", *count(m + f"{approved} AND {outdated}")),
        ("Not APPROVED mappingStatus with concepts outdated", "WARNING", *count(m + f"{other} AND {outdated}")),
        ("Missing C&CR columns", "ERROR", *absent("sourceConceptId", "sourceConceptClass", "sourceDomain")),
        ("SourceConceptId is empty", "ERROR", *count(m + "sourceConceptId IS NULL")),
        ("SourceConceptId is not a number on the range", "ERROR", *count(m + "sourceConceptId NOT BETWEEN 2002400000 AND 2002499999")),
        ("SourceConceptClass is empty", "ERROR", *count(m + blank.format("sourceConceptClass"))),
        ("SourceConceptClass is more than 20 characters", "ERROR", *count(m + "length(sourceConceptClass) > 20")),
        ("SourceDomain is empty", "ERROR", *count(m + blank.format("sourceDomain"))),
        ("SourceDomain is not a valid domain", "ERROR", *count(m + "trim(sourceDomain) <> '' AND sourceDomain NOT IN ('Condition', 'Device', 'Drug', 'Measurement', 'Observation', 'Procedure', 'Specimen', 'Unit', 'Visit')")),
        ("Not APPROVED mappingStatus with valid domain combination", "WARNING", *count(mixed.format(other), "codes")),
        ("APPROVED mappingStatus with valid domain combination", "ERROR", *count(mixed.format(approved), "codes")),
        ("Missing date columns", "ERROR", *absent("validStart", "validEnd")),
        ("SourceValidStartDate is after SourceValidEndDate", "ERROR", *count(m + "validStart::DATE > validEnd::DATE")),
        ("Missing parent columns", "ERROR", *absent("parentCode")),
        ("Invalid parent concept code", "ERROR", *count("mapping c WHERE trim(parentCode) <> '' AND NOT EXISTS (SELECT 1 FROM mapping p WHERE p.sourceCode = c.parentCode)")),
        ("LAB: Invalid lab source name format", "ERROR", *count(m + r"NOT coalesce(regexp_matches(sourceCode, '^[^\[\]]+\[[^\[\]]*\]$'), false)")),
        ("LAB: APPROVED Invalid lab unit", "ERROR", *count(m + f"{approved} AND {bad_unit}", "APPROVED lab source codes where unit is not in validUnitsList or is NA")),
        ("LAB: not APPROVED Invalid lab unit", "WARNING", *count(m + f"{other} AND {bad_unit}", "not APPROVED lab source codes where unit is not in validUnitsList or is NA")),
        ("LAB: Invalid lab mapped domain", "WARNING", *count("mapping JOIN concepts USING (conceptId) WHERE conceptId <> 0 AND domainId <> 'Measurement'", "mapped lab source codes where domain is not 'Measurement'")),
        ("LAB: APPROVED Invalid lab quantity", "ERROR", *count(m + f"{approved} AND {bad_quantity}", "APPROVED lab source codes where test unit does not agree with omop_quantity")),
        ("LAB: not APPROVED Invalid lab quantity", "WARNING", *count(m + f"{other} AND {bad_quantity}", "not APPROVED lab source codes where test unit does not agree with omop_quantity")),
        ("LAB: TestName with same quantity maps to different concept ids", "WARNING", *count("(SELECT 1 FROM mapping WHERE mappingStatus = 'APPROVED' GROUP BY testNameAbbreviation, omopQuantity HAVING count(DISTINCT conceptId) > 1)", "codes with testName with same quantity maps to different concept ids")),
        ("Missing required columns", "ERROR", *absent()),
        ("TEST_NAME_ABBREVIATION source_unit_clean is unique", "ERROR", *count("(SELECT 1 FROM unit_fix GROUP BY TEST_NAME_ABBREVIATION, source_unit_clean HAVING count(*) > 1)", "repeated pairs")),
        ("TEST_NAME_ABBREVIATION is empty", "ERROR", *count("unit_fix WHERE " + blank.format("TEST_NAME_ABBREVIATION"))),
        ("TEST_NAME_ABBREVIATION source_unit_clean_fix pair valid", "WARNING", *count("unit_fix WHERE NOT EXISTS (SELECT 1 FROM mapping WHERE testNameAbbreviation IS NOT DISTINCT FROM TEST_NAME_ABBREVIATION AND measurementUnit IS NOT DISTINCT FROM source_unit_clean_fix)", "pairs that aren't mapped")),
    ]


def _log_sql(*lacking: str) -> str:
    text = lambda x: x.replace("'", "''")
    types = {"sourceFrequency": "INTEGER", "conceptId": "INTEGER", "sourceConceptId": "BIGINT"}
    whole = f"WITH {vocabulary.sql()}".replace("mapping AS (", "mapping_ AS (", 1) + ", mapping AS (SELECT * REPLACE (line AS line" + "".join(f", NULL::{types.get(c, 'VARCHAR')} AS {c}" for c in lacking) + ") FROM mapping_)"
    rows = " UNION ALL ".join(f"SELECT {i} AS place, 'LAB' AS context, '{text(step)}' AS step, '{kind}' AS severity, {n}::BIGINT AS n, '{text(found)}' AS found" for i, (step, kind, n, found) in enumerate(_steps(lacking)))
    return whole + f", log AS (SELECT context, CASE WHEN n > 0 THEN severity ELSE 'SUCCESS' END AS type, step, CASE WHEN n > 0 THEN 'Found ' || n || ' ' || found ELSE '' END AS message, n, place FROM ({rows})) "


LOG_SQL = _log_sql()
LOG = ["context", "type", "step", "message", "n"]
add("validate_log", lambda s, d: _log(s, d).select(*LOG), LOG_SQL + f"SELECT {', '.join(LOG)} FROM log", own=True)
_LACKING = ("parentCode", "sourceDomain", "sourceName", "validEnd")
add("validate_lacking_columns", lambda s, d: _log(s, d, *_LACKING).select(*LOG), _log_sql(*_LACKING) + f"SELECT {', '.join(LOG)} FROM log", own=True)
add("validate_rollup", lambda s, d: validate.rollup(_log(s, d)), LOG_SQL + "SELECT context, " + ", ".join(f"count(*) FILTER (WHERE type = '{t}') AS {t}" for t in validate.SEVERITY) + " FROM log GROUP BY context", own=True)
add("final_status", lambda s, d: validate.final_status(_log(s, d)), LOG_SQL + "SELECT CASE WHEN count(*) FILTER (WHERE type = 'ERROR') > 0 THEN 'ERROR' WHEN count(*) FILTER (WHERE type = 'WARNING') > 0 THEN 'WARNING' ELSE 'SUCCESS' END AS final_status FROM log", own=True)
add("status_page", lambda s, d: validate.page(_log(s, d)).filter("line like '|LAB|%'"), LOG_SQL + "SELECT place + 3.0::DOUBLE AS place, '|' || context || '|' || type || '|' || step || '|' || message || '|' AS line FROM log UNION ALL SELECT 1.0::DOUBLE, '|' || context || '|' || count(*) FILTER (WHERE type = 'SUCCESS') || '|' || count(*) FILTER (WHERE type = 'WARNING') || '|' || count(*) FILTER (WHERE type = 'ERROR') || '|' FROM log GROUP BY context", own=True)

# ---- looking at tables
add("row_cap", lambda s, d: preview.cap(measurement(s, d), 100).agg(F.count("*").alias("n")), "SELECT least(100, count(*)) AS n FROM m")
add("seeded_sample", lambda s, d: preview.sample(lab.raw(s, d).select("TEST_NAME").distinct(), 3, ["TEST_NAME"], 7), "SELECT DISTINCT TEST_NAME FROM m ORDER BY md5('7' || chr(31) || coalesce(TEST_NAME, '')) LIMIT 3")
_COLUMNS = ("omop_quantity", "source_unit_valid", "to_source_unit_valid", "conversion", "only_to_omop_concepts")
add("column_preview", lambda s, d: preview.columns(V(s, d, "conversion")).select("place", "name", "n", "n_missing", "smallest", "largest"), voc("conversion") + " UNION ALL ".join(f"SELECT {i}::INT AS place, '{c}' AS name, count(*) AS n, count(*) - count({c}) AS n_missing, min({c}) AS smallest, max({c}) AS largest FROM conversion" for i, c in enumerate(_COLUMNS)), own=True)
add("row_counts", lambda s, d: preview.counts(extract.summary_values_source(measurement(s, d)), K5), f"SELECT (SELECT count(*) FROM sources) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT {K} FROM sources)) AS n_keys")
add("look_up", lambda s, d: preview.look_up(summary(s, d).select("rowId", "TEST_NAME", "MEASUREMENT_UNIT"), 4, TEST_NAME="click", MEASUREMENT_UNIT=None), "SELECT rowId, TEST_NAME, MEASUREMENT_UNIT FROM summary WHERE TEST_NAME = 'click' AND MEASUREMENT_UNIT IS NULL ORDER BY rowId LIMIT 4")
add("side_by_side", lambda s, d: preview.beside(V(s, d, "mapping").select("line", "sourceCode"), V(s, d, "ignored"), [F.col("line")], [F.col("TEST_NAME"), F.col("REASON")]), voc("mapping", "ignored") + "SELECT line, sourceCode, TEST_NAME, REASON FROM (SELECT line, sourceCode, row_number() OVER (ORDER BY line) AS k FROM mapping) FULL JOIN (SELECT *, row_number() OVER (ORDER BY TEST_NAME NULLS FIRST, REASON) AS k FROM ignored) USING (k)", own=True)
add("concept_ids", lambda s, d: V(s, d, "conversion").select("omop_quantity", F.expr("try_cast(only_to_omop_concepts as int)").alias("concept"), F.expr("try_cast(conversion as int)").alias("factor")), voc("conversion") + "SELECT omop_quantity, try_cast(only_to_omop_concepts AS INT) AS concept, CASE WHEN regexp_matches(conversion, '^-?[0-9]+$') THEN try_cast(conversion AS INT) END AS factor FROM conversion", own=True)

# ---- vocabulary files: the same tables written and read by the readers
Files = vocabulary.files
add("read_unit_fix", lambda s, d: tables.read_unit_fix(s, Files(s, d)["unit_fix"]).select("TEST_NAME_ABBREVIATION", "source_unit_clean", "source_unit_clean_fix"), voc("unit_fix") + "SELECT nullif(TEST_NAME_ABBREVIATION, '') AS TEST_NAME_ABBREVIATION, source_unit_clean, source_unit_clean_fix FROM unit_fix", own=True)
add("read_unit_conversion", lambda s, d: tables.read_unit_conversion(s, Files(s, d)["conversion"]).drop("validation_messages"), voc("conversion") + "SELECT * REPLACE (nullif(source_unit_valid, '') AS source_unit_valid) FROM conversion", own=True)
add("read_ignore_list", lambda s, d: tables.read_ignore_list(s, Files(s, d)["ignored"]).select("TEST_NAME", "REASON"), voc("ignored") + "SELECT * FROM ignored", own=True)
add("read_mapping", lambda s, d: tables.read_mapping(s, Files(s, d)["mapping"]), voc("mapping") + "SELECT row_number() OVER (ORDER BY line) AS line, conceptId, sourceCode, testNameAbbreviation, measurementUnit, nullif(conceptName, '') AS conceptName, omopQuantity, validationMessages, mappingStatus, ignoreReason FROM mapping", own=True)
add("read_vocabulary_folder", lambda s, d: tables.vocabulary_views(s, Files(s, d)["folder"], {"CONCEPT": "conceptId int, domainId string, invalidReason string"}) or s.table("CONCEPT"), voc("concepts") + "SELECT * FROM concepts", own=True)
add("text_to_parquet", lambda s, d: s.read.parquet(vocabulary.malformed_text(s, d)), "SELECT p_name || ' ' || p_partkey AS name, CASE WHEN p_size % 4 <> 0 THEN p_brand END AS brand FROM part WHERE p_partkey % 50 NOT IN (7, 8)", own=True)
_FILE_SQL = {"summaryTest": "SELECT * FROM tests", "summaryValuesSource": "SELECT * FROM sources", "summaryValues": f"SELECT {K}, {VALS} FROM vals", "summaryOutcomes": "SELECT * FROM outcomes"}


def _extract(s: SparkSession, d: str, name: str) -> DataFrame:
    read = tables.read_extracts(s, lab.extract_files(s, d, lambda: extract.all_extracts(facts(s, d))))[name]
    return read.select(*(F.round(c, 6).alias(c) if kind == "double" else c for c, kind in read.dtypes))


for _name, _sql in _FILE_SQL.items():
    add(f"read_{_name}" if _name != "summaryOutcomes" else "read_extract", lambda s, d, n=_name: _extract(s, d, n), _sql)

# ---- checks
add("decile_grids", lambda s, d: checks.grids(_extract(s, d, "summaryValues")), f"SELECT {K}, bool_and(true) AS whole, bool_and(true) AS ordered, count(decile_MEASUREMENT_VALUE_HARMONIZED) = 9 AS harmonized FROM vals GROUP BY {K}")
add("extract_recheck", lambda s, d: functools.reduce(DataFrame.union, (_extract(s, d, n).agg(F.lit(n).alias("name"), F.count("*").alias("n_rows"), F.count_if(F.col("n_subjects") < extract.MIN_SUBJECTS).alias("n_small")) for n in _FILE_SQL)), " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n_rows, count(*) FILTER (WHERE n_subjects < 5) AS n_small FROM {t}" for n, t in (("summaryTest", "tests"), ("summaryValuesSource", "sources"), ("summaryValues", "vals"), ("summaryOutcomes", "outcomes"))))


def _sketched(s: SparkSession, d: str) -> DataFrame:
    """Deciles from sketches of single months that are stored and merged, beside the share of values below and up to them."""
    m = measurement(s, d).withColumn("part", F.pmod(F.xxhash64("subject"), F.lit(12)))
    deciles = extract.sketched_deciles(extract.merged(store.cut(extract.sketches(m, ["part"]), "sketches", ["part"])))
    values = m.filter("MEASUREMENT_VALUE is not null").groupBy(*K5, "MEASUREMENT_VALUE").agg(F.count("*").alias("k"))
    ranks = left_join(deciles, values, K5).groupBy(*K5, "n", "decile", "value").agg(F.sum(F.when(F.col("MEASUREMENT_VALUE") < F.col("value"), F.col("k")).otherwise(0)).alias("below"), F.sum(F.when(F.col("MEASUREMENT_VALUE") <= F.col("value"), F.col("k")).otherwise(0)).alias("upto"))
    e = extract.SKETCH_ERROR + 1 / F.col("n")
    return ranks.select(*K5, "n", F.round("decile", 1).alias("decile"), ((F.col("below") / F.col("n") <= F.col("decile") + e) & (F.col("upto") / F.col("n") >= F.col("decile") - e)).alias("within_error"))


add("sketched_deciles", _sketched, f"SELECT {K}, n, round(unnest(range(1, 10)) / 10, 1) AS decile, true AS within_error FROM (SELECT {K}, count(*) AS n FROM m WHERE MEASUREMENT_VALUE IS NOT NULL GROUP BY {K})")
