"""Queries of this subpackage: opN_<name> -> (spark, sf_dir) -> DataFrame, and the SQL twin where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labharm.llm import decontaminate, html_extract, line_dedup, mixing, nearest, negatives, ngram_join, rope, sharding, substring_dedup, token_tables, toxicity, url_filter
from labharm.llm.common import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.LineDedup(spark, min_docs=10, min_chars=1).insert(docs).apply(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT r, doc_id, unnest(generate_series(1, len(parts))) AS i, unnest(parts) AS line FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), hot AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(h.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE h.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN hot h USING (k) GROUP BY r, doc_id
"""


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP2_SQL = """
WITH v AS (
  SELECT vec_id::BIGINT AS id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), fit AS (
  SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), n AS (
  SELECT id, e, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b)) AS norm FROM fit WHERE len(e) = (SELECT mode(len(e)) FROM fit)
), scored AS (
  SELECT q.id AS query_id, c.id AS vec_id, list_reduce(list_transform(range(1, len(c.e) + 1), lambda i: c.e[i] * q.e[i]), lambda a, b: a + b) / (c.norm * q.norm) AS score
  FROM n q JOIN n c ON q.id % 50 = 0 AND c.id <> q.id
), ranked AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 5
"""


#: The mixture asked for: domains by source, and weights by node.
DOMAINS = {"web": [f"src{i}" for i in range(10)], "books": [f"src{i}" for i in range(10, 15)]}
WEIGHTS = {"domain": {"web": 5, "books": 3, "news": 2}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}
BUDGET_SHARE, MAX_EPOCHS, SEED = 0.6, 2, 17


def domain() -> Column:
    source = F.col("source")
    return F.when(source.isin(DOMAINS["web"]), "web").when(source.isin(DOMAINS["books"]), "books").when(source.isNotNull(), "news")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), domain(), WEIGHTS, BUDGET_SHARE, MAX_EPOCHS, SEED)
    return mixed.select("doc_id", "domain", "lang", "source", "epoch", "n_tokens")


def _share_sql(i: int) -> str:
    """Budgets of one level of the tree, as mixing.share_out computes them."""
    level, up, here = mixing.LEVELS[i], ", ".join(mixing.LEVELS[:i]) or "0", ", ".join(mixing.LEVELS[: i + 1])
    weights = " ".join(f"WHEN {level} = '{k}' THEN {v}" for k, v in WEIGHTS.get(level, {}).items())
    w = f"CASE {weights} ELSE 1 END" if weights else "1"
    budget = f"floor({BUDGET_SHARE}::DOUBLE * (sum(supply) OVER () / {MAX_EPOCHS}))" if not i else "budget"
    join = "" if not i else f" JOIN (SELECT {', '.join(f'{c} AS p{k}' for k, c in enumerate(mixing.LEVELS[:i]))}, given AS budget FROM given{i - 1}) p ON " + " AND ".join(f"{c} IS NOT DISTINCT FROM p{k}" for k, c in enumerate(mixing.LEVELS[:i]))
    before = f"(PARTITION BY {up} ORDER BY CASE WHEN w > 0 THEN supply / w END ASC NULLS LAST, {level} ASC NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""nodes{i} AS (SELECT {here}, (sum(tokens) * {MAX_EPOCHS})::BIGINT AS supply, ({w})::DOUBLE AS w FROM leaves GROUP BY {here}),
budgets{i} AS (SELECT n.*, ({budget})::BIGINT AS budget FROM nodes{i} n{join}),
rest{i} AS (SELECT *, sum(w) OVER (PARTITION BY {up}) - coalesce(sum(w) OVER {before}, 0) AS rest, coalesce(sum(supply) OVER {before}, 0) AS used FROM budgets{i}),
marks{i} AS (SELECT *, CASE WHEN rest > 0 THEN (budget - used)::DOUBLE / rest ELSE 0 END AS mark FROM rest{i}),
given{i} AS (SELECT {here}, (CASE WHEN supply <= w * mark THEN supply ELSE least(supply, floor(w * greatest(0, max(CASE WHEN supply > w * mark THEN mark END) OVER (PARTITION BY {up})))) END)::BIGINT AS given FROM marks{i})"""


_IN = {k: ", ".join(f"'{s}'" for s in v) for k, v in DOMAINS.items()}
OP3_SQL = rf"""
WITH docs AS (
  SELECT doc_id, lang, source, text, CASE WHEN source IN ({_IN["web"]}) THEN 'web' WHEN source IN ({_IN["books"]}) THEN 'books' WHEN source IS NOT NULL THEN 'news' END AS domain,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens FROM documents
), leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM docs GROUP BY ALL),
{_share_sql(0)},
{_share_sql(1)},
{_share_sql(2)},
plans AS (
  SELECT l.*, g.given AS budget, CASE WHEN tokens > 0 THEN g.given // tokens ELSE 0 END AS epochs FROM leaves l JOIN given2 g
  ON l.domain IS NOT DISTINCT FROM g.domain AND l.lang IS NOT DISTINCT FROM g.lang AND l.source IS NOT DISTINCT FROM g.source WHERE g.given > 0
), placed AS (
  SELECT d.*, p.epochs, p.budget - p.epochs * p.tokens AS rest, md5('{SEED}:' || p.epochs::VARCHAR || ':' || coalesce(d.doc_id::VARCHAR, '') || ':' || md5(coalesce(d.text, ''))) AS key FROM docs d JOIN plans p
  ON d.domain IS NOT DISTINCT FROM p.domain AND d.lang IS NOT DISTINCT FROM p.lang AND d.source IS NOT DISTINCT FROM p.source
), ordered AS (
  SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed
)
SELECT doc_id, domain, lang, source, unnest(range(epochs))::BIGINT AS epoch, n_tokens FROM placed
UNION ALL SELECT doc_id, domain, lang, source, epochs::BIGINT, n_tokens FROM ordered WHERE rest > 0 AND before < rest
"""


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.texts(pages, html_extract.fit(pages)).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), size=4, similarity=(85, 100))


OP6_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' ')) END) AS s FROM docs
), flat AS (SELECT doc_id, len(s) AS n, unnest(list_transform(s, lambda x: hash(x))) AS g FROM sets),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS k FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs WHERE 100 * k >= 85 * (n + m - k)),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM sets JOIN least ON x = doc_id
"""


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.summary(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))  # a null doc_id has no label to hold out
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def op10_token_tables(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None, end_id: int = 2) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    uri = shared_dir(spark, "token-tables")
    return token_tables.read(spark, uri, token_tables.write(table(spark, sf_dir, "documents"), uri, tokenizer_path, end_id, by_word=True))



RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.apply(table(spark, sf_dir, "pages").select("page_id", "url"), RULES).select("page_id", "host", "path", "rule", "verdict")


_VALUES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
OP9_SQL = rf"""
WITH rests AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
rules(verdict, host, path) AS (VALUES {_VALUES}),
fits AS (
  SELECT p.page_id, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.host || r.path) DESC) AS k
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.k = 1
"""


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = rope.transform(table(spark, sf_dir, "documents").select("doc_id", "text"), rope.Settings(seed=7, rate=100, spm=50))
    return rope.restore(made).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("fim_text", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"))


OP11_SQL = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), ranked AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain' WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM hashed
), parts AS (
  SELECT doc_id, n, form, text, coalesce(array_to_string(u[1 : least(x, y)], ''), '') AS p, coalesce(array_to_string(u[least(x, y) + 1 : greatest(x, y)], ''), '') AS m, coalesce(array_to_string(u[greatest(x, y) + 1 :], ''), '') AS s FROM ranked
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM parts
"""


SHARDS = 40


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), SHARDS, shared_dir(spark, "shard-map"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


#: CRC-32 byte by byte with a table made by its rule (the polynomial is a fixed value); the map by a fold over the slots, a list of loads with the shards chosen so far behind it.
OP12_SQL = f"""
WITH crc_table AS (SELECT list(list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, b) ORDER BY b) AS steps FROM (SELECT unnest(range(256)) AS b)),
hexed AS (SELECT *, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes FROM documents),
records AS (
  SELECT doc_id, (strlen(coalesce(text, '')) + {sharding.RECORD_BYTES})::BIGINT AS size, xor(coalesce(list_reduce(bytes, lambda v, x: xor(steps[(xor(v, x) & 255) + 1], v >> 8), 4294967295::BIGINT), 4294967295), 4294967295) AS text_crc32,
    md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS digest FROM hexed, crc_table
), placed AS (SELECT *, (('0x' || digest[1:8])::BIGINT % {sharding.SLOTS})::INTEGER AS virtual_slot FROM records),
slots AS (SELECT s.virtual_slot, coalesce(sum(size), 0)::BIGINT AS bytes, count(p.size) AS rows FROM (SELECT unnest(range({sharding.SLOTS}))::INTEGER AS virtual_slot) s LEFT JOIN placed p USING (virtual_slot) GROUP BY 1),
folded AS (
  SELECT list_reduce(list([bytes, virtual_slot] ORDER BY bytes DESC, virtual_slot DESC), lambda a, x: list_concat(
    list_transform(a[1:{SHARDS}], lambda v, i: v + CASE WHEN i = list_position(a[1:{SHARDS}], list_min(a[1:{SHARDS}])) THEN x[1] + 1 ELSE 0 END), a[{SHARDS + 1}:], [list_position(a[1:{SHARDS}], list_min(a[1:{SHARDS}]))::BIGINT - 1]), list_transform(range({SHARDS}), lambda i: 0::BIGINT)) AS fold,
    list(virtual_slot ORDER BY bytes DESC, virtual_slot DESC) AS slot_list FROM slots
), chosen AS (SELECT unnest(slot_list) AS virtual_slot, unnest(fold[{SHARDS + 1}:])::INTEGER AS shard FROM folded)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY virtual_slot, digest, doc_id NULLS FIRST) - 1 AS slot, NULL::INTEGER AS grown_shard, virtual_slot FROM placed JOIN chosen USING (virtual_slot)
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label, positives=5, k=5, low=80)


OP13_SQL = """
WITH fit AS (
  SELECT vec_id::BIGINT AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR abs(x) > 262144)) = 0
), rows AS (SELECT * FROM fit WHERE len(v) = (SELECT mode(len(v)) FROM fit) QUALIFY row_number() OVER (PARTITION BY id ORDER BY label, v) = 1),
scored AS (
  SELECT a.id AS anchor_id, r.id AS id, a.label = r.label AS same, list_sum(list_transform(range(1, len(r.v) + 1), lambda i: a.v[i] * r.v[i]))::BIGINT AS score FROM rows a JOIN rows r ON a.id % 100 = 0 AND a.id <> r.id
), positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) QUALIFY row_number() OVER w <= 5
"""

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_nearest": op2_nearest,
    "op3_mixing": op3_mixing,
    "op4_html_extract": op4_html_extract,
    "op5_decontaminate": op5_decontaminate,
    "op6_ngram_join": op6_ngram_join,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_url_filter": op9_url_filter,
    "op10_token_tables": op10_token_tables,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_sharding": op12_sharding,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLE_SQL = {"op1_line_dedup": OP1_SQL, "op2_nearest": OP2_SQL, "op3_mixing": OP3_SQL, "op6_ngram_join": OP6_SQL, "op9_url_filter": OP9_SQL, "op11_fill_in_middle": OP11_SQL, "op12_sharding": OP12_SQL, "op13_hard_negatives": OP13_SQL}
