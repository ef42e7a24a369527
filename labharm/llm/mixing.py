"""Mixing sources to target weights: a token budget is shared out in a tree of domains, languages and sources.

Budgets. The root's budget is a share of all tokens. A node's budget goes to its children by their weights. No child gets more than it can supply,
its tokens times max_epochs; what it can't take goes to its siblings, by their weights, again up to what those can supply. A node's
supply is its leaves' sum, so only what a whole subtree can't take reaches the siblings of an ancestor. Budgets are whole tokens, rounded down.

Selection. A leaf's documents come in epochs, each a permutation by md5(seed:epoch:doc_id:md5 of the text), so that rows of one doc_id, or of none, spread too. The leaf yields as many whole epochs as its budget
holds, and of the next one a prefix: the documents before which fewer tokens have come than the budget has left. The order is never made for a whole leaf:
token sums by the key's first digits tell which of these lie before the budget's end, which one holds it, and only that one is sorted.

Tokens are words [^\\x20\\x09-\\x0D]+; null and empty texts have none. Null domains, languages and sources are nodes of their own, of weight 1 like all
that have no weight given; weight 0 gets nothing. Leaves without tokens yield nothing. Repeated rows count each, and one is as
good as another. Columns named __key, __bucket, __epochs, __rest, __end, __left or __before can't be used. Of an empty table nothing is chosen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labharm.llm.common import cut, small

LEVELS = ("domain", "lang", "source")
#: Rows meant to share the first digits of their keys, and bytes up to which budgets are broadcast.
BUCKET_ROWS, BROADCAST_BYTES = 4096, 16 << 20


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def weight(level: str, weights: dict[str, dict[str, int]]) -> Column:
    out = F.lit(1)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("double")


def share_out(nodes: DataFrame, up: list[str], level: str) -> DataFrame:
    """nodes with given, what each gets of its parent's budget; columns up name the parent, budget is the parent's, supply and w the node's."""
    w, supply, budget = F.col("w"), F.col("supply"), F.col("budget")
    parent = W.partitionBy(*up) if up else W.partitionBy(F.lit(0))
    order = parent.orderBy(F.when(w > 0, supply / F.when(w > 0, w)).asc_nulls_last(), F.col(level).asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    rest = F.sum("w").over(parent) - F.coalesce(F.sum("w").over(order), F.lit(0.0))
    # children in order of supply by weight: the first that isn't used up sets the level for all that follow
    mark = F.when(rest > 0, (budget - F.coalesce(F.sum("supply").over(order), F.lit(0))) / F.when(rest > 0, rest)).otherwise(F.lit(0.0))
    nodes = nodes.withColumn("mark", mark).withColumn("full", supply <= w * F.col("mark"))
    line = F.max(F.when(~F.col("full"), F.col("mark"))).over(parent)
    return nodes.withColumn("given", F.when(F.col("full"), supply).otherwise(F.least(supply, F.floor(w * F.greatest(F.lit(0.0), line))))).drop("mark", "full")


def joined(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str], how: str = "inner") -> DataFrame:
    """left with columns of right, null keys being equal."""
    right = right.select(*(F.col(c).alias(f"__of_{c}") for c in keys), *columns)
    at = F.lit(True)
    for c in keys:
        at = at & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    return left.join(small(right, BROADCAST_BYTES), at, how).drop(*(f"__of_{c}" for c in keys))


def plan(leaves: DataFrame, weights: dict[str, dict[str, int]], budget_share: float, max_epochs: int) -> DataFrame:
    """domain, lang, source, tokens -> the same, budget, epochs (whole ones), rest (tokens of the next)."""
    budgets = None
    for i, level in enumerate(LEVELS):
        up, here = list(LEVELS[:i]), list(LEVELS[: i + 1])
        nodes = leaves.groupBy(*here).agg((F.sum("tokens") * max_epochs).alias("supply")).withColumn("w", weight(level, weights))
        if budgets is None:
            nodes = nodes.withColumn("budget", F.floor(F.lit(budget_share) * (F.sum("supply").over(W.partitionBy(F.lit(0))) / max_epochs)))
        else:
            nodes = joined(nodes, budgets, up, ["budget"])
        budgets = cut(share_out(nodes, up, level).select(*here, F.col("given").alias("budget")), "mixing-budgets")
    out = joined(leaves, budgets, list(LEVELS), ["budget"])
    return out.withColumn("epochs", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.greatest("tokens", F.lit(1)))).otherwise(0).cast("long")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))


def mix(docs: DataFrame, domain: Column, weights: dict[str, dict[str, int]], budget_share: float, max_epochs: int = 2, seed: int = 0) -> DataFrame:
    """docs (doc_id, text, lang, source, ...) as chosen, a row for each epoch of a document; further columns: domain, epoch (from 0), n_tokens."""
    columns = [c for c in docs.columns if c not in ("domain", "epoch", "n_tokens")]
    if clash := {"__key", "__bucket", "__epochs", "__rest", "__end", "__left", "__before"} & set(columns):
        raise ValueError(f"columns that mixing uses itself: {sorted(clash)}")
    docs = docs.withColumns({"domain": domain, "n_tokens": tokens(F.col("text"))}).select(*columns, "domain", "n_tokens")
    leaves = cut(docs.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")), "mixing-leaves")
    most = leaves.agg(F.max("rows")).first()[0] or 1
    digits = max(1, min(8, math.ceil(math.log(max(1, most / BUCKET_ROWS), 16))))
    made = plan(leaves, weights, budget_share, max_epochs).filter("budget > 0").select(*LEVELS, F.col("epochs").alias("__epochs"), F.col("rest").alias("__rest"))
    made = cut(made, "mixing-plan")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("__epochs").cast("string"), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))
    rows = joined(docs, made, list(LEVELS), ["__epochs", "__rest"]).withColumn("__key", key).withColumn("__bucket", F.substring("__key", 1, digits))
    # the bucket that holds the end of each leaf's prefix, and what is left there
    sums = rows.filter("__rest > 0").groupBy(*LEVELS, "__rest", "__bucket").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy(*LEVELS).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ends = sums.withColumn("before", before).filter("before < __rest and before + n >= __rest").select(*LEVELS, F.col("__bucket").alias("__end"), (F.col("__rest") - F.col("before")).alias("__left"))
    placed = joined(rows, cut(ends, "mixing-ends"), list(LEVELS), ["__end", "__left"], "left")
    whole = placed.filter("__epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__epochs") - 1)))
    part = placed.filter("__rest > 0").withColumn("epoch", F.col("__epochs"))
    inside = part.filter("__bucket < __end")
    last = part.filter("__bucket = __end")
    order = W.partitionBy(*LEVELS).orderBy("__key").rowsBetween(W.unboundedPreceding, -1)
    last = last.withColumn("__before", F.coalesce(F.sum("n_tokens").over(order), F.lit(0))).filter("__before < __left")
    out = [*columns, "domain", "epoch", "n_tokens"]
    return whole.select(*out).union(inside.select(*out)).union(last.select(*out))
