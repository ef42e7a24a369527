"""Toxicity: passages whose words speak for the toxic class.

Learning. From labelled documents (SAMPLE at most, the ones with the smallest hash of doc_id) three quarters give the
units' log-odds: a unit is a word or the first four to seven characters of words; its log-odds between
the classes have an informative Dirichlet prior, which is its share in both classes together; units with too small a z-score or log-odds
are left out. The last quarter calibrates.

Scoring. A text is a sequence of its words' log-odds (those of its most specific unit; without any: -DRIFT). One linear scan finds all maximal scoring segments
(those that no extension or cut improves). Segment scores of text without toxic passages follow an extreme-value
distribution whose location grows with the logarithm of the text's words; its parameters come from the calibration
quarter's class 0. A segment with a small enough p-value is a passage. The sum of a text's best segments, as standard extreme values, is compared with
what such sums reach by chance, and that goes through a logistic function fitted on the calibration quarter.

SAMPLE bounds the labelled rows that are learned from, thus the units too; every text is scored, by all its segments.

Null and empty texts have no passage and get the score of an empty text. Labels other than 0 and 1 are ignored, a document labelled both
ways counts for both. Without labels of both classes every score is 0. Repeated rows are scored each.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labharm.llm.common import cut, steps, words
from labharm.llm.decontaminate import strip

SAMPLE = 40_000
#: Strength of the prior as a share of the documents; least z-score, log-odds and documents of a unit.
PRIOR, LEAST_Z, LEAST_ODDS, LEAST_DOCS = 0.05, 3.0, 1.0, 4
#: What a word without a unit takes away, and the p-value of a passage.
DRIFT, SIGNIFICANT = 1.0, 0.01


def units(word: str) -> list[str]:
    """From the most to the least specific: the word and its beginnings."""
    w = strip(word)
    return [w, *(f"{w[:n]}*" for n in range(7, 3, -1) if len(w) > n)] if w else []


def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text, toxic -> unit, documents of either class that hold it ('' : all documents)."""
    for batch in batches:
        for a, z in steps(batch.column(0)):
            begin, code, vocabulary = words(batch.column(0)[a:z])
            known = [units(w) for w in vocabulary.to_pylist()]
            tally: tuple[Counter, Counter] = Counter(), Counter()
            for i, toxic in enumerate(batch.column(1)[a:z].to_pylist()):
                tally[toxic].update({u for c in set(code[begin[i] : begin[i + 1]].tolist()) for u in known[c]})
                tally[toxic][""] += 1
            found = list(tally[0] | tally[1])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *(pa.array([t[u] for u in found], pa.int64()) for t in tally)], names=["unit", "n0", "n1"])


def segments(values: list[float], places: list[int]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, begin, end) of a sequence; values are its scores by place, other places have -DRIFT.

    Ruzzo and Tompa's scan: candidates are kept with the running sums at either end, so that a new one finds whom to join.
    """
    out: list[tuple[float, float, int, int]] = []  # sum before, sum after, begin, end
    total, last = 0.0, 0
    for value, place in zip(values, places):
        total -= DRIFT * (place - last)
        last = place + 1
        if value <= 0:
            total += value
            continue
        low, total = total, total + value
        begin = place
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][0] >= low:
                j -= 1
            if j < 0 or out[j][1] >= total:
                break
            low, begin = out[j][0], out[j][2]
            del out[j:]
        out.append((low, total, begin, place + 1))
    return [(z - a, b, e) for a, z, b, e in out]


class Model:
    """weights: log-odds by unit."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.location, self.scale, self.a, self.b = 0.0, 1.0, 0.0, -math.inf

    def weigh(self, word: str) -> float | None:
        return next((self.weights[u] for u in units(word) if u in self.weights), None)

    def texts(self, texts: pa.Array) -> Iterator[tuple[int, list[tuple[float, int, int]]]]:
        """Words and segments of each text."""
        begin, code, vocabulary = words(texts)
        weight = np.fromiter((math.nan if (w := self.weigh(x)) is None else w for x in vocabulary.to_pylist()), float, len(vocabulary))[code]
        known = ~np.isnan(weight)
        where = np.flatnonzero(known)
        cuts = np.searchsorted(where, begin)
        for i in range(len(begin) - 1):
            at = where[cuts[i] : cuts[i + 1]]
            values = weight[at]
            yield int(begin[i + 1] - begin[i]), segments(values.tolist(), (at - begin[i]).tolist()) if (values > 0).any() else []

    def place(self, n: int, score: float) -> float:
        """A segment's score as a standard extreme value."""
        return (score - math.log1p(n) - self.location) / self.scale

    def chance(self, n: int, score: float) -> float:
        return -math.expm1(-math.exp(-self.place(n, score))) if score > 0 else 1.0

    def feature(self, n: int, found: list[tuple[float, int, int]]) -> float:
        """How far the best segments together surpass chance: the largest, over r, of -ln P(r best extreme values sum to so much)."""
        if not found:
            return -5.0
        best = np.sort(np.array([s for s, _, _ in found]))[::-1]
        total = np.cumsum((best - math.log1p(n) - self.location) / self.scale)
        r = np.arange(1, len(best) + 1)
        factorial = np.cumsum(np.log(r))  # of r, thus 2 ln r! - ln r for those of r and r - 1
        some = np.maximum(total, 1e-9)
        mass = np.where(total > r, total - (r - 1) * np.log(some) + 2 * factorial - np.log(r), total)
        return float(np.clip(mass.max(), -5.0, 200.0)) if (total > 0).any() else -5.0

    def score(self, n: int, found: list[tuple[float, int, int]]) -> float:
        if self.b == -math.inf:
            return 0.0
        return 1 / (1 + math.exp(-x)) if (x := max(-700.0, self.a * self.feature(n, found) + self.b)) < 700 else 1.0

    def fit_extremes(self, n: np.ndarray, best: np.ndarray) -> None:
        """Fits the extreme-value distribution to the best segments of texts of class 0 by their median and ninth decile."""
        half, most = np.quantile(best - np.log1p(n), [0.5, 0.9])
        self.scale = max(0.1, float(most - half) / (math.log(math.log(2)) - math.log(-math.log(0.9))))
        self.location = float(half) + self.scale * math.log(math.log(2))

    def fit_scores(self, x: np.ndarray, toxic: np.ndarray) -> None:
        """Fits the logistic function of the feature by Newton steps."""
        y = toxic.astype(float)
        middle, wide = x.mean(), max(1e-6, x.std())
        d = np.stack([(x - middle) / wide, np.ones(len(x))], axis=1)
        beta = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(d @ beta, -30, 30)))
            step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + np.diag([1e-2, 1e-6]), d.T @ (y - p) - np.array([1e-2, 0]) * beta)
            beta += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        self.a, self.b = beta[0] / wide, beta[1] - beta[0] * middle / wide


def measure(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """text, toxic -> words, best segment's score, feature, toxic."""
    for batch in batches:
        for a, z in steps(batch.column(0)):
            got = [(n, max((s for s, _, _ in found), default=0.0), model.value.feature(n, found)) for n, found in model.value.texts(batch.column(0)[a:z])]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*got), (pa.int64(), pa.float64(), pa.float64()))), batch.column(1)[a:z]], names=["n", "best", "feature", "toxic"])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from docs (doc_id, text) and labels (doc_id, toxic): SAMPLE labels at most, and of each one's documents, if several have its doc_id, the one whose text has the least hash."""
    spark = docs.sparkSession
    chosen = labels.filter("toxic in (0, 1) and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic")).withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id", "toxic").limit(SAMPLE)
    one = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("t"), "text")).alias("least"))
    known = cut(one.select("doc_id", "least.text").join(F.broadcast(chosen), "doc_id"), "toxicity-sample")
    part = F.pmod(F.xxhash64(F.col("h")), F.lit(4))
    tally = known.filter(part > 0).select("text", "toxic").mapInArrow(count, "unit string, n0 long, n1 long").groupBy("unit").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    total = tally.filter("unit = ''").first()
    if total is None or not total.n0 or not total.n1:
        return Model({})
    prior = PRIOR * (total.n0 + total.n1)
    share = (F.col("n0") + F.col("n1")) * PRIOR
    odds = lambda n, all_: F.log((F.col(n) + share) / (F.lit(all_ + prior) - F.col(n) - share))
    scored = tally.filter(f"unit <> '' and n0 + n1 >= {LEAST_DOCS} and n0 + n1 < {total.n0 + total.n1}").select("unit", (odds("n1", total.n1) - odds("n0", total.n0)).alias("w"), F.sqrt(1 / (F.col("n1") + share) + 1 / (F.col("n0") + share)).alias("sd"))
    kept = scored.filter(F.abs(F.col("w")) >= F.greatest(F.lit(LEAST_ODDS), LEAST_Z * F.col("sd"))).collect()  # no more than the sample's texts hold
    model = Model({r.unit: r.w for r in kept})
    calibration = known.filter(part == 0).select("text", "toxic")

    def measured() -> tuple[np.ndarray, ...]:
        sent = spark.sparkContext.broadcast(model)
        rows = calibration.mapInArrow(lambda it: measure(it, sent), "n long, best double, feature double, toxic int").collect()
        return tuple(np.array([r[k] for r in rows]) for k in range(4))

    n, best, _, toxic = measured()
    if len(set(toxic.tolist())) < 2:
        return Model({})
    model.fit_extremes(n[toxic == 0], best[toxic == 0])
    model.fit_scores(*measured()[2:])
    return model


def rate(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    model = model.value
    for batch in batches:
        for a, z in steps(batch.column(1)):
            scores, spans = [], []
            for n, found in model.texts(batch.column(1)[a:z]):
                scores.append(model.score(n, found))
                spans.append([{"begin": b, "end": e, "score": s, "p_value": p} for s, b, e in found if (p := model.chance(n, s)) <= SIGNIFICANT])
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:z], pa.array(scores, pa.float64()), pa.array(spans, SPANS)], names=["doc_id", "score", "passages"])


SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("p_value", pa.float64())]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1), passages (their first word, the one after their last, score and p-value) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(lambda it: rate(it, sent), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, passages array<struct<begin:int,end:int,score:double,p_value:double>>")


def clean(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of docs whose text scores below threshold, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            low = [sent.value.score(n, found) < threshold for a, z in steps(batch.column(at)) for n, found in sent.value.texts(batch.column(at)[a:z])]
            yield batch.filter(pa.array(low, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
