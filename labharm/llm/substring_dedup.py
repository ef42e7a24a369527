"""Substring dedup: passages of min_words words or more that stand in several texts, word for word.

A window is min_words words in a row. A passage is a run of windows each of which stands, whole, in another text too. Each window stays in the
text with the smallest doc_id that holds it (of texts with one doc_id, that with the smallest hash) and goes from the others. Of equal texts the
one with the smallest doc_id stays, the others go whole. Words are what white space leaves; how much white space stands between them doesn't matter.

Method: content-defined chunking. A gear rolling hash runs over each text's words, and a chunk begins at each word whose hash is the smallest of
some stretch of `reach` words, so that a chunk has as many words at most and its ends depend on nearby words alone: an insertion moves no boundary
beyond them. Every chunk is deduplicated by its digest; those of a single text are dropped by an aggregation. A window of min_words words holds, for
certain, a chunk that any other text with that window has too. So only windows all of whose such chunks repeat are compared, by hashes of their own, where
their first such chunk's digest brings them together: no passage is missed, wherever it begins and ends, and chunks of different texts side by side make none.

Hot chunks: digests of more than HOT chunks, MOST_HOT of them at most whatever the input, are known to every task and dealt over SALTS tasks each.
Windows are gathered by chunk up to GROUP rows (some 10 MB); where there may be more, they are aggregated before the shuffle, equal stretches of them at once.

Null and empty texts, and texts of fewer than min_words words, have no windows; equal ones of those stay. Repeated rows (one doc_id, one text) are one
document; different texts of one doc_id are different documents, those of a null doc_id too, after all others. Chunks, windows and texts are compared
by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from labharm.llm.common import cut, hashes, mix, steps, words
from labharm.llm.decontaminate import grams

#: Words that the rolling hash sees: each moves the hash up by 64 / GEAR_WORDS bits.
GEAR_WORDS = 4
#: Stands for a null doc_id.
NO_ID = 2**63 - 1
#: Chunks of one digest from which it is hot, most hot digests, and the tasks over which each is dealt.
HOT, MOST_HOT, SALTS = 4096, 100_000, 64
#: Most rows of windows that one chunk gathers in a task.
GROUP = 65_536
WORD = regex.compile(r"[^\x20\x09-\x0D]+")


def reach_of(min_words: int) -> int:
    """The longest chunk for which any window of min_words words holds a whole chunk whose two ends its own words decide (see `candidates`)."""
    return max(1, (min_words - 1) // 4)


def boundaries(begin: np.ndarray, word: np.ndarray, reach: int) -> np.ndarray:
    """The words at which chunks begin: the starts of texts, and words whose rolling hash is the least (the leftmost of equal ones) in some stretch of reach words."""
    at = np.arange(len(word)) - np.repeat(begin[:-1], np.diff(begin))
    left = np.repeat(begin[1:], np.diff(begin)) - np.arange(len(word))
    gear = mix(word + np.uint64(1))
    rolled = gear.copy()
    for k in range(1, min(GEAR_WORDS, len(word))):
        rolled[k:] += np.where(at[k:] >= k, gear[:-k], np.uint64(0)) << np.uint64(64 // GEAR_WORDS * k)
    # how far each word is from one before it that is as small, and from one after it that is smaller, or from the text's ends
    back, ahead = np.full(len(word), reach), np.full(len(word), reach)
    for k in range(reach - 1, 0, -1):
        back[at < k] = k
        ahead[left <= k] = k
        if k < len(word):
            back[k:][rolled[:-k] <= rolled[k:]] = k
            ahead[:-k][rolled[k:] < rolled[:-k]] = k
    return np.flatnonzero((back + ahead > reach) | (at == 0))


def chunk(begin: np.ndarray, word: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the texts' chunks begin, and their digests."""
    starts = boundaries(begin, word, reach)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    inside = np.arange(len(word)) - np.repeat(starts, np.diff(np.append(starts, len(word))))
    power = np.cumprod(np.full(int(inside.max()) + 1, 0x9E3779B97F4A7C15, np.uint64))
    return starts, mix(np.add.reduceat(word * power[inside], starts))


def long_texts(texts: pa.Array, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows with min_words words or more, where each one's words begin, and the words as hashes."""
    begin, code, vocabulary = words(texts, lower=False)
    count = np.diff(begin)
    rows = np.flatnonzero(count >= min_words)
    word = hashes(vocabulary)[code[np.repeat(count >= min_words, count)]]
    return rows, np.concatenate([[0], np.cumsum(count[rows])]), word


def split(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """key, text -> digest, key, k of each chunk; k counts a text's chunks from 0."""
    for batch in batches:
        for a, z in steps(batch.column(1)):
            rows, begin, word = long_texts(batch.column(1)[a:z], min_words)
            starts, digest = chunk(begin, word, reach_of(min_words))
            text = np.searchsorted(begin, starts, side="right") - 1
            k = np.arange(len(starts)) - np.searchsorted(starts, begin[:-1])[text]
            yield pa.RecordBatch.from_arrays([pa.array(digest.view(np.int64)), batch.column(0)[a:z].take(pa.array(rows[text])), pa.array(k.astype(np.int32))], names=["digest", "key", "k"])


def candidates(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """doc, key, text, marks (k and n of the chunks that repeat) -> digest, n, doc, key, at, windows: windows side by side whose chunks all repeat.

    Of a window that begins at word p, the words decide whether a chunk begins at word x if all stretches with x and their rolling hashes
    lie inside: from p + reach + GEAR_WORDS - 2 (the first word with whole stretches before it) to p + min_words - reach. Any reach of these words have
    a boundary, so there are two at least: the first of them begins the chunk that stands for the window.
    """
    reach = reach_of(min_words)
    lead = reach + GEAR_WORDS - 2
    for batch in batches:
        for a, z in steps(batch.column(2)):
            marks = batch.column(3)[a:z]
            rows, begin, word = long_texts(batch.column(2)[a:z], min_words)
            if not len(rows):
                continue
            starts, digest = chunk(begin, word, reach)
            base = np.zeros(z - a, np.int64)
            base[rows] = np.searchsorted(starts, begin[:-1])
            flat = marks.flatten()
            times = np.zeros(len(starts), np.int64)
            times[np.repeat(base, np.diff(marks.offsets.to_numpy())) + flat.field("k").to_numpy()] = flat.field("n").to_numpy()
            single = np.concatenate([[0], np.cumsum(times == 0)])
            p, window = grams(begin, word, min_words)
            first, last = np.searchsorted(starts, p + lead), np.searchsorted(starts, p + min_words - reach, side="right") - 1
            alone = last <= first  # only where min_words is too few for two boundaries: the window stands for itself
            first = np.minimum(first, len(starts) - 1)
            fits = (single[np.maximum(last, first)] == single[first]) | alone
            p, first, alone, window = p[fits], first[fits], alone[fits], window[fits]
            if not len(p):
                continue
            text = np.searchsorted(begin, p, side="right") - 1
            meeting = np.where(alone, window, digest[first])
            turn = np.flatnonzero(np.concatenate([[True], (np.diff(p) > 1) | (meeting[1:] != meeting[:-1]) | (first[1:] != first[:-1]) | (text[1:] != text[:-1])]))
            row = pa.array(a + rows[text[turn]])
            columns = {
                "digest": pa.array(meeting[turn].view(np.int64)), "n": pa.array(np.where(alone, 0, times[first])[turn]), "doc": batch.column(0).take(row), "key": batch.column(1).take(row),
                "at": pa.array((p - begin[text])[turn].astype(np.int32)), "windows": pa.ListArray.from_arrays(pa.array(np.append(turn, len(p)).astype(np.int32)), pa.array(window.view(np.int64))),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """digest, doc, key, at, windows, sorted by digest -> doc, key, a, z, first_doc, first_key: windows a to z that other texts hold, first that one."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([x for x in (rest, batch) if x is not None]).combine_chunks()
        digest = table.column(0).to_numpy()
        ends = int(np.searchsorted(digest, digest[-1])) if len(digest) else 0  # the last digest's rows may go on
        if ends:
            yield held(table.slice(0, ends))
        rest = table.slice(ends).to_batches()[0] if table.num_rows > ends else None
    if rest is not None:
        yield held(pa.Table.from_batches([rest]))


def held(table: pa.Table) -> pa.RecordBatch:
    doc, key, at = (table.column(k).to_numpy() for k in (1, 2, 3))
    windows = table.column(4).combine_chunks()
    sizes = np.diff(windows.offsets.to_numpy())
    window, row = windows.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
    place = at[row] + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    order = np.lexsort((key[row], doc[row], window))
    w, r = window[order], row[order]
    starts = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
    ends = np.append(starts[1:], len(w)) - 1
    several = (key[r[starts]] != key[r[ends]]) | (doc[r[starts]] != doc[r[ends]])
    first = np.empty(len(w), np.int64)
    first[order] = np.repeat(np.where(several, r[starts], -1), ends - starts + 1)
    kept = np.flatnonzero(first >= 0)
    row, place, first = row[kept], place[kept], first[kept]
    joined = (row[1:] == row[:-1]) & (place[1:] == place[:-1] + 1) & (doc[first[1:]] == doc[first[:-1]]) & (key[first[1:]] == key[first[:-1]])
    a = np.flatnonzero(np.concatenate([[True], ~joined])) if len(row) else np.zeros(0, np.int64)
    z = np.append(a[1:], len(row)) - 1 if len(a) else a
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[row[a]], key[row[a]], place[a].astype(np.int32), place[z].astype(np.int32), doc[first[a]], key[first[a]])], names=["doc", "key", "a", "z", "first_doc", "first_key"])


def text_key() -> Column:
    return F.xxhash64("text")


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.filter("text is not null").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), text_key().alias("key"), "text")


def marked(rows: DataFrame, min_words: int) -> DataFrame:
    """key, marks of texts with chunks that other texts have: the chunks' numbers and how many there are of each in all."""
    chunks = rows.select("key", "text").mapInArrow(lambda it: split(it, min_words), "digest long, key long, k int")
    repeated = chunks.groupBy("digest").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n")).filter("low <> high").select("digest", "n")
    repeated = cut(repeated, "substring-repeated")
    limit = max(HOT, (repeated.agg(F.sum("n")).first()[0] or 0) // MOST_HOT)
    hot = F.broadcast(repeated.filter(F.col("n") > limit).select("digest", F.lit(True).alias("hot")))  # MOST_HOT at most
    dealt = chunks.join(hot, "digest", "left").withColumn("salt", F.when(F.col("hot"), F.pmod("key", F.lit(SALTS))).otherwise(0))
    wide = repeated.withColumn("salt", F.explode(F.when(F.col("n") > limit, F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")).otherwise(F.array(F.lit(0).cast("bigint")))))
    met = dealt.join(wide.hint("merge"), ["digest", "salt"]).groupBy("key", "k").agg(F.max("n").alias("n"))
    return met.groupBy("key").agg(F.collect_list(F.struct("k", "n")).alias("marks"))


def stretches(rows: DataFrame, holders: DataFrame, min_words: int) -> DataFrame:
    """doc, key, a, z, first_doc, first_key: the windows a to z of each text that other texts hold too, and which one holds them first."""
    first = marked(rows, min_words).join(holders.select("key", "doc"), "key")
    once = rows.groupBy("doc", "key").agg(F.first("text").alias("text"))
    near = once.join(first.hint("merge"), ["doc", "key"]).select("doc", "key", "text", "marks")
    windows = cut(near.mapInArrow(lambda it: candidates(it, min_words), "digest long, n long, doc long, key long, at int, windows array<long>"), "substring-windows")
    cold = windows.filter(F.col("n") <= GROUP).drop("n").repartition("digest").sortWithinPartitions("digest")
    cold = cold.mapInArrow(meet, "doc long, key long, a int, z int, first_doc long, first_key long")
    # of hot chunks, many rows have equal stretches of windows: one of each is compared, and the rest learn from it
    rows = windows.filter(F.col("n") > GROUP).withColumn("stretch", F.xxhash64("windows"))
    owner = F.struct("doc", "key")
    unlike = rows.groupBy("stretch").agg(F.min(owner).alias("low"), F.max(owner).alias("high"), F.first("windows").alias("windows"))
    each = unlike.select("stretch", "low", "high", F.posexplode("windows").alias("i", "window"))
    firsts = each.groupBy("window").agg(F.min("low").alias("first"), F.max("high").alias("last")).filter("first <> last").select("window", "first")
    known = each.join(firsts, "window").groupBy("stretch").agg(F.collect_list(F.struct("i", "first")).alias("firsts"))
    hot = rows.select("doc", "key", "at", "stretch").join(known, "stretch").select("doc", "key", "at", F.inline("firsts"))
    hot = hot.select("doc", "key", (F.col("at") + F.col("i")).alias("a"), (F.col("at") + F.col("i")).alias("z"), F.col("first.doc").alias("first_doc"), F.col("first.key").alias("first_key"))
    return cold.union(hot)


def repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """doc_id, key (the text's hash), passages, removed (arrays of begin and end, in words), first_doc: a row for each text with passages that others have too.

    passages are the text's runs of repeated windows; removed, the words that go from it; first_doc, the smallest document that keeps any of those, null if none goes.
    """
    rows = texts_of(docs)
    holders = rows.groupBy("key").agg(F.min("doc").alias("doc"), F.max("doc").alias("last"), F.max(F.regexp_count("text", F.lit(WORD.pattern))).alias("n"))
    by = W.partitionBy("key").orderBy("a")
    before = by.rowsBetween(W.unboundedPreceding, -1)
    found = stretches(rows, holders, min_words).withColumn("away", (F.col("first_doc") != F.col("doc")) | (F.col("first_key") != F.col("key")))
    found = found.withColumn("fresh", F.col("a") > F.coalesce(F.max("z").over(before), F.lit(-2)) + 1)
    found = found.withColumn("apart", F.col("away") & (F.col("a") > F.coalesce(F.max(F.when(F.col("away"), F.col("z") + min_words)).over(before), F.lit(-1))))
    found = found.withColumns({"run": F.count_if("fresh").over(by), "span": F.count_if("apart").over(by)})
    place = F.struct(F.min("a").alias("begin"), (F.max("z") + min_words).alias("end")).alias("place")
    runs = found.groupBy("key", "run").agg(place, F.min("doc").alias("doc")).groupBy("key").agg(F.min("doc").alias("doc"), F.sort_array(F.collect_list("place")).alias("passages"))
    spans = found.filter("away").groupBy("key", "span").agg(place, F.min("first_doc").alias("first_doc"))
    spans = spans.groupBy("key").agg(F.sort_array(F.collect_list("place")).alias("removed"), F.min("first_doc").alias("first_doc"))
    own = runs.join(spans, "key", "left").withColumn("removed", F.coalesce("removed", F.array().cast("array<struct<begin:int,end:int>>")))
    # equal texts of several documents: all windows repeat, and all go from the documents after the first
    copied = holders.filter((F.col("doc") != F.col("last")) & (F.col("n") >= min_words)).select("key", F.col("doc").alias("keeper"), F.array(F.struct(F.lit(0).alias("begin"), F.col("n").cast("int").alias("end"))).alias("whole"))
    own = own.join(copied, "key", "full")
    own = own.select("key", F.coalesce("doc", "keeper").alias("doc"), F.coalesce("whole", "passages").alias("passages"), F.coalesce("removed", F.array().cast("array<struct<begin:int,end:int>>")).alias("removed"), "first_doc", "keeper", "whole")
    copies = rows.select("doc", "key").distinct().join(own.filter("whole is not null").drop("doc"), "key").filter("doc <> keeper")
    copies = copies.select("key", "doc", "passages", F.col("whole").alias("removed"), F.least("first_doc", "keeper").alias("first_doc"))
    out = own.select("key", "doc", "passages", "removed", "first_doc").union(copies)
    null = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return out.select(null("doc").alias("doc_id"), "key", "passages", "removed", null("first_doc").alias("first_doc"))


def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes the words of the spans in the last column out of the text in the one before."""
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            if spans:
                at = [m.span() for m in WORD.finditer(text)]
                ends = [0, *(at[s["end"] - 1][1] for s in spans)]
                text = "".join(text[a:z] for a, z in zip(ends, [*(at[s["begin"]][0] for s in spans), len(text)]))
            texts.append(text)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(texts, pa.string())], names=batch.schema.names[:-1])


def dedup(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """docs with each repeated passage only where it stands first."""
    gone = repeats(docs, min_words).filter(F.size("removed") > 0).select(F.col("doc_id").alias("__doc"), F.col("key").alias("__key"), F.col("removed").alias("__spans"))
    columns = [c for c in docs.columns if c != "text"]
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (text_key() == F.col("__key"))
    joined = docs.join(gone, same, "left").select(*columns, "text", "__spans")
    schema = docs.select(*columns, "text").schema
    return joined.mapInArrow(without, schema).select(*docs.columns)


def summary(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """A row for each document with repeated passages: how many, how many spans of words go, the longest passage's words, all words that go, and the smallest document that keeps some of these."""
    size = lambda x: x["end"] - x["begin"]
    found = repeats(docs, min_words).withColumns({"longest": F.array_max(F.transform("passages", size)), "gone": F.aggregate(F.transform("removed", size), F.lit(0), lambda a, b: a + b)})
    return found.groupBy("doc_id").agg(
        F.sum(F.size("passages")).alias("n_passages"), F.sum(F.size("removed")).alias("n_removed"), F.max("longest").cast("long").alias("longest_words"), F.sum("gone").cast("long").alias("removed_words"), F.min("first_doc").alias("first_doc")
    )
