"""N-gram Jaccard join: documents whose shingle sets have a Jaccard similarity of at least a threshold.

Method: the universe of shingles is dealt into segments by a hash. Two sets that reach the threshold differ in at most
H elements, so among segments that can tolerate more than H differences together, one must agree: exactly, or, where
the allocation gives it a deletion, up to one element. Sets are grouped into bands of sizes; each band has its own H,
its own segments and its own allocation, chosen by cost (`allocate`). A set indexes itself in its own band and in those below
that hold sets it may be similar to. Candidates are verified on the sets themselves.

Hot groups: equal sets share one node; a signature bucket yields a star about the member that meets most
others, not all pairs. Where
a star's candidate turns out not to be similar and the two stay in different components, that bucket is open: the sketches (see
below) of the members left out meet each other's and the rest's in blocks inside tasks, and what they leave open across
components is verified. The rest are one component already. So no link between components is lost. Each band has some segments to spare (`spare`), so that a set may drop as many of its full
buckets: of the buckets that a similar pair shares, one more than those at least, the least full is dropped by neither.

Candidates first meet with sketches, counts of their shingles by hash bucket: the sum of the counts' differences is a
lower bound of the sets' difference. Only pairs within the bound have their sets compared.

Null or empty texts have no shingles and are linked with nothing. Texts with fewer words than a shingle count as one
shingle. Repeated rows are equal sets, thus linked. A null doc_id is never a component's id unless it is alone there.
Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from labharm.llm.common import cut, drop, hashes, mix, shingles, small, steps, words

#: Sizes of a band's sets lie within this factor.
BAND = 1.5
#: Members of a block of an open bucket.
BLOCK = 1000
#: Bands there are; the last holds sets of up to 10^10 elements.
BANDS = 57
#: Rows from which a bucket counts as full.
FULL = 8
#: Cost model: chance that a shingle of two unlike sets in one segment agrees, and what a false candidate costs in signatures.
AGREE, FALSE_COST = 0.2, 200.0
#: Bytes up to which a table of ids is broadcast.
BROADCAST_BYTES = 16 << 20


@lru_cache(maxsize=None)
def band_of(n: int) -> int:
    """Band b holds the sizes in (BAND^(b-1), BAND^b]."""
    b = max(0, math.ceil(math.log(n) / math.log(BAND)) - 1)
    while top(b) < n:
        b += 1
    return b


@lru_cache(maxsize=None)
def top(b: int) -> int:
    return math.floor(BAND**b) if b >= 0 else 0


@lru_cache(maxsize=None)
def meets(n: int, num: int, den: int) -> tuple[int, ...]:
    """The band of size n, and those below with sets that a set of size n can be similar to."""
    b = band_of(n)
    below = range(b - 1, -1, -1)
    return (b, *(c for c in below if n * num <= top(c) * den and top(c) > top(c - 1)))


def bound_of(b: int, num: int, den: int) -> int:
    """The most elements in which a similar pair can differ that meets in band b: its sizes are up to top(b) and top(b) * den / num."""
    return (den - num) * (top(b) + top(b) * den // num) // (den + num)


def spare(b: int, num: int, den: int) -> int:
    """Exact segments that band b has beyond those it needs."""
    return 4 + bound_of(b, num, den) // 8


@lru_cache(maxsize=None)
def allocate(b: int, num: int, den: int) -> tuple[int, int]:
    """(exact segments, segments with one-deletion neighbourhoods) of band b, by cost. Exact segments bear one difference, the others two."""
    u, bound = top(b), bound_of(b, num, den)
    best = None
    for deletions in range(0, (bound + 2) // 2 + 1):
        need = bound + 1 - 2 * deletions
        exact = need + spare(b, num, den) if need > 0 else 0
        if exact + deletions == 0:
            continue
        e = u / (exact + deletions)
        cost = exact + deletions * (1 + e) + FALSE_COST * (exact * AGREE**e + deletions * (1 + e) * AGREE ** max(0.0, e - 1))
        if best is None or cost < best[0]:
            best = cost, exact, deletions
    return best[1], best[2]


def distinct_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted."""
    begin, code, vocabulary = words(texts)
    got, made = shingles(begin, hashes(vocabulary)[code], size)
    at = np.concatenate([[0], np.cumsum(made)])
    return [np.unique(got[at[i] : at[i + 1]]) for i in range(len(made))]


def set_id(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63


def sketch(s: np.ndarray) -> bytes:
    """Counts of elements (up to 255) in a power of two of hash buckets, half the elements at least."""
    size = 256
    while 2 * size < len(s):
        size *= 2
    return np.minimum(np.bincount((s % np.uint64(size)).astype(np.int64), minlength=size), 255).astype(np.uint8).tobytes()


def apart_at_least(p: np.ndarray, q: np.ndarray) -> int:
    """A lower bound of the elements in which two sets differ, from their sketches."""
    size = min(len(p), len(q))
    p, q = (x.reshape(-1, size).sum(0, dtype=np.int64) for x in (p, q))
    return int(np.abs(p - q).sum())


def ids(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """doc_id, text -> doc_id, n, node, sketch."""
    for batch in batches:
        for a, z in steps(batch.column(1)):
            sets = distinct_sets(batch.column(1)[a:z], size)
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:z], pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary())], names=["doc_id", "n", "node", "sketch"])


def signatures(sets: list[np.ndarray], nodes: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, node) of sets, each in its own band and in those where it may meet smaller sets.

    A signature's lowest 8 bits hold its band. Bit 8 is set if its segment has a neighbourhood of deletions.
    """
    jobs = []  # (row, band)
    for row, s in enumerate(sets):
        n = len(s)
        if n:
            jobs += [(row, b) for b in meets(n, num, den)]
    if not jobs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    plans = [allocate(b, num, den) for _, b in jobs]
    exact, total = (np.array(x, np.int64) for x in zip(*((e, e + d) for e, d in plans)))
    sizes = np.array([len(sets[r]) for r, _ in jobs])
    base = np.concatenate([[0], np.cumsum(total)])
    job = np.repeat(np.arange(len(jobs)), sizes)
    h = np.concatenate([sets[r] for r, _ in jobs])
    bands = np.array([b for _, b in jobs], np.uint64)
    with np.errstate(over="ignore"):
        segment = (mix(h ^ (bands * np.uint64(0x9E3779B97F4A7C15))[job]) % total.astype(np.uint64)[job]).astype(np.int64)
        at, element = base[job] + segment, mix(h + np.uint64(7))
        sums = np.zeros(base[-1], np.uint64)
        np.add.at(sums, at, element)
        number = np.arange(base[-1]) - np.repeat(base[:-1], total)
        owner = np.repeat(np.arange(len(jobs)), total)
        salt = mix(bands[owner] * np.uint64(1 << 32) + number.astype(np.uint64) + np.uint64(1))
        deleting = number >= exact[owner]

        def sign(sums: np.ndarray, where: np.ndarray) -> np.ndarray:
            return (mix(sums ^ salt[where]) & ~np.uint64(0x1FF)) | (deleting[where].astype(np.uint64) << np.uint64(8)) | bands[owner[where]]

        less = np.flatnonzero(deleting[at])
        where = np.concatenate([np.arange(base[-1]), at[less]])
        sigs = sign(np.concatenate([sums, sums[at[less]] - element[less]]), where)
    return sigs.view(np.int64), nodes[np.array([r for r, _ in jobs])][owner[where]]


def index(batches: Iterator[pa.RecordBatch], size: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """text -> sig, node; equal sets of one batch index themselves once."""
    for batch in batches:
        seen: set[int] = set()
        for a, z in steps(batch.column(0)):
            fresh = {}
            for s in distinct_sets(batch.column(0)[a:z], size):
                node = set_id(s)
                if len(s) and node not in seen:
                    fresh[node] = s
                    seen.add(node)
            sigs, nodes = signatures(list(fresh.values()), np.fromiter(fresh, np.int64, len(fresh)), num, den)
            for i in range(0, len(sigs), 500_000):
                yield pa.RecordBatch.from_arrays([pa.array(sigs[i : i + 500_000]), pa.array(nodes[i : i + 500_000])], names=["sig", "node"])


def sets_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """text -> node, its set as bytes."""
    for batch in batches:
        for a, z in steps(batch.column(0)):
            sets = distinct_sets(batch.column(0)[a:z], size)
            yield pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "shingles"])


def maybe(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """a, b, sizes and sketches -> a, b, maybe: whether sizes and sketches leave it open that they are similar."""
    for batch in batches:
        out = []
        for n, m, x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5)):
            fits = num * max(n, m) <= den * min(n, m)
            out.append(fits and (den + num) * apart_at_least(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)) <= (den - num) * (n + m))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.bool_())], names=["a", "b", "maybe"])


def verify(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """a, b, both sets -> a, b, linked."""
    for batch in batches:
        linked = []
        for x, y in zip(batch.column(2), batch.column(3)):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True)) if num * max(len(p), len(q)) <= den * min(len(p), len(q)) else 0
            linked.append(den * both >= num * (len(p) + len(q) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, component (its smallest node) for all nodes of links (a, b): large and small stars in turn until neither changes a link."""
    edges = cut(links.select("a", "b").filter("a <> b").distinct(), name)
    last = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).filter("a <> b").distinct()
        large = cut(large, name)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a").select(F.col("b").alias("x"), "m").filter("x <> m")
        before, edges = edges, cut(moved.select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).union(low.select("a", F.col("m").alias("b"))).distinct(), name)
        drop(before)
        drop(large)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    return edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def buckets(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """sig, node, first, rows of the buckets that hold several nodes, less each set's spare fullest ones: first is the member that meets most others."""
    rows = docs.select("text").mapInArrow(lambda it: index(it, size, num, den), "sig long, node long").repartition("sig")
    # one shuffle serves both: which signatures hold several nodes, and a look-up that streams past them, without a sort of a full bucket
    held = rows.groupBy("sig").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("rows")).filter("low <> high").select("sig", "rows")
    several = cut(rows.join(held.hint("shuffle_hash"), "sig").distinct(), "ngram-several")
    full = several.filter((F.col("rows") > FULL) & (F.col("sig").bitwiseAND(256) == 0))
    band = F.col("sig").bitwiseAND(255)
    spares = F.element_at(F.array(*[F.lit(spare(b, num, den)) for b in range(BANDS)]), band.cast("int") + 1)
    order = W.partitionBy("node", band).orderBy(F.desc("rows"), "sig")
    dropped = full.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= spares).select("sig", "node")
    kept = cut(several.join(dropped, ["sig", "node"], "left_anti"), "ngram-kept")
    drop(several)
    # first the sets that meet most others: an original before its copies, each of which may differ too much from the next
    met = kept.groupBy("node").agg(F.sum("rows").alias("met"))
    best = kept.join(met, "node").groupBy("sig").agg(F.min(F.struct((-F.col("met")).alias("less"), "node"))["node"].alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    table = cut(kept.select("sig", "node").join(best, "sig"), "ngram-buckets")
    drop(kept)
    return table


def compare(node: np.ndarray, n: np.ndarray, component: np.ndarray, block: np.ndarray, i: int, j: int, sketches: list[bytes], num: int, den: int) -> list[tuple[int, int]]:
    """The pairs of a block of a bucket, or between two blocks of it, that sizes and sketches leave open and that are in different components."""
    least = min(map(len, sketches))
    counts = np.stack([np.frombuffer(x, np.uint8).reshape(-1, least).sum(0, dtype=np.int32) for x in sketches])
    rough = counts.reshape(len(counts), -1, 32).sum(1)
    pairs = []
    for p in np.flatnonzero(block == i):
        q = np.flatnonzero((block == j) & (component != component[p]) & (num * np.maximum(n, n[p]) <= den * np.minimum(n, n[p])))
        q = q[q > p] if i == j else q
        for x in (rough, counts):
            q = q[(den + num) * np.abs(x[q] - x[p]).sum(1) <= (den - num) * (n[q] + n[p])] if len(q) else q
        pairs += [(int(node[p]), x) for x in node[q].tolist()]
    return pairs


def compare_all(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """sig, i, j, node, n, component, block, sketch, sorted by the first three -> a, b. A group has two blocks at most."""
    rest = None
    for batch in itertools.chain(batches, [None]):
        table = pa.Table.from_batches([x for x in (rest, batch) if x is not None]).combine_chunks() if rest is not None or batch is not None else None
        if table is None or not table.num_rows:
            continue
        sig, i, j, node, n, component, block = (table.column(k).to_numpy() for k in range(7))
        starts = np.flatnonzero(np.concatenate([[True], (sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        ends = np.append(starts[1:], len(sig))
        if batch is not None:  # the last group may go on
            rest = table.slice(starts[-1]).to_batches()[0]
            starts, ends = starts[:-1], ends[:-1]
        found = []
        for a, z in zip(starts.tolist(), ends.tolist()):
            if (component[a:z] != component[a]).any():
                found += compare(node[a:z], n[a:z], component[a:z], block[a:z], i[a], j[a], table.column(7)[a:z].to_pylist(), num, den)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])


def open_pairs(table: DataFrame, alone: DataFrame, found: DataFrame, members: DataFrame, num: int, den: int) -> DataFrame:
    """Candidates (a, b) in the open buckets of table (sig, node, rows). alone (sig, node) are the members that aren't in the component of their bucket's first.

    All others of a bucket are, so only a member in alone can add a link: blocks of BLOCK of these meet each other and the blocks of the others.
    """
    opened = alone.groupBy("sig").agg(F.count("*").alias("n_alone"))
    rows = table.select("sig", "node", "rows").join(opened, "sig").join(alone.withColumn("alone", F.lit(True)), ["sig", "node"], "left")
    opens, rest = F.ceil(F.col("n_alone") / BLOCK), F.ceil((F.col("rows") - F.col("n_alone")) / BLOCK)
    dealt, alone_ = F.xxhash64("sig", "node"), F.col("alone").isNotNull()
    block = F.when(alone_, F.pmod(dealt, opens)).otherwise(opens + F.pmod(dealt, rest))
    rows = cut(rows.select("sig", "node", block.alias("block"), (F.when(alone_, opens + rest).otherwise(opens) - 1).alias("last")), "ngram-open")
    nodes = members.join(rows.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    each = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).select("sig", "node", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    groups = each.join(nodes, "node").select("sig", "i", "j", "node", "n", "component", "block", "sketch").repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    return groups.mapInArrow(lambda it: compare_all(it, num, den), "a long, b long").distinct()


def checked(pairs: DataFrame, docs: DataFrame, members: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """a, b, linked for pairs of nodes; sets are computed again, for one document of each node in question."""
    nodes = members.groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    met = pairs.join(nodes.toDF("a", "n", "x"), "a").join(nodes.toDF("b", "m", "y"), "b").select("a", "b", "n", "m", "x", "y")
    met = cut(met.mapInArrow(lambda it: maybe(it, num, den), "a long, b long, maybe boolean"), "ngram-met")
    pairs = met.filter("maybe").select("a", "b")
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    one = members.join(needed, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    one = cut(one, "ngram-needed")
    texts = docs.join(small(one.select("doc_id").distinct(), BROADCAST_BYTES).withColumnRenamed("doc_id", "needed"), F.col("doc_id").eqNullSafe(F.col("needed")), "left_semi")
    sets = texts.select("text").mapInArrow(lambda it: sets_of(it, size), "node long, shingles binary")
    sets = cut(sets.join(one, "node", "left_semi").groupBy("node").agg(F.first("shingles").alias("shingles")), "ngram-sets")
    left, right = sets.toDF("a", "x"), sets.toDF("b", "y")
    sure = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(lambda it: verify(it, num, den), "a long, b long, linked boolean")
    return sure.union(met.filter("not maybe"))


def with_nodes(batches: Iterator[pa.RecordBatch], at: int, size: int) -> Iterator[pa.RecordBatch]:
    """Rows with the node of the text in column at, and how many shingles it has."""
    for batch in batches:
        for a, z in steps(batch.column(at)):
            sets = distinct_sets(batch.column(at)[a:z], size)
            yield pa.RecordBatch.from_arrays([*(c[a:z] for c in batch.columns), pa.array([set_id(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64())], names=[*batch.schema.names, "__node", "__n"])


def named(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """doc_id, n, node, component of each row: its number of shingles, its set, and the component of that."""
    docs = docs.select("doc_id", "text")
    members = cut(docs.mapInArrow(lambda it: ids(it, size), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, node long, sketch binary"), "ngram-members")
    table = buckets(docs, size, num, den)
    star = table.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    tried = cut(checked(star, docs, members, size, num, den), "ngram-tried")
    links = tried.filter("linked").select("a", "b")
    found = cut(components(links), "ngram-components")
    # buckets in which a candidate failed and may still meet through another member
    failed = tried.filter("not linked").select("a", "b")
    apart = _apart(failed, found)
    wide = table.filter("rows > 2")
    alone = cut(wide.join(apart.toDF("first", "node"), ["first", "node"], "left_semi").select("sig", "node"), "ngram-alone")
    more = checked(open_pairs(wide, alone, found, members, num, den), docs, members, size, num, den).filter("linked").select("a", "b")
    more = cut(more, "ngram-more")
    if more.limit(1).count():
        found = cut(components(links.union(more)), "ngram-components")
    return members.join(found, "node", "left").select("doc_id", "n", "node", F.coalesce("component", "node").alias("component"))


def join(docs: DataFrame, size: int = 5, similarity: tuple[int, int] = (4, 5)) -> DataFrame:
    """doc_id, n_shingles, component_id of documents (doc_id, text): components under Jaccard >= num / den."""
    rows = named(docs, size, *similarity)
    # documents without shingles stay alone
    least = rows.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "component", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose ends are not known to be in one component."""
    x, y = found.toDF("a", "ca"), found.toDF("b", "cb")
    known: Column = F.coalesce("ca", "a") != F.coalesce("cb", "b")
    return pairs.join(x, "a", "left").join(y, "b", "left").filter(known).select("a", "b")


def dedup(docs: DataFrame, size: int = 5, similarity: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row of each component: of those with the smallest doc_id (nulls last) that with the smallest set and hash of the text.

    Rows without shingles stay, equal ones once.
    """
    rows = cut(named(docs, size, *similarity), "ngram-named")
    least = rows.filter("n > 0").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("least")).select("least.doc_id", "least.node")
    several = rows.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("__id"), F.lit(True).alias("several"))
    stay = least.union(rows.filter("n = 0").select("doc_id", "node").distinct())
    stay = cut(stay.join(several, F.col("doc_id").eqNullSafe(F.col("__id")), "left").select(F.col("doc_id").alias("__doc"), F.col("node").alias("__stays"), F.coalesce("several", F.lit(False)).alias("several")), "ngram-stay")
    same = F.col("doc_id").eqNullSafe(F.col("__doc"))
    once = docs.join(small(stay.filter("not several").select("__doc"), BROADCAST_BYTES), same, "left_semi").select(*docs.columns)
    # which row of a doc_id it is that stays, its text tells
    stay = stay.filter("several")
    at, schema = docs.columns.index("text"), StructType([*docs.schema.fields, StructField("__node", LongType()), StructField("__n", LongType())])
    more = docs.join(small(stay.select("__doc").distinct(), BROADCAST_BYTES), same, "left_semi").select(*docs.columns).mapInArrow(lambda it: with_nodes(it, at, size), schema)
    more = more.join(stay, (F.col("__node") == F.col("__stays")) & same, "left_semi").withColumn("__key", F.xxhash64("text"))
    more = cut(more.dropDuplicates(["doc_id", "__node", "__key"]), "ngram-several")
    first = more.groupBy(F.col("doc_id").alias("__doc"), F.col("__node").alias("__stays")).agg(F.min("__key").alias("__first"))
    more = more.join(first, (F.col("__node") == F.col("__stays")) & same).filter("__n = 0 or __key = __first")
    return once.union(more.select(*docs.columns))
