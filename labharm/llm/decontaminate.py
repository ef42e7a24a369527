"""Benchmark decontamination: documents that hold a benchmark item, whole or nearly.

Method: every document is cut into windows sized by the items: an item of n words is looked for with windows of the
largest size class up to 0.7 n (255 at most), laid over the document at a stride such that at least two of them fall inside any copy
of the item; each item adds all its own windows of that size to the index. Windows meet by SimHash. The index is a
multi-index over BLOCKS blocks of the fingerprint: two fingerprints within RADIUS bits agree up to RADIUS / BLOCKS bits
in one block at least, so looking up each block's neighbourhood misses none of them. A hit gives an item and a document, and there the
weighted similarity of word shingles decides: the sum over shingles of the smaller count over that of the larger count,
for the best of all texts of the document, whatever their length. Shingles are compared as 64-bit hashes.

Fingerprints alone miss copies whose changes stand close together. So the shortest window, the shingle, is looked up too, as it is: an item meets every
document that has one of its rarest shingles, as many of them as leave too few others for the similarity. That misses no similar text.

Words are what white space leaves, lower-cased, less the punctuation around them. SimHash leaves out words that stand in more than COMMON of the items.

Null and empty texts and items match nothing; items with fewer words than a shingle are one shingle. Repeated rows each give their own
result. Items are taken in blocks of about block_words words, whose indexes (some 900 bytes a word) are the only data that go to the driver and to every task.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labharm.llm.common import give_back, keep, let_go, mix, steps, words

RADIUS, BLOCKS, COMMON = 11, 4, 0.1
#: Words of the items of one index, which takes about 130 MB.
BLOCK_WORDS = 150_000
#: A window's words as a share of its items', and at most, so that counts of words fit a byte.
SHARE, WIDEST = 0.7, 255
#: Words whose hashes a Python worker keeps.
CACHE_WORDS = 200_000

_hashes: dict[str, int] = keep("decontaminate")
#: A byte's bits, each in a byte of its own.
_spread = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def size_class(n: int) -> int:
    """The window size for items of n words: the largest of 1, 2, 3, ... growing by about a third, up to SHARE * n and WIDEST."""
    w = 1
    while (bigger := max(w + 1, round(w * 1.3))) <= min(SHARE * n, WIDEST):
        w = bigger
    return w


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's words begin, and the words as hashes."""
    begin, code, vocabulary = words(texts)
    if len(_hashes) > CACHE_WORDS:
        _hashes.clear()
    hashed = np.fromiter((_hashes[w] if w in _hashes else hash_of(w) for w in vocabulary.to_pylist()), np.uint64, len(vocabulary))[code]
    kept = hashed != 0
    return np.concatenate([[0], np.cumsum(kept)])[begin], hashed[kept]


def hash_of(word: str) -> int:
    """64-bit hash of a word without the punctuation around it, 0 if nothing is left."""
    x = strip(word)
    _hashes[word] = xxhash.xxh64_intdigest(x) if x else 0
    return _hashes[word]


def strip(word: str) -> str:
    if word.isalnum():
        return word.lower()
    a, z = 0, len(word)
    while a < z and not word[a].isalnum():
        a += 1
    while z > a and not word[z - 1].isalnum():
        z -= 1
    return word[a:z].lower()


def grams(begin: np.ndarray, word: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The words at which windows of size words inside one text begin, and the windows' hashes."""
    n = max(0, len(word) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += word[k : k + n]
    inside = np.ones(n, bool)
    for k in range(1, size):
        edge = begin[1:-1] - k
        inside[edge[(edge >= 0) & (edge < n)]] = False
    at = np.flatnonzero(inside)
    return at, mix(out[at])


def fewest(total: int, least: float) -> int:
    """Of so many shingles, how many a text of similarity least has in common with them."""
    return max(1, math.ceil(least * total - 1e-6))


class Grams:
    """The different shingles of one size of all items, and which items look for which.

    A text similar to an item shares at least fewest(item) of its shingles; so of any others and one more it has at least one. Each item looks for
    its rarest such shingles.
    """

    def __init__(self, keys: np.ndarray):
        self.keys, self.seen = np.unique(keys, return_counts=True)
        self.seekers: list[tuple[int, int]] = []
        self.shift = np.uint64(64 - min(26, len(self.keys).bit_length() + 4))
        self.some = np.zeros(1 << 64 - int(self.shift), bool)
        self.some[self.keys >> self.shift] = True

    def among(self, begin: np.ndarray, word: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the texts have these shingles, and which."""
        at, key = grams(begin, word, size)
        maybe = self.some[key >> self.shift]
        at, key = at[maybe], key[maybe]
        which = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        same = self.keys[which] == key
        return at[same], which[same]

    def look_for(self, item: int, own: np.ndarray, times: np.ndarray, spare: int) -> None:
        rare = np.argsort(self.seen[own], kind="stable")
        enough = int(np.searchsorted(np.cumsum(times[rare]), spare + 1)) + 1
        self.seekers += [(k, item) for k in own[rare[:enough]].tolist()]

    def ready(self) -> None:
        pairs = np.array(sorted(self.seekers), np.int64).reshape(-1, 2)
        self.start = np.searchsorted(pairs[:, 0], np.arange(len(self.keys) + 1))
        self.item, self.seekers = pairs[:, 1], []

    def sought(self, begin: np.ndarray, at: np.ndarray, which: np.ndarray) -> np.ndarray:
        """(text, item) of items that look for one of the texts' shingles."""
        count = self.start[which + 1] - self.start[which]
        text = np.repeat(np.searchsorted(begin, at, side="right") - 1, count)
        return np.stack([text, self.item[np.repeat(self.start[which] - np.cumsum(count) + count, count) + np.arange(len(text))]])


class Sums:
    """Prefix sums of word bits, from which windows get their fingerprints.

    Sums of eight bits share an integer, a byte each. Overflows of the running sums cancel out in a window's difference, whose counts fit their bytes.
    """

    def __init__(self, word: np.ndarray, common: np.ndarray):
        used = ~np.isin(word, common)
        self.ones = np.zeros((len(word) + 1, 8), np.uint64)
        np.cumsum(_spread[(word * used).view(np.uint8).reshape(-1, 8)], axis=0, out=self.ones[1:])
        self.used = np.concatenate([[0], np.cumsum(used)])

    def prints(self, at: np.ndarray, size: int) -> np.ndarray:
        ones = (self.ones[at + size] - self.ones[at]).view(np.uint8)
        half = ((self.used[at + size] - self.used[at]) // 2).astype(np.uint8)
        return np.packbits(ones > half[:, None], axis=1).view(np.uint64).ravel()


def near(bits: int, radius: int) -> np.ndarray:
    """All masks of up to radius of so many bits."""
    masks = np.array([0])
    found = [masks]
    for _ in range(radius):
        masks = np.unique(masks[:, None] ^ (1 << np.arange(bits))[None, :])
        found.append(masks)
    return np.unique(np.concatenate(found))


class Index:
    """Multi-index over the items' window fingerprints, by window size."""

    def __init__(self, items: list[tuple], shingle: int, least: float):
        begin, word = plain_words(pa.array([t for _, t in items], pa.string()))
        self.ids = [i for i, _ in items]
        self.words = [word[a:z] for a, z in zip(begin, begin[1:])]
        seen = Counter(w for x in self.words for w in set(x.tolist()))
        self.common = np.array([w for w, n in seen.items() if n > COMMON * len(items) and n > 2], np.uint64)
        # an item with fewer words than a shingle is one, which only a text of as many words has
        self.sizes = [min(len(x), shingle) for x in self.words]
        own = [grams(np.array([0, len(x)]), x, k)[1] if k else np.zeros(0, np.uint64) for x, k in zip(self.words, self.sizes)]
        self.known = {k: Grams(np.concatenate([x for x, j in zip(own, self.sizes) if j == k])) for k in set(self.sizes) - {0}}
        self.grams = [np.unique(np.searchsorted(self.known[k].keys, x), return_counts=True) if k else None for x, k in zip(own, self.sizes)]
        for item, k in enumerate(self.sizes):
            if k:
                total = int(self.grams[item][1].sum())
                self.known[k].look_for(item, *self.grams[item], total - fewest(total, least))
        for known in self.known.values():
            known.ready()
        groups = defaultdict(list)
        for k, x in enumerate(self.words):
            if len(x):
                groups[size_class(len(x))].append(k)
        block_bits = 64 // BLOCKS
        masks = near(block_bits, RADIUS // BLOCKS)
        self.classes = []
        for size, members in sorted(groups.items()):
            stride = max(1, min(len(self.words[k]) - size + 1 for k in members) // 2)
            prints, item = [], []
            for k in members:
                at = np.arange(len(self.words[k]) - size + 1)
                prints.append(Sums(self.words[k], self.common).prints(at, size))
                item.append(np.full(len(at), k))
            prints, item = np.concatenate(prints), np.concatenate(item)
            tables = []
            for b in range(BLOCKS):
                own = (prints >> np.uint64(b * block_bits)) & np.uint64((1 << block_bits) - 1)
                key = (own.astype(np.int64)[:, None] ^ masks[None, :]).ravel()
                order = np.argsort(key, kind="stable")
                tables.append((np.searchsorted(key[order], np.arange((1 << block_bits) + 1)), (order // len(masks)).astype(np.int32)))
            self.classes.append((size, stride, prints, item, tables))

    def hits(self, begin: np.ndarray, word: np.ndarray) -> np.ndarray:
        """(text, item) of windows within RADIUS."""
        if not len(word) or not self.classes:
            return np.zeros((2, 0), np.int64)
        sums = Sums(word, self.common)
        lengths = np.diff(begin)
        block_bits = 64 // BLOCKS
        found = [np.zeros((2, 0), np.int64)]
        for size, stride, prints, item, tables in self.classes:
            n = np.maximum(0, (lengths - size) // stride + 1)
            text = np.repeat(np.arange(len(n)), n)
            at = begin[:-1][text] + stride * (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n))
            for i in range(0, len(at), 100_000):
                mine = sums.prints(at[i : i + 100_000], size)
                for b, (start, who) in enumerate(tables):
                    key = ((mine >> np.uint64(b * block_bits)) & np.uint64((1 << block_bits) - 1)).astype(np.int64)
                    count = start[key + 1] - start[key]
                    window = np.repeat(np.arange(len(mine)), count)
                    other = who[np.repeat(start[key] - np.cumsum(count) + count, count) + np.arange(len(window))]
                    close = np.bitwise_count(mine[window] ^ prints[other]) <= RADIUS
                    w, o = window[close] + i, other[close]
                    found.append(np.unique(np.stack([text[w], item[o]]), axis=1))
        return np.concatenate(found, axis=1)

    def best(self, item: int, at: np.ndarray, which: np.ndarray, least: float) -> tuple[float, int, int]:
        """The similarity of the item and the best text of a document with these shingles, and where that begins and ends.

        That text begins and ends with shingles of the item: without others it is more similar.
        """
        own, times = self.grams[item]
        total, out = int(times.sum()), (0.0, 0, 0)
        k = np.minimum(np.searchsorted(own, which), len(own) - 1)
        hit = own[k] == which
        at, k = at[hit], k[hit]
        # a similar text shares at least that many shingles with the item and has at most that many
        last = np.searchsorted(at, at + math.floor(total / least + 1e-6))
        begins = np.flatnonzero(last - np.arange(len(at)) >= fewest(total, least))
        if not len(begins):
            return out
        # a shingle that the item has c times counts if the one c such shingles before it isn't in the text
        order = np.argsort(k, kind="stable")
        sorted_k = k[order]
        back = np.arange(len(k)) - times[sorted_k]
        before = np.empty(len(k), np.int64)
        before[order] = np.where(back >= np.searchsorted(sorted_k, sorted_k), order[np.maximum(back, 0)], -1)
        for i in begins.tolist():
            z = last[i]
            both = np.cumsum(before[i:z] < i)
            found = both / (at[i:z] - at[i] + 1 + total - both)
            j = int(found.argmax())
            if found[j] > out[0]:
                out = (float(found[j]), int(at[i]), int(at[i + j]) + self.sizes[item])
                if out[0] == 1.0:
                    break
        return out


def found_in(texts: pa.Array, index: Index, least: float) -> dict[tuple[int, int], tuple[float, int, int]]:
    """(text, item) of items found -> similarity, first word, word after the last."""
    begin, word = plain_words(texts)
    best = {}
    shared = {k: known.among(begin, word, k) for k, known in index.known.items()}
    met = [index.hits(begin, word), *(known.sought(begin, *shared[k]) for k, known in index.known.items())]
    for text, item in np.unique(np.concatenate(met, axis=1), axis=1).T.tolist():
        at, which = shared[index.sizes[item]]
        i, j = np.searchsorted(at, begin[text : text + 2])
        got = index.best(item, at[i:j] - begin[text], which[i:j], least)
        if got[0] >= least:
            best[text, item] = got
    return best


def scan(batches: Iterator[pa.RecordBatch], index, least: float) -> Iterator[pa.RecordBatch]:
    index = index.value
    for batch in batches:
        for a, z in steps(batch.column(1), operator="decontaminate"):
            best = found_in(batch.column(1)[a:z], index, least)
            if best:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:z].take(pa.array([t for t, _ in best])), pa.array([index.ids[i] for _, i in best], pa.int64()), *(pa.array(x, t) for x, t in zip(zip(*best.values()), (pa.float64(), pa.int32(), pa.int32())))],
                    names=["doc_id", "item_id", "similarity", "start_word", "end_word"],
                )


def indexes(docs: DataFrame, benchmark: DataFrame, shingle: int, least: float, block_words: int) -> Iterator:
    """Broadcast indexes of blocks of items, of about block_words words each (one item at least)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    total = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield spark.sparkContext.broadcast(Index([tuple(r) for r in part.collect()], shingle, least))


def find(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, least: float = 0.8, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, similarity, start_word, end_word: an item found in a document, once, at its best place."""
    docs = docs.select("doc_id", "text")
    out = None
    for index in indexes(docs, benchmark, shingle, least, block_words):
        found = docs.mapInArrow(lambda it, index=index: scan(it, index, least), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id long, similarity double, start_word int, end_word int")
        out = found if out is None else out.union(found)
    return out


def clean(batches: Iterator[pa.RecordBatch], at: int, index, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.ones(batch.num_rows, bool)
        for a, z in steps(batch.column(at), operator="decontaminate"):
            keep[[a + t for t, _ in found_in(batch.column(at)[a:z], index.value, least)]] = False
        yield batch.filter(pa.array(keep))
    let_go()  # the next stage's tasks may be none of Python's, and so wouldn't
    give_back()


def without(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, least: float = 0.8, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of docs in which no item is found, whatever their doc_id."""
    at, schema = docs.columns.index("text"), docs.schema
    for index in indexes(docs, benchmark, shingle, least, block_words):
        docs = docs.mapInArrow(lambda it, index=index: clean(it, at, index, least), schema)
    return docs
