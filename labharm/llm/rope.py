"""Fill-in-the-middle documents by ropes.

A text is a balanced binary tree, a rope, whose leaves are pieces of LEAF code points at most. Leaves and inner nodes cache how many code points and how many
unit ends (line ends) lie below. A split at a unit rank goes down one path by the cached counts, cuts one leaf, and joins what lies left and right of the
path; joining two ropes makes one node (and a join of the shallower rope into the deeper one keeps the depth logarithmic). The transformation splits a rope at two unit ranks and joins
prefix, suffix and middle with sentinels in between; the inverse splits the output's rope at the sentinels' code points.

Units are lines, [^\\n]*\\n|[^\\n]+. Which ranks and which form a document gets depends on seed and doc_id alone (sha256), so every run and every
executor gives the same. Prefix, middle and suffix may be empty. An empty (or null) text and one that holds a sentinel stay as they are, form plain.
A null doc_id counts as an empty one. Rows are transformed one by one: repeated rows give repeated rows. Columns other than text stay; columns named as those
that are added (see ADDED) are refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labharm.llm.common import steps

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Code points of a leaf.
LEAF = 2048
#: What `transform` adds, as DDL.
ADDED = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "fim_text": "string"}


class Node(NamedTuple):
    """A leaf (piece) or an inner node (left, right), with code points, unit ends and depth below."""

    chars: int
    ends: int
    depth: int
    piece: str | None = None
    left: Node | None = None
    right: Node | None = None


EMPTY = Node(0, 0, 0, "")


def leaf(piece: str) -> Node:
    return Node(len(piece), piece.count("\n"), 0, piece) if piece else EMPTY


def _node(a: Node, b: Node) -> Node:
    return Node(a.chars + b.chars, a.ends + b.ends, 1 + max(a.depth, b.depth), None, a, b)


def join(a: Node, b: Node) -> Node:
    """a before b; the deeper rope takes the other one in along its edge, so depths stay logarithmic."""
    if not a.chars or not b.chars:
        return a if a.chars else b
    if a.depth > b.depth + 1:
        if a.left.depth >= a.right.depth:
            return _node(a.left, join(a.right, b))
        return _node(_node(a.left, a.right.left), join(a.right.right, b))
    if b.depth > a.depth + 1:
        if b.right.depth >= b.left.depth:
            return _node(join(a, b.left), b.right)
        return _node(join(a, b.left.left), _node(b.left.right, b.right))
    return _node(a, b)


def rope(text: str) -> Node:
    row = [leaf(text[i : i + LEAF]) for i in range(0, len(text), LEAF)] or [EMPTY]
    while len(row) > 1:
        row = [_node(row[i], row[i + 1]) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
    return row[0]


def split(node: Node, rank: int, by_unit: bool = False) -> tuple[Node, Node]:
    """The rope before and after a rank: of code points, or of unit ends (the cut is right after the rank-th one)."""
    if node.piece is not None:
        at = rank
        if by_unit:
            at = 0
            for _ in range(rank):
                at = node.piece.index("\n", at) + 1
        return leaf(node.piece[:at]), leaf(node.piece[at:])
    first = node.left.ends if by_unit else node.left.chars
    if rank <= first:
        a, b = split(node.left, rank, by_unit)
        return a, join(b, node.right)
    a, b = split(node.right, rank - first, by_unit)
    return join(node.left, a), b


def text_of(node: Node) -> str:
    out, todo = [], [node]
    while todo:
        x = todo.pop()
        if x.piece is not None:
            out.append(x.piece)
        else:
            todo += (x.right, x.left)
    return "".join(out)


def units(node: Node, text: str) -> int:
    """Lines: one an end, and a last one without."""
    return node.ends + (bool(text) and not text.endswith("\n"))


def at_unit(node: Node, rank: int) -> tuple[Node, Node]:
    """The rope before and after rank units; past the last end it is whole."""
    return split(node, rank, by_unit=True) if rank <= node.ends else (node, EMPTY)


class Settings(NamedTuple):
    """Hashed before the doc_id; percent of documents that are transformed, and of those, of the form suffix-prefix-middle."""

    seed: int = 7
    rate: int = 100
    spm: int = 50


def rearrange(doc_id: object, text: str, to: Settings) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, output."""
    whole = rope(text)
    n = units(whole, text)
    h = hashlib.sha256(f"{to.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or h3 % 100 >= to.rate or any(x in text for x in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    head, suffix = at_unit(whole, b)
    prefix, middle = at_unit(head, a)
    p, s, m = leaf(PREFIX), leaf(SUFFIX), leaf(MIDDLE)
    spm = h4 % 100 < to.spm
    parts = (s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle)
    out = EMPTY
    for part in parts:
        out = join(out, part)
    return n, "spm" if spm else "psm", prefix.chars, middle.chars, text_of(out)


def rebuild(output: str, form: str) -> str:
    """The text that an output was made of: its rope is split at the sentinels."""
    if form == "plain":
        return output
    names = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
    second, third = output.index(names[1]), output.index(names[2])
    rest, c = split(rope(output), third)
    a, b = split(rest, second)
    a, b, c = (split(x, len(name))[1] for x, name in zip((a, b, c), names))
    prefix, suffix = (b, a) if form == "spm" else (a, b)
    return text_of(join(join(prefix, c), suffix))


def _transformed(batches: Iterator[pa.RecordBatch], to: Settings, key: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        for i, j in steps(texts):
            made = [rearrange(k, t, to) for k, t in zip(batch.column(key)[i:j].to_pylist(), texts[i:j].to_pylist())]
            columns = [pa.array(c, t) for c, t in zip(zip(*made), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c)[i:j] for c in names), *columns], names=[*names, *ADDED])


def transform(docs: DataFrame, to: Settings = Settings(), key: str = "doc_id") -> DataFrame:
    """docs with text replaced by n (units), form, prefix_chars, middle_chars (code points, null if plain) and fim_text."""
    taken = set(ADDED) & set(docs.columns)
    if taken:
        raise ValueError(f"columns that the transformation adds are there already: {sorted(taken)}")
    names = [c for c in docs.columns if c != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"), *(f"{c} {t}" for c, t in ADDED.items())])
    return docs.mapInArrow(lambda batches: _transformed(batches, to, key, names), schema)


def _restored(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j in steps(batch.column("fim_text")):
            made = [None if t is None or f is None else rebuild(t, f) for t, f in zip(batch.column("fim_text")[i:j].to_pylist(), batch.column("form")[i:j].to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c)[i:j] for c in names), pa.array(made, pa.string())], names=[*names, "text"])


def restore(made: DataFrame) -> DataFrame:
    """What transform gave, with the text that it was made of, exactly (an empty one where it was null)."""
    if "text" in made.columns:
        raise ValueError("restore adds a column named text")
    names = made.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema), "text string"])
    return made.mapInArrow(lambda batches: _restored(batches, names), schema)
