"""URL filter: allow and block rules by host and path prefix, looked up in a sorted array of digests.

The rules become one file in the shared folder: the sorted 64-bit xxhash keys of their strings (host + path prefix), and, in that order,
the strings themselves and the verdicts. Spark hands the file to every executor, which maps it into memory. For a url, the keys of its host's
suffixes of as many labels as rules have, each with its path's prefixes of the lengths that rules have, are probed by binary search, a
whole batch at once, so long hosts and paths cost no more than short ones; a stored string has to equal the candidate, so a collision of keys decides nothing. The longest rule that fits wins; for
equal strings block wins. A url that no rule fits is allowed.

Host and path of null urls and of urls without :// are empty, which no rule fits. Rules with a null part are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labharm.llm.common import LOWER, UPPER, shared_dir

_open: dict[str, Rules] = {}


def build(rules: list[tuple[str, str, str]]) -> bytes:
    """The file's bytes from (verdict, host, path prefix): a header line, then keys, string ends, verdicts, strings."""
    table: dict[str, str] = {}
    for verdict, host, path in rules:
        if None not in (verdict, host, path):
            text = host.translate(str.maketrans(UPPER, LOWER)) + path
            table[text] = "block" if "block" in (verdict, table.get(text)) else verdict
    order = sorted(table, key=lambda t: (xxhash.xxh64_intdigest(t), t))
    lengths = sorted({len(p) for v, h, p in rules if None not in (v, h, p)})
    texts = [t.encode() for t in order]
    keys = np.array([xxhash.xxh64_intdigest(t) for t in order], np.uint64)
    ends = np.cumsum([len(t) for t in texts], dtype=np.uint64) if texts else np.zeros(0, np.uint64)
    labels = sorted({h.count(".") + 1 for v, h, p in rules if None not in (v, h, p)})
    head = json.dumps({"rules": len(order), "path_lengths": lengths, "host_labels": labels}).encode()
    head += b" " * (-(len(head) + 1) % 8) + b"\n"
    return head + keys.tobytes() + ends.tobytes() + bytes(table[t] == "block" for t in order) + b"".join(texts)


class Rules:
    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        start = int(np.argmax(data == ord("\n"))) + 1
        head = json.loads(bytes(data[:start]))
        n = head["rules"]
        self.lengths, self.labels = head["path_lengths"], head["host_labels"]
        self.keys = data[start : start + 8 * n].view(np.uint64)
        self.ends = data[start + 8 * n : start + 16 * n].view(np.uint64)
        self.block = data[start + 16 * n : start + 17 * n]
        self.texts = data[start + 17 * n :]

    def text(self, i: int) -> bytes:
        return bytes(self.texts[int(self.ends[i - 1]) if i else 0 : int(self.ends[i])])

    def find(self, candidates: list[bytes]) -> list[int]:
        """The rule with each candidate's string, or -1."""
        keys = np.fromiter((xxhash.xxh64_intdigest(c) for c in candidates), np.uint64, len(candidates))
        at = np.searchsorted(self.keys, keys)
        found = [-1] * len(candidates)
        for k in np.flatnonzero(at < len(self.keys)):
            i = int(at[k])
            while i < len(self.keys) and self.keys[i] == keys[k]:
                if self.text(i) == candidates[k]:
                    found[k] = i
                    break
                i += 1
        return found


def candidates(host: str, path: str, lengths: list[int], labels: list[int]) -> list[bytes]:
    """Host suffixes of as many labels, with path prefixes of as many letters, as rules have, the longest string first."""
    suffixes = [".".join(host.rsplit(".", n)[-n:]) for n in labels if n <= host.count(".") + 1] if host else []
    out = [(suffix + path[:n]).encode() for suffix in suffixes for n in lengths if n <= len(path)]
    return sorted(out, key=len, reverse=True)


def judge(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    """host, path and further columns -> those, rule, verdict."""
    if name not in _open:
        _open[name] = Rules(SparkFiles.get(name))
    rules = _open[name]
    for batch in batches:
        known: dict[tuple[str, str], int] = {}
        pairs = list(zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()))
        longest = max(rules.lengths, default=0)
        short = [(h, p[:longest]) for h, p in pairs]
        distinct = list(dict.fromkeys(short))
        sets = [candidates(h, p, rules.lengths, rules.labels) for h, p in distinct]
        hits = iter(rules.find([c for s in sets for c in s]))
        for pair, s in zip(distinct, sets):
            got = [next(hits) for _ in s]
            known[pair] = next((i for i in got if i >= 0), -1)
        at = [known[x] for x in short]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([rules.text(i).decode() if i >= 0 else None for i in at], pa.string()), pa.array(["block" if i >= 0 and rules.block[i] else "allow" for i in at], pa.string())], names=[*batch.schema.names, "rule", "verdict"])


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def publish(spark: SparkSession, rules: list[tuple[str, str, str]]) -> str:
    """Puts the rules' file into the shared folder and hands it to the executors; returns its name there."""
    data = build(rules)
    name = f"url-rules-{xxhash.xxh3_128_hexdigest(data)}.bin"
    folder = shared_dir(spark, "url-rules")
    at, path = fs.FileSystem.from_uri(folder)
    at.create_dir(path)
    with at.open_output_stream(f"{path}/{name}") as out:
        out.write(data)
    if not any(f.endswith(name) for f in spark.sparkContext.listFiles):
        spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def apply(urls: DataFrame, rules: list[tuple[str, str, str]], url: str = "url") -> DataFrame:
    """urls with host, path, rule and verdict (columns of these names are replaced)."""
    name = publish(urls.sparkSession, rules)
    base = urls.select(*(c for c in urls.columns if c not in ("host", "path", "rule", "verdict")), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    schema = T.StructType([*base.schema.fields, T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])
    return base.mapInArrow(lambda it: judge(it, name), schema)
