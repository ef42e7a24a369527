import random

import pytest
import xxhash

from labharm.llm import url_filter as U
from labharm.llm.catalog import RULES


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:end]), rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(len((h + p).encode()), v == "block", h + p, v) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[2:] if fits else (None, "allow"))


def test_brute_force(spark):
    rnd = random.Random(2)
    urls = [None, "", "no scheme", "://", "http://", "http://com", "HTTP://A.Example.COM/en/7?x=/en/", "http://example.com/en/71#a", "http://xcom/en/", "http://.com/en/", "a://b://com/en/", "http://com?q/en/", "http://é.NET/de/8ü", "http://com/en/" + "x" * 200_000, "http://" + "a." * 500_000 + "com/en/1", "http://" + "." * 100_000 + "com/en/", "http://" + "b" * 300_000 + ".net/de/8", "http://a.com./en/"]
    for _ in range(400):
        urls.append(f"{rnd.choice(['http', 'x'])}://{rnd.choice(['', 'a.', 'A.b.', 'not'])}{rnd.choice(['example.', ''])}{rnd.choice(['com', 'net', 'org'])}{rnd.choice(['/en/', '/en/7', '/de/8', '/de/', '/es/', '/en', '', '/EN/'])}{rnd.choice(['', '?a#b', '#/en/', 'x/y'])}")
    urls += urls[:40]
    df = spark.createDataFrame([(u, "mine", i) for i, u in enumerate(urls)], "url string, host string, verdict_of int").repartition(3)
    got = {r.verdict_of: (r.host, r.path, r.rule, r.verdict) for r in U.apply(df, RULES).collect()}
    assert got == {i: brute(u, RULES) for i, u in enumerate(urls)}


@pytest.mark.parametrize("rules", [[], [("block", "com", "")], [("allow", "a.com", "/x"), ("block", "a.com", "/x"), ("block", None, "/")]])
def test_rules(spark, rules):
    df = spark.createDataFrame([("http://a.com/x",), ("http://b.org",)], "url string")
    known = [r for r in rules if None not in r]
    assert sorted(tuple(r)[1:] for r in U.apply(df, rules).collect()) == sorted(brute(u, known) for u in ("http://a.com/x", "http://b.org"))
    assert U.apply(df.limit(0), rules).collect() == []


def test_colliding_keys(tmp_path, monkeypatch):
    """Where all keys collide, the stored strings decide."""
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda text: 5)
    path = tmp_path / "rules"
    path.write_bytes(U.build(RULES))
    rules = U.Rules(str(path))
    assert [rules.text(i) if i >= 0 else None for i in rules.find([b"com/en/", b"com/xx/", b"org/es/"])] == [b"com/en/", None, b"org/es/"]
