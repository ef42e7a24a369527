"""HTML extraction: a page's main text as the contiguous run of tokens with the largest score.

Each word scores by where it stands, each tag by its name; a linear scan finds the run of tokens with the largest sum. Words are
positive and tags negative; words in places such as menus are slightly negative. Inside the run, text in such places is left out.

Weights come from labelled pages: pages that mark their content themselves with exactly one article or main element, SAMPLE of them
at most (smallest hash of their html). A place is the nearest landmark and block element; its weight is the log-odds of words there to be
content. The names that a word stands below, landmarks such as nav and whole classes, roles and ids, have weights of their own: the
log-odds, over pages, that content stands below that name. Ids of headings, paragraphs and the like are anchors and no names. A word below a name that speaks against content enough is away from it, whatever else
it has. Names that are known to mark what isn't content (AWAY, HINTS) start with PRIOR pages that say so, which labelled pages outweigh; all others start
with none. Names below which all of a page stands that could be content are wrappers (a form around the page) and count for nothing there.
Words away cost next to nothing, so that a box within the article, however long, doesn't part it from what follows. A place or name seen too rarely falls back to its block element, then to a default. Pages without such elements, or tables without
labelled pages, thus work with fallbacks.

Character references are decoded, white space in a block becomes one space, blocks are joined by line feeds; br is white space.
Null, empty or broken html gives what text can be found, or an empty text. Repeated rows and null ids are kept as they are.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labharm.llm.common import cut, sample

SAMPLE, LEAST = 2000, 20
#: Pages from which a name's weight counts, pages that known names start with, and the log-odds below which words are away from content.
LEAST_PAGES, PRIOR, FAR = 5, 20, -1.0
#: What a word away from content and a tag there cost.
AWAY_WORD, AWAY_TAG = -0.001, -0.001
# Element names of HTML by their role.
#: Raw text, up to the closing tag or the end of the page.
RAW = frozenset("script style textarea iframe".split())
#: Elements whose text isn't shown or isn't content; NARROW ones hold no blocks, so the next block ends them if nothing else does.
SKIPPED = frozenset("template noscript svg object canvas select button audio video annotation annotation-xml".split())
NARROW = frozenset("select button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
LANDMARKS = frozenset("nav header footer aside form menu head title dialog fieldset article main".split())
AWAY = frozenset("nav header footer aside form menu head title dialog fieldset".split())
#: Words in class, id or role attributes that name what isn't content.
HINTS = frozenset("ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer discussion disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice pager pagination paywall popup promo promoted recommended related replies share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget".split())
#: Elements whose id is an anchor into the text rather than the name of a part of the page.
ANCHORS = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th blockquote figure figcaption pre caption".split())
#: Names of elements that never wrap a page's content.
NEVER_AROUND = AWAY - {"form", "fieldset"} | {"(hidden)"}
#: Those that tell even of an article element that it isn't the article.
NOT_ARTICLE = frozenset("ad ads advert advertisement adverts comment comments promo promoted recommended related sponsored".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes): kinds are text, open, close, and skip, from which an element is left out. Comments, declarations and raw elements give none."""
    at, n = 0, len(page)
    lower, last_close = page.lower() if page.isascii() else "".join(c.lower() if c.isascii() else c for c in page), {}
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            yield "text", page[at:lt], ""
        if lt == n:
            return
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        closing = page.startswith("/", lt + 1)
        name = NAME.match(page, lt + 1 + closing)
        if not name:
            if page.startswith(("!", "?"), lt + 1) or closing:
                end = page.find(">", lt)
                at = n if end < 0 else end + 1
            else:  # not a tag
                yield "text", "<", ""
                at = lt + 1
            continue
        rest = REST.match(page, name.end())
        end = rest.end() if rest else page.find(">", name.end()) + 1 or n
        tag = name[0].lower()
        if closing:
            yield "close", tag, ""
        elif tag in RAW:
            close = re.compile(f"</{tag}\\b[^>]*>", re.I).search(page, end)
            end = close.end() if close else n
            yield "open", "hr" if tag == "iframe" else "wbr", ""
        elif tag in SKIPPED:
            if tag not in last_close:
                last_close[tag] = lower.rfind(f"</{tag}")
            # one that ends itself or never ends holds nothing
            yield "open", "hr" if tag == "object" else "wbr", ""
            if last_close[tag] >= end and not page.endswith("/>", at, end):
                yield "skip", tag, ""
        else:
            yield "open", tag, page[name.end() : end]
        at = end


def attributes_of(text: str) -> dict[str, str]:
    """An element's attributes, names in lower case; of repeated ones the first counts."""
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), value[1:-1] if value[:1] in ("'", '"') else value)
    return out


def names(tag: str, attributes: str) -> list[str]:
    """What an element is called: its name if it is a landmark, and each whole class, role and id (if that isn't an anchor), with a dot before it; "(hidden)" if it is."""
    found = [tag] if tag in LANDMARKS else []
    if attributes:
        a = attributes_of(attributes)
        if tag not in ("html", "body"):
            words = f"{a.get('class', '')} {a.get('role', '')}".lower().split() + ([a["id"].strip().lower()] if a.get("id", "").strip() and tag not in ANCHORS else [])
            found += (f".{w}" for w in dict.fromkeys(words) if tag not in ("article", "main") or w in NOT_ARTICLE)
        if "hidden" in a and a["hidden"].lower() != "until-found" or NOT_SHOWN.search(a.get("style", "")) or a.get("aria-hidden", "").lower() == "true":
            found.append("(hidden)")
    return found


def suspect(name: str) -> bool:
    """Whether a name is known to mark what isn't content."""
    return name in AWAY or name == "(hidden)" or name[0] == "." and name[1:] in HINTS


def parse(page: str) -> list[tuple]:
    """("text", text, (landmark, block, names above), block number, inside) and the same with "tag" and its name, in page order.

    inside: within article or main, and below no name there that is known to mark what isn't content.
    """
    out: list[tuple] = []
    # block elements that are open, with the nearest landmark, all names above, whether they are inside, and whether within article or main
    stack: list[tuple[str, str, tuple, bool, bool]] = []
    block, root = 0, ("-", "-", (), False, False)
    skipped, depth, within = "", 0, []  # the element being left out, how often it is open, and the blocks open in it
    for kind, value, attributes in tokens(page):
        if kind == "skip":
            if not skipped:
                skipped, depth, within = value, 1, []
            elif value == skipped and value not in NARROW:
                depth += 1
            continue
        if skipped:
            if kind == "close" and value == skipped:
                depth -= 1
                skipped = skipped if depth else ""
                continue
            if kind == "text" or value not in BLOCKS or value in VOID:
                continue
            if skipped not in NARROW:
                if kind == "open":
                    within.append(value)
                    continue
                if value in within or all(x[0] != value for x in stack):
                    while value in within:
                        if within.pop() == value:
                            break
                    continue
            skipped = ""
        if kind == "text":
            if not value.isspace():
                name, landmark, above, inside, _ = stack[-1] if stack else root
                out.append(("text", value, (landmark, name, above), block, inside))
            continue
        if value in BLOCKS:
            block += 1
            if kind == "open":
                if value not in VOID:
                    if stack and stack[-1][0] == "p" or value in ("li", "tr", "td", "th", "dt", "dd") and stack and stack[-1][0] == value:
                        stack.pop()
                    _, landmark, above, inside, within_article = stack[-1] if stack else root
                    own = names(value, attributes)
                    content = value in ("article", "main")
                    inside = (inside or content and not within_article) and not any(map(suspect, own))
                    stack.append((value, value if value in LANDMARKS else landmark, (*above, *(n for n in own if n not in above)), inside, within_article or content))
            elif any(x[0] == value for x in stack):
                while stack and stack.pop()[0] != value:
                    pass
        _, landmark, above, inside, _ = stack[-1] if stack else root
        out.append(("tag", value, (landmark, "", above), block, inside))
    return out


class Weights:
    """Log-odds of places ((landmark, block)), of block elements (name) and of tags ("<" + name) to be content, and of names ("~", name) to stand above content, by page."""

    def __init__(self, inside: Counter, outside: Counter):
        odds = lambda k, more=0.0: max(-4.0, min(4.0, math.log((inside[k] + 0.5) / (outside[k] + more + 0.5))))
        self.odds, self.names, self.far = {}, {}, {}
        for k, n in (inside + outside).items():
            if k[0] != "~":
                if n >= LEAST:
                    self.odds[k] = odds(k)
            elif suspect(k[1]) or n >= LEAST_PAGES:
                self.names[k[1]] = odds(k, PRIOR * suspect(k[1]))

    def away(self, above: tuple[str, ...]) -> bool:
        """Whether one of the names above speaks against content."""
        if above not in self.far:
            if len(self.far) > 100_000:
                self.far.clear()
            self.far[above] = any(self.names.get(n, -4.0 if suspect(n) else 0.0) < FAR for n in above)
        return self.far[above]

    def around(self, found: list[tuple]) -> frozenset[str]:
        """Names that speak against content, but stand above all of a page that could be content, and above most of it: they are wrappers, and say nothing."""
        words: Counter = Counter()
        for kind, value, place, _, _ in found:
            if kind == "text" and "head" not in place[2]:
                words[frozenset(n for n in place[2] if self.names.get(n, -4.0 if suspect(n) else 0.0) < FAR)] += len(value.split())
        if not words or words[frozenset()]:
            return frozenset()
        most, n = max(words.items(), key=lambda kv: (kv[1], sorted(kv[0])))
        return most if 2 * n >= words.total() and not most & NEVER_AROUND else frozenset()

    def word(self, place: tuple[str, str, tuple]) -> float:
        if self.away(place[2]):
            return AWAY_WORD
        place = place[:2]
        if place in self.odds:
            return self.odds[place]
        if place[0] in ("article", "main"):
            return 1.0
        return self.odds.get(place[1], 1.0) if place[1] not in ("body", "html", "-") else 0.2

    def tag(self, name: str, above: tuple[str, ...]) -> float:
        """Tags are negative, those that stand outside content more so."""
        return AWAY_TAG if self.away(above) else -0.1 - min(1.0, max(0.0, -self.odds.get("<" + name, 0.0)))


def best_run(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous run with the largest sum (the first such), empty if no sum is positive."""
    best, span, total, begin = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, span = total, (begin, i + 1)
    return span


def extract(page: str | None, weights: Weights) -> str:
    found = parse(page or "")
    wrappers = weights.around(found)
    if wrappers:
        found = [(kind, value, ("-" if place[0] in wrappers else place[0], place[1], tuple(n for n in place[2] if n not in wrappers)), block, inside) for kind, value, place, block, inside in found]
    a, z = best_run([len(t[1].split()) * weights.word(t[2]) if t[0] == "text" else weights.tag(t[1], t[2][2]) for t in found])
    blocks: dict[int, list[str]] = {}
    for kind, value, place, block, _ in found[a:z]:
        if kind == "tag":
            if value == "br":
                blocks.setdefault(block, []).append(" ")
        elif weights.word(place) > 0:
            blocks.setdefault(block, []).append(value)
    texts = (" ".join(html.unescape("".join(x)).split()) for x in blocks.values())
    return "\n".join(t for t in texts if t)


def count_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """html of labelled pages -> name, pages in which content stands below it, and others that have it."""
    for batch in batches:
        tally: dict[str, list[int]] = {}
        for page in batch.column(0).to_pylist():
            texts = [t for t in parse(page) if t[0] == "text"]
            holding = {n for t in texts if t[4] for n in t[2][2]}
            for name in {n for t in texts for n in t[2][2]}:
                tally.setdefault(name, [0, 0])[name not in holding] += 1
        yield tallied({("~", k): v for k, v in tally.items()})


def count(batches: Iterator[pa.RecordBatch], weights) -> Iterator[pa.RecordBatch]:
    """html of labelled pages -> kind of token, how often inside and outside content, where names don't tell already."""
    for batch in batches:
        tally: dict[tuple[str, str], list[int]] = {}
        for page in batch.column(0).to_pylist():
            for kind, value, place, _, inside in parse(page):
                if weights.value.away(place[2]):
                    continue
                for key in [place[:2], ("", place[1])] if kind == "text" else [("<", value)]:
                    tally.setdefault(key, [0, 0])[not inside] += len(value.split()) if kind == "text" else 1
        yield tallied(tally)


def tallied(tally: dict[tuple[str, str], list[int]]) -> pa.RecordBatch:
    keys = list(tally)
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), *(pa.array([tally[k][i] for k in keys], pa.int64()) for i in (0, 1))], names=["landmark", "name", "inside", "outside"])


def fit(pages: DataFrame) -> Weights:
    """Weights from the labelled ones among pages (html): of names first, then of places and tags that names leave open."""
    marked = F.regexp_count("html", F.lit("(?i)<(article|main)[\\s>]")) == 1
    chosen = cut(sample(pages.select("html").filter(marked), "html", SAMPLE), "html-labelled")
    key = lambda r: r.name if r.landmark == "" else "<" + r.name if r.landmark == "<" else (r.landmark, r.name)

    def counts(counting, least: int) -> tuple[dict, dict]:
        rows = chosen.mapInArrow(counting, "landmark string, name string, inside long, outside long").groupBy("landmark", "name").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o")).filter(f"i + o >= {least}").collect()
        return {key(r): r.i for r in rows}, {key(r): r.o for r in rows}

    inside, outside = counts(count_names, LEAST_PAGES)
    sent = pages.sparkSession.sparkContext.broadcast(Weights(Counter(inside), Counter(outside)))
    more_inside, more_outside = counts(lambda it: count(it, sent), LEAST)
    return Weights(Counter(inside | more_inside), Counter(outside | more_outside))


def texts(pages: DataFrame, weights: Weights) -> DataFrame:
    """pages with text, the main text of html; html goes."""
    sent = pages.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("string")
    def main_text(pages):
        return pages.map(lambda p: extract(p, sent.value))

    return pages.withColumn("text", main_text("html")).drop("html")
