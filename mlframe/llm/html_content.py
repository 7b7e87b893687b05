"""Main-content extraction by maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags
negative; one linear scan finds the contiguous region with the highest sum.
How much a tag costs and a word is worth inside a tag is learned from pages
that label their own content (exactly one ``article`` or ``main`` element),
whose container is hidden while the price is tuned. Boilerplate elements are neutral
and left out of the region's text, unless the content itself lies in them: then
the scan goes through them, and the hint words that named them are learned weights.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mlframe.llm._text import slices
from mlframe.llm.tables import boxed, unboxed

#: A comment, a raw-text element with its content, a tag, or other markup; '<' before anything else is text.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|svg|iframe|object|canvas|select|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*>", re.S | re.I)
_HINT = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_WORDS = re.compile(r"[a-z]+")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset(("article", "main"))
#: Elements whose text is no main text, unless all the page's containers are in them (or, for a form, most of its words).
DROPPED = frozenset("nav aside footer form button menu dialog label input datalist output head".split())
#: Words of a class, id or role that say the same of any element that does not hold the page's content.
DROPPED_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu menubar navbar nav navigation "
    "breadcrumb breadcrumbs footer masthead topbar comment comments disqus respond reply replies cookie cookies consent notice notices "
    "newsletter subscribe subscription signup login popup modal overlay share sharing social related recommended widget widgets toolbar "
    "complementary contentinfo search pagination pager skip".split())
#: What may stand in a head; anything else closes it.
HEAD_CONTENT = frozenset("base basefont bgsound link meta noscript script style template title".split())
#: Prior share of the elements with a hint word that hold the content.
HINT_PRIOR = 0.25
#: So many prices for a tag that opens or closes a container.
CONTAINER_PRICES = 8.0


@dataclass
class ContentModel:
    """Share of content among the places where each tag was seen, and the price of a tag outside content."""

    tag_inside: dict[str, float] = field(default_factory=dict)
    word_inside: dict[str, float] = field(default_factory=dict)
    price: float = 16.0
    hint_inside: dict[str, float] = field(default_factory=dict)

    def hint(self, name: str) -> float:
        """Share of the elements with this hint word that hold the content."""
        return self.hint_inside.get(name, HINT_PRIOR)

    def trusted(self) -> frozenset[str]:
        """Hint words that mostly name elements around the content here, so they say nothing."""
        return frozenset(h for h, share in self.hint_inside.items() if share >= 0.5)

    def share(self, name: str) -> float:
        return self.tag_inside.get(name, 0.9 if name.strip("/") == "a" else 0.99)

    def word(self, context: str) -> float:
        name, _, hint = context.partition("!")
        return max(0.05, self.word_inside.get(name, 0.8)) * (self.hint(hint) if hint else 1.0)

    def score(self, token: tuple) -> float:
        """Words: positive. Tags: negative. Dropped elements are neutral, as their text is left out in any case."""
        kind, what, where, flag = token
        if kind == "w":
            return 0.0 if flag else n_words(what) * self.word(where)
        if flag:
            return -self.price * CONTAINER_PRICES
        if what[0] == "!":
            return -self.price * CONTAINER_PRICES * (1.0 - self.hint(what[1:]))
        return 0.0 if "~" in what else -self.price * (1.0 - self.share(what))


def _hint(name: str, attributes: str, trusted: frozenset[str]) -> str:
    """The first hint word of a class, id or role, or ''."""
    if attributes and name not in ("body", "html", *CONTAINERS):
        for m in _HINT.finditer(attributes):
            for word in _WORDS.findall(m[1].lower()):
                if word in DROPPED_HINTS and word not in trusted:
                    return word
    return ""


@dataclass(slots=True)
class Boilerplate:
    """An element that a name or a hint word marks as boilerplate: its tokens are [start, end)."""

    name: str
    hint: str
    start: int
    end: int = -1
    holds: bool = False  # a container


def parse(page: str, trusted: frozenset[str] = frozenset()) -> list[tuple]:
    """Tokens in page order: ('w', text, innermost element, inside a dropped element) or ('t', feature, is a block, container).

    A tag's feature is its name, with '/' in front if it closes and '~' if it
    belongs to a dropped element. ``container`` is
    +1 / -1 for the tags that open and close an article or main element. End
    tags close the nearest open element of their name; a block closes an open
    paragraph, and whatever cannot stand in a head closes it.

    Boilerplate is dropped unless the content is in it: if no container lies
    outside, an element stays that holds one, and so does a form or an element
    with a hint word that holds most of the page's words. The feature of the
    tags of an element that stays in spite of a hint word is '!' and the word,
    which also follows the innermost element of the words in it. ``trusted``
    hint words are ignored.
    """
    return parse_marked(page, trusted)[0]


def parse_marked(page: str, trusted: frozenset[str] = frozenset()) -> tuple[list[tuple], list[Boilerplate]]:
    """What :func:`parse` gives, and all elements that are marked as boilerplate, dropped or not."""
    tokens, marked = _tokens(page, trusted, frozenset())
    kept = _holding_content(tokens, marked)
    return _tokens(page, trusted, kept) if kept else (tokens, marked)


def _holding_content(tokens: list[tuple], marked: list[Boilerplate]) -> frozenset[int]:
    """Numbers of the marked elements that hold the page's content."""
    if not marked or any(t[0] == "t" and t[3] for t in tokens):
        return frozenset()
    kept = {i for i, x in enumerate(marked) if x.holds}
    loose = [i for i, x in enumerate(marked) if i not in kept and (x.name == "form" or x.hint and x.name not in DROPPED)]
    if loose:
        # words before each token, without those of elements that cannot stay
        before, at = [0], 0
        stays = kept.union(loose)
        stop = [(x.start, x.end) for i, x in enumerate(marked) if i not in stays]
        until = 0
        for i, t in enumerate(tokens):
            while at < len(stop) and stop[at][0] <= i:
                until = max(until, stop[at][1])
                at += 1
            before.append(before[-1] + (n_words(t[1]) if t[0] == "w" and i >= until else 0))
        kept.update(i for i in loose if 2 * (before[marked[i].end] - before[marked[i].start]) > before[-1])
    return frozenset(kept)


def _tokens(page: str, trusted: frozenset[str], kept: frozenset[int]) -> tuple[list[tuple], list[Boilerplate]]:
    """One pass over the page, in which the marked elements with the numbers ``kept`` are not dropped."""
    out: list[tuple] = []
    stack: list[tuple[str, bool, str, int]] = []  # name, dropped, hint word it stays in spite of, number if marked or -1
    marked: list[Boilerplate] = []
    hints: list[str] = []
    inner: list[int] = []  # tokens that open a container
    at, dropped = 0, 0

    def text(a: int, b: int) -> None:
        if a < b:
            if stack and stack[-1][0] == "head" and not page[a:b].isspace():
                close(len(stack) - 1)
            where = stack[-1][0] if stack else ""
            out.append(("w", page[a:b], f"{where}!{hints[-1]}" if hints else where, dropped > 0))

    def close(depth: int) -> None:
        nonlocal dropped
        while len(stack) > depth:
            _, bad, hint, number = stack.pop()
            dropped -= bad
            if hint:
                hints.pop()
            if number >= 0:
                marked[number].end = len(out)

    for m in _TOKEN.finditer(page):
        text(at, m.start())
        at = m.end()
        name = m[3]
        if not name:
            continue
        name = name.lower()
        hint = ""
        if not m[2] and stack and stack[-1][0] == "head" and name not in HEAD_CONTENT:
            close(len(stack) - 1)
        block, before = name in BLOCKS, dropped
        if m[2]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    hint = stack[depth][2]
                    close(depth)
                    break
        else:
            if block and any(x[0] == "p" for x in stack[-4:]):
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == "p":
                        close(depth)
                        break
            if name not in VOID and not m[4].endswith("/"):
                hint = _hint(name, m[4], trusted)
                bad, number = name in DROPPED or hint != "", -1
                if name == "header" and not any(x[0] in CONTAINERS for x in stack):
                    bad = True
                if bad:
                    number = len(marked)
                    marked.append(Boilerplate(name, hint, len(out)))
                    bad = number not in kept
                if bad:
                    hint = ""
                if hint:
                    hints.append(hint)
                stack.append((name, bad, hint, number))
                dropped += bad
        feature = "~" + name if before else "!" + hint if hint and not dropped else m[2] + name + ("~" if dropped else "")
        if name in CONTAINERS and not m[2]:
            inner.append(len(out))
        out.append(("t", feature, block, (-1 if m[2] else 1) if name in CONTAINERS and not before else 0))
    text(at, len(page))
    close(0)
    for x in marked:
        i = bisect_left(inner, x.start)
        x.holds = i < len(inner) and inner[i] < x.end
    return out, marked


def n_words(text: str) -> int:
    return len(text.split())


def best_region(tokens: list[tuple], model: ContentModel) -> tuple[int, int]:
    """[a, b) of the tokens with the highest sum of scores (Kadane's scan); the first of equal ones, (0, 0) without words."""
    best, where, total, start = 0.0, (0, 0), 0.0, 0
    for i, t in enumerate(tokens):
        total += model.score(t)
        if total <= 0.0:
            total, start = 0.0, i + 1
        elif total > best:
            best, where = total, (start, i + 1)
    return where


def region_text(tokens: list[tuple], a: int, b: int) -> str:
    """The region's blocks without dropped elements: references decoded, white space joined, blocks two newlines apart."""
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        joined = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        if joined:
            blocks.append(joined)

    for t in tokens[a:b]:
        if t[0] == "w":
            if not t[3]:
                parts.append(t[1])
        elif t[2]:
            flush()
        elif t[1].strip("~") == "br":
            parts.append("\n")
    flush()
    return "\n\n".join(blocks)


def extract(page: str | None, model: ContentModel) -> str:
    tokens = parse(page or "", model.trusted())
    return region_text(tokens, *best_region(tokens, model))


def labelled_span(tokens: list[tuple]) -> tuple[int, int] | None:
    """Tokens inside the page's only container, or None."""
    opens = [i for i, t in enumerate(tokens) if t[0] == "t" and t[3] > 0]
    closes = [i for i, t in enumerate(tokens) if t[0] == "t" and t[3] < 0]
    if len(opens) != 1 or len(closes) != 1 or closes[0] < opens[0]:
        return None
    return opens[0] + 1, closes[0]


def _agreement(pages: list[tuple[list, tuple]], model: ContentModel) -> float:
    """Mean F1 of the words in the found region against the labelled one."""
    total = 0.0
    for tokens, (x, y) in pages:
        a, b = best_region([("t", "~" + t[1], t[2], 0) if t[0] == "t" and t[3] else t for t in tokens], model)
        count = lambda p, q: sum(n_words(t[1]) for t in tokens[p:q] if t[0] == "w" and not t[3])
        both = count(max(a, x), max(min(b, y), max(a, x)))
        total += 2 * both / max(1, count(a, b) + count(x, y))
    return total / max(1, len(pages))


def fit(pages: DataFrame, sample: int = 2_000, tune: int = 200, id_col: str = "page_id", html_col: str = "html") -> ContentModel:
    """Weights from about ``sample`` pages (by hash) that have exactly one container; about ``tune`` of them choose the price.

    Only counts per tag name reach the driver, and the tuning pages' scores
    per candidate price. Without labelled pages the prior weights stay.
    """
    candidates = pages.filter(F.col(html_col).rlike(r"(?i)<(article|main)\b"))
    rate = min(1.0, sample / max(1, candidates.count()))
    unit = F.pmod(F.xxhash64(F.lit("html"), id_col), F.lit(1_000_000))
    chosen = candidates.filter(unit < 1_000_000 * rate).select(html_col)

    def counted(batches):
        seen: dict[tuple[str, str], list[float]] = {}
        for batch in batches:
            for page in batch.column(html_col).to_pylist():
                tokens, marked = parse_marked(page)
                span = labelled_span(tokens)
                if not span:
                    continue
                for x in marked:
                    if x.hint:
                        seen.setdefault(("h", x.hint), [0.0, 0.0])[x.holds] += 1
                for i, t in enumerate(tokens):
                    n = n_words(t[1]) if t[0] == "w" else 1
                    if n and not t[3] and not (t[0] == "t" and ("~" in t[1] or t[1][0] == "!")):
                        c = seen.setdefault((t[0], t[2].partition("!")[0] if t[0] == "w" else t[1]), [0.0, 0.0])
                        c[span[0] <= i < span[1]] += n
        keys = sorted(seen)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                          pa.array([seen[k][0] for k in keys], pa.float64()), pa.array([seen[k][1] for k in keys], pa.float64())],
                                         names=["kind", "name", "outside", "inside"])

    sums = (chosen.mapInArrow(counted, "kind string, name string, outside double, inside double").groupBy("kind", "name")
            .agg(F.sum("outside").alias("o"), F.sum("inside").alias("i")).orderBy(F.desc(F.col("o") + F.col("i"))).limit(10_000).collect())
    model = ContentModel()
    for r in sums:
        prior = {"t": model.share, "w": model.word, "h": model.hint}[r["kind"]](r["name"])
        share = (r["i"] + 2 * prior) / (r["i"] + r["o"] + 2)
        {"t": model.tag_inside, "w": model.word_inside, "h": model.hint_inside}[r["kind"]][r["name"]] = share
    trusted = model.trusted()
    prices = [2.0 ** k for k in range(1, 9)]

    def scored(batches):
        for batch in batches:
            own = [(t, s) for page in batch.column(html_col).to_pylist() if (s := labelled_span(t := parse(page, trusted)))]
            for price in prices:
                yield pa.RecordBatch.from_arrays([pa.array([price]), pa.array([_agreement(own, replace(model, price=price)) * len(own)])],
                                                 names=["price", "score"])

    few = chosen.filter(F.pmod(F.xxhash64(F.lit("tune"), html_col), F.lit(1_000_000)) < 1_000_000 * min(1.0, tune / sample))
    got = {r["price"]: round(r["s"], 3) for r in few.mapInArrow(scored, "price double, score double").groupBy("price").agg(F.sum("score").alias("s")).collect()}
    if got and max(got.values()) > 0:
        tied = sorted(p for p in got if got[p] >= max(got.values()) - 1e-6)
        model.price = tied[len(tied) // 2]
    return model


def main_text(pages: DataFrame, model: ContentModel, html_col: str = "html") -> DataFrame:
    """``pages`` without the html, with text (string, empty if none) and n_chars (long, its code points).

    Null counts as empty. The whole page is read, and nothing is cut from its
    region but dropped elements. Columns named text or n_chars are replaced.
    """
    own = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "_html"):
                texts = [extract(page, shared.value) for page in part.column("_html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("_own"), pa.array(texts, pa.string()),
                                                  pa.array(np.array([len(t) for t in texts], np.int64))], names=["_own", "text", "n_chars"])

    work = pages.select(boxed(own), F.col(f"`{html_col}`").alias("_html"))
    schema = work.select("_own", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return work.mapInArrow(run, schema).select(*unboxed(own), "text", "n_chars")
