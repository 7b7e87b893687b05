"""Exact repeated-substring removal by distributed prefix-free parsing.

A byte is removed if it lies in a string of ``length`` bytes that also starts
earlier in the corpus (documents in id order, matches inside documents only).

1. *Parse.* A rolling hash of ``trigger`` bytes marks triggers: the smallest
   hash of every window of ``length`` bytes. Consecutive windows with the same
   trigger form a phrase; it holds all bytes of its windows. As a window's
   trigger depends on its bytes alone, equal strings lie in phrases with equal
   triggers, at equal distances from them.
2. *Dictionary.* Phrases meet by trigger. Of equal phrases all but the first
   in corpus order are repeated as a whole; highly repetitive text ends here,
   with one row per phrase instead of one per byte.
3. *Suffix order.* Different phrases with the same trigger can still share
   strings where a repeat begins or ends. The suffixes of these dictionary
   phrases, cut at ``length`` bytes, are sorted within each trigger's group by
   128 bits of fingerprint; equal ones are neighbours in corpus order, and all
   but the first are repeated. Order among different strings has no say in the
   result, so fingerprints replace byte order.
4. *Cut.* Removed spans meet their documents.

Tasks keep one row per different phrase (of each part of their input) and
mark the other copies themselves. A trigger with very many different surroundings is split by
phrase, each part sorts its own suffixes, and one more round by fingerprint
joins the parts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mlframe.llm._text import SpanHash, mix, plain, slices
from mlframe.llm.tables import boxed, in_corpus_order, materialize

_TRIGGER, _PHRASE, _SUFFIX, _SUFFIX2 = (SpanHash(s) for s in (71, 72, 73, 74))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_LOW = np.uint64(0xFFFFFFFF)
#: Bytes of text hashed at once, and phrases that a task keeps before it sorts and hands them on.
_SLICE, _HELD = 1 << 19, 1 << 19
#: Parts of a trigger with very many surroundings.
_PARTS = 64


def phrases(buf: np.ndarray, off: np.ndarray, length: int, trigger: int):
    """Trigger hash, phrase hash, text number, first window (in the text), windows before the trigger, and window count of each phrase."""
    n, width = len(buf), length - trigger + 1
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    at = np.arange(n - trigger + 1)
    h = _TRIGGER.spans(_TRIGGER.sums(buf), at, at + trigger)
    least, span = (h & _HIGH) | at.astype(np.uint64), 1  # the leftmost of equal hashes
    while 2 * span <= width:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    count = n - length + 1
    least = np.minimum(least[:count], least[width - span:width - span + count])
    sizes = np.diff(off)
    whole = np.maximum(sizes - length + 1, 0)  # windows of each text
    begin = np.cumsum(whole) - whole
    text = np.repeat(np.arange(len(sizes)), whole)
    window = off[:-1][text] + np.arange(len(text)) - begin[text]
    found = (least[window] & _LOW).astype(np.int64)
    if not len(found):
        return phrases(buf[:0], off, length, trigger)
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    lo, anchor, text = window[first], found[first], text[first]
    windows = np.diff(np.concatenate([first, [len(found)]]))
    back = anchor - lo
    own = mix(_PHRASE.spans(_PHRASE.sums(buf), lo, lo + windows - 1 + length) + back.astype(np.uint64) * _ODD)
    return h[anchor], own, text, lo - off[text], back, windows


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (count[0] values), start[1], ..."""
    before = np.cumsum(count) - count
    return np.repeat(start - before, count) + np.arange(int(count.sum()))


class _Parser:
    """What the tasks need to know: the lengths, and the triggers that are dealt out in parts."""

    def __init__(self, length: int, trigger: int, hot: np.ndarray):
        self.length, self.trigger, self.bits = length, trigger, length.bit_length()
        self.hot = np.sort(hot)
        parts = self.hot[:, None] + np.arange(1, _PARTS + 1, dtype=np.uint64)[None, :] * _ODD
        self.parts = np.sort(mix(parts.ravel()))

    def dealt(self, trigger: np.ndarray, phrase: np.ndarray) -> np.ndarray:
        """The group of each phrase: its trigger, or a part of it."""
        if not len(self.hot):
            return trigger
        part = mix(trigger + (phrase % np.uint64(_PARTS) + np.uint64(1)) * _ODD)
        return np.where(np.isin(trigger, self.hot), part, trigger)

    def pack(self, lo, back, windows):
        return (lo << 2 * self.bits) | (back << self.bits) | windows

    def unpack(self, packed):
        low = (1 << self.bits) - 1
        return packed >> 2 * self.bits, (packed >> self.bits) & low, packed & low

    def read(self, batches):
        """The phrases of a task in parts of about ``_HELD``: group, phrase, doc, packed place."""
        out, n = [], 0
        for batch in batches:
            for part in slices(batch, "_text", _SLICE):
                buf, off = plain(part.column("_text"))
                t, p, text, lo, back, windows = phrases(buf, off, self.length, self.trigger)
                doc = part.column("_doc").to_numpy()
                out.append([self.dealt(t, p), p, doc[text], self.pack(lo, back, windows)])
                n += len(t)
                if n >= _HELD:
                    yield [np.concatenate(x) for x in zip(*out)]
                    out, n = [], 0
        if n:
            yield [np.concatenate(x) for x in zip(*out)]


def _changes(*cols: np.ndarray) -> np.ndarray:
    new = np.ones(len(cols[0]), bool)
    if len(new):
        new[1:] = False
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
    return new


def _hot_triggers(docs: DataFrame, length: int, trigger: int, least: int, each: int, most: int = 10_000) -> np.ndarray:
    """Triggers with at least ``least`` different phrases in the parts of tasks that have ``each``: only a hint for dealing them out.

    Any choice gives the same result, so the list may be cut at ``most``.
    """
    parser = _Parser(length, trigger, np.zeros(0, np.uint64))

    def run(batches):
        for t, p, _, _ in parser.read(batches):
            order = np.lexsort((p, t))
            t, p = t[order], p[order]
            t = t[_changes(t, p)]
            value, n = np.unique(t, return_counts=True)
            own = n >= each
            yield pa.RecordBatch.from_arrays([pa.array(value[own].view(np.int64)), pa.array(n[own])], names=["t", "n"])

    found = docs.mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    rows = found.orderBy(F.desc("n"), "t").limit(most).collect()
    return np.array([r["t"] for r in rows], np.int64).view(np.uint64)


_MARK = "repeat boolean, grp long, doc long, place long"


def _parse(docs: DataFrame, parser: _Parser) -> DataFrame:
    """(grp, phrase, doc, place): one row per different phrase of a task's part; its other copies have place < 0 and a random group."""

    def run(batches):
        for g, p, doc, place in parser.read(batches):
            order = np.lexsort((place, doc, p, g))
            g, p, doc, place = (x[order] for x in (g, p, doc, place))
            again = ~_changes(g, p)
            g[again] = mix(doc[again].view(np.uint64) * _ODD + place[again].view(np.uint64))
            place[again] = ~place[again]
            for a in range(0, len(g), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[a:a + 100_000].view(np.int64)) for x in (g, p, doc, place)],
                                                 names=["grp", "phrase", "doc", "place"])

    return docs.mapInArrow(run, "grp long, phrase long, doc long, place long")


def _meet(parsed: DataFrame, parser: _Parser) -> DataFrame:
    """Repeated phrases (repeat), and first phrases whose trigger has others too (not repeat); the rest is unique."""

    def judged(g, p, doc, place):
        decided = place < 0
        new = _changes(g, p)
        starts = np.flatnonzero(_changes(g))
        contexts = np.add.reduceat(new.astype(np.int64), starts)
        many = np.repeat(contexts > 1, np.diff(np.concatenate([starts, [len(g)]])))
        if len(parser.parts):
            many |= np.isin(g.view(np.uint64), parser.parts)
        repeat = decided | ~new
        keep = np.flatnonzero(repeat | many)
        place = np.where(decided, ~place, place)
        g = np.where(repeat, 0, g)  # a repeat is only cut; its group is not needed any more
        yield pa.RecordBatch.from_arrays([pa.array(repeat[keep]), *(pa.array(x[keep]) for x in (g, doc, place))],
                                         names=["repeat", "grp", "doc", "place"])

    def run(batches):
        held = None
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("grp", "phrase", "doc", "place")]
            if held:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            last = int(np.searchsorted(cols[0], cols[0][-1]))  # the last group may go on
            if last:
                yield from judged(*(c[:last] for c in cols))
            held = [c[last:] for c in cols]
        if held:
            yield from judged(*held)

    return parsed.repartition("grp").sortWithinPartitions("grp", "phrase", "doc", "place").mapInArrow(run, _MARK)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside it is a lambda's variable, which nothing inlines."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _bytes_of(docs: DataFrame, reps: DataFrame, parser: _Parser) -> DataFrame:
    """(grp, doc, lo, back, phrase bytes) of the given dictionary phrases."""
    wanted = reps.groupBy("doc").agg(F.collect_list(F.struct("grp", "place")).alias("want"))
    texts = docs.join(wanted, docs["_doc"] == wanted["doc"]).select("doc", "want", F.col("_text").cast("binary").alias("_bytes"))
    low = F.lit((1 << parser.bits) - 1)

    def cell(w, data):
        lo = F.shiftright(w["place"], 2 * parser.bits)
        size = w["place"].bitwiseAND(low) + F.lit(parser.length - 1)
        return F.struct(w["grp"].alias("grp"), lo.alias("lo"), F.shiftright(w["place"], parser.bits).bitwiseAND(low).alias("back"),
                        F.substring(data, (lo + 1).cast("int"), size.cast("int")).alias("bytes"))

    cells = _let(F.col("_bytes"), lambda data: F.transform("want", lambda w: cell(w, data)))
    return texts.select("doc", F.explode(cells).alias("c")).select("c.grp", "doc", "c.lo", "c.back", "c.bytes")


def _suffix_order(cells: DataFrame, parser: _Parser, chunk: int = 20_000) -> DataFrame:
    """(kind, doc, a, b, c): kind 0: bytes [a, b) are repeated; kind 1: string with fingerprint (a, b) at c is its part's first."""
    length = parser.length

    def ordered(cells: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(cells).combine_chunks()
        g, doc, lo, back = (rows.column(c).to_numpy() for c in ("grp", "doc", "lo", "back"))
        buf, off = plain(rows.column("bytes").combine_chunks())
        windows = np.diff(off) - length + 1
        cell = np.repeat(np.arange(len(g)), windows)
        start = _ranges(off[:-1], windows)
        distance = back[cell] - (start - off[:-1][cell])
        w1 = _SUFFIX.spans(_SUFFIX.sums(buf), start, start + length)
        w2 = _SUFFIX2.spans(_SUFFIX2.sums(buf), start, start + length)
        key = mix(w1 + mix(g.view(np.uint64)[cell] + distance.astype(np.uint64) * _ODD))
        order = np.argsort(key, kind="stable")  # stable: equal suffixes stay in corpus order
        same = ~_changes(key[order], w2[order])
        again = np.zeros(len(key), bool)
        again[order[same]] = True
        edge = np.diff(np.concatenate([[False], again, [False]]).astype(np.int8))
        # a run of repeated suffixes of one phrase is one span
        cuts = np.flatnonzero((edge[:-1] == 1) | (again & _changes(cell)))
        stops = np.flatnonzero(again & np.concatenate([~again[1:] | (cell[1:] != cell[:-1]), [True]])) if len(again) else cuts
        own = cell[cuts]
        a = lo[own] + start[cuts] - off[:-1][own]
        b = lo[own] + start[stops] - off[:-1][own] + length
        yield _rows(np.zeros(len(a), np.int32), doc[own], a, b, a)
        if len(parser.parts):
            first = np.flatnonzero(~again & np.isin(g.view(np.uint64), parser.parts)[cell])
            own = cell[first]
            yield _rows(np.ones(len(first), np.int32), doc[own], w1[first].view(np.int64), w2[first].view(np.int64),
                        lo[own] + start[first] - off[:-1][own])

    def _rows(*cols):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", "doc", "a", "b", "c"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n < chunk:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            g = rows.column("grp").to_numpy()
            last = int(np.searchsorted(g, g[-1]))
            if last:
                yield from ordered(rows.slice(0, last).to_batches())
            rows = rows.slice(last)
            held, n = rows.to_batches(), rows.num_rows
        if held:
            yield from ordered(held)

    return (cells.repartition("grp").sortWithinPartitions("grp", "doc", "lo")
            .mapInArrow(run, "kind int, doc long, a long, b long, c long"))


def repeated_spans(docs: DataFrame, length: int = 100, hot_contexts: int = 100_000, hot_in_task: int = 32) -> DataFrame:
    """(doc, spans array<struct<a long, b long>>) of all byte ranges to remove; ``docs`` has unique long _doc and _text.

    Spans may overlap. Documents without any are not in the result.
    """
    trigger = max(1, length // 4)
    parser = _Parser(length, trigger, _hot_triggers(docs, length, trigger, hot_contexts, hot_in_task))
    marks = materialize(_meet(_parse(docs, parser), parser), "phrases")
    back, low = 2 * parser.bits, (1 << parser.bits) - 1
    lo = F.shiftright("place", back)
    whole = marks.filter("repeat").select("doc", lo.alias("a"), (lo + F.col("place").bitwiseAND(F.lit(low)) + F.lit(length - 1)).alias("b"))
    found = _suffix_order(_bytes_of(docs, marks.filter("NOT repeat"), parser), parser)
    if len(parser.hot):
        found = materialize(found, "suffixes")
    spans = whole.unionByName(found.filter("kind = 0").select("doc", "a", "b"))
    if len(parser.hot):
        nth = F.row_number().over(Window.partitionBy("a", "b").orderBy("doc", "c"))
        late = found.filter("kind = 1").withColumn("nth", nth).filter("nth > 1")
        spans = spans.unionByName(late.select("doc", F.col("c").alias("a"), (F.col("c") + length).alias("b")))
    return spans.groupBy("doc").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def _cut(texts: DataFrame, as_text: bool) -> DataFrame:
    """Adds kept, n_bytes, n_removed, n_spans and the merged spans to rows with _text and spans.

    Of one document, spans that start later end later, so sorted neighbours
    tell where a run of overlapping spans begins and ends.
    """
    none = F.array().cast("array<struct<a:long,b:long>>")

    def joined(found):
        first = F.filter(found, lambda x, i: F.coalesce(x["a"] > F.get(found, i - 1)["b"], F.lit(True)))
        last = F.filter(found, lambda x, i: F.coalesce(F.get(found, i + 1)["a"] > x["b"], F.lit(True)))
        return F.zip_with(first, last, lambda x, y: F.struct(x["a"].alias("a"), y["b"].alias("b")))

    d = texts.withColumn("spans", _let(F.sort_array(F.coalesce("spans", none)), joined))

    def cut(data, runs):
        size = F.octet_length(data).cast("long")
        inside = lambda p: F.hex(F.substring(data, (p + 1).cast("int"), F.lit(1))).between("80", "BF")

        def down(p):  # to the start of the character that holds byte p
            return F.when(~inside(p), p).when(~inside(p - 1), p - 1).when(~inside(p - 2), p - 2).otherwise(p - 3)

        def up(p):  # to the start of the next character
            return F.when(~inside(p), p).when(~inside(p + 1), p + 1).when(~inside(p + 2), p + 2).otherwise(p + 3)

        def piece(i):
            a = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(runs, i - 1)["b"])
            b = F.coalesce(F.get(runs, i)["a"], size)
            if as_text:
                a, b = F.when(i == 0, a).otherwise(up(a)), F.when(i == F.size(runs), b).otherwise(down(b))
            return F.substring(data, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int")).cast("string")

        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(runs)), piece), "")

    kept = _let(F.col("_text").cast("binary"), lambda data: _let(F.col("spans"), lambda runs: cut(data, runs)))
    kept = F.when(F.size("spans") == 0, F.col("_text")).otherwise(kept)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["b"] - x["a"])
    return d.withColumns({"kept": kept if as_text else kept.cast("binary"), "n_bytes": F.coalesce(F.octet_length("_text").cast("long"), F.lit(0)),
                          "n_removed": removed, "n_spans": F.size("spans").cast("long")})


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text",
                   hot_contexts: int = 100_000, hot_in_task: int = 32, as_text: bool = False) -> DataFrame:
    """``docs`` without the text, with kept (binary, or a string without cut characters with ``as_text``), n_bytes, n_removed, n_spans (long) and spans (merged, sorted byte ranges).

    Null and empty texts have no bytes (kept is null or empty); texts shorter than ``length`` lose
    none. Corpus order is id order; rows with equal or null ids come in the
    order of their texts, null ids last, so a repeated row is a later copy.
    Columns with the result's names are replaced. ``kept`` may begin or end
    inside a character, as bytes are judged. An empty table gives an empty one.
    """
    new = ("kept", "n_bytes", "n_removed", "n_spans", "spans")
    own = [c for c in docs.columns if c not in (text_col, *new)]
    base, _ = in_corpus_order(docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), boxed(own)), "_id", "_text")
    base = base.select("_doc", "_text", "_own")
    spans = repeated_spans(base, length, hot_contexts, hot_in_task)
    cut_in = base.join(spans, base["_doc"] == spans["doc"], "left").drop("doc")
    return _cut(cut_in, as_text).select("_own.*", *new)
