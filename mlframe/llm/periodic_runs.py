"""Periodic runs of words, found in a Re-Pair grammar of each document.

A run is a stretch of words of smallest period q that is at least
``min_words`` and ``exponent * q`` words long and that no neighbouring word
extends. Tasks work on slices of whole documents:

1. *Grammar.* Word ids are unique to their document, so all documents of a
   slice are paired at once. Every round replaces the most frequent pairs: an
   occurrence is replaced where its pair is more frequent than the pairs that
   overlap it. Pairs that occur once are never looked at again, so rounds
   shrink with what still repeats. What remains are rules X -> Y Z and one
   sequence per document, in which no pair repeats.
2. *Boundaries.* A run lies across the middle of the smallest rule that holds
   it (or across a boundary of its document's sequence). Each rule is looked
   at once, at its first occurrence and within its own words; rules shorter
   than ``min_words`` hold no run. Half a run lies on one side of the boundary,
   so the words next to it come again one period further on: candidates are
   equal word groups at that distance, for groups of 4, 8, 16, ... words.
3. *Derivation.* A rule's runs are moved to all its occurrences, and intervals
   of one period that overlap by a period or more become one.

Equal hashes only propose candidates and extensions; every run is compared
word by word before it counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlframe.llm._text import SPACE, WHITE, mix, padded, slices, words, xxh64

_ODD = np.uint64(0x9E3779B97F4A7C15)
_FIRST_GROUP = 4
#: Candidate pairs looked at together.
_CHUNK = 1 << 20


def _word_ids(buf: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Numbers that are equal for equal words of one document, and for nothing else."""
    h = mix(xxh64(buf, start, end - start, 1) + mix(doc.astype(np.uint64) * _ODD))
    order = np.argsort(h, kind="stable")
    sorted_h, size = h[order], (end - start)[order]
    new = np.ones(len(h), bool)
    new[1:] = sorted_h[1:] != sorted_h[:-1]
    # words that share a hash must be equal byte by byte; else they are told apart below
    same = np.flatnonzero(~new)
    wrong = (size[same] != size[same - 1]) | (doc[order[same]] != doc[order[same - 1]])
    a, b, n = start[order[same]], start[order[same - 1]], size[same]
    live = np.flatnonzero(~wrong)
    k = 0
    while len(live):
        live = live[n[live] > k]
        differ = buf[a[live] + k] != buf[b[live] + k]
        wrong[live[differ]] = True
        live, k = live[~differ], k + 1
    if wrong.any():
        names: dict[tuple[int, bytes], int] = {}
        return np.array([names.setdefault((d, buf[s:e].tobytes()), len(names)) for d, s, e in zip(doc.tolist(), start.tolist(), end.tolist())], np.int64)
    out = np.empty(len(h), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


class Grammar:
    """Re-Pair of all documents of a slice: rules with their occurrences, and the boundaries of the final sequences.

    ``rules``: (first word, words of the left part, words) of every rule of at
    least ``least`` words, ``places``: all its occurrences' first words, rule
    by rule, with ``counts``; ``joints``: word positions between neighbours in
    the final sequences.
    """

    def __init__(self, ids: np.ndarray, doc: np.ndarray, least: int):
        n = len(ids)
        self.rounds = 0
        symbol, at, size = ids.copy(), np.arange(n), np.ones(n, np.int64)
        own = doc.copy()
        nxt = int(ids.max()) + 1 if n else 0
        rules, places, counts = [], [], []
        # left elements of the pairs that may still repeat
        live = np.flatnonzero(own[1:] == own[:-1]) if n else np.zeros(0, np.int64)
        while len(live):
            key = symbol[live] * np.int64(nxt) + symbol[live + 1]
            order = np.argsort(key, kind="stable")
            k = key[order]
            cut = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
            times = np.diff(np.concatenate([cut, [len(k)]]))
            number = np.empty(len(k), np.int64)
            number[order] = np.repeat(np.arange(len(cut)), times)
            freq = times[number]
            again = freq > 1
            live, number, freq = live[again], number[again], freq[again]
            if not len(live):
                break
            self.rounds += 1
            # by frequency, then by a mixed number: equal pairs, and no others, are equal
            rank = (freq.astype(np.uint64) << np.uint64(40)) | mix(number.astype(np.uint64) * _ODD) & np.uint64(0xFF00000000) | number.astype(np.uint64)
            touch = live[1:] == live[:-1] + 1
            left = np.zeros(len(live), np.uint64)
            right = np.zeros(len(live), np.uint64)
            left[1:][touch] = rank[:-1][touch]
            right[:-1][touch] = rank[1:][touch]
            # a run of one pair (a a a a): every second occurrence, from its left end on
            head = ~(np.concatenate([[False], touch]) & (left == rank))
            place = np.arange(len(live)) - np.maximum.accumulate(np.where(head, np.arange(len(live)), 0))
            stretch = np.concatenate([np.flatnonzero(head), [len(live)]])
            first, last = np.repeat(left[stretch[:-1]], np.diff(stretch)), np.repeat(right[stretch[1:] - 1], np.diff(stretch))
            chosen = (place % 2 == 0) & (rank > first) & (rank > last)
            # a stretch overlapped by a better pair at one end may still give its inner occurrences
            length = np.repeat(np.diff(stretch), np.diff(stretch))
            inner = (length > 2) & ~((rank > first) & (rank > last)) & (place % 2 == 1) & (place < length - 1)
            chosen |= inner
            pick = live[chosen]
            kind, code = np.unique(number[chosen], return_inverse=True)
            new_size = size[pick] + size[pick + 1]
            by_rule = np.argsort(code, kind="stable")
            starts = np.searchsorted(code[by_rule], np.arange(len(kind)))
            lead = pick[by_rule[starts]]
            long = new_size[by_rule[starts]] >= least
            if long.any():
                use = long[code[by_rule]]
                rules.append(np.stack([at[lead], size[lead], size[lead] + size[lead + 1]], 1)[long])
                places.append(at[pick[by_rule[use]]])
                counts.append(np.bincount(code, minlength=len(kind))[long])
            symbol[pick] = nxt + code
            nxt += len(kind)
            size[pick] = new_size
            gone = np.zeros(len(symbol), bool)
            gone[pick + 1] = True
            new = np.zeros(len(symbol), bool)
            new[pick] = True
            may = np.zeros(len(symbol), bool)
            may[live[~chosen]] = True
            may &= ~gone
            keep = ~gone
            symbol, at, size, own, new, may = symbol[keep], at[keep], size[keep], own[keep], new[keep], may[keep]
            # pairs next to a new symbol are new; other pairs live on if they repeated before
            beside = new.copy()
            beside[:-1] |= new[1:]
            inside = np.zeros(len(symbol), bool)
            inside[:-1] = own[1:] == own[:-1]
            live = np.flatnonzero((may | beside) & inside)
            if nxt >= 1 << 31:
                _, symbol = np.unique(symbol, return_inverse=True)
                nxt = int(symbol.max()) + 1
        self.rules = np.concatenate(rules) if rules else np.zeros((0, 3), np.int64)
        self.places = np.concatenate(places) if places else np.zeros(0, np.int64)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.joints = at[1:][own[1:] == own[:-1]] if n else np.zeros(0, np.int64)


class _Extender:
    """Longest common extensions of two word positions by hashes of word groups, within given limits."""

    def __init__(self, ids: np.ndarray):
        v = mix(ids.astype(np.uint64) * _ODD + _ODD)
        self.base = np.uint64(0xD6E8FEB86659FD93)
        power = np.full(len(v) + 1, self.base)
        power[0] = 1
        self.power = np.multiply.accumulate(power)
        self.sums = np.zeros(len(v) + 1, np.uint64)
        np.cumsum(v * self.power[:-1], out=self.sums[1:])

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether ids[a : a + n] and ids[b : b + n] have equal hashes (a <= b)."""
        return (self.sums[a + n] - self.sums[a]) * self.power[b - a] == self.sums[b + n] - self.sums[b]

    def group(self, at: np.ndarray, n: int) -> np.ndarray:
        """A number for the n words at each place, equal for equal words."""
        return (self.sums[at + n] - self.sums[at]) * self.power[len(self.power) - 1 - at]

    def forward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words are equal from a and b > a on, at most ``most``."""
        lo, hi = np.zeros(len(a), np.int64), most.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            ok = self.equal(a, b, mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        return lo

    def backward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words are equal before a and b > a, at most ``most``."""
        lo, hi = np.zeros(len(a), np.int64), most.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            ok = self.equal(a - mid, b - mid, mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        return lo


def _crossing(ids: np.ndarray, spans: np.ndarray, least: int, exponent: int):
    """(span number, start, end, period) of the stretches across the boundaries; ``spans`` has (first, boundary, end) rows.

    All maximal stretches within a span that hold its boundary, have the
    period and are long enough; a period that is a multiple of a smaller one
    may be among them.
    """
    lcp = _Extender(ids)
    n, out = len(ids), []
    size, at = _FIRST_GROUP, np.arange(max(len(ids) - _FIRST_GROUP + 1, 0))
    most = int((spans[:, 2] - spans[:, 0]).max(initial=0))
    while len(at):
        g = lcp.group(at, size)
        order = np.lexsort((at, g))
        g, places = g[order], at[order]
        same = g[1:] == g[:-1]
        again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        g, places = g[again], places[again]
        if not len(g):
            break
        names = np.cumsum(np.concatenate([[0], g[1:] != g[:-1]]))
        keyed = names * np.int64(n + 1) + places
        name_of = np.full(n + 1, -1, np.int64)
        name_of[places] = names
        near, far = (1, 4 * size) if size == _FIRST_GROUP else (2 * size, 4 * size)  # near <= period < far
        for side in (0, 1):
            anchor = spans[:, 1] if side == 0 else spans[:, 1] - size
            fits = (anchor >= spans[:, 0]) & (anchor + size <= spans[:, 2])
            span = np.flatnonzero(fits)
            anchor = anchor[span]
            known = name_of[anchor] >= 0
            span, anchor = span[known], anchor[known]
            if side == 0:  # the group right of the boundary comes again to the right
                low, high = anchor + near, np.minimum(anchor + far, spans[span, 2] - size + 1)
            else:  # the group left of it came before
                low, high = np.maximum(anchor - far + 1, spans[span, 0]), anchor - near + 1
            name = name_of[anchor] * np.int64(n + 1)
            a = np.searchsorted(keyed, name + np.clip(low, 0, n))
            b = np.searchsorted(keyed, name + np.clip(high, 0, n))
            count = np.where(high > low, np.maximum(b - a, 0), 0)
            found = np.flatnonzero(count)
            span, anchor, a, count = span[found], anchor[found], a[found], count[found]
            part = (np.cumsum(count) - count) // _CHUNK
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(span)]
            for u, w in zip(cuts, cuts[1:]):
                if w <= u:
                    continue
                c = count[u:w]
                before = np.cumsum(c) - c
                other = places[np.repeat(a[u:w] - before, c) + np.arange(int(c.sum()))]
                who, own = np.repeat(span[u:w], c), np.repeat(anchor[u:w], c)
                t, period = np.minimum(own, other), np.abs(own - other)
                lo, hi = spans[who, 0], spans[who, 2]
                start = t - lcp.backward(t, t + period, t - lo)
                end = t + period + lcp.forward(t, t + period, hi - t - period)
                right = (end - start >= np.maximum(least, exponent * period)) & (start <= spans[who, 1]) & (end >= spans[who, 1])
                out.append(np.stack([who, start, end, period], 1)[right])
        # a group twice as long repeats only where both its halves do
        size *= 2
        if 2 * size * exponent > most:
            break
        half = size // 2
        twin = np.zeros(n + 1, bool)
        twin[places] = True
        at = np.sort(places)
        at = at[at + size <= n]
        at = at[twin[at + half]]
    return np.concatenate(out) if out else np.zeros((0, 4), np.int64)


def _distinct(rows: np.ndarray) -> np.ndarray:
    return np.unique(rows, axis=0) if len(rows) else rows


def _smallest_period(rows: np.ndarray) -> np.ndarray:
    """Of sorted rows with equal (span, start, end) the one with the smallest period."""
    if not len(rows):
        return rows
    return rows[np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(1)])]


def _confirmed(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The (span, start, end, period) rows whose words do have the period."""
    ok = np.ones(len(rows), bool)
    checked: dict[tuple[int, int, int], bool] = {}
    for i, (_, s, e, q) in enumerate(rows.tolist()):
        if (s, e, q) not in checked:
            checked[s, e, q] = bool((ids[s:e - q] == ids[s + q:e]).all())
        ok[i] = checked[s, e, q]
    return rows[ok]


def _stretches(ids: np.ndarray, periods: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """The runs of one document among the given periods, word by word; only for the case that unequal words had equal hashes."""
    out: dict[tuple[int, int], int] = {}
    for q in np.unique(periods).tolist():
        same = np.concatenate([[False], ids[q:] == ids[:-q], [False]])
        for a, b in np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2).tolist():
            if b + q - a >= max(least, exponent * q):
                out.setdefault((a, b + q), q)
    return np.array([(a, b, q) for (a, b), q in out.items()], np.int64).reshape(-1, 3)


def find_runs(ids: np.ndarray, doc: np.ndarray, least: int = 24, exponent: int = 3) -> np.ndarray:
    """(start, end, period) of all runs, by start and period; ``ids`` are numbers of words, unique to their document ``doc`` (ascending)."""
    if least < 6 * _FIRST_GROUP or exponent < 3:
        raise ValueError(f"runs of at least {6 * _FIRST_GROUP} words and 3 periods")
    none = np.zeros((0, 3), np.int64)
    if len(ids) < least:
        return none
    grammar = Grammar(ids, doc, least)
    first = np.searchsorted(doc, doc, side="left")
    last = np.searchsorted(doc, doc, side="right")
    joints = grammar.joints
    rules = grammar.rules
    spans = np.concatenate([
        np.stack([rules[:, 0], rules[:, 0] + rules[:, 1], rules[:, 0] + rules[:, 2]], 1),
        np.stack([first[joints], joints, last[joints]], 1)])
    every = _distinct(_crossing(ids, spans, least, exponent))
    found = _smallest_period(every)
    if not len(found):
        return none
    sound = _confirmed(ids, found)
    if len(sound) < len(found):  # an extension went too far; no equal words are ever missed, so the periods are all there
        parts = [none]
        for d in np.unique(doc[every[:, 1]]):
            a, b = np.searchsorted(doc, [d, d + 1])
            parts.append(_stretches(ids[a:b], every[doc[every[:, 1]] == d, 3], least, exponent) + [a, a, 0])
        return _ordered(np.concatenate(parts))
    # a rule's runs at all its occurrences
    in_rule = sound[:, 0] < len(rules)
    moved = sound[in_rule]
    before = np.cumsum(grammar.counts) - grammar.counts
    times = grammar.counts[moved[:, 0]]
    which = np.repeat(np.arange(len(moved)), times)
    place = grammar.places[np.repeat(before[moved[:, 0]] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))]
    shift = place - rules[moved[which, 0], 0]
    rows = np.concatenate([np.stack([moved[which, 1] + shift, moved[which, 2] + shift, moved[which, 3]], 1), sound[~in_rule][:, 1:]])
    return _ordered(_merged(rows))


def _merged(rows: np.ndarray) -> np.ndarray:
    """Intervals of one period that overlap by a period or more as one."""
    rows = _distinct(rows)
    order = np.lexsort((rows[:, 1], rows[:, 0], rows[:, 2]))
    s, e, q = rows[order].T
    out: list[list[int]] = []
    for a, b, p in zip(s.tolist(), e.tolist(), q.tolist()):
        if out and out[-1][2] == p and a + p <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b, p])
    return np.array(out, np.int64).reshape(-1, 3)


def _ordered(rows: np.ndarray) -> np.ndarray:
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _without(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words stay: a word goes if any run holds it after that run's first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


_RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def periodic_runs(docs: DataFrame, text_col: str = "text", min_words: int = 24, exponent: int = 3, slice_bytes: int = 1 << 20) -> DataFrame:
    """``docs`` without the text, with n_words (long), runs (array of start, length, period in words) and collapsed (string).

    Words are what white space ([\\x20\\x09-\\x0D]) separates, numbered from 0 in
    each document. Runs come by start, then period. ``collapsed`` is the words
    joined by one space, without those that lie in a run after its first
    period. Null and empty texts have no words and an empty ``collapsed``.
    Columns with the result's names are replaced; no column needs to be unique.
    """
    new = ("n_words", "runs", "collapsed")
    own = [c for c in docs.columns if c not in (text_col, *new)]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("own"), F.col(f"`{text_col}`").cast("string").alias("text")) if own else \
        docs.select(F.struct(F.lit(0).alias("_")).alias("own"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["own"], T.StructField("n_words", T.LongType()), T.StructField("runs", _RUNS), T.StructField("collapsed", T.StringType())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", slice_bytes):
                yield _answer(part)

    def _answer(part: pa.RecordBatch) -> pa.RecordBatch:
        buf, off = padded(part.column("text"))
        start, end, until = words(buf, off, WHITE)
        n = np.diff(until)
        doc = np.repeat(np.arange(len(n)), n)
        found = find_runs(_word_ids(buf, start, end, doc), doc, min_words, exponent)
        stay = _without(len(doc), found)
        # kept words with one space after each
        s, size = start[stay], (end - start)[stay] + 1
        to = np.concatenate([[0], np.cumsum(size)])
        text = buf[np.repeat(s - to[:-1], size) + np.arange(int(to[-1]))]
        text[to[1:] - 1] = SPACE
        kept = np.concatenate([[0], np.cumsum(stay)])[until]
        a, b = to[kept[:-1]], to[kept[1:]] - (kept[1:] > kept[:-1])  # no space after the last word
        use = np.ones(len(text), bool)
        use[b[kept[1:] > kept[:-1]]] = False
        offsets = np.concatenate([[0], np.cumsum(b - a)])
        collapsed = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text[use].tobytes())).cast(pa.string())
        base = until[doc[found[:, 0]]] if len(found) else found[:, 0]
        runs = pa.StructArray.from_arrays([pa.array(found[:, 0] - base), pa.array(found[:, 1] - found[:, 0]), pa.array(found[:, 2])],
                                          names=["start", "length", "period"])
        per_doc = np.concatenate([[0], np.cumsum(np.bincount(doc[found[:, 0]] if len(found) else found[:, 0], minlength=len(n)))]).astype(np.int32)
        return pa.RecordBatch.from_arrays([part.column("own"), pa.array(n.astype(np.int64)), pa.ListArray.from_arrays(pa.array(per_doc), runs), collapsed],
                                          names=["own", *new])

    answer = rows.mapInArrow(run, schema)
    return answer.select("own.*", *new) if own else answer.select(*new)
