"""Benchmark decontamination as a prefix-filtered set join.

A benchmark window (``n`` consecutive words of an item, or the whole item if
it is shorter) is a set of word shingles. A document that contains the window
contains all of them, so one necessary prefix token is enough to find every
candidate place: the window's rarest shingle, by counts over all documents.
Each place where it occurs fixes where the window would start (positional
bound) and end (length bound); the words there are then compared exactly.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlframe.llm._text import SpanHash, mix, slices, squeezed
from mlframe.llm.tables import boxed, materialize, unboxed

#: [\x00-\x2F\x3A-\x60\x7B-\x7F] after A-Z became a-z
NOT_WORD = np.zeros(256, bool)
NOT_WORD[0x00:0x30] = NOT_WORD[0x3A:0x61] = NOT_WORD[0x7B:0x80] = True

_HASH = SpanHash(9)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def word_shingles(text, start, end, first, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words that lies in one text, and its first word."""
    if len(start) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    own = _HASH.spans(_HASH.sums(text), start, end)
    h = own[:len(own) - size + 1].copy()
    for k in range(1, size):
        h = h * _STEP + own[k:len(own) - size + 1 + k]
    inside = np.ones(len(h), bool)
    for k in range(1, size):  # no run may cross into the next text
        edge = first[1:-1] - k
        inside[edge[(edge >= 0) & (edge < len(h))]] = False
    at = np.flatnonzero(inside)
    return mix(h[at]), at


def item_windows(items: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(window, items): distinct windows as space-joined words, and the sorted ids (strings) of the items that have it."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                text, start, end, first = squeezed(part.column(text_col), NOT_WORD)
                ids, out = part.column("_id").to_pylist(), []
                for d, name in enumerate(ids):
                    a, b = int(first[d]), int(first[d + 1])
                    for w in range(a, max(b - n, a) + 1 if b > a else a):
                        out.append((text[start[w]:end[min(w + n, b) - 1]].tobytes().decode(), name))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string())],
                                                 names=["window", "item"])

    named = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("_id"), text_col)
    return named.mapInArrow(run, "window string, item string").groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


class _Block:
    """A bounded block of windows with each window's necessary prefix token."""

    def __init__(self, windows: list[tuple[str, list[str]]], shingle: int):
        self.text = [w.encode() for w, _ in windows]
        self.items = [i for _, i in windows]
        self.n = np.array([w.count(b" ") + 1 for w in self.text], np.int64)
        self.size = np.minimum(self.n, shingle)
        parts = []
        for size in np.unique(self.size):
            own = np.flatnonzero(self.size == size)
            text, start, end, first = squeezed(pa.array([windows[i][0] for i in own], pa.string()), NOT_WORD)
            h, at = word_shingles(text, start, end, first, int(size))
            win = np.searchsorted(first, at, side="right") - 1
            parts.append((h, own[win], at - first[win]))
        self.hash, self.window, self.offset = (np.concatenate(x) for x in zip(*parts))
        self.tokens = np.unique(self.hash)
        self.sizes = [int(s) for s in np.unique(self.size)]

    def choose(self, count: dict[int, int]) -> None:
        """Keep one token per window: the rarest in the corpus (ties: smaller hash, earlier place)."""
        seen = np.array([count.get(int(t), 0) for t in self.tokens], np.int64)[np.searchsorted(self.tokens, self.hash)]
        order = np.lexsort((self.offset, self.hash, seen, self.window))
        head = order[np.unique(self.window[order], return_index=True)[1]]
        head = head[np.argsort(self.hash[head], kind="stable")]
        self.hash, self.window, self.offset = self.hash[head], self.window[head], self.offset[head]
        self.tokens = np.unique(self.hash)

    def sieve(self) -> np.ndarray:
        bits = np.zeros(1 << 20, bool)
        bits[self.tokens >> np.uint64(44)] = True
        return bits


def _found(h: np.ndarray, tokens: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """Places of ``h`` whose value is one of the sorted ``tokens``."""
    maybe = np.flatnonzero(sieve[h >> np.uint64(44)])
    at = np.minimum(np.searchsorted(tokens, h[maybe]), len(tokens) - 1)
    return maybe[tokens[at] == h[maybe]]


def _token_counts(docs: DataFrame, block: _Block, text_col: str) -> dict[int, int]:
    """How often each of the block's tokens occurs in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast((block.tokens, block.sieve(), block.sizes))

    def run(batches):
        tokens, sieve, sizes = shared.value
        total = np.zeros(len(tokens), np.int64)
        for batch in batches:
            for part in slices(batch, text_col):
                cut = squeezed(part.column(text_col), NOT_WORD)
                for size in sizes:
                    h, _ = word_shingles(*cut, size)
                    np.add.at(total, np.searchsorted(tokens, h[_found(h, tokens, sieve)]), 1)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(tokens[own].view(np.int64)), pa.array(total[own])], names=["token", "n"])

    rows = docs.select(text_col).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n")).collect()
    return {int(t) & ((1 << 64) - 1): n for t, n in rows}


_SPANS = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))


def _match(docs: DataFrame, block: _Block, text_col: str) -> DataFrame:
    """``docs`` with the block's hit word spans and items added to _spans and _items, and _n_words."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        b = shared.value
        sieve = b.sieve()
        for batch in batches:
            for part in slices(batch, text_col):
                cut = text, start, end, first = squeezed(part.column(text_col), NOT_WORD)
                spans: list[dict] = [{} for _ in range(part.num_rows)]
                for size in b.sizes:
                    h, at = word_shingles(*cut, size)
                    for i in _found(h, b.tokens, sieve):
                        doc = int(np.searchsorted(first, at[i], side="right")) - 1
                        for k in range(*np.searchsorted(b.hash, [h[i], h[i]], side="left").tolist()[:1],
                                       int(np.searchsorted(b.hash, h[i], side="right"))):
                            w = int(b.window[k])
                            s = int(at[i] - b.offset[k])
                            e = s + int(b.n[w])
                            if b.size[w] == size and s >= first[doc] and e <= first[doc + 1] \
                                    and text[start[s]:end[e - 1]].tobytes() == b.text[w]:
                                spans[doc][s - int(first[doc]), e - int(first[doc])] = w
                old_spans, old_items = part.column("_spans").to_pylist(), part.column("_items").to_pylist()
                new_spans = [o + [{"a": x, "b": y} for x, y in sorted(s)] for o, s in zip(old_spans, spans)]
                new_items = [sorted({*o, *(i for w in s.values() for i in b.items[w])}) for o, s in zip(old_items, spans)]
                kept = [part.column(c) for c in part.schema.names if c not in ("_spans", "_items", "_n_words")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(new_spans, part.schema.field("_spans").type), pa.array(new_items, pa.list_(pa.string())),
                     pa.array(np.diff(first))],
                    names=[c for c in part.schema.names if c not in ("_spans", "_items", "_n_words")] + ["_spans", "_items", "_n_words"])

    return docs.mapInArrow(run, docs.schema)


def contamination(docs: DataFrame, items: DataFrame, n: int = 13, shingle: int = 5, block_windows: int = 200_000,
                  id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` without their text (or with it), with what of them lies in benchmark windows.

    Added: n_words, n_hit (words inside any occurrence of a window), n_items
    and item_ids (items with an occurring window, ids as sorted strings),
    spans (the occurrences as word ranges [a, b)). Columns with these names
    are replaced. Null and empty texts have no words; items without words or
    without an id have no windows; items with equal windows all count; rows
    with equal ids are judged one by one. Without windows nothing is hit.

    Windows are broadcast in blocks of at most ``block_windows`` (about 100
    bytes each), one pass over the documents per block, so a benchmark of any
    size fits; with several blocks the passes are cut by written tables.
    """
    new = ("n_words", "n_hit", "n_items", "item_ids", "spans")
    keep = [c for c in docs.columns if c not in (*new, text_col)]
    work = docs.select(boxed(keep), F.col(f"`{text_col}`").alias("_text"), F.array().cast(_SPANS).alias("_spans"),
                       F.array().cast("array<string>").alias("_items"), F.lit(0).cast("long").alias("_n_words"))
    windows = materialize(item_windows(items, n, item_id, item_text), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    for i in range(blocks):
        own = windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == i) if blocks > 1 else windows
        rows = sorted((r["window"], r["items"]) for r in own.collect())
        block = _Block(rows, shingle) if rows else None
        if block is None:
            if blocks > 1:
                continue
            block = _Block([("\x00", [])], shingle)  # no document has this word: only words are counted
        block.choose(_token_counts(work, block, "_text") if rows else {})
        work = _match(work, block, "_text")
        if i + 1 < blocks:
            work = materialize(work, "contamination")
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    hit = F.aggregate(F.array_sort("_spans"), start, lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["reach"]))).alias("n"), F.greatest(s["reach"], x["b"]).alias("reach")),
        lambda s: s["n"].cast("long"))
    found = work.select("_own", "_text", F.col("_n_words").alias("n_words"), hit.alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
                        F.col("_items").alias("item_ids"), F.col("_spans").alias("spans"))
    return found.select(*unboxed(keep), *([F.col("_text").alias(text_col)] if keep_text else []), *new)



def is_contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """At least a twentieth of the words is hit."""
    return (F.col(n_hit) > 0) & (F.col(n_hit) * 20 >= F.col(n_words))
