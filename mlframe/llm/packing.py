"""Shortest-pack-first histogram packing of token sequences.

Documents are cut into full sequences and one rest each; only the histogram
of piece lengths (at most ``capacity`` counts) reaches the driver. Lengths
are placed longest first, each into the packs that are shortest so far,
changing counts of packing patterns and never single packs. Pieces then find
their place by joining their rank within their length with the patterns.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mlframe.llm._text import slices
from mlframe.llm.tables import materialize

_ENCODERS: dict[str, object] = {}
_PROBE = "A probe: don't we'll \t\n  naïve Ωμέγα 日本語 12345 x_y #$%  　 <|endoftext|> \U0001f600 end "
#: GPT-style split before the merges; the same as the tokenizer file's byte-level pre-tokenizer
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: White-space runs of this length go to ``tokenizers``: the pattern's look-ahead keeps a way back for each character of a
#: run, and tiktoken panics when it has a million of them.
_LONG_RUN = 100_000
_RUN = re.compile(r"\s+")


def _has_long_run(text: str) -> bool:
    """Whether ``text`` holds a white-space run of at least ``_LONG_RUN`` characters; linear in the text."""
    return len(text) >= _LONG_RUN and any(m.end() - m.start() >= _LONG_RUN for m in _RUN.finditer(text))


def _byte_names() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str):
    """text -> uint32 ids of the tokenizer file, special strings taken as ordinary text.

    The file's vocabulary is also its merge order, which tiktoken encodes
    several times faster; if that gives other ids for a probe text, the
    ``tokenizers`` library itself is used, as it is for every text with a
    very long white-space run.
    """
    if path not in _ENCODERS:
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(path)
        exact.encode_special_tokens = True

        def slow(text: str) -> np.ndarray:
            return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)

        _ENCODERS[path] = slow
        try:
            import tiktoken

            with open(path, encoding="utf-8") as f:
                model = json.load(f)
            special = {t["content"] for t in model.get("added_tokens") or []}
            names = _byte_names()
            ranks = {bytes(names[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
            fast = tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
            if np.array_equal(fast.encode_ordinary(_PROBE), slow(_PROBE)):
                _ENCODERS[path] = lambda text: slow(text) if _has_long_run(text) else np.array(fast.encode_ordinary(text), np.uint32)
        except (ImportError, KeyError):  # no tiktoken here, or not a byte-level vocabulary
            pass
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens (long), and the ids with ``keep_ids``.

    A document is its ids and ``end_id``, cut every ``capacity`` ids; null
    counts as empty, which leaves the end id alone.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        encode = encoder(tokenizer_path)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for part in slices(batch, text_col):
                row, start, length, crc, total, ids = [], [], [], [], [], []
                for i, text in enumerate(part.column(text_col).to_pylist()):
                    own = np.concatenate([encode(text or ""), end]).astype("<u4")
                    for a in range(0, len(own), capacity):
                        piece = own[a:a + capacity]
                        row.append(i)
                        start.append(a)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        total.append(len(own))
                        if keep_ids:
                            ids.append(piece.astype(np.int32))
                cols = [part.column(id_col).take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    cols, names = [*cols, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    out = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids
    return docs.select(id_col, text_col).mapInArrow(run, out)


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in placing order) and how many packs follow each; every counted piece is placed once.

    Longest lengths first; a piece goes to the packs with the most room left.
    If it fits nowhere, new packs open, each with as many pieces of this
    length as it holds. One length splits at most one group of packs and opens
    at most two, so there are at most 3 * capacity patterns.
    """
    room: dict[int, list[list]] = {}  # room left -> groups [pattern, count]
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} ids for sequences of {capacity}")
        left = histogram[length]
        spaces = sorted(r for r in room if r >= length)
        while left and spaces:
            r = spaces.pop()
            groups = room.pop(r)
            while left and groups:
                pattern, count = groups.pop()
                n = min(count, left)
                if n < count:
                    groups.append([pattern, count - n])
                left -= n
                room.setdefault(r - length, []).append([(*pattern, length), n])
            if groups:
                room[r] = groups
            new = r - length
            at = bisect_right(spaces, new)
            if new >= length and (not at or spaces[at - 1] != new):
                spaces.insert(at, new)
        if left:
            each = capacity // length
            for pattern, n in (((length,) * each, left // each), ((length,) * (left % each), 1)):
                if n and pattern:
                    room.setdefault(capacity - length * len(pattern), []).append([pattern, n])
    return [(tuple(p), n) for r in sorted(room) for p, n in sorted(room[r])]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Per slot range, sorted by (length, first rank): which sequences its ranks fill, and at what offset."""
    rows, used, sequence = [], {}, 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + n
            offset += length
        sequence += n
    rows.sort()
    return dict(zip(("length", "rank", "sequence", "offset"), np.array(rows, np.int64).reshape(-1, 4).T))


def ranked(pieces: DataFrame, id_col: str, rows_each: int = 50_000) -> DataFrame:
    """``pieces`` with rank (long): gapless from 0 within each length, by salted groups of at most about ``rows_each`` rows.

    A group is a hash bucket of one length; small per-group counts give each
    group its first rank, so no task holds all pieces of a common length.
    """
    least = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(id_col, "start"), F.lit(max(least, pieces.count() // rows_each))).cast("int")
    salted = pieces.withColumn("_salt", salt)
    first = (salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_first", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).drop("_n"))
    within = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(id_col, "start", "ids_crc32"))
    return (salted.withColumn("_row", within).join(first, ["length", "_salt"])
            .withColumn("rank", F.col("_first") + F.col("_row") - 1).drop("_salt", "_row", "_first"))


def place(pieces: DataFrame, table: dict[str, np.ndarray]) -> DataFrame:
    """Ranked pieces with sequence_id and offset (long). ``table`` is bounded by the capacity, not by the data."""
    keys = table["length"] << 44 | table["rank"]

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            yield (batch.append_column("sequence_id", pa.array(table["sequence"][at] + rank - table["rank"][at]))
                   .append_column("offset", pa.array(table["offset"][at])))

    return pieces.mapInArrow(run, T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece of all documents: where it lies in which packed sequence.

    Null and empty texts are one piece of the end id. Rows with equal ids are
    packed one by one. Other columns are ignored. An empty table gives an
    empty one.
    """
    pieces = materialize(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, keep_ids), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    table = slots(shortest_pack_first(histogram, capacity))
    return place(ranked(pieces, id_col), table).drop("rank")
