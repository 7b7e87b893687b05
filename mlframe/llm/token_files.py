"""Token ids of a corpus in files of patched frame-of-reference blocks (:mod:`mlframe.llm.pfor`).

Documents are dealt by ranges of their id, sorted within, encoded and
written by the tasks: each part of the range is a row of files whose names
give their order. A file is written under a passing name and then renamed,
and the same task always writes the same files, so a task that runs again
puts the same bytes in the same place. The manifest is a small Parquet table.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from mlframe.llm._text import slices
from mlframe.llm.packing import _byte_names as byte_names
from mlframe.llm.pfor import BLOCK, Reader, Writer
from mlframe.session import scratch_dir

#: Kept pieces of a task's vocabulary; beyond it the cache starts anew.
CACHE_PIECES = 500_000
#: Bytes of text encoded at once: distinct words are looked up once in each slice.
_SLICE = 4 << 20
_MANIFEST = "part int, seq int, file string, first long, n_ids long, n_docs long, n_bytes long"
_ENCODERS: dict[str, PieceEncoder] = {}
_SPACE = regex.compile(r"\s")


class _Letters(dict):
    """Whether a character is a letter to the tokenizer, whose Unicode tables are not those of ``regex``; each is asked once."""

    def __init__(self, split):
        super().__init__({c: c.isalpha() for c in map(chr, range(128))})
        self.split = split

    def __missing__(self, c: str) -> bool:
        self[c] = len(self.split("a" + c)) == 1
        return self[c]


class PieceEncoder:
    """Encodes texts with the ``tokenizers`` library, every distinct piece of a text once.

    ``breaks_at_space`` (found from the tokenizer's own description) says that
    no token holds or crosses ASCII white space and that a piece's ids do not
    depend on its neighbours; else a whole text is one piece. ASCII letters
    and the punctuation after them are further pieces where the description
    splits there, too.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.exact = Tokenizer.from_file(path)
        self.exact.encode_special_tokens = True
        self.breaks_at_space = self._breaks()
        self._byte_names = {b: c for c, b in byte_names().items()}
        self._letters = _Letters(self.exact.pre_tokenizer.pre_tokenize_str) if self.breaks_at_space else {}
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.start, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _breaks(self) -> bool:
        """Whether pieces may be encoded apart: words end in a suffix, white space is dropped, a word is letters only."""
        model = json.loads(self.exact.to_str())
        split = ((model.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        steps = [s.get("type") for s in (model.get("normalizer") or {}).get("normalizers") or []]
        pattern = (split.get("pattern") or {}).get("Regex", "")
        return (split.get("type") == "Split" and split.get("invert") is True and split.get("behavior") == "Removed"
                and pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+") and steps == ["NFC", "Replace", "Lowercase"]
                and bool(model["model"].get("end_of_word_suffix")) and model.get("post_processor") is None)

    def _learn(self, new: list[str]) -> None:
        """Words of letters are normalised together and go through the model alone; other pieces through all steps."""
        plain = [p for p in new if not _SPACE.search(p)]
        names = self.exact.normalizer.normalize_str("\n".join(plain)).split(" ") if plain else []
        if len(names) != len(plain):
            plain, names = [], []
        tokenize, bytes_of, letter = self.exact.model.tokenize, self._byte_names, self._letters.__getitem__
        learned, rest, flat, size = [], [] if plain else new, [], []
        if plain and len(plain) < len(new):
            own = set(plain)
            rest.extend(p for p in new if p not in own)
        for piece, name in zip(plain, names):
            if not name or not all(map(letter, name)):
                rest.append(piece)
                continue
            tokens = tokenize(name if name.isascii() else name.encode().decode("latin-1").translate(bytes_of))
            learned.append(piece)
            size.append(len(tokens))
            flat.extend([t.id for t in tokens])
        for piece, e in zip(rest, self.exact.encode_batch_fast(rest, add_special_tokens=False) if rest else []):
            learned.append(piece)
            size.append(len(e.ids))
            flat.extend(e.ids)
        size = np.array(size, np.int64)
        self.known.update(zip(learned, range(len(self.size), len(self.size) + len(learned))))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, np.array(flat, np.uint32)])

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece; pieces not seen before are learned."""
        found = list(map(self.known.get, pieces))
        new = [p for p, k in zip(pieces, found) if k is None]
        if new:
            self._learn(new)
            found = list(map(self.known.__getitem__, pieces))
        return np.array(found, np.int64)

    def _gather(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the numbered pieces one after the other, and each piece's count."""
        size = self.size[number]
        before = np.cumsum(size) - size
        return self.flat[np.repeat(self.start[number] - before, size) + np.arange(int(size.sum()))], size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (uint32) one after the other, and the count of each text; null is empty."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.breaks_at_space:
            ids = [np.array(self.exact.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts.to_pylist()]
            return np.concatenate(ids), np.array([len(i) for i in ids], np.int64)
        if len(self.known) > CACHE_PIECES:
            self.clear()
        words = pc.ascii_split_whitespace(texts)
        of_text = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))]).astype(np.int64)
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary
        # a combining mark can join an ASCII letter, so only pure ASCII is lowered here
        distinct = pc.if_else(pc.string_is_ascii(distinct), pc.ascii_lower(distinct), distinct)
        pieces = pc.ascii_split_whitespace(pc.replace_substring_regex(distinct, r"([A-Za-z])([.,;:!?)])", r"\1 \2"))
        of_word = np.concatenate([[0], np.cumsum(pc.list_value_length(pieces).to_numpy(zero_copy_only=False))]).astype(np.int64)
        parts = pieces.flatten().dictionary_encode()
        number = self._numbers(parts.dictionary.to_numpy(zero_copy_only=False).tolist())[parts.indices.to_numpy()]
        flat, size = self._gather(number)
        until = np.concatenate([[0], np.cumsum(size)])[of_word]  # ids before each distinct word
        word = coded.indices.to_numpy()
        count = until[word + 1] - until[word]
        before = np.cumsum(count) - count
        ids = flat[np.repeat(until[word] - before, count) + np.arange(int(count.sum()))]
        return ids, np.diff(np.concatenate([[0], np.cumsum(count)])[of_text])


def piece_encoder(path: str) -> PieceEncoder:
    """The encoder of a tokenizer file, one for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def _with_end(ids: np.ndarray, count: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, np.cumsum(count), np.uint32(end_id)), count + 1


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


def _publish(fs: pafs.FileSystem, passing: str, name: str) -> None:
    """Gives a finished file its name; an earlier run of the same task left the same bytes there."""
    try:
        fs.move(passing, name)
    except OSError:
        if fs.get_file_info(name).type != pafs.FileType.File:
            raise
        fs.delete_file(passing)


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str | None = None, end_id: int = 1, id_col: str = "doc_id",
                      text_col: str = "text", part_bytes: int = 64 << 20, file_ids: int = 4 << 20) -> str:
    """Encode all texts and write their ids, documents in ascending id order, under ``path``; returns the path.

    Every document is its ids and ``end_id``; null and empty texts are the end
    id alone. Rows with equal ids keep all their copies, in the order of their
    texts' hashes, and may lie in different parts; null ids come last. Other
    columns are ignored. A part is about ``part_bytes`` of text, a file about
    ``file_ids`` ids (a longer document is not cut). An empty table gives an
    empty manifest. ``path`` must be new.
    """
    spark = docs.sparkSession
    path = path or f"{scratch_dir(spark, 'tokens')}/t"
    fs, root = _file_system(path)
    fs.create_dir(root, recursive=True)
    text = F.col("_text")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))).first()[0]
    parts = max(-(-total // part_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("_id").asc_nulls_last(), F.col("_a"), F.col("_b"), F.col("_row")]
    sorted_rows = (rows.withColumns({"_a": F.xxhash64(text), "_b": F.xxhash64(F.lit(1), text), "_row": F.monotonically_increasing_id()})
                   .repartitionByRange(parts, *order).sortWithinPartitions(*order).select("_id", "_text"))
    kind = to_arrow_type(rows.schema["_id"].dataType)
    manifest = to_arrow_schema(T._parse_datatype_string(_MANIFEST))

    def run(batches):
        fs, root = _file_system(path)
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        encoder, writer, stream, passing = piece_encoder(tokenizer_path), None, None, ""
        names = [f.name for f in manifest]

        def close():
            nonlocal writer, seq, first
            size = writer.finish()
            stream.close()
            name = f"part-{part:07d}-{seq:06d}.pfor"
            _publish(fs, passing, f"{root}/{name}")
            row = (part, seq, name, first, writer.n_ids, writer.n_docs, size)
            first, seq, writer = first + writer.n_ids, seq + 1, None
            return pa.RecordBatch.from_pylist([dict(zip(names, row))], schema=manifest)

        for batch in batches:
            for piece in slices(batch, "_text", _SLICE):
                ids, count = _with_end(*encoder.encode(piece.column("_text")), end_id)
                if writer is None:
                    passing = f"{root}/.passing-{uuid.uuid4().hex}"
                    stream = fs.open_output_stream(passing)
                    writer = Writer(stream, kind)
                writer.add(ids, piece.column("_id").cast(kind), count)
                if writer.n_ids >= file_ids:
                    yield close()
        if writer is not None:
            yield close()

    sorted_rows.mapInArrow(run, _MANIFEST).write.parquet(f"{path}/_manifest")
    return path


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id", id_type: T.DataType | str = "long", keep_ids: bool = False,
                     chunk: int = 256 * BLOCK) -> DataFrame:
    """One row per document of the files: its id, start (ids of all documents before it), n_tokens, ids_crc32 (long), and the ids with ``keep_ids``.

    A task reads a file in chunks of blocks. One number per part (where its
    ids begin) goes to the tasks.
    """
    manifest = spark.read.schema(_MANIFEST).parquet(f"{path}/_manifest")
    sizes = {r["part"]: r["n"] for r in manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    order = np.array(sorted(sizes), np.int64)
    before = np.concatenate([[0], np.cumsum(np.array([sizes[p] for p in order], np.int64))])
    kind = id_type if isinstance(id_type, T.DataType) else T._parse_datatype_string(id_type)
    schema = T.StructType([T.StructField(id_col, kind), *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32")),
                           *([T.StructField("ids", T.ArrayType(T.LongType()))] if keep_ids else [])])

    def one(fs, name: str, base: int):
        with fs.open_input_file(name) as stream:
            reader = Reader(stream)
            docs = reader.documents()
            n = docs.column("n_ids").to_numpy()
            start = np.cumsum(n) - n
            crc = np.zeros(len(n), np.int64)
            held: list[list[np.ndarray]] = [[] for _ in n] if keep_ids else []
            at = 0
            for a in range(0, reader.n_ids, chunk):
                ids = reader.ids(a, a + chunk).astype("<u4")
                while at < len(n) and start[at] < a + chunk:
                    lo, hi = max(start[at], a) - a, min(start[at] + n[at] - a, len(ids))
                    crc[at] = zlib.crc32(ids[lo:hi], int(crc[at]))
                    if keep_ids:
                        held[at].append(ids[lo:hi].astype(np.int64))
                    if start[at] + n[at] > a + chunk:
                        break
                    at += 1
            cols = [docs.column("id").combine_chunks(), pa.array(base + start), pa.array(n), pa.array(crc)]
            if keep_ids:
                cols.append(pa.array([np.concatenate(h) for h in held], pa.list_(pa.int64())))
            yield from pa.Table.from_arrays(cols, names=schema.names).to_batches(max_chunksize=4096)

    def run(batches):
        fs, root = _file_system(path)
        for batch in batches:
            for row in batch.to_pylist():
                yield from one(fs, f"{root}/{row['file']}", int(before[np.searchsorted(order, row["part"])]) + row["first"])

    return manifest.select("part", "file", "first").repartition(max(len(sizes), 1)).mapInArrow(run, schema)
