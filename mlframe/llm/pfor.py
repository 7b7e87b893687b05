"""Patched frame-of-reference blocks for token ids, in a file that is its own index.

A file holds blocks of up to 1,024 ids, then the table of its documents (an
Arrow stream: id, n_ids), the place of every block, and a footer of fixed
size. A block subtracts its minimum and packs the differences at the width
of one of its percentiles, the one that makes the block smallest; larger
differences are exceptions, listed as positions and values. Packing is by 16
lanes of 64 values, so numpy packs all blocks of one width at once.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

BLOCK = 1024
_LANES = BLOCK // 64
MAGIC = b"PFORIDS1"
#: least id, ids in the block, width in bits, exceptions
_HEAD = np.dtype([("least", "<u4"), ("count", "<u2"), ("width", "u1"), ("zero", "u1"), ("exceptions", "<u4")])
#: ids, documents, start of the document table, start of the index, blocks, magic
_FOOT = struct.Struct("<QQQQQ8s")
PERCENTILES = (0.5, 0.75, 0.9, 0.95, 0.98, 1.0)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of every value (0 for 0)."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """(k, 1024) values below 2^width as (k, width * 16) words."""
    v = rows.astype(np.uint64).reshape(-1, 64, _LANES)
    out = np.zeros((len(v), width, _LANES), np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[:, word] |= v[:, j] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= v[:, j] >> np.uint64(64 - shift)
    return out.reshape(len(v), width * _LANES)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The inverse of :func:`_pack`."""
    w = words.reshape(-1, width, _LANES)
    out = np.empty((len(w), 64, _LANES), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        value = w[:, word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (w[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = value & mask
    return out.reshape(len(w), BLOCK).astype(np.uint32)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """The blocks of ``ids`` (uint32) in order; the last one may be short, and is filled up with its minimum."""
    if not len(ids):
        return []
    n = -(-len(ids) // BLOCK)
    counts = np.full(n, BLOCK, np.int64)
    counts[-1] = len(ids) - BLOCK * (n - 1)
    rows = np.concatenate([ids, np.full(n * BLOCK - len(ids), ids[BLOCK * (n - 1):].min(), np.uint32)]).reshape(n, BLOCK)
    least = rows.min(1)
    diff = rows - least[:, None]
    bits = _bits(diff)
    sizes = np.sort(bits, axis=1)
    choices = sizes[:, [int(np.ceil(p * BLOCK)) - 1 for p in PERCENTILES]]
    larger = np.stack([(sizes > c[:, None]).sum(1) for c in choices.T], axis=1)
    width = choices[np.arange(n), (choices.astype(np.int64) * (BLOCK // 8) + larger * 6).argmin(1)]
    patched = bits > width[:, None]
    at_row, at = np.nonzero(patched)
    value = diff[at_row, at].astype("<u4")
    first = np.searchsorted(at_row, np.arange(n + 1))
    low = np.where(patched, 0, diff)
    packed: list[bytes] = [b""] * n
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            for i, words in zip(own, _pack(low[own], int(w)).astype("<u8")):
                packed[i] = words.tobytes()
    head = np.zeros(n, _HEAD)
    head["least"], head["count"], head["width"], head["exceptions"] = least, counts, width, np.diff(first)
    at = at.astype("<u2")
    return [head[i].tobytes() + packed[i] + at[first[i]:first[i + 1]].tobytes() + value[first[i]:first[i + 1]].tobytes() for i in range(n)]


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks; ``starts`` are their places in ``data``."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    head = np.concatenate([np.frombuffer(data, _HEAD, 1, int(s)) for s in starts])
    width, out = head["width"].astype(np.int64), np.zeros((len(head), BLOCK), np.uint32)
    body = starts + _HEAD.itemsize
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            words = np.stack([np.frombuffer(data, "<u8", int(w) * _LANES, int(body[i])) for i in own])
            out[own] = _unpack(words, int(w))
    tail = body + width * (BLOCK // 8)
    for i in np.flatnonzero(head["exceptions"]):
        k = int(head["exceptions"][i])
        at = np.frombuffer(data, "<u2", k, int(tail[i]))
        out[i, at] = np.frombuffer(data, "<u4", k, int(tail[i]) + 2 * k)
    out += head["least"][:, None]
    if (head["count"] == BLOCK).all():
        return out.ravel()
    return out[np.arange(BLOCK)[None, :] < head["count"][:, None]]


class Writer:
    """Writes one file to an open binary stream; memory is a few hundred blocks, the index and the document table."""

    def __init__(self, stream, id_type: pa.DataType, chunk: int = 256 * BLOCK):
        self.stream, self.id_type, self.chunk = stream, id_type, chunk
        self.at, self.n_ids, self.n_docs = len(MAGIC), 0, 0
        self.starts, self.held, self.n_held, self.tables = [], [], 0, []
        stream.write(MAGIC)

    def add(self, ids: np.ndarray, doc_ids: pa.Array, lengths: np.ndarray) -> None:
        """The ids of further documents, one after the other."""
        self.tables.append(pa.RecordBatch.from_arrays([doc_ids, pa.array(lengths, pa.int64())], names=["id", "n_ids"]))
        self.n_ids += len(ids)
        self.n_docs += len(doc_ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.chunk:
            self._flush(self.n_held // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate([np.zeros(0, np.uint32), *self.held])
        for a in range(0, n, self.chunk):
            for block in encode_blocks(ids[a:min(a + self.chunk, n)]):
                self.starts.append(self.at)
                self.at += len(block)
                self.stream.write(block)
        self.held, self.n_held = [ids[n:]], len(ids) - n

    def finish(self) -> int:
        """Writes the rest, the document table, the index and the footer; returns the file's size."""
        self._flush(self.n_held)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("id", self.id_type), ("n_ids", pa.int64())])) as out:
            for t in self.tables:
                out.write_batch(t)
        docs = sink.getvalue().to_pybytes()
        index = np.array(self.starts, "<u8").tobytes()
        foot = _FOOT.pack(self.n_ids, self.n_docs, self.at, self.at + len(docs), len(self.starts), MAGIC)
        self.stream.write(docs + index + foot)
        return self.at + len(docs) + len(index) + len(foot)


class Reader:
    """Reads a file through a seekable stream: the documents, and the ids of any range by the block index."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        if size < len(MAGIC) + _FOOT.size:
            raise ValueError("not a token file: too short")
        self.n_ids, self.n_docs, self._docs_at, self._index_at, blocks, magic = _FOOT.unpack(self._bytes(size - _FOOT.size, _FOOT.size))
        if magic != MAGIC:
            raise ValueError("not a token file: no footer")
        self.starts = np.frombuffer(self._bytes(self._index_at, 8 * blocks), "<u8").astype(np.int64)

    def _bytes(self, at: int, n: int) -> bytes:
        self.stream.seek(at)
        data = self.stream.read(n)
        if len(data) != n:
            raise ValueError("token file ends early")
        return data

    def documents(self) -> pa.Table:
        """id and n_ids of every document, in order."""
        return pa.ipc.open_stream(self._bytes(self._docs_at, self._index_at - self._docs_at)).read_all()

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids [start, stop) of the file; only the blocks that hold them are read."""
        start, stop = max(start, 0), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = start // BLOCK, -(-stop // BLOCK)
        end = int(self.starts[b]) if b < len(self.starts) else self._docs_at
        data = self._bytes(int(self.starts[a]), end - int(self.starts[a]))
        return decode_blocks(data, self.starts[a:b] - self.starts[a])[start - a * BLOCK:stop - a * BLOCK]
