"""Byte-level text kernels shared by the operators of this package.

Everything works on Arrow string columns inside a task: texts are taken in
slices of a MB, so the temporary arrays stay small whatever the batch size
is (one text longer than a slice is a slice of its own and is never cut).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SPACE = 32

#: [\x20\x09-\x0D]
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, every other byte as it is
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_MASK = (1 << 64) - 1


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """The batch in consecutive pieces of about ``limit`` bytes of text (at least one row each)."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts], [*cuts, n]):
        if b > a:
            yield batch.slice(int(a), int(b - a))
    pa.default_memory_pool().release_unused()


def padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with one space after each, and the start of each text (n + 1 values); null is empty."""
    col = pc.binary_join_element_wise(pc.fill_null(column.cast(pa.large_binary()), b""),
                                      pa.scalar(b" ", pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]], off - off[0]


def plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts without anything between them, and the start of each (n + 1 values); null is empty."""
    col = pc.fill_null(column.cast(pa.large_binary()), b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    if off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]], off - off[0]


def words(buf: np.ndarray, off: np.ndarray, separator: np.ndarray):
    """Start and end of every word of a :func:`padded` buffer and the number of words before each text (n + 1)."""
    sep = separator[buf]
    before = np.empty_like(sep)
    before[0], before[1:] = True, sep[:-1]
    start, end = np.flatnonzero(before & ~sep), np.flatnonzero(sep & ~before)
    return start, end, np.searchsorted(start, off)


def squeezed(column: pa.Array, separator: np.ndarray):
    """Texts with A-Z lowered, one space after each word and nothing else between words.

    Returns the bytes, start and end of every word, and the number of words
    before each text (n + 1). ``separator`` must hold the space and no
    lower-case letter.
    """
    buf, off = padded(column)
    low = LOWER[buf]
    sep = separator[low]
    before = np.empty_like(sep)
    before[0], before[1:] = True, sep[:-1]
    starts = np.flatnonzero(before & ~sep)
    text = np.where(sep, np.uint8(SPACE), low)[~sep | ~before]
    end = np.flatnonzero(text == SPACE)
    start = np.concatenate([[0], end[:-1] + 1]).astype(np.int64) if len(end) else end
    return text, start, end, np.searchsorted(starts, off)


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class SpanHash:
    """64-bit hashes of any spans of a byte buffer from one running sum: h(s, e) = sum(v[b_i] * B^i) * B^-s.

    All instances share the base and its tables of powers; each has its own
    random values for the bytes.
    """

    _BASE = 0x9FB21C651E98DF25
    _powers = _inverses = np.ones(1, np.uint64)

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.value = rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)

    @classmethod
    def _grow(cls, n: int) -> None:
        if len(cls._powers) < n:
            n = max(n, 1 << 18)
            up, down = np.full(n, np.uint64(cls._BASE)), np.full(n, np.uint64(pow(cls._BASE, -1, 1 << 64)))
            up[0] = down[0] = 1
            SpanHash._powers, SpanHash._inverses = np.multiply.accumulate(up), np.multiply.accumulate(down)

    def sums(self, buf: np.ndarray) -> np.ndarray:
        """Running sums (n + 1 values) that :meth:`spans` takes."""
        self._grow(len(buf) + 1)
        out = np.empty(len(buf) + 1, np.uint64)
        out[0] = 0
        np.multiply(self.value[buf], self._powers[:len(buf)], out=out[1:])
        np.cumsum(out[1:], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self._inverses[start])


_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * _P2, 31) * _P1


def xxh64(buf: np.ndarray, start: np.ndarray, length: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of the spans buf[start : start + length], all spans at once."""
    if not len(start):
        return np.zeros(0, np.uint64)
    data = np.concatenate([buf, np.zeros(32, np.uint8)])
    u64 = np.ndarray(len(data) - 8, "<u8", data, strides=(1,))
    u32 = np.ndarray(len(data) - 8, "<u4", data, strides=(1,))
    seed = np.uint64(seed)
    at, left = start.astype(np.int64), length.astype(np.int64)
    h = np.full(len(at), (int(seed) + int(_P5)) & _MASK, np.uint64)
    long = np.flatnonzero(left >= 32)
    if len(long):
        s, p1, p2 = int(seed), int(_P1), int(_P2)
        v = [np.full(len(long), x & _MASK, np.uint64) for x in (s + p1 + p2, s + p2, s, s - p1)]
        p, rest, live = at[long], left[long], np.arange(len(long))
        while len(live):
            q = p[live]
            for k in range(4):
                v[k][live] = _round(v[k][live], u64[q + 8 * k])
            p[live] += 32
            rest[live] -= 32
            live = live[rest[live] >= 32]
        x = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for k in range(4):
            x = (x ^ _round(np.zeros_like(x), v[k])) * _P1 + _P4
        h[long], at = x, at.copy()
        at[long], left[long] = p, rest
    h += length.astype(np.uint64)
    for _ in range(3):
        i = np.flatnonzero(left >= 8)
        if not len(i):
            break
        lane = u64[at[i]]
        h[i] = _rotl(h[i] ^ _round(np.zeros_like(lane), lane), 27) * _P1 + _P4
        at[i] += 8
        left[i] -= 8
    i = np.flatnonzero(left >= 4)
    if len(i):
        h[i] = _rotl(h[i] ^ (u32[at[i]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        at[i] += 4
        left[i] -= 4
    for _ in range(3):
        i = np.flatnonzero(left >= 1)
        if not len(i):
            break
        h[i] = _rotl(h[i] ^ (data[at[i]].astype(np.uint64) * _P5), 11) * _P1
        at[i] += 1
        left[i] -= 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))
