"""Texts in Arrow batches: bounded chunks, words as byte ranges, hashes of ranges.

All work on UTF-8 bytes, a chunk of documents at a time, without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer document is a chunk of its own.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of up to ``limit`` bytes of text, or one row."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        texts = pc.fill_null(batch.column(at).cast(pa.string()), "")
        batch = batch.set_column(at, column, texts)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < len(ends):
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and the ``n + 1`` places where they begin and end."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_table(inside) -> np.ndarray:
    """256 booleans: which bytes ``inside`` accepts."""
    return np.array([bool(inside(b)) for b in range(256)])


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of the longest runs of ``inside`` bytes, and for each text the number of runs before it."""
    hit = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = hit.copy()
    begins[1:] &= ~hit[:-1] | edge[1:-1]
    ends = hit.copy()
    ends[:-1] &= ~hit[1:] | edge[1:-1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return begins, ends, np.searchsorted(begins, offsets)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        got = np.full(max(n, CHUNK_BYTES + 1), base, np.uint64)
        got[0] = 1
        _POWERS[base] = got = np.multiply.accumulate(got)
    return got


class RangeHash:
    """64-bit hashes of byte ranges; equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data) + 1)[: len(data)], out=sums[1:])
        self._sums, self._back = sums, _powers(_INVERSE, len(data) + 1)

    def __call__(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[begins]) * self._back[begins] + (ends - begins).astype(np.uint64))


#: Bytes that are compared at once.
KEY_BYTES = 8

# By the number of bytes left in a word: which bytes of a key belong to it.
_INSIDE = np.array([0, *(((1 << 8 * n) - 1) << 8 * (KEY_BYTES - n) for n in range(1, KEY_BYTES + 1))], np.uint64)


class Keys:
    """Eight bytes of a word as one number that orders like the bytes; zeros behind the word's end.

    A word without zero bytes has ended in a key whose last byte is zero.
    """

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(KEY_BYTES, np.uint8)])
        self._at = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))

    def __call__(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        left = ends - begins
        return self._at[np.where(left > 0, begins, 0)].byteswap() & _INSIDE[np.clip(left, 0, KEY_BYTES)]


def strings(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as an Arrow array of strings."""
    sizes = ends - begins
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    picked = data[np.repeat(begins - offsets[:-1], sizes) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(picked))
