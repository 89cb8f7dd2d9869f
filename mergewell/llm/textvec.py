"""Whole-array text scanning: words, 64-bit word hashes and word shingles of Arrow string columns.

A string column is viewed as its UTF-8 bytes, so a batch of texts is scanned by a few numpy passes instead of a Python
loop over words. All word definitions used here treat every byte from 0x80 up alike, which makes the byte view exact.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Word bytes: everything but ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Word bytes: digits, a to z and all of a non-ASCII character, after lower-casing.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_SLOTS = 64
_rng = np.random.Generator(np.random.PCG64(20240229))
_TABLE = _rng.integers(0, 2**64, size=_SLOTS * 256, dtype=U64)
_ODD = _rng.integers(0, 2**64, size=64, dtype=U64) | U64(1)
_LENGTHS = _rng.integers(0, 2**64, size=64, dtype=U64)
_FAR = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every input bit over all output bits."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets into them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, most_bytes: int = 1 << 20, most_rows: int = 1024) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows lo to hi, their bytes and offsets, in pieces of bounded size. A longer text is a piece of its own."""
    data, offsets = text_bytes(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + most_rows, n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Words:
    """Words of a piece: starts and ends (bytes), first (index of each text's first word, and the total), hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kept: np.ndarray, lower: bool = True):
        data = LOWER[data] if lower else data
        mask = kept[data]
        first = mask.copy()
        first[1:] &= ~mask[:-1]
        inner = offsets[:-1][offsets[:-1] < len(data)]
        first[inner] = mask[inner]
        last = mask.copy()
        last[:-1] &= ~mask[1:]
        outer = offsets[1:][offsets[1:] > 0] - 1
        last[outer] = mask[outer]
        self.data, self.mask = data, mask
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self._hashes: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = span_hashes(self.data[self.mask], self.ends - self.starts)
        return self._hashes

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def span_hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of adjoining byte spans: the sum of a random number for each byte at each place, then mixed."""
    if not len(lengths):
        return np.zeros(0, U64)
    begin = np.cumsum(lengths) - lengths
    at = np.arange(len(data), dtype=np.int32 if len(data) < 2**31 else np.int64)
    at -= np.repeat(begin.astype(at.dtype), lengths)
    longest = int(lengths.max())
    far = None
    if longest > _SLOTS:
        powers = np.cumprod(np.full(longest // _SLOTS + 1, _FAR, U64))
        powers[1:], powers[0] = powers[:-1].copy(), U64(1)
        far = powers[at // _SLOTS]
        at %= _SLOTS
    at <<= 8
    at += data
    parts = _TABLE[at]
    if far is not None:
        parts *= far
    return mix(np.add.reduceat(parts, begin) + lengths.astype(U64) * _FAR)


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of width words and the text of each. Fewer words than that make one run; none make none."""
    count = np.diff(first)
    texts = np.arange(len(count))
    total = np.zeros(max(0, len(hashes) - width + 1), U64)
    for j in range(width):
        total += hashes[j : len(hashes) - width + 1 + j] * _ODD[j]
    inside = np.zeros(len(hashes) + 1, np.int8)
    full = count >= width
    np.add.at(inside, first[:-1][full], 1)
    np.add.at(inside, first[1:][full] - width + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    out, of = mix(total[at]) if len(at) else np.zeros(0, U64), np.repeat(texts[full], count[full] - width + 1)
    short = np.flatnonzero((count > 0) & ~full)
    if len(short):
        value = [np.sum(np.append(hashes[first[t] : first[t + 1]] * _ODD[: count[t]], _LENGTHS[count[t]]), dtype=U64) for t in short]
        out, of = np.concatenate([out, mix(np.array(value, U64))]), np.concatenate([of, short])
    return out, of


def distinct_by_text(hashes: np.ndarray, of: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct hashes, ascending, without the lowest bits that number the text; and the text of each."""
    bits = U64(10 if n_texts <= 1024 else int(n_texts - 1).bit_length())
    key = np.sort((of.astype(U64) << (U64(64) - bits)) | (hashes >> bits))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    return key & ((U64(1) << (U64(64) - bits)) - U64(1)), (key >> (U64(64) - bits)).astype(np.int64)


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column of values, counts to a row."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def give_back() -> None:
    """Frees the memory that this Python worker, which goes on to live, no longer uses."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which the worker gives back memory."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
