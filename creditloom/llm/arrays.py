"""Texts of Arrow batches as numpy arrays: words, their hashes, and hashes of word n-grams.

All functions work on the UTF-8 bytes of many texts at once. A hash of a word is a polynomial over its bytes
modulo 2**64, a hash of words one over theirs, both mixed at the end; equal words give equal hashes on every
executor, as all constants are fixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text that are turned into arrays at a time: few enough for the arrays to stay in the processor's caches.
CHUNK = 1 << 18

CHUNK_BITS = 18

_random = np.random.default_rng(20)
BYTE_CODES = _random.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
WORD_BASE, GRAM_BASE = (U64(int(x) * 2 + 1) for x in _random.integers(1 << 60, 1 << 62, 2))

#: The bytes that separate words: space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `most` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        row = 0
        while row < batch.num_rows:
            begun = ends[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, begun + most, side="right")))
            yield batch.slice(row, stop - row)
            row = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the offsets where they begin and end. A null text is empty."""
    column = pa.concat_arrays([pc.fill_null(column, "").cast(pa.large_string())])
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; and the number of the first run of each text, with the total."""
    size = len(inside)
    if not size:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    begins, ends = inside.copy(), inside.copy()
    edges = offsets[(offsets > 0) & (offsets < size)]
    begins[1:] &= ~inside[:-1]
    begins[edges] = inside[edges]
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return runs(~SPACE[data], offsets)


@lru_cache(maxsize=2)  # for the two bases; a longer text replaces what is there
def powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2**bits powers of an odd base modulo 2**64, and those of its inverse."""
    inverse = U64(pow(base, -1, 1 << 64))
    out = []
    for x in (U64(base), inverse):
        factors = np.full(1 << bits, x, U64)
        factors[0] = 1
        out.append(np.multiply.accumulate(factors))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the word: the finishing steps of the public SplitMix64 generator."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _sums(codes: np.ndarray, base: U64, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial over codes[start:end] of each range, before mixing."""
    up, down = powers(int(base), max(CHUNK_BITS, int(len(codes) - 1).bit_length()))
    total = np.zeros(len(codes) + 1, U64)
    np.cumsum(codes * up[: len(codes)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A hash of the bytes of each range, one of two independent ones. Ranges ascend and don't overlap."""
    out = np.zeros(len(starts), U64)
    at = 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, side="right")))
        low = starts[at]
        codes = BYTE_CODES[which][data[low : ends[stop - 1]]]
        out[at:stop] = mix(_sums(codes, WORD_BASE, starts[at:stop] - low, ends[at:stop] - low))
        at = stop
    return out


def gram_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the word hashes of each range; ranges may overlap."""
    return mix(_sums(hashes, GRAM_BASE, starts, ends))


def gram_starts(first: np.ndarray, size: int) -> np.ndarray:
    """The words at which an n-gram of `size` words begins that doesn't leave its text."""
    left = np.repeat(first[1:], np.diff(first)) - np.arange(first[-1])
    return np.flatnonzero(left >= size)


def distinct_per_text(values: np.ndarray, texts: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct values of each text, one after another; and where those of each text begin."""
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(texts[order], kind="stable")]
    values, texts = values[order], texts[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    return values[new], np.searchsorted(texts[new], np.arange(count + 1))
