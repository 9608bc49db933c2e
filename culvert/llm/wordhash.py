"""Words of an Arrow text column as 64-bit hashes, without a Python object per word.

Two words that differ share a hash with a chance of about 2**-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

#: Longer words are hashed one by one.
LONG = 64

_rng = np.random.default_rng(1)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: A-Z become a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)

#: Everything but blank, tab, line feed, vertical tab, form feed and return.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: ASCII letters and digits, and all bytes beyond ASCII.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    kind = np.int64 if large else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.null_count:
        column = column.fill_null("")
        return bytes_of(column)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


@dataclass(frozen=True)
class Words:
    """Of all texts in order: ``hashes``, the ``text`` each word is in, where it ``starts``
    and ``ends`` in the bytes, and ``first``: the number of words before each text and in all."""

    hashes: np.ndarray
    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def per_text(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray, fold: np.ndarray) -> Words:
    inside = in_word[data]
    if len(data):
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cut = offsets[:-1][offsets[:-1] < len(data)]
        begins[cut] = inside[cut]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        last = cut[cut > 0] - 1
        closes[last] = inside[last]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    else:
        starts = ends = np.zeros(0, np.int64)
    lengths = ends - starts
    order = np.argsort(-np.minimum(lengths, LONG + 1).astype(np.int8), kind="stable")
    sizes, at = lengths[order], starts[order]
    h = np.full(len(order), 0x51_7C_C1_B7_27_22_0A_95, np.uint64)
    table = _BYTE[fold]
    # By descending length, those with a byte at this place come first.
    reach = np.searchsorted(-np.minimum(sizes, LONG + 1), -np.arange(LONG + 1), "left").tolist()
    for place, n in enumerate(reach[:LONG]):
        if not n:
            break
        h[:n] = (h[:n] ^ table[data[at[:n] + place]]) * _STEP
    for i in range(reach[LONG]):
        h[i] = xxhash.xxh3_64_intdigest(fold[data[at[i] : at[i] + sizes[i]]].tobytes())
    hashes = np.empty_like(h)
    hashes[order] = mixed(h + sizes.astype(np.uint64))
    first = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(hashes, text, starts, ends, first)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words and how many each text has. A text of fewer words
    is one run, a text without words none."""
    h, n = words.hashes, words.per_text()
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    starts = np.repeat(words.first[:-1], counts) + within(counts)
    out = np.full(len(starts), size, np.uint64)
    lengths = np.repeat(np.minimum(n, size), counts)
    for place in range(size):
        there = place < lengths
        part = h[np.where(there, starts + place, 0)] if len(h) else np.zeros(0, np.uint64)
        out = np.where(there, mixed(out * _STEP + part), out)
    return out, counts


def within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each group."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
