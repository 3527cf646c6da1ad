"""Words of whole texts as byte spans, many texts at a time.

A word is a run of bytes of one table. Bytes beyond ASCII are word bytes in every table here, so runs of bytes are runs of
characters. A-Z become a-z, other letters stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: texts of about so many bytes are looked at together; a longer text is looked at alone
CHUNK_BYTES = 4 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_bytes(digits: bool) -> np.ndarray:
    """Which bytes belong to words, after lower-casing: a-z, bytes beyond ASCII and, if asked for, 0-9."""
    out = np.zeros(256, bool)
    out[97:123] = True
    out[128:] = True
    if digits:
        out[48:58] = True
    return out


@dataclass
class Words:
    """Words of some texts in order: the text of each, its bytes from ``start`` to ``end`` of the joined texts, and its
    code in ``distinct`` (the different words)."""

    first_row: int
    offsets: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    distinct: pa.BinaryArray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of bytes, and where each begins (one more entry than texts); null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw, at


def words_of(column: pa.Array, table: np.ndarray) -> Iterator[Words]:
    """The words of a column of texts, in chunks of whole texts."""
    raw, at = joined(column)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(at, at[row] + CHUNK_BYTES, "right")) - 1)
        yield _chunk(raw[at[row]:at[last]], at[row:last + 1] - at[row], row, table)
        row = last


def _chunk(raw: np.ndarray, offsets: np.ndarray, first_row: int, table: np.ndarray) -> Words:
    low = LOWER[raw]
    inside = np.zeros(len(low) + 1, bool)
    inside[:-1] = table[low]
    word = inside[:-1]
    # a word begins after another byte or with its text, and ends likewise
    begins, ends = word.copy(), word & ~inside[1:]
    begins[1:] &= ~word[:-1]
    edges = offsets[:-1][(offsets[:-1] < len(low)) & (np.diff(offsets) > 0)]
    begins[edges] = word[edges]
    before = edges[edges > 0] - 1
    ends[before] = word[before]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    bounds = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=bounds[1:])
    packed = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(low[word])])
    coded = packed.dictionary_encode()
    return Words(first_row, offsets, np.searchsorted(offsets, start, "right") - 1, start, end,
                 coded.indices.to_numpy(), coded.dictionary)


# odd, so that it has an inverse modulo 2**64
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def finished(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte string, the same wherever it stands; unequal strings may share one."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    if not len(words):
        return np.empty(0, np.uint64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.empty(0, np.uint8)
    at = at - at[0]
    sizes = np.diff(at)
    # sum of byte * base ** (distance from the word's first byte)
    place = np.arange(len(raw), dtype=np.int64) - np.repeat(at[:-1], sizes)
    part = _powers(int(sizes.max(initial=0)))[place] * (raw.astype(np.uint64) + np.uint64(1))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(part, dtype=np.uint64, out=total[1:])
    return finished((total[at[1:]] - total[at[:-1]]) ^ finished(sizes.astype(np.uint64) + np.uint64(seed)))
