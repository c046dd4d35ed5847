"""Words and word shingles of Arrow text columns, as arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def byte_class(separators: bytes) -> np.ndarray:
    """True for every byte that belongs to a word."""
    table = np.ones(256, bool)
    table[np.frombuffer(separators, np.uint8)] = False
    return table


# What separates words.  Bytes from 0x80 on are parts of non-ASCII
# characters, which always belong to words.
BLANK_SEPARATED = byte_class(bytes([0x20, *range(0x09, 0x0E)]))
LETTERS_DIGITS = byte_class(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int) -> np.ndarray:
    """An odd number for each of ``n`` places, without a rule between them.

    Powers of one number would let whole families of strings collide modulo 2**64,
    the longer ones of Thue and Morse among them.
    """
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


@dataclass
class Words:
    """The words of a block of texts: lower-cased bytes, spans in them, hashes, and
    for each text the range of its words."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # one more entry than texts


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut an Arrow string column into blocks: first row, bytes, and offsets in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, raw[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at]
        at = to


def split_words(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Words:
    low = LOWER[raw]
    mask = inside[low]
    before = np.zeros(len(mask) + 1, bool)
    before[1:] = mask
    before[offsets] = False  # a word ends with its text
    start = np.flatnonzero(mask & ~before[:-1])
    if not len(start):
        none = np.zeros(0, np.int64)
        return Words(low, none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    after = np.zeros(len(mask) + 1, bool)
    after[:-1] = mask
    after[offsets] = False
    end = np.flatnonzero(mask & ~after[1:]) + 1
    size = end - start
    # Only bytes of words take part, so a word's bytes follow one another.
    begin = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(begin, size)
    value = (low[mask].astype(np.uint64) + np.uint64(1)) * multipliers(int(size.max()))[place]
    hashed = mix(np.add.reduceat(value, begin) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return Words(low, start, end, hashed, np.searchsorted(start, offsets))


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """One hash per ``n`` consecutive words; shorter sequences, but not empty ones, give one."""
    n = min(n, len(hashes))
    if n == 0:
        return hashes
    weight = multipliers(n)
    total = np.full(len(hashes) - n + 1, np.uint64(n), np.uint64)
    for j in range(n):
        total += hashes[j: len(hashes) - n + 1 + j] * weight[j]
    return mix(total)


def shingles_of_rows(rows: np.ndarray) -> np.ndarray:
    """One hash per row of hashes."""
    weight = multipliers(rows.shape[1])
    return mix((rows * weight).sum(axis=1, dtype=np.uint64) + np.uint64(rows.shape[1]))
