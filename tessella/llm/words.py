"""Vectorised word and shingle hashing over the UTF-8 bytes of Arrow string columns.

A word's hash is a polynomial over random 64-bit byte values, computed for all words of a block with a handful of
numpy passes; no Python object is made per word.  Blocks are cut at word ends, so a text of any length needs memory
for one block of bytes and for its word hashes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at once.
BLOCK = 1 << 18

_RANDOM = np.random.default_rng(20240229)
#: A random odd value for each byte; A-Z share those of a-z.
BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BYTE_VALUE[65:91] = BYTE_VALUE[97:123]
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POSITION = np.uint64(0xD6E8FEB86659FD93)

#: [\x20\x09-\x0D] separate the words of a text.
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (nulls are empty) and the offsets of its rows in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in turn, in pieces of about BLOCK bytes of a string column; a longer text is in one piece."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = np.flatnonzero(np.diff(ends // BLOCK)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ends)], strict=True):
        yield batch.slice(a, b - a)


def powers(n: int, base: np.uint64 = _POSITION) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def blocks(data: np.ndarray, breaks: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of about BLOCK bytes that end before a break byte or at the end."""
    at = 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data):
            found = np.flatnonzero(breaks[data[end : end + BLOCK]])
            if len(found):
                end += int(found[0])
                break
            end = min(end + BLOCK, len(data))
        yield at, end
        at = end


@lru_cache(maxsize=4)
def _both_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(size), powers(size, np.uint64(pow(int(_POSITION), -1, 1 << 64)))


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all words, and the hash of each; a row's end is a word's end too.

    Running sums of value * power give a word's polynomial as a difference, shifted back to its start.
    """
    starts, hashes = [], []
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    for at, end in blocks(data, breaks):
        part = data[at:end]
        inside = ~breaks[part]
        begin, close = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1] | first[at + 1 : end]
        close[:-1] &= ~inside[1:] | first[at + 1 : end]
        begin, close = np.flatnonzero(begin), np.flatnonzero(close) + 1
        if not len(begin):
            continue
        # whole steps of size, so that few tables of powers are made
        power, back = _both_powers(-(-len(part) // BLOCK) * BLOCK)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[part] * power[: len(part)], out=total[1:])
        hashes.append(mix((total[close] - total[begin]) * back[begin]))
        starts.append(begin + at)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def shingles(column: pa.Array, k: int = 5) -> Iterator[np.ndarray]:
    """For each row, the sorted distinct hashes of its k-word shingles; a row of 1 to k-1 words is one shingle."""
    data, offsets = utf8(column)
    starts, words = word_spans(data, offsets, WHITE)
    bounds = np.searchsorted(starts, offsets)
    rolled = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j, factor in enumerate(powers(k, _STEP) if len(rolled) else ()):
        rolled += words[j : j + len(rolled)] * factor
    rolled = mix(rolled)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(rolled[a : b - k + 1])
        elif b > a:
            yield mix((words[a:b] * powers(k, _STEP)[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield words[:0]


def all_shingles(column: pa.Array, k: int = 5) -> np.ndarray:
    """The hashes of the k-word shingles of all rows of k words or more, repeats included."""
    data, offsets = utf8(column)
    starts, words = word_spans(data, offsets, WHITE)
    size = max(0, len(words) - k + 1)
    rolled = np.zeros(size, np.uint64)
    for j, factor in enumerate(powers(k, _STEP) if size else ()):
        rolled += words[j : j + size] * factor
    row = np.searchsorted(offsets, starts, "right")
    return mix(rolled[row[:size] == row[k - 1 :][:size]])


def set_id(tokens: np.ndarray) -> int:
    """A 64-bit name for a set of token hashes; 0 only for the empty set."""
    if not len(tokens):
        return 0
    places = np.arange(1, len(tokens) + 1, dtype=np.uint64)
    return int(mix((mix(tokens + _STEP) * (places * _POSITION | np.uint64(1))).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0]) or 1


def count_words(column: pa.Array) -> np.ndarray:
    """Number of words of each row."""
    data, offsets = utf8(column)
    out = np.zeros(len(offsets) - 1, np.int64)
    for at in range(0, len(data), BLOCK):
        inside = ~WHITE[data[at : at + BLOCK]]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        if at:
            begin[0] &= WHITE[data[at - 1]]
        row = np.searchsorted(offsets, [at, at + len(inside) - 1], "right") - 1
        # a row's first byte starts a word whatever the row before ends with
        first = offsets[row[0] : row[1] + 1]
        first = first[(first >= at) & (first < at + len(inside))] - at
        begin[first] = inside[first]
        total = np.append(0, np.cumsum(begin))
        ends = np.clip(offsets[row[0] : row[1] + 2] - at, 0, len(inside))
        out[row[0] : row[1] + 1] += np.diff(total[ends])
    return out
