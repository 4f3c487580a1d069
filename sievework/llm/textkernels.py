"""Numpy kernels over the bytes of an Arrow string column, used inside Spark tasks.

A task sees its texts as one byte buffer with offsets.  The kernels cut it into
chunks of whole documents, find words, and hash words or byte windows with a
polynomial hash modulo 2**64, so that no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: White space of the word pattern [^\x20\x09-\x0D]+.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Separators of the punctuation-blind words: every ASCII byte that is no letter or digit.
IS_PUNCT = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_table(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte."""
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


BYTES = byte_table(42)


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n; grown as needed, so its size is that of the largest chunk."""
    if len(_POWERS[0]) < n:
        for k, b in ((0, _BASE), (1, _INVERSE)):
            full = np.full(n, b, np.uint64)
            full[0] = 1
            _POWERS[k] = np.cumprod(full, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and the offsets of its rows (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole rows of about ``limit`` bytes; a longer row is a run of its own."""
    data, offsets = text_buffer(column)
    n, row = len(offsets) - 1, 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of all words; words never cross rows."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = separator[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = gap[:-1]
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = gap[1:]
    starts = np.flatnonzero(~gap & (before | edge[:-1]))
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of value * BASE**position; a span's hash is a difference of two of them."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = BYTES) -> np.ndarray:
    """A 64-bit hash for each word, equal for equal bytes wherever they stand."""
    return span_hash(prefix_hash(table[data]), starts, ends)


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n) if len(rows) else np.zeros(n, np.int64)


_GRAM = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` word hashes; the caller drops those that cross rows."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(size))
    for k in range(size):
        h = (h ^ words[k : k + n]) * _GRAM[k % 5]
        h ^= h >> np.uint64(29)
    return h
