"""Whole columns of text as flat byte arrays inside a task.

An Arrow string column already is one byte buffer plus offsets. The helpers find words in
that buffer, hash them and cut a batch into pieces of bounded size, without making one Python
object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20      # text handled at a time; a longer single text is a chunk of its own
_BLOCK = 1 << 17           # bytes hashed at a time, to stay in the processor's cache
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_ODD = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                               0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]

#: White space that separates words in the quality and near-duplicate contracts.
ASCII_SPACE = np.ones(256, dtype=bool)
ASCII_SPACE[[0x20, 9, 10, 11, 12, 13]] = False
#: Digits, letters and every byte of a non-ASCII character, after A-Z became a-z.
WORD_BYTES = np.zeros(256, dtype=bool)
WORD_BYTES[0x30:0x3A] = WORD_BYTES[0x61:0x7B] = WORD_BYTES[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _ODD[0]
    x ^= x >> np.uint64(27)
    x *= _ODD[1]
    x ^= x >> np.uint64(31)
    return x


with np.errstate(over="ignore"):
    _BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD[2])


def _inverse(odd: int) -> int:
    """Inverse modulo 2**64, by Newton's rule."""
    x = odd
    for _ in range(6):
        x = x * (2 - odd * x) % (1 << 64)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    up = _powers(int(_BASE), _BLOCK + 1)
    down = _powers(_inverse(int(_BASE)), _BLOCK + 1)

    @classmethod
    def upto(cls, n: int):
        if n <= len(cls.up):
            return cls.up, cls.down
        return _powers(int(_BASE), n), _powers(_inverse(int(_BASE)), n)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the n + 1 offsets of a string column; NULL counts as empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, dtype=np.int64)
    data = column.buffers()[2] if len(column) else None
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with at most `limit` bytes, or one row."""
    data, offsets = flat(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, and the n + 1 word offsets of the rows; no word spans two rows."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    member = inside[data]
    first, last = member.copy(), member.copy()
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first[1:] &= ~member[:-1] | edge[1:-1]
    last[:-1] &= ~member[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges are in order and don't overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            base = int(starts[i])
            j = max(i + 1, int(np.searchsorted(ends, base + _BLOCK, side="right")))
            up, down = _Powers.upto(int(ends[j - 1]) - base + 1)
            sums = np.zeros(int(ends[j - 1]) - base + 1, dtype=np.uint64)
            np.cumsum(_BYTE_CODE[data[base:ends[j - 1]]] * up[:len(sums) - 1], out=sums[1:])
            s, e = starts[i:j] - base, ends[i:j] - base
            out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _ODD[3]
            i = j
        return mix(out)


def windows(codes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, and the n + 1 offsets of the rows.

    A row of fewer words, but not none, has one window: the whole of it.
    """
    count = np.diff(rows)
    per_row = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    out_rows = np.concatenate([[0], np.cumsum(per_row)])
    where = np.arange(out_rows[-1]) + np.repeat(rows[:-1] - out_rows[:-1], per_row)
    limit = np.repeat(rows[1:], per_row)
    total = np.zeros(len(where), dtype=np.uint64)
    padded = np.concatenate([codes, np.zeros(size, dtype=np.uint64)])
    with np.errstate(over="ignore"):
        for k in range(size):
            part = padded[where + k]
            if len(count) and count.min() < size:
                part = np.where(where + k < limit, part, np.uint64(0))
            total = total * _BASE + mix(part + np.uint64(k + 1))
        return mix(total), out_rows


def row_of(rows: np.ndarray) -> np.ndarray:
    """Row number of each element, from n + 1 offsets."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))


def rows_sum(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of whole numbers per row, from n + 1 offsets."""
    total = np.concatenate([np.zeros(1, dtype=values.dtype), np.cumsum(values)])
    return total[rows[1:]] - total[rows[:-1]]
