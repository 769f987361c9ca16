"""Pre-tokens of whole chunks of text, and token ids that are looked up once per distinct piece."""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd

from . import bytetext as bt

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
CACHED = 48 << 20   # bytes that a worker's memory of pieces may take; past that it starts anew
#: The suffixes that the public pattern splits off after an apostrophe.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of each code point: letter, number, white space or other."""
    import regex

    points = [p for p in range(sys.maxunicode + 1) if not 0xD800 <= p < 0xE000]
    text = "".join(map(chr, points))
    out = np.full(sys.maxunicode + 1, OTHER, dtype=np.uint8)
    index = np.array(points)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, text):
            out[index[m.start():m.end()]] = kind
    return out


def pretokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and the n + 1 offsets of the pre-tokens; they cover the bytes without a gap.

    Runs of letters, of numbers and of other signs take one space before them; an apostrophe
    that starts a run takes a suffix; a run of white space leaves its last character to what follows.
    """
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    kind = char_classes()[chars]
    n = len(chars)
    edge = np.zeros(n + 1, dtype=bool)
    edge[np.searchsorted(at, offsets)] = True
    edge[n] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    after = np.flatnonzero(start[1:] & (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:n]) + 1
    start[after] = chars[after - 1] != 0x20
    start[after - 1] = True
    quote = np.flatnonzero((chars == 0x27) & start)
    for suffix in SUFFIXES:
        hit = quote
        for k, c in enumerate(suffix, 1):
            hit = hit[hit + k < n]
            hit = hit[(chars[hit + k] == ord(c)) & ~edge[hit + k]]
        start[hit + 1] = False
        end = hit + 1 + len(suffix)
        start[end[end < n]] = True
    starts = at[start]
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)


class Memo:
    """Number arrays remembered by a 64-bit hash, as sorted keys and one pool: some twenty bytes a key besides the numbers."""

    def __init__(self, limit: int = CACHED):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.begin, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        self.pool = np.zeros(0, dtype="<u4")

    def held(self) -> int:
        return self.keys.nbytes + self.begin.nbytes + self.size.nbytes + self.pool.nbytes

    def lookup(self, hashes: np.ndarray, compute: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Where in the pool the numbers of each of these distinct hashes begin, and how many they are. `compute` gives
        the numbers in a row, and their counts, for the places of those not known yet."""
        if self.held() > self.limit:
            self.clear()
        order = np.argsort(hashes)
        wanted = hashes[order]
        at = np.searchsorted(self.keys, wanted)
        new = np.ones(len(wanted), dtype=bool)
        new[at < len(self.keys)] = self.keys[at[at < len(self.keys)]] != wanted[at < len(self.keys)]
        if new.any():
            numbers, counts = compute(order[new])
            begin = len(self.pool) + np.cumsum(counts) - counts
            self.pool = np.concatenate([self.pool, numbers.astype("<u4")])
            self.keys = np.insert(self.keys, at[new], wanted[new])
            self.begin, self.size = np.insert(self.begin, at[new], begin), np.insert(self.size, at[new], counts)
            at = np.searchsorted(self.keys, wanted)
        begin, size = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
        begin[order], size[order] = self.begin[at], self.size[at]
        return begin, size


class PieceIds:
    """Token ids of chunks, with `encode` called on distinct pieces only.

    `encode` gives the ids of all its pieces in a row, and the number of ids of each piece. `split` cuts
    a chunk into pieces that are encoded apart.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], split: Callable = pretokens):
        self.encode, self.split, self.memo = encode, split, Memo()

    def clear(self) -> None:
        self.memo.clear()

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a chunk, and the n + 1 offsets of the rows."""
        starts, ends, rows = self.split(data, offsets)
        if not len(starts):
            return np.zeros(0, dtype="<u4"), rows
        code, distinct = pd.factorize(bt.hashes(data, starts, ends))
        first = np.empty(len(distinct), dtype=np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        text = data.tobytes()

        def compute(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return self.encode([text[s:e] for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])

        begin, size = self.memo.lookup(distinct, compute)
        per = size[code]
        total = np.concatenate([[0], np.cumsum(per)])
        where = np.repeat(begin[code] - total[:-1], per)
        where += np.arange(total[-1])
        return self.memo.pool[where], total[rows]
