"""Benchmark decontamination with suffix arrays over shards of the training text.

Every shard, a few megabytes of whole documents inside a task, gets a suffix array of its words,
sorted as deep as a test window is long. All test suffixes are found in it by binary search;
the interval of a suffix holds the places of its verbatim matches. Matches that follow each
other on one diagonal make the longest match. Suffixes that start with a pair of words that no
test text has are left out of the array: no search could end there.

The benchmark is the stated query set. It is read in blocks of bounded size; each block passes
over all documents in a job of its own, whose state is written before the next block is read, so
neither the driver nor a task holds more than a block.

Rows: NULL or empty text has no words and is clean. Repeated rows and equal ids keep one row
each. A benchmark item without words matches nothing; one without an id counts for hits but is
not listed. An empty benchmark leaves every document clean. Columns of the documents are carried
in a struct, so their names can't clash with the results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytetext as bt
from .caches import hold
from .store import written

BLOCK_BYTES = 16 << 20   # benchmark text that is searched at a time


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = bt.flat(column)
    data = bt.LOWER[data]
    starts, ends, rows = bt.words(data, offsets, bt.WORD_BYTES)
    return bt.hashes(data, starts, ends), rows


class TestSet:
    """The test windows of one block as rows of packed words."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        code, rows = _words(pa.array([text for _, text in items], pa.string()))
        self.names = [name for name, _ in items]
        self.window = window
        self.vocabulary, word = np.unique(code, return_inverse=True)
        word = word + 1
        self.bits = int(len(self.vocabulary) + 1).bit_length()
        self.per_key = 63 // self.bits
        slots = 1 << min(24, max(12, 4 + len(self.vocabulary).bit_length()))
        self.mask = np.uint64(slots - 1)
        self.maybe = np.zeros(slots, dtype=bool)
        self.maybe[(self.vocabulary & self.mask).astype(np.int64)] = True
        at, item, size = [], [], []
        for k in range(len(items)):
            n = int(rows[k + 1] - rows[k])
            count = max(min(n, 1), n - window + 1)
            at += range(int(rows[k]), int(rows[k]) + count)
            item += [k] * count
            size += [min(n, window)] * count
        at, item, size = (np.array(x, dtype=np.int64) for x in (at, item, size))
        padded = np.concatenate([word, np.zeros(window, dtype=np.int64)])
        low, high = self._keys(padded, at, size, 0), self._keys(padded, at, size, (1 << self.bits) - 1)
        # Equal windows are searched once; each keeps the places it has in the items.
        table = np.stack([*low, size], axis=1) if len(at) else np.zeros((0, len(low) + 1), dtype=np.int64)
        _, first, kind = np.unique(table, axis=0, return_index=True, return_inverse=True)
        kind = kind.reshape(-1)
        order = np.argsort(kind, kind="stable")
        self.item, self.item_at = item[order], (at - rows[:-1][item])[order] if len(at) else at
        self.item_rows = np.concatenate([[0], np.cumsum(np.bincount(kind, minlength=len(first)))]).astype(np.int64)
        self.low, self.high, self.size = [x[first] for x in low], [x[first] for x in high], size[first]
        self.single = np.unique(padded[at[size == 1]]) if len(at) else at
        pair = at[size > 1]
        self.pairs = np.unique(padded[pair] << self.bits | padded[pair + 1]) if len(pair) else pair

    def _keys(self, word: np.ndarray, at: np.ndarray, size: np.ndarray | None, fill: int) -> list[np.ndarray]:
        """Words at..at + window packed into 64-bit keys; past `size` each word is `fill`."""
        out = []
        for begin in range(0, self.window, self.per_key):
            key = np.zeros(len(at), dtype=np.int64)
            for k in range(begin, min(begin + self.per_key, self.window)):
                part = word[at + k]
                if size is not None:
                    part = np.where(k < size, part, fill)
                key = key << self.bits | part
            out.append(key)
        return out

    def word_ids(self, code: np.ndarray) -> np.ndarray:
        """1 + place in the vocabulary; 0 for any other word."""
        out = np.zeros(len(code), dtype=np.int64)
        if not len(self.vocabulary):
            return out
        maybe = np.flatnonzero(self.maybe[(code & self.mask).astype(np.int64)])
        place = np.searchsorted(self.vocabulary, code[maybe])
        place[place == len(self.vocabulary)] = 0
        hit = self.vocabulary[place] == code[maybe]
        out[maybe[hit]] = place[hit] + 1
        return out

    def matches(self, code: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(test window, word position) of every verbatim match in a shard."""
        word = self.word_ids(code)
        stop = np.repeat(rows[1:], np.diff(rows))   # where each word's document ends
        following = np.append(word[1:], 0)
        following[rows[1:][rows[1:] > 0] - 1] = 0
        seed = np.zeros(len(word), dtype=bool)
        if len(self.pairs):
            both = np.flatnonzero((word > 0) & (following > 0))
            key = word[both] << self.bits | following[both]
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            seed[both[self.pairs[place] == key]] = True
        if len(self.single):
            seed |= np.isin(word, self.single)
        at = np.flatnonzero(seed)
        keys = self._keys(np.concatenate([word, np.zeros(self.window, dtype=np.int64)]), at, stop[at] - at, 0)
        order = np.lexsort(keys[::-1])
        suffixes, keys = at[order], [k[order] for k in keys]
        begin, end = _bounds(keys, self.low, False), _bounds(keys, self.high, True)
        count = end - begin
        kind = np.repeat(np.arange(len(count)), count)
        where = np.arange(count.sum()) + np.repeat(begin - np.concatenate([[0], np.cumsum(count)])[:-1], count)
        return kind, suffixes[where]


def _bounds(keys: list[np.ndarray], wanted: list[np.ndarray], after: bool) -> np.ndarray:
    """Binary search for all wanted rows at once in rows sorted by several keys."""
    low = np.zeros(len(wanted[0]), dtype=np.int64)
    high = np.full(len(wanted[0]), len(keys[0]), dtype=np.int64)
    for _ in range(len(keys[0]).bit_length()):
        mid = np.minimum((low + high) >> 1, max(len(keys[0]) - 1, 0))
        less = np.full(len(low), after)
        for key, want in zip(keys[::-1], wanted[::-1], strict=True):
            got = key[mid]
            less = (got < want) | (got == want) & less
        live = low < high
        low, high = np.where(live & less, mid + 1, low), np.where(live & ~less, mid, high)
    return low


def _longest(tests: TestSet, kind: np.ndarray, at: np.ndarray, row: np.ndarray, rows: np.ndarray) -> dict[int, tuple]:
    """Per row with a match: (words, item, first word in the document, first word in the item)."""
    if not len(kind):
        return {}
    per = np.diff(tests.item_rows)[kind]
    which = np.arange(per.sum()) + np.repeat(tests.item_rows[:-1][kind] - np.concatenate([[0], np.cumsum(per)])[:-1], per)
    item, inside = tests.item[which], tests.item_at[which]
    at, size = np.repeat(at, per), np.repeat(tests.size[kind], per)
    order = np.lexsort((at, at - inside, item))
    item, inside, at, size = item[order], inside[order], at[order], size[order]
    new = np.ones(len(at), dtype=bool)
    home = row[at]
    new[1:] = (item[1:] != item[:-1]) | (np.diff(at) != 1) | (np.diff(inside) != 1) | (home[1:] != home[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    words = at[last] + size[last] - at[first]
    out: dict[int, tuple] = {}
    for k in np.lexsort((item[first], at[first], -words)):
        f = first[k]
        r = int(home[f])
        if r not in out:
            out[r] = (int(words[k]), tests.names[item[f]], int(at[f] - rows[r]), int(inside[f]))
    return out


def _searched(batch: pa.RecordBatch, tests: TestSet) -> Iterator[list[pa.Array]]:
    """Word counts, hit spans, item names and longest match of each row, added to those of blocks before."""
    for begin, end, data, offsets in bt.chunks(batch.column(1)):
        data = bt.LOWER[data]
        starts, ends, rows = bt.words(data, offsets, bt.WORD_BYTES)
        kind, at = tests.matches(bt.hashes(data, starts, ends), rows)
        row = bt.row_of(rows)
        spans, names, longest = ([x.as_py() for x in batch.column(c).slice(begin, end - begin)] for c in (3, 4, 5))
        best = _longest(tests, kind, at, row, rows)
        hit = np.zeros(len(row) + 1, dtype=np.int64)
        np.add.at(hit, at, 1)
        np.add.at(hit, at + tests.size[kind], -1)
        inside = np.cumsum(hit[:-1]) > 0
        met = np.unique(row[at] * len(tests.size) + kind) if len(at) else at
        items: dict[int, set] = {}
        for pair in met.tolist():
            r, k = divmod(pair, len(tests.size))
            items.setdefault(r, set()).update(tests.item[tests.item_rows[k]:tests.item_rows[k + 1]].tolist())
        for r, got in items.items():
            own = inside[rows[r]:rows[r + 1]].copy()
            for s, e in zip(spans[r][::2], spans[r][1::2], strict=True):
                own[s:e] = True
            spans[r] = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))).tolist()
            names[r] = sorted({*names[r], *(tests.names[i] for i in got if tests.names[i] is not None)})
            size, name, here, there = best[r]
            if longest[r] is None or size > longest[r]["words"]:
                longest[r] = {"words": size, "item": name, "doc_at": here, "item_at": there}
        yield [batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin),
               pa.array(np.diff(rows), pa.int64()), pa.array(spans, batch.schema.field(3).type),
               pa.array(names, batch.schema.field(4).type), pa.array(longest, batch.schema.field(5).type)]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str | None, str]]]:
    """The test items in blocks of about BLOCK_BYTES; equal rows once."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    part = items.distinct().withColumn("block", F.pmod(F.xxhash64("text", "id"), F.lit(max(1, blocks))))
    for k in range(max(1, blocks)):
        yield [(r.id, r.text) for r in part.where(F.col("block") == k).select("id", "text").collect()]


def matched(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text") -> DataFrame:
    """`row` (the document's columns), n_words, spans of hit words, items and the longest match.

    spans holds begin and end of each run of hit words, in turn; longest is NULL in a clean row.
    """
    state = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<bigint>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
        F.lit(None).cast("struct<words:bigint,item:string,doc_at:bigint,item_at:bigint>").alias("longest"))
    for number, items in enumerate(_blocks(benchmark, "item_id", "text")):
        if number:   # the blocks before are done and let go before the next is taken up
            state = written(state, "searched")
        tests = TestSet(items, window)

        def search(batches: Iterator[pa.RecordBatch], tests: TestSet = tests) -> Iterator[pa.RecordBatch]:
            hold("suffixes")
            for batch in batches:
                for columns in _searched(batch, tests):
                    yield pa.record_batch(columns, schema=batch.schema)

        state = state.mapInArrow(search, state.schema)
    return state.drop("text")


def verdicts(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; then the longest match and its place."""
    signed = F.transform("spans", lambda x, k: F.when(k % 2 == 1, x).otherwise(-x))
    n_hit = F.aggregate(signed, F.lit(0).cast("bigint"), lambda total, x: total + x)
    return matched(docs.select("doc_id", "text"), benchmark, window).select(
        "row.doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
        F.coalesce("longest.words", F.lit(0).cast("bigint")).alias("longest_words"), F.col("longest.item").alias("longest_item"),
        F.col("longest.doc_at").alias("longest_at"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents without any verbatim match, with their own columns."""
    return matched(docs, benchmark, window).where(F.size("spans") == 0).select("row.*")
