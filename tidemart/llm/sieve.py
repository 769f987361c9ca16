"""Bloom filters that keep rows without a partner out of a shuffle; an exact join always follows.

A key sets four bits of one 64-bit word, so the filter is one row a word and one `bit_or`. With 16 bits
a key less than one in a hundred strange keys pass. The filter is bounded: beyond WORDS words more
strange keys pass, and the join behind it gets more rows, never fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import bytetext as bt

KEYS = 4            # keys a word
WORDS = 1 << 22     # 32 MB


def _places(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Word and bits of each code."""
    mixed = bt.mix(np.ascontiguousarray(codes).view(np.uint64))
    bits = np.zeros(len(mixed), dtype=np.uint64)
    for k in range(4):
        bits |= np.uint64(1) << ((mixed >> np.uint64(6 * k)) & np.uint64(63))
    return ((mixed >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64), bits


def may_know(words: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """False where a code is certainly none of the filter's."""
    word, bits = _places(codes, len(words))
    return words[word] & bits == bits


def sieve(keys: DataFrame, *columns: str) -> np.ndarray:
    """The filter of the keys (codes by `code`) in a written table."""
    size = max(1, min(WORDS, -(-keys.count() // KEYS)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, bits = _places(batch.column(0).to_numpy(zero_copy_only=False), size)
            yield pa.record_batch([pa.array(word), pa.array(bits.view(np.int64))], names=["word", "bits"])

    found = keys.select(code(*columns)).mapInArrow(place, "word bigint, bits bigint").groupBy("word").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(size, dtype=np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return words


def code(*columns: str) -> Column:
    return F.xxhash64(*columns)


def maybe(words: np.ndarray, *columns: str) -> Column:
    """True where the columns' code may be in the filter. Only the codes go through Python."""
    @F.pandas_udf("boolean")
    def known(codes: pd.Series) -> pd.Series:
        return pd.Series(may_know(words, codes.to_numpy()))

    return known(code(*columns))
