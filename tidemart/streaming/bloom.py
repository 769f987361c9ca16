"""Duplicate removal with rotating Bloom filters as state.

Keys become 128-bit digests, dealt over `shards`. A shard's state is a chain of generations, each a
Bloom filter sized for `expected` keys at an `error` rate and the list of its digests. A digest that no
filter knows is new, for certain, without reading any list. One that a filter may know is looked up in
the digests of the generations that know it, so a false alarm never costs a row. A full generation is followed by the next; with `keep` generations the
oldest is dropped, and its keys count as new again. A key's state is the filter's bits and 16 bytes,
however long the keys or the rows are. Copies inside an Arrow batch are removed before the shuffle, so
a key repeated without end reaches its shard once a batch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

DIGEST, SHARD, ALARM = "bloom_digest", "bloom_shard", "false_alarm"


class Filter:
    """A Bloom filter of 128-bit digests (two columns of 64 bits), with the usual sizes for n keys at an error rate."""

    def __init__(self, expected: int, error: float, bits: bytes | None = None):
        self.size = max(64, math.ceil(-expected * math.log(error) / math.log(2) ** 2))
        self.hashes = max(1, round(self.size / expected * math.log(2)))
        self.bits = np.zeros(-(-self.size // 8), dtype=np.uint8) if bits is None else np.frombuffer(bits, dtype=np.uint8).copy()

    def _places(self, digests: np.ndarray) -> np.ndarray:
        """A row of bit places per digest, by double hashing of its halves."""
        steps = np.arange(self.hashes, dtype=np.uint64)
        with np.errstate(over="ignore"):
            return (digests[:, :1] + steps * (digests[:, 1:] | np.uint64(1))) % np.uint64(self.size)

    def may_know(self, digests: np.ndarray) -> np.ndarray:
        at = self._places(digests)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).all(axis=1)

    def add(self, digests: np.ndarray) -> None:
        at = self._places(digests).reshape(-1)
        np.bitwise_or.at(self.bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))


def as_pairs(digests: Sequence[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)


class RotatingBloom(StatefulProcessor):
    """State of one shard. `count` has the running generation, its keys and where its last list begins; `bits` has each
    generation's filter, `digests` its lists of some thousand digests, found by how many come before them."""

    LIST = 4096   # digests after which a list is left alone and the next begins

    def __init__(self, expected: int, error: float, keep: int | None):
        self.expected, self.error, self.keep = expected, error, keep

    def init(self, handle) -> None:
        number = T.StructType().add("generation", "long")
        self.count = handle.getValueState("count", T.StructType().add("generation", "long").add("keys", "long").add("list", "long"))
        self.bits = handle.getMapState("bits", number, T.StructType().add("bits", "binary"))
        self.digests = handle.getMapState("digests", T.StructType().add("generation", "long").add("part", "long"), T.StructType().add("digests", "binary"))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        generation, keys, last = self.count.get() or (0, 0, 0)
        filters = {}
        for g in range(generation + 1):
            if self.bits.containsKey((g,)):
                filters[g] = Filter(self.expected, self.error, bytes(self.bits.getValue((g,))[0]))
        filters.setdefault(generation, Filter(self.expected, self.error))
        known: dict[int, set[bytes]] = {}
        for part in rows:
            part = part[~part[DIGEST].map(bytes).duplicated()]
            own = [bytes(d) for d in part[DIGEST]]
            pairs = as_pairs(own)
            seen, alarm = np.zeros(len(own), dtype=bool), np.zeros(len(own), dtype=bool)
            for g, bloom in filters.items():
                maybe = np.flatnonzero(bloom.may_know(pairs) & ~seen)
                if len(maybe):
                    if g not in known:
                        known[g] = self._listed(g)
                    sure = np.array([own[k] in known[g] for k in maybe], dtype=bool)
                    seen[maybe[sure]] = True
                    alarm[maybe[~sure]] = True
            new = np.flatnonzero(~seen)
            begin = 0
            while begin < len(new):
                taken = new[begin:begin + self.expected - keys]
                filters[generation].add(pairs[taken])
                fresh = [own[k] for k in taken]
                before = b""
                if keys - last >= self.LIST or keys == 0:
                    last = keys
                else:
                    before = bytes(self.digests.getValue((generation, last))[0])
                self.digests.updateValue((generation, last), (before + b"".join(fresh),))
                if generation in known:
                    known[generation].update(fresh)
                self.bits.updateValue((generation,), (filters[generation].bits.tobytes(),))
                keys, begin = keys + len(taken), begin + len(taken)
                if keys == self.expected:
                    generation, keys, last = generation + 1, 0, 0
                    filters[generation] = Filter(self.expected, self.error)
                    self._forget(generation, filters, known)
            if len(new):
                yield part.iloc[new].assign(**{ALARM: alarm[new]}).drop(columns=[DIGEST, SHARD])
        self.count.update((generation, keys, last))

    def _listed(self, generation: int) -> set[bytes]:
        """All digests of a generation, list after list."""
        out: set[bytes] = set()
        at = 0
        while self.digests.containsKey((generation, at)):
            data = bytes(self.digests.getValue((generation, at))[0])
            out.update(data[k:k + 16] for k in range(0, len(data), 16))
            at += len(data) // 16
        return out

    def _forget(self, generation: int, filters: dict[int, Filter], known: dict[int, set[bytes]]) -> None:
        for g in [g for g in filters if self.keep is not None and g <= generation - self.keep]:
            at = 0
            while self.digests.containsKey((g, at)):
                size = len(self.digests.getValue((g, at))[0]) // 16
                self.digests.removeKey((g, at))
                at += size
            self.bits.removeKey((g,))
            filters.pop(g)
            known.pop(g, None)

    def close(self) -> None:
        pass


def distinct(stream: DataFrame, keys: Sequence[str], expected: int = 100_000, error: float = 0.01, shards: int = 64,
             keep: int | None = None) -> DataFrame:
    """One row of each key, the first to come, and `false_alarm`: whether a filter knew it wrongly.

    `expected` keys go to a shard's generation. NULL is a value of its own. Without `keep` no key is forgotten.
    """
    text = F.to_json(F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]), {"ignoreNullFields": "false"})
    named = stream.withColumn(DIGEST, F.unhex(F.md5(text)))
    named = named.withColumn(SHARD, F.pmod(F.xxhash64(DIGEST), F.lit(shards)).cast("int"))

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows[~rows[DIGEST].map(bytes).duplicated()]

    out = T.StructType([*stream.schema.fields, T.StructField(ALARM, T.BooleanType())])
    return named.mapInPandas(thin, named.schema).groupBy(SHARD).transformWithStateInPandas(
        RotatingBloom(expected, error, keep), out, "Append", "None").select(*stream.columns, ALARM)
