"""Token-id files compressed by Re-Pair grammars.

Documents are dealt out by ranges of doc_id, so that the files hold all ids in ascending order.
Inside a partition runs of whole documents become shards. In each shard the most frequent pairs
of neighbouring symbols are replaced by new symbols, again and again, until no pair is frequent.
A shard's row stores the symbols, the rules and the length of each rule's expansion, so any run
of ids can be decoded from the symbols that cover it alone.

File format, one Parquet row per shard: part, seq (place in the order), doc_ids, doc_ends (ids up
to the end of each document), first_rule (symbols below it are ids), rules (left and right
symbol of each rule, in turn), lengths (expansion length of each rule), width (bytes per
symbol), symbols (little-endian).

NULL counts as empty text: such a document holds the end id alone. Equal doc_ids are ordered by a
hash of the text, then by the text, so that many rows under one doc_id spread over partitions; a
NULL doc_id comes first. Strings of special tokens inside a text become those tokens, as the library
has it. Bytes that aren't UTF-8 are replaced first. Further columns of the input are not looked at.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, Window as W

from ..session import scratch_path
from . import bytetext as bt
from .caches import hold
from .pieces import PieceIds
from .store import parts_for

SHARD_IDS = 1 << 20     # ids per shard; a longer document is a shard of its own
FREQUENT = 1 / 20_000   # a pair is replaced if it takes at least this share of a shard's symbols
PER_ROUND = 2048        # pairs replaced before the pairs are counted again
SCHEMA = ("part int, seq int, doc_ids array<bigint>, doc_ends array<bigint>, first_rule int, rules array<int>, "
          "lengths array<int>, width int, symbols binary")


def _short(pairs: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)


def repair(ids: np.ndarray, first_rule: int, frequent: float = FREQUENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules as pairs, expansion length of each rule)."""
    symbols = ids.astype(np.int64)
    rules: list[np.ndarray] = []
    count = 0
    while len(symbols) > 1:
        pair = symbols[:-1] << 32 | symbols[1:]
        ordered = np.sort(pair)
        at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        times = np.diff(np.append(at, len(ordered)))
        often = np.flatnonzero(times >= max(2, frequent * len(symbols)))
        if not len(often):
            break
        often = often[np.argsort(-times[often], kind="stable")[:PER_ROUND]]
        chosen = np.sort(ordered[at[often]])
        # Most places drop out by a hash of 16 bits, before the search.
        sieve = np.zeros(1 << 16, dtype=bool)
        sieve[_short(chosen)] = True
        hit = np.flatnonzero(sieve[_short(pair)])
        place = np.searchsorted(chosen, pair[hit])
        place[place == len(chosen)] = 0
        same = chosen[place] == pair[hit]
        hit, place = hit[same], place[same]
        # Pairs that overlap: every second one of a run is replaced.
        run = np.flatnonzero(np.concatenate([[True], np.diff(hit) > 1]))
        first = np.repeat(hit[run], np.diff(np.append(run, len(hit))))
        second = (hit - first) % 2 == 0
        hit = hit[second]
        symbols[hit] = first_rule + count + place[second]
        symbols = np.delete(symbols, hit + 1)
        rules.append(np.stack([chosen >> 32, chosen & 0xFFFFFFFF], axis=1))
        count += len(chosen)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64)
    size = np.ones(first_rule + len(table), dtype=np.int64)
    begin = 0
    for part in rules:  # a round's rules use symbols of the rounds before only
        size[first_rule + begin:first_rule + begin + len(part)] = size[part[:, 0]] + size[part[:, 1]]
        begin += len(part)
    return symbols, table, size[first_rule:]


def expand(symbols: np.ndarray, rules: np.ndarray, first_rule: int) -> np.ndarray:
    """All ids of a run of symbols."""
    symbols = symbols.astype(np.int64)
    while True:
        deep = symbols >= first_rule
        if not deep.any():
            return symbols
        out = np.repeat(symbols, 1 + deep)
        left = np.flatnonzero(deep) + np.arange(int(deep.sum()))
        rule = symbols[deep] - first_rule
        out[left], out[left + 1] = rules[rule, 0], rules[rule, 1]
        symbols = out


def decode_range(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_rule: int, begin: int, end: int) -> np.ndarray:
    """Ids begin..end of a shard, expanding only the symbols that cover them."""
    size = np.ones(len(symbols), dtype=np.int64)
    deep = symbols >= first_rule
    size[deep] = lengths[symbols[deep].astype(np.int64) - first_rule]
    stop = np.cumsum(size)
    low, high = np.searchsorted(stop, begin, side="right"), np.searchsorted(stop, end, side="left") + 1
    before = int(stop[low - 1]) if low else 0
    return expand(symbols[low:high], rules, first_rule)[begin - before:end - before]


class Encoder:
    """Ids of chunks: once per distinct pre-token, but texts that hold a special token's string are encoded as a whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, special))) if special else None
        self.pieces = PieceIds(self._encode)

    def _encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = self.tokenizer.encode([p.decode("utf-8") for p in parts], is_pretokenized=True, add_special_tokens=False)
        return np.array(got.ids, dtype=np.int64), np.bincount(np.array(got.word_ids, dtype=np.int64), minlength=len(parts))

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a chunk, and the n + 1 offsets of the rows."""
        ids, rows = self.pieces.ids(data, offsets)
        at = np.array([m.start() for m in self.special.finditer(data.tobytes())] if self.special else [], dtype=np.int64)
        if not len(at):
            return ids, rows
        whole = set((np.searchsorted(offsets, at, side="right") - 1).tolist())   # a match over two rows does no harm
        parts = [np.array(self.tokenizer.encode(data[offsets[k]:offsets[k + 1]].tobytes().decode("utf-8"), add_special_tokens=False).ids, dtype="<u4")
                 if k in whole else ids[rows[k]:rows[k + 1]] for k in range(len(rows) - 1)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _shard(part: int, seq: int, docs: list[tuple[int | None, np.ndarray]], first_rule: int) -> pa.RecordBatch:
    symbols, rules, lengths = repair(np.concatenate([ids for _, ids in docs]), first_rule)
    width = 2 if first_rule + len(rules) <= 1 << 16 else 4
    row = {"part": part, "seq": seq, "doc_ids": [d for d, _ in docs], "doc_ends": np.cumsum([len(ids) for _, ids in docs]).tolist(),
           "first_rule": first_rule, "rules": rules.reshape(-1).tolist(), "lengths": lengths.tolist(), "width": width,
           "symbols": symbols.astype(f"<u{width}").tobytes()}
    kinds = {"part": pa.int32(), "seq": pa.int32(), "doc_ids": pa.list_(pa.int64()), "doc_ends": pa.list_(pa.int64()),
             "first_rule": pa.int32(), "rules": pa.list_(pa.int32()), "lengths": pa.list_(pa.int32()), "width": pa.int32(),
             "symbols": pa.binary()}
    return pa.RecordBatch.from_pylist([row], schema=pa.schema(list(kinds.items())))


def write_ids(docs: DataFrame, tokenizer_path: str, end_id: int, path: str) -> None:
    """Encodes (doc_id, text), appends `end_id` to each document and writes the shards to `path`."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        hold(f"ids {tokenizer_path}", lambda: (encoder.pieces.clear(), _encoder.cache_clear()))
        first_rule = max(encoder.vocabulary, end_id + 1)
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for row, end, data, offsets in bt.chunks(batch.column(1)):
                ids, rows = encoder.ids(data, offsets)
                for k in range(end - row):
                    if held and size + rows[k + 1] - rows[k] >= SHARD_IDS:
                        yield _shard(part, seq, held, first_rule)
                        seq, held, size = seq + 1, [], 0
                    held.append((ids_of[row + k], np.append(ids[rows[k]:rows[k + 1]], np.uint32(end_id))))
                    size += len(held[-1][1])
        if held:
            yield _shard(part, seq, held, first_rule)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.make_valid_utf8("text").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    ranged = rows.repartitionByRange(parts_for(docs), "doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    ranged.mapInArrow(encode, SCHEMA).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """part, seq, doc_id, at (place in the shard) and ids of each document of the files."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                ids = _decoded(shard).astype(np.int32)
                ends = shard["doc_ends"]
                n = len(ends)
                yield pa.record_batch([
                    pa.array([shard["part"]] * n, pa.int32()), pa.array([shard["seq"]] * n, pa.int32()),
                    pa.array(shard["doc_ids"], pa.int64()), pa.array([0, *ends[:-1]], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(ids))],
                    names=["part", "seq", "doc_id", "at", "ids"])

    return spark.read.parquet(path).mapInArrow(decode, "part int, seq int, doc_id bigint, at bigint, ids array<int>")


def _decoded(shard: dict) -> np.ndarray:
    symbols = np.frombuffer(shard["symbols"], dtype=f"<u{shard['width']}")
    return expand(symbols, np.array(shard["rules"], dtype=np.int64).reshape(-1, 2), shard["first_rule"])


def index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and CRC-32 of the ids of each document, read from the files."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                ids = _decoded(shard).astype("<u4")
                stops = [0, *shard["doc_ends"]]
                n = len(stops) - 1
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(stops, stops[1:], strict=False)]
                yield pa.record_batch([
                    pa.array([shard["part"]] * n, pa.int32()), pa.array([shard["seq"]] * n, pa.int32()),
                    pa.array(shard["doc_ids"], pa.int64()), pa.array(stops[:-1], pa.int64()),
                    pa.array(np.diff(stops), pa.int64()), pa.array(crc, pa.int64())],
                    names=["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    shards = spark.read.parquet(path)
    rows = shards.mapInArrow(summed, "part int, seq int, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint")
    sizes = shards.select("part", "seq", F.element_at("doc_ends", -1).alias("size"))
    # Shards before one in its partition, then partitions before it: the second sum has one row per partition.
    inside = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("size").alias("size"))
    before = parts.select("part", F.coalesce(F.sum("size").over(
        W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    starts = sizes.select("part", "seq", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("own")).join(before, "part")
    return rows.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("own") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def indexed(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Writes the documents' ids below the shared folder and lists them as read back."""
    path = scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, tokenizer_path, end_id, path)
    return index(docs.sparkSession, path)
