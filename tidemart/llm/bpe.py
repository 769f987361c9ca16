"""Byte-level BPE encoding by a rank queue under a hierarchical bitmap, and decoding.

Merges run over a linked list of symbols. Each merge rank has a bucket with the list positions
whose pair has that rank; a three-level bitmap marks the ranks with a bucket, so the lowest one
is found with three find-first-set steps however long the piece is. An entry whose pair has
changed meanwhile is stale and skipped. All distinct pieces of a chunk share one queue: they
have no pairs across their borders, so their merges don't disturb each other.

NULL counts as empty text, which has no ids. Repeated rows, equal ids and NULL ids keep one row
each; further columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytetext as bt
from .caches import hold
from .pieces import PieceIds, pretokens

GROUP = 2048     # pieces that share a queue: few enough for the lists to stay in the processor's cache


class RankQueue:
    """Positions by rank, with find-first-set over three levels of 64-bit words."""

    def __init__(self, ranks: int):
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
            return
        self.put(rank, [position])

    def put(self, rank: int, positions: list[int]) -> None:
        if rank in self.buckets:
            self.buckets[rank] += positions
            return
        self.buckets[rank] = positions
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank and its positions in text order."""
        a = (self.top & -self.top).bit_length() - 1
        word = self.mid[a]
        b = a << 6 | (word & -word).bit_length() - 1
        word = self.low[b]
        rank = b << 6 | (word & -word).bit_length() - 1
        self.low[b] &= word - 1
        if not self.low[b]:
            self.mid[a] &= self.mid[a] - 1
            if not self.mid[a]:
                self.top &= self.top - 1
        return rank, sorted(self.buckets.pop(rank))


class Bpe:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.top = max(ranks.values()) + 1
        self.bytes_of = [b""] * self.top
        for piece, rank in ranks.items():
            self.bytes_of[rank] = piece
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)])
        self.first = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])
        # Rank of every pair of tokens that makes a token, by left id * top + right id.
        self.pairs = {ranks[piece[:k]] * self.top + ranks[piece[k:]]: rank for piece, rank in ranks.items()
                      for k in range(1, len(piece)) if piece[:k] in ranks and piece[k:] in ranks}

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece."""
        out: list[list[int] | None] = [[self.ranks[p]] if p in self.ranks else None for p in pieces]
        open_ = [k for k, ids in enumerate(out) if ids is None]
        for low in range(0, len(open_), GROUP):
            part = open_[low:low + GROUP]
            for k, ids in zip(part, self._merged([pieces[k] for k in part]), strict=True):
                out[k] = ids
        return out

    def _merged(self, pieces: list[bytes]) -> Iterator[list[int]]:
        if not pieces:
            return
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        rank_at = np.full(len(data), -1, dtype=np.int64)
        rank_at[:-1] = self.first[data[:-1], data[1:]]
        following = np.arange(1, len(data) + 1)
        following[ends - 1] = -1
        rank_at[ends - 1] = -1
        before = np.arange(-1, len(data) - 1)
        before[ends[:-1]] = -1
        queue = RankQueue(self.top)
        waiting = np.flatnonzero(rank_at >= 0)
        waiting = waiting[np.argsort(rank_at[waiting], kind="stable")]
        cuts = np.flatnonzero(np.diff(rank_at[waiting])) + 1
        cuts, places = [0, *cuts.tolist(), len(waiting)], waiting.tolist()
        for a, b in zip(cuts, cuts[1:], strict=False) if places else ():
            queue.put(int(rank_at[places[a]]), places[a:b])
        ids, nxt, prv, rank_at = self.byte_id[data].tolist(), following.tolist(), before.tolist(), rank_at.tolist()
        push, buckets, rank_of, top = queue.push, queue.buckets, self.pairs.get, self.top
        while buckets:
            rank, bucket = queue.pop()
            for k, i in enumerate(bucket):
                if rank_at[i] != rank:
                    continue  # stale
                lower = False
                j = nxt[i]
                ids[i] = rank
                rank_at[j] = -1
                after = nxt[i] = nxt[j]
                ids[j] = -1
                if after >= 0:
                    prv[after] = i
                    new = rank_at[i] = rank_of(rank * top + ids[after], -1)
                    if new >= 0:
                        push(new, i)
                        lower = new < rank
                else:
                    rank_at[i] = -1
                p = prv[i]
                if p >= 0:
                    new = rank_at[p] = rank_of(ids[p] * top + rank, -1)
                    if new >= 0:
                        push(new, p)
                        lower |= new < rank
                if lower and k + 1 < len(bucket):
                    queue.put(rank, bucket[k + 1:])
                    break
        begin = 0
        for end in ends.tolist():
            yield [x for x in ids[begin:end] if x >= 0]
            begin = end

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def load(path: str) -> tuple[Bpe, PieceIds]:
    with open(path, "rb") as file:
        bpe = Bpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})

    def encode(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = bpe.encode(parts)
        return np.fromiter((x for own in ids for x in own), dtype=np.int64), np.array([len(own) for own in ids])

    return bpe, PieceIds(encode)


def _checked(bpe: Bpe, pieces: PieceIds, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, bytes]]:
    """(ids, decoded bytes) of each row. Pieces are looked up by hash, so a row whose ids don't
    decode to its text is encoded again from its pieces."""
    ids, rows = pieces.ids(data, offsets)
    for k in range(len(rows) - 1):
        own, text = ids[rows[k]:rows[k + 1]], data[offsets[k]:offsets[k + 1]].tobytes()
        decoded = bpe.decode(own.tolist())
        if decoded != text:
            starts, ends, _ = pretokens(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]))
            own = np.array([x for got in bpe.encode([text[s:e] for s, e in zip(starts, ends, strict=True)]) for x in got], dtype="<u4")
            decoded = bpe.decode(own.tolist())
        yield own, decoded


def encoded(docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, ids (array of int) and the text decoded from them, for each row of (doc_id, text)."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pieces = load(ranks_path)
        hold(f"bpe {ranks_path}", lambda: (pieces.clear(), load.cache_clear()))
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column(1)):
                got = list(_checked(bpe, pieces, data, offsets))
                yield pa.record_batch([
                    batch.column(0).slice(row, end - row),
                    pa.array([x.astype(np.int32) for x, _ in got], pa.list_(pa.int32())),
                    pa.array([d.decode("utf-8", "replace") for _, d in got], pa.string())], names=["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.make_valid_utf8("text").alias("text")).mapInArrow(
        encode, "doc_id bigint, ids array<int>, decoded string")


def digests(docs: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids (little-endian unsigned 32 bit) and of the decoded bytes."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pieces = load(ranks_path)
        hold(f"bpe {ranks_path}", lambda: (pieces.clear(), load.cache_clear()))
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column(1)):
                got = [(len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest())
                       for ids, decoded in _checked(bpe, pieces, data, offsets)]
                yield pa.record_batch([
                    batch.column(0).slice(row, end - row), pa.array([x[0] for x in got], pa.int64()),
                    pa.array([x[1] for x in got], pa.string()), pa.array([x[2] for x in got], pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.make_valid_utf8("text").alias("text")).mapInArrow(
        encode, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
