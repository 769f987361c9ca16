"""Alignment of two tokenizations of the same text.

Each text is encoded by both vocabularies. Offsets where tokens of both end cut the text into
groups; the last tokens of a group end together and are linked. The ends of a batch of texts are two
rising arrays, merged in pieces of equal work (`ends`); a group that runs over a piece's edge is put
together by the pieces' common numbering. Linked id pairs are counted over all texts. Of two linked
tokens one is a suffix of the other, so there are at most as many distinct pairs as the tokens of
both vocabularies have bytes (under a million), however large the corpus is: that bounds the
table of counts which goes to every task.

Texts that are NULL, empty, or whose tokens of either vocabulary don't spell a space and the text,
have no tokens: counts are 0 and the digest is ''. No token of the vocabularies is empty. Equal rows
and ids stay rows of their own. Further columns are carried in `row` and not looked at.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import bytetext as bt
from .caches import hold
from .ends import common
from .pieces import PieceIds
from .store import written

SPACE = "▁"
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


class Spelling:
    """The bytes of each token of a vocabulary and, for digests, its id in decimal with a separator."""

    def __init__(self, tokens: list[bytes]):
        self.bytes = tokens
        self.length = np.array([len(t) for t in tokens], dtype=np.int64)
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.begin = np.cumsum(self.length) - self.length
        text = np.array([str(k) for k in range(len(tokens))], dtype="S")
        self.digits = text.view(np.uint8).reshape(len(tokens), -1)
        self.n_digits = np.char.str_len(text)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return ranges(self.flat, self.begin[ids], self.length[ids])


def ranges(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The given ranges of `data`, one after another."""
    total = np.cumsum(length)
    where = np.repeat(begin - (total - length), length)
    where += np.arange(total[-1] if len(total) else 0)
    return data[where]


def byte_symbols() -> dict[str, int]:
    """The printable sign that a byte-level vocabulary writes for each byte, by the public rule: printable
    bytes stand for themselves, the others take the code points from 256 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(others)}}


class ByteVocabulary:
    """A byte-level vocabulary: ids of chunks, once per distinct pre-token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True   # their strings inside a text are ordinary text
        byte = byte_symbols()
        entries = [self.tokenizer.id_to_token(k) or "" for k in range(self.tokenizer.get_vocab_size())]
        self.spelling = Spelling([bytes(byte[c] for c in e) if all(c in byte for c in e) else e.encode() for e in entries])
        self.pieces = PieceIds(self._encode)

    def _encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = self.tokenizer.encode([p.decode("utf-8") for p in parts], is_pretokenized=True, add_special_tokens=False)
        return np.array(got.ids, dtype=np.int64), np.bincount(np.array(got.word_ids, dtype=np.int64), minlength=len(parts))

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.pieces.ids(data, offsets)

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids, dtype="<u4")


def spaced_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of spaces with what follows up to the next space: starts, ends, the n + 1 offsets of the rows."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    space = data == 0x20
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(first)
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)


class PieceVocabulary:
    """A sentence-piece vocabulary. No piece has a space after another sign, so no piece runs over the
    start of a spaced word, and texts can be encoded once per distinct spaced word."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(len(self.model))]
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece runs over the start of a word")
        self.spelling = Spelling([bytes([int(p[3:-1], 16)]) if self.model.is_byte(k) else p.replace(SPACE, " ").encode()
                                  for k, p in enumerate(pieces)])
        self.pieces = PieceIds(self._encode, spaced_words)

    def _encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = self.model.encode([p[1:].decode("utf-8") for p in parts], num_threads=1)   # the model adds one space itself
        return np.array([x for own in got for x in own], dtype=np.int64), np.array([len(own) for own in got], dtype=np.int64)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.pieces.ids(data, offsets)

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self.model.encode(text[1:].decode("utf-8"), num_threads=1), dtype="<u4")


@lru_cache(maxsize=1)
def vocabularies(a_path: str, b_path: str) -> tuple[ByteVocabulary, PieceVocabulary]:
    return ByteVocabulary(a_path), PieceVocabulary(b_path)


def spelled_ids(vocabulary: ByteVocabulary | PieceVocabulary, data: np.ndarray,
                offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, the n + 1 offsets of the rows, and which rows their tokens spell. Pieces are looked up by hash, so a
    row that isn't spelled is encoded again by the library as a whole before it is given up."""
    ids, rows = vocabulary.ids(data, offsets)
    own = vocabulary.spelling
    ok = same_rows(own, ids, rows, data, offsets)
    if ok.all():
        return ids, rows, ok
    parts = [ids[rows[k]:rows[k + 1]] if fine else vocabulary.whole(data[offsets[k]:offsets[k + 1]].tobytes()) for k, fine in enumerate(ok.tolist())]
    ids, rows = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    return ids, rows, same_rows(own, ids, rows, data, offsets)


def same_rows(spelling: Spelling, ids: np.ndarray, rows: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    size = bt.rows_sum(spelling.length[ids], rows)
    if (size == np.diff(offsets)).all():
        wrong = np.flatnonzero(spelling.spelled(ids) != data)
        out = np.ones(len(size), dtype=bool)
        out[np.searchsorted(offsets, wrong, side="right") - 1] = False
        return out
    return np.array([np.array_equal(spelling.spelled(ids[rows[k]:rows[k + 1]]), data[offsets[k]:offsets[k + 1]]) for k in range(len(size))], dtype=bool)


class Aligned:
    """Groups and links of the rows of a chunk, where every row begins with a space."""

    def __init__(self, a_vocabulary: ByteVocabulary, b_vocabulary: PieceVocabulary, data: np.ndarray, offsets: np.ndarray):
        a, a_rows, a_ok = spelled_ids(a_vocabulary, data, offsets)
        b, b_rows, b_ok = spelled_ids(b_vocabulary, data, offsets)
        ok = a_ok & b_ok
        self.a, self.a_rows = kept(a, a_rows, ok)
        self.b, self.b_rows = kept(b, b_rows, ok)
        self.a_spelling, self.b_spelling = a_vocabulary.spelling, b_vocabulary.spelling
        # Texts one after another: both token streams end together at each text's end, so no group runs over it.
        self.a_last, self.b_last = common(np.cumsum(self.a_spelling.length[self.a]), np.cumsum(self.b_spelling.length[self.b]))
        self.groups = np.searchsorted(self.a_last, self.a_rows)   # groups before each row

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Linked id pairs as one number each, and the n + 1 offsets of the rows."""
        return self.a[self.a_last].astype(np.int64) << 32 | self.b[self.b_last].astype(np.int64), self.groups

    def listing(self) -> tuple[np.ndarray, np.ndarray]:
        """`a1,a2|b1;a3|b2` of all rows one after another, and the n + 1 byte offsets of the rows."""
        na, nb = len(self.a), len(self.b)
        if not na:
            return np.zeros(0, dtype=np.uint8), np.zeros(len(self.groups), dtype=np.int64)
        a_group = group_of(self.a_last, na)
        b_group = group_of(self.b_last, nb)
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        a_end, b_end = np.full(na, ord(","), dtype=np.uint8), np.full(nb, ord(","), dtype=np.uint8)
        a_end[self.a_last] = ord("|")
        b_end[self.b_last] = ord(";")
        width = max(self.a_spelling.digits.shape[1], self.b_spelling.digits.shape[1]) + 1
        size = np.concatenate([self.a_spelling.n_digits[self.a], self.b_spelling.n_digits[self.b]])[order]
        place = np.arange(na + nb)
        cells = np.zeros((na + nb, width), dtype=np.uint8)
        cells[:na, :self.a_spelling.digits.shape[1]] = self.a_spelling.digits[self.a]
        cells[na:, :self.b_spelling.digits.shape[1]] = self.b_spelling.digits[self.b]
        cells = cells[order]
        cells[place, size] = np.concatenate([a_end, b_end])[order]
        ends = np.concatenate([[0], np.cumsum(size + 1)])
        return cells[np.arange(width) <= size[:, None]], ends[self.a_rows + self.b_rows]

    def digests(self) -> list[str]:
        text, rows = self.listing()
        return [hashlib.sha256(text[s:e - 1].tobytes()).hexdigest() if e > s else "" for s, e in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)]


def group_of(last: np.ndarray, n: int) -> np.ndarray:
    """Number of each token's group, from the groups' last tokens."""
    after = np.zeros(n, dtype=np.int64)
    after[last[:-1] + 1] = 1
    return np.cumsum(after)


def kept(ids: np.ndarray, rows: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the ids of rows that aren't `ok`."""
    if ok.all():
        return ids, rows
    size = np.where(ok, np.diff(rows), 0)
    return ids[np.repeat(ok, np.diff(rows))], np.concatenate([[0], np.cumsum(size)])


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A space before each text that isn't empty."""
    filled = np.diff(offsets) > 0
    out = offsets + np.concatenate([[0], np.cumsum(filled)])
    result = np.empty(out[-1], dtype=np.uint8)
    is_text = np.ones(len(result), dtype=bool)
    is_text[out[:-1][filled]] = False
    result[~is_text], result[is_text] = 0x20, data
    return result, out


def per_text(docs: DataFrame, a_path: str, b_path: str, carry: Sequence[str]) -> DataFrame:
    """row, n_a, n_b, n_groups, n_links, groups_sha256, and each text's distinct linked pairs with how often it has them."""
    named = F.struct(*[F.col(f"`{c}`").alias(c) for c in carry], F.lit(0).alias("_")).alias("row")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = vocabularies(a_path, b_path)
        hold(f"align {a_path} {b_path}", lambda: (a.pieces.clear(), b.pieces.clear(), vocabularies.cache_clear()))
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column(1)):
                own = Aligned(a, b, *spaced(data, offsets))
                pairs, rows = own.pairs()
                key, times, distinct = counted(pairs, rows)
                n = np.diff(rows)
                offset = pa.array(distinct.astype(np.int32))
                yield pa.record_batch([
                    batch.column(0).slice(row, end - row), pa.array(np.diff(own.a_rows)), pa.array(np.diff(own.b_rows)), pa.array(n), pa.array(n),
                    pa.array(own.digests(), pa.string()), pa.ListArray.from_arrays(offset, pa.array(key)),
                    pa.ListArray.from_arrays(offset, pa.array(times.astype(np.int32)))],
                    names=["row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    given = docs.select(named, F.make_valid_utf8("text").alias("text"))
    longs = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    return given.mapInArrow(align, T.StructType([
        given.schema["row"], *longs, T.StructField("groups_sha256", T.StringType()),
        T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.IntegerType()))]))


def counted(pairs: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of each row, how often each occurs there, and the n + 1 offsets of the rows."""
    home = bt.row_of(rows)
    order = np.lexsort((pairs, home))
    pairs, home = pairs[order], home[order]
    first = np.ones(len(pairs), dtype=bool)
    first[1:] = (pairs[1:] != pairs[:-1]) | (home[1:] != home[:-1])
    at = np.flatnonzero(first)
    return pairs[at], np.diff(np.append(at, len(pairs))), np.searchsorted(home[at], np.arange(len(rows)))


def pair_counts(texts: DataFrame) -> DataFrame:
    """How many links hold each id pair, over all texts: pair, links, best (the highest of its second id)."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, totals = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            both = np.concatenate([keys, batch.column(0).flatten().to_numpy()])
            weight = np.concatenate([totals, batch.column(1).flatten().to_numpy()])
            keys, place = np.unique(both, return_inverse=True)
            totals = np.bincount(place, weights=weight, minlength=len(keys)).astype(np.int64)
        yield pa.record_batch([pa.array(keys), pa.array(totals)], names=["pair", "links"])

    per_task = texts.select("pairs", "times").mapInArrow(summed, "pair bigint, links bigint")
    counts = per_task.groupBy("pair").agg(F.sum("links").alias("links"))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    counts = counts.withColumn("b", b_id)
    return counts.join(counts.groupBy("b").agg(F.max("links").alias("most")), "b").select(
        "pair", "links", (F.col("links") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, a_path: str, b_path: str, carry: Sequence[str] = ()) -> DataFrame:
    """row (the carried columns), the counts of COLUMNS and groups_sha256 of each row of (text)."""
    texts = written(per_text(docs, a_path, b_path, carry), "token-pairs")
    # At most as many rows as the tokens of the vocabularies have bytes, see above.
    table = pair_counts(texts).toPandas().sort_values("pair")
    key, links, best = (table[c].to_numpy() for c in ("pair", "links", "best"))
    shared = docs.sparkSession.sparkContext.broadcast((key, links.astype(np.int64), best.astype(bool)))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, links, best = shared.value
        for batch in batches:
            times = batch.column(7).flatten().to_numpy().astype(np.int64)
            rows = np.concatenate([[0], np.cumsum(batch.column(6).value_lengths().to_numpy())])
            at = np.searchsorted(key, batch.column(6).flatten().to_numpy())
            n_best = bt.rows_sum(times * best[at], rows) if len(at) else np.zeros(batch.num_rows, dtype=np.int64)
            count_sum = bt.rows_sum(times * links[at], rows) if len(at) else np.zeros(batch.num_rows, dtype=np.int64)
            yield pa.record_batch([*[batch.column(k) for k in range(6)], pa.array(n_best), pa.array(count_sum)],
                                  names=["row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"])

    schema = T.StructType([*texts.schema.fields[:6], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return texts.mapInArrow(total, schema).select("row", *COLUMNS, "groups_sha256")
