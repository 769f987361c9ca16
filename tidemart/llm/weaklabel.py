"""Quality scores from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each document. All documents are
counted by their pattern of votes; expectation-maximisation over these counts estimates how often
each labeller is right and gives each pattern the posterior of being good. Posterior labels then
train a linear scorer over hashed byte trigrams, which scores every whole text.

The scorer is fitted on at most SAMPLE documents, picked by a hash of their ids; votes and their
counts cover all documents. Rows: NULL or empty text has no trigrams and scores by the bias.
Repeated rows and equal ids keep one row each. Without both good and bad patterns every document
scores its posterior. Columns are carried in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytetext as bt
from .fertility import base_counts
from .mainblocks import STOP_WORDS
from .store import written

SAMPLE = 6000
HASHED = 1 << 12
KEEP = 0.5
GOOD, BAD, NONE = 1, 0, 2
#: Labellers: name, measure, bad beyond (side, limit), good beyond.
LABELLERS = (
    ("symbols", "symbol_share", ">", 0.05, "<", 0.01),
    ("stop words", "stop_share", "<", 0.04, ">", 0.12),
    ("repeats", "repeat_share", ">", 0.2, "<", 0.02),
    ("lines", "line_share", ">", 0.3, "<", 0.02),
    ("capitals", "capital_share", ">", 0.4, "<", 0.1),
    ("length", "n_words", "<", 10, ">", 50),
    ("word length", "word_length", ">", 12, "<", 8),
    ("sentences", "signs_share", ">", 0.4, "<", 0.2),
)


def _hash_words(words: list[str]) -> np.ndarray:
    data, offsets = bt.flat(pa.array(words, pa.string()))
    return np.sort(bt.hashes(data, offsets[:-1], offsets[1:]))


def votes(data: np.ndarray, offsets: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """One line of votes per row of a chunk."""
    counts, (starts, _, rows, _) = base_counts(data, offsets)
    lower = bt.LOWER[data]
    s, e, r = bt.words(lower, offsets, bt.WORD_BYTES)
    code = bt.hashes(lower, s, e)
    place = np.minimum(np.searchsorted(stops, code), len(stops) - 1)
    words, letters = np.maximum(counts["n_words"], 1), np.maximum(counts["word_chars"], 1)
    lines = bt.rows_sum((data == 10).astype(np.int64), offsets) + 1
    capital = (data >= 0x41) & (data <= 0x5A)
    # A word that is a sign, or ends in one that no sentence ends in.
    last = data[np.minimum(np.maximum(_ends(starts, rows, data, offsets) - 1, 0), max(len(data) - 1, 0))] if len(starts) else starts
    sign = np.isin(last, np.frombuffer(b"!#$%&*|<>=+~^\\/", dtype=np.uint8)).astype(np.int64)
    measure = {
        "symbol_share": counts["n_symbols"] / letters, "stop_share": bt.rows_sum((stops[place] == code).astype(np.int64), r) / np.maximum(np.diff(r), 1),
        "repeat_share": counts["n_repeat_words"] / words, "line_share": counts["n_dup_lines"] / lines,
        "capital_share": bt.rows_sum(capital.astype(np.int64), offsets) / letters, "n_words": counts["n_words"],
        "word_length": counts["word_chars"] / words, "signs_share": bt.rows_sum(sign, rows) / words}
    out = np.full((len(rows) - 1, len(LABELLERS)), NONE, dtype=np.int64)
    for k, (_, name, bad_side, bad, good_side, good) in enumerate(LABELLERS):
        value = measure[name]
        out[value > good if good_side == ">" else value < good, k] = GOOD
        out[value > bad if bad_side == ">" else value < bad, k] = BAD
    return out


def _ends(starts: np.ndarray, rows: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return bt.words(data, offsets, bt.ASCII_SPACE)[1]


def em(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of good for each pattern, P(vote | class) per labeller): a two-class model of independent labellers."""
    good = (patterns == GOOD).sum(axis=1) - 2.0 * (patterns == BAD).sum(axis=1)
    posterior = 1 / (1 + np.exp(-good))
    given = np.zeros((2, patterns.shape[1], 3))
    for _ in range(rounds):
        prior = (counts * posterior).sum() / counts.sum()
        for side, share in ((GOOD, posterior), (BAD, 1 - posterior)):
            weight = counts * share
            for vote in (BAD, GOOD, NONE):
                given[side, :, vote] = ((patterns == vote) * weight[:, None]).sum(axis=0) + 1.0
            given[side] /= given[side].sum(axis=1, keepdims=True)
        line = np.arange(patterns.shape[1])
        odds = np.log(max(prior, 1e-9)) - np.log(max(1 - prior, 1e-9)) + (
            np.log(given[GOOD, line, patterns]) - np.log(given[BAD, line, patterns])).sum(axis=1)
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - posterior).max() < 1e-6:
            break
        posterior = new
    return posterior, given


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams inside each row of a chunk, and the n + 1 offsets of the rows."""
    size = np.maximum(np.diff(offsets) - 2, 0)
    rows = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(rows[-1]) + np.repeat(offsets[:-1] - rows[:-1], size)
    wide = data.astype(np.uint64)
    code = bt.mix((wide[at] << np.uint64(16)) | (wide[at + 1] << np.uint64(8)) | wide[at + 2])
    return (code & np.uint64(HASHED - 1)).astype(np.int64), rows


def _train(x: np.ndarray, target: np.ndarray, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by accelerated gradient steps; columns are scaled to unit deviation."""
    scale = 1 / np.maximum(x.std(axis=0), 1e-6)
    x = x * scale
    w, b, speed = np.zeros(x.shape[1], dtype=np.float32), 0.0, np.zeros(x.shape[1], dtype=np.float32)
    step = np.float32(4 / max(1.0, float((x ** 2).sum(axis=1).mean())))
    for k in range(rounds):
        ahead = w + speed * np.float32(k / (k + 3))
        error = 1 / (1 + np.exp(-np.clip(x @ ahead + b, -30, 30))) - target
        new = ahead - step * (x.T @ error / len(x) + np.float32(1e-4) * ahead)
        b -= 0.5 * float(error.mean())
        speed, w = new - w, new
    return w * scale, b


def scored(docs: DataFrame, carry: list[str]) -> DataFrame:
    """`row` (the columns to carry), posterior of the votes and score of each document."""
    stops = _hash_words(sorted(STOP_WORDS))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = 3 ** np.arange(len(LABELLERS))
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column(1)):
                yield pa.record_batch([batch.column(0).slice(row, end - row), pa.array(votes(data, offsets, stops) @ power)],
                                      names=["doc_id", "pattern"])

    voted = written(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(vote, "doc_id bigint, pattern bigint"), "votes")
    # At most 3 ** 8 patterns, whatever the number of documents.
    found = voted.groupBy("pattern").agg(F.count("*").alias("texts")).orderBy("pattern").collect()
    if not found:
        return docs.limit(0).select(F.struct(*carry).alias("row"), F.lit(0.0).alias("posterior"), F.lit(0.0).alias("score"))
    patterns = np.array([[r.pattern // 3 ** k % 3 for k in range(len(LABELLERS))] for r in found])
    posterior, _ = em(patterns, np.array([float(r.texts) for r in found]))
    good = {r.pattern: float(p) for r, p in zip(found, posterior, strict=True)}

    picked = voted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).select("doc_id", "pattern").dropDuplicates(["doc_id"])
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column(1), 1 << 20):
                code, rows = trigrams(data, offsets)
                many = np.bincount(bt.row_of(rows) * HASHED + code, minlength=(end - row) * HASHED).reshape(end - row, HASHED)
                share = (many / np.maximum(many.sum(axis=1, keepdims=True), 1)).astype(np.float32)
                yield pa.record_batch([batch.column(0).slice(row, end - row), pa.array([x.tobytes() for x in share], pa.binary())],
                                      names=["pattern", "share"])

    sample = texts.select("pattern", "text").mapInArrow(features, "pattern bigint, share binary").limit(SAMPLE).collect()
    target = np.array([good[r.pattern] for r in sample], dtype=np.float32)
    if len(sample) and target.min() < 0.5 < target.max():
        weights, bias = _train(np.stack([np.frombuffer(r.share, dtype=np.float32) for r in sample]), target)
    else:
        weights, bias = np.zeros(HASHED), float(np.log(max(target.mean(), 1e-6) / max(1 - target.mean(), 1e-6))) if len(sample) else 0.0
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), "text")
    schema = given.select("row", F.lit(0.0).alias("posterior"), F.lit(0.0).alias("score")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = 3 ** np.arange(len(LABELLERS))
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column(1)):
                code, rows = trigrams(data, offsets)
                total = np.concatenate([[0], np.cumsum(weights[code])])
                mean = (total[rows[1:]] - total[rows[:-1]]) / np.maximum(np.diff(rows), 1)
                known = [good[p] for p in (votes(data, offsets, stops) @ power).tolist()]
                yield pa.record_batch([batch.column(0).slice(row, end - row), pa.array(known, pa.float64()),
                                       pa.array(1 / (1 + np.exp(-np.clip(mean + bias, -30, 30))), pa.float64())],
                                      names=["row", "posterior", "score"])

    return given.mapInArrow(score, schema)
