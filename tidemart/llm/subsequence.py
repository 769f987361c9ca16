"""Toxicity by a support vector machine over a gap-weighted subsequence kernel.

Two words are alike when they share three letters in order, with letters skipped or inserted in
between at a discount per step. Landmark words span the kernel's space (Nyström): the machine is
linear in a word's kernel values to the landmarks. Since the kernel is an inner product of
subsequence counts, the fitted machine folds into one weight per three letters, and a word costs
a few look-ups however many landmarks there are; `kernel` is the plain form it is tested against.

A text is a bag of sentences, a sentence a bag of words, and only texts have labels. Words that
explain labelled toxic texts, each new one texts that those before don't explain, are positive;
words of clean texts are negative, and after a first fit those that come closest to the positive
side. A text scores as its worst word. Words are folded first: accents and signs go, digits that
look like letters become them, and single letters in a row are joined. Letters outside a-z have
codes by code point: those of one alphabet mostly differ, those of different ones may share a code.

The machine is fitted on at most TOXIC + CLEAN labelled texts, picked by a hash of their ids.
Rows: NULL or empty text scores as a text without words. Repeated rows and equal ids keep one
row each. NULL labels are left out; of several labels of an id the highest counts; labels without
any toxic text give score 0 everywhere. Columns of the documents are carried in a struct.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bytetext as bt
from .caches import hold, release
from .store import written

TOXIC, CLEAN = 6000, 14000   # most labelled texts used
NEGATIVES, CLOSE = 20_000, 4000  # random and closest words of clean texts
LANDMARKS = 256
ROWS = 2048      # windows whose features are made at a time
CANDIDATES = 3000            # words of toxic texts that may become positive
LETTERS = 16                 # a longer word is read in windows of so many letters
SPAN = 5                     # letters from the first to the last of a subsequence
DECAY = 0.6                  # discount per letter skipped
CUT = 0.3                    # score from which a text counts as toxic
CACHED = 24 << 20   # bytes that each of a worker's two memories of words may take; past that it starts anew
WORD = 190            # bytes of a remembered word besides its letters: two objects and a place in the table
#: Digits and signs that stand for letters inside a word.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

_BEGIN, _END = 27, 28
_SIZE = 64
_OTHERS = _SIZE - _END - 1   # codes of letters outside a-z, dealt out by code point: an alphabet's letters in a row differ
_STEPS = [(a, b, DECAY ** (b - 2)) for b in range(2, SPAN) for a in range(1, b)]
_WEIGHTS = np.array([0.0] + [DECAY ** (b - 2) for b in range(2, SPAN)])   # by the step to the last letter; none first
_BITS = (len(_WEIGHTS) - 1).bit_length()


def fold(word: str) -> str:
    """Letters of a word in lower case without accents; lookalikes count between other letters only."""
    word = word.lower()
    if not word.isascii():
        word = "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))
    if word.isalpha():
        return word
    inner = word.strip("0123456789@$!.,;:?\"'()[]{}*#%&|<>-_/\\~`^+=")
    return "".join(c for c in inner.translate(LOOKALIKES) if c.isalpha())


def _code(letter: str) -> int:
    point = ord(letter)
    return point - 96 if 97 <= point <= 122 else _END + 1 + point % _OTHERS


def windows(word: str) -> list[list[int]]:
    """Letter codes of a folded word between its border marks, in windows of bounded length."""
    codes = [_BEGIN, *map(_code, word), _END]
    if len(codes) <= LETTERS + 2:
        return [codes]
    return [codes[k:k + LETTERS + 2] for k in range(0, len(codes) - LETTERS // 2, LETTERS // 2)]


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of all windows, zeros at the end, and the word of each window."""
    parts, owner = [], []
    for k, word in enumerate(words):
        for codes in windows(word):
            parts.append(bytes(codes))
            owner.append(k)
    out = np.frombuffer(b"".join(p.ljust(LETTERS + 2, b"\0") for p in parts), dtype=np.uint8)
    return out.reshape(len(parts), LETTERS + 2).astype(np.int32), np.array(owner, dtype=np.int64)


def _features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each window in rising order, their weights, and the length of the window's feature vector.

    Weights of a feature that comes twice add up for the length. Places after the end weigh nothing.
    """
    width = codes.shape[1]
    keys = []
    for a, b, _ in _STEPS:
        x, y, z = codes[:, :width - b], codes[:, a:width - b + a], codes[:, b:]
        keys.append((((x * _SIZE + y) * _SIZE + z) << _BITS) + (z > 0) * np.int32(b - 1))
    key = np.sort(np.concatenate(keys, axis=1), axis=1)
    feature, weight = key >> _BITS, _WEIGHTS[key & ((1 << _BITS) - 1)]
    new = np.ones(feature.shape, dtype=bool)
    new[:, 1:] = feature[:, 1:] != feature[:, :-1]
    start = np.flatnonzero(new)
    square = np.add.reduceat(weight.ravel(), start) ** 2 if len(start) else np.zeros(0)
    total = np.bincount(start // feature.shape[1], weights=square, minlength=len(codes))
    return feature, weight, np.sqrt(np.maximum(total, 1e-9))


def _blocks(codes: np.ndarray) -> Iterator[slice]:
    return (slice(k, k + ROWS) for k in range(0, len(codes), ROWS))


def _dot(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Inner products of the windows' normed features with one weight per feature."""
    out = np.zeros(len(codes))
    for at in _blocks(codes):
        feature, weight, norm = _features(codes[at])
        out[at] = np.einsum("ij,ij->i", weights[feature], weight) / norm
    return out


class _Marks:
    """Normed features of landmark windows, one column each; only features that a landmark has are rows."""

    def __init__(self, codes: np.ndarray):
        feature, weight, norm = _features(codes)
        there = weight > 0
        self.known = np.unique(feature[there])
        self.row = np.full(_SIZE ** 3, len(self.known), dtype=np.int32)   # the row after the last is empty
        self.row[self.known] = np.arange(len(self.known))
        self.columns = np.zeros((len(self.known) + 1, len(codes)))
        np.add.at(self.columns, (self.row[feature[there]], np.nonzero(there)[0]), weight[there])
        self.columns /= norm

    def dot(self, codes: np.ndarray, span: np.ndarray) -> np.ndarray:
        """Inner products of windows with each column of `span`, whose rows are those of the landmarks."""
        out = np.zeros((len(codes), span.shape[1]))
        for at in _blocks(codes):
            feature, weight, norm = _features(codes[at])
            for k in range(feature.shape[1]):
                out[at] += span[self.row[feature[:, k]]] * weight[:, k:k + 1]
            out[at] /= norm[:, None]
        return out

    def spread(self, weights: np.ndarray) -> np.ndarray:
        """Weights of the landmarks' features as weights of all features."""
        out = np.zeros(_SIZE ** 3)
        out[self.known] = weights[:-1]
        return out


def kernel(a: str, b: str) -> float:
    """The kernel of two short folded words, straight from its definition."""
    def counts(word: str) -> tuple[dict, float]:
        codes, out = windows(word)[0], {}
        for i in range(len(codes)):
            for x, y, weight in _STEPS:
                if i + y < len(codes):
                    key = (codes[i], codes[i + x], codes[i + y])
                    out[key] = out.get(key, 0.0) + weight
        return out, max(sum(w * w for w in out.values()), 1e-9) ** 0.5

    (left, n), (right, m) = counts(a), counts(b)
    return sum(w * right.get(k, 0.0) for k, w in left.items()) / (n * m)


@dataclass
class Machine:
    """weights per subsequence, the bias folded into the scale of a logistic score."""

    weights: np.ndarray
    slope: float = 0.0
    offset: float = 0.0

    def words(self, words: list[str]) -> np.ndarray:
        """Margin of each folded word."""
        if not words:
            return np.zeros(0)
        codes, owner = _matrix(words)
        out = np.full(len(words), -np.inf)
        np.maximum.at(out, owner, _dot(codes, self.weights))
        return out

    def score(self, margin: np.ndarray) -> np.ndarray:
        if not self.slope:
            return np.zeros(len(margin))
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def _svm(z: np.ndarray, sign: np.ndarray, weight: np.ndarray, c: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss and a bias column, by Newton steps on the active rows."""
    w = np.zeros(z.shape[1])
    keep = np.eye(z.shape[1])
    for _ in range(rounds):
        active = sign * (z @ w) < 1
        a, g = z[active], c * weight[active]
        new = np.linalg.solve(keep + (a * g[:, None]).T @ a, a.T @ (g * sign[active]))
        done = np.abs(new - w).max() < 1e-9
        w = new
        if done:
            break
    return w


def fit_words(positive: dict[str, float], negative: list[str], close: list[str] | None = None) -> Machine:
    """A machine that tells weighted positive words from negative ones.

    Landmarks are the positive words, then those of `close`, the negative words nearest to the positive
    side so far, and as many others.
    """
    own = sorted(positive, key=lambda w: (-positive[w], w))
    marks = own[:LANDMARKS * 2 // 3]
    marks += (close or [])[:(LANDMARKS - len(marks)) // 2]
    others = sorted(set(negative).difference(marks), key=lambda w: hashlib.sha1(w.encode()).digest())
    marks += others[:LANDMARKS - len(marks)]
    landmarks = _Marks(_matrix(marks)[0])
    values, vectors = np.linalg.eigh(landmarks.columns.T @ landmarks.columns)
    good = values > 1e-6 * values.max()
    span = landmarks.columns @ (vectors[:, good] / np.sqrt(values[good]))     # features -> Nyström coordinates
    words = own + negative
    codes, owner = _matrix(words)
    z = np.concatenate([landmarks.dot(codes, span), np.ones((len(codes), 1))], axis=1)
    sign = np.where(owner < len(own), 1.0, -1.0)
    weight = np.array([positive[w] for w in own] + [1.0] * len(negative))[owner]
    for side in (1.0, -1.0):
        weight[sign == side] /= weight[sign == side].sum()
    w = _svm(z, sign, weight * 1000)
    # The bias joins the weights as a constant of the score; it doesn't change which word is worst.
    return Machine(landmarks.spread(span @ w[:-1]), 1.0, float(w[-1]))


def chosen(texts: list[set[str]], odds: dict[str, float], least: int) -> dict[str, float]:
    """Words that explain the toxic texts, with the number of texts that each has.

    Greedy: the word in most texts not yet explained comes next, weighted by how much likelier it is
    in toxic texts; it stops when no word explains `least` more.
    """
    having: dict[str, set[int]] = {}
    for k, words in enumerate(texts):
        for w in words:
            having.setdefault(w, set()).add(k)
    out: dict[str, float] = {}
    opened = set(range(len(texts)))
    while having:
        word = max(having, key=lambda w: (len(having[w] & opened) * odds[w], w))
        gain = having.pop(word)
        if len(gain & opened) < least:
            break
        out[word] = float(len(gain))
        opened -= gain
    return out


class _Folded:
    """Folded distinct words of chunks."""

    def __init__(self):
        self.known: dict[int, str] = {}
        self.size = 0
        hold("folded words", self.known.clear)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct folded words, the word of each token, and the row of each token."""
        starts, ends, rows = bt.words(data, offsets, bt.ASCII_SPACE)
        place, distinct = pd.factorize(bt.hashes(data, starts, ends))
        first = np.empty(len(distinct), dtype=np.int64)
        first[place[::-1]] = np.arange(len(place))[::-1]
        if self.size > CACHED:
            self.known.clear()
            self.size = 0
        words = []
        for key, s, e in zip(distinct.tolist(), starts[first].tolist(), ends[first].tolist(), strict=True):
            word = self.known.get(key)
            if word is None:
                word = self.known[key] = fold(data[s:e].tobytes().decode("utf-8", "replace"))
                self.size += WORD + len(word)
            words.append(word)
        row = bt.row_of(rows)
        single = np.array([len(w) == 1 for w in words], dtype=bool)[place] if len(words) else np.zeros(0, dtype=bool)
        near = np.append(True, (starts[1:] - ends[:-1] <= 2) & (row[1:] == row[:-1])) if len(row) else single
        spelt, spelt_row = [], []
        at = np.flatnonzero(single)
        if len(at):
            cut = np.flatnonzero((np.diff(at) > 1) | ~near[at[1:]]) + 1
            for run in np.split(at, cut):
                if len(run) >= 3:
                    spelt.append("".join(words[place[k]] for k in run))
                    spelt_row.append(row[run[0]])
        place = np.append(place, np.arange(len(words), len(words) + len(spelt)))
        return words + spelt, place, np.append(row, np.array(spelt_row, dtype=np.int64))


def _word_counts(docs: DataFrame) -> DataFrame:
    """(word, toxic, clean): numbers of labelled texts (text, toxic) with each folded word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded = _Folded()
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for row, end, data, offsets in bt.chunks(batch.column(0)):
                words, place, home = folded.words(data, offsets)
                if not words:
                    continue
                names, kind = np.unique(np.array(words, dtype=object), return_inverse=True)
                pair = np.unique(home * len(names) + kind[place])
                toxic = label[row:end][pair // len(names)] > 0
                kind = pair % len(names)
                counts = [np.bincount(kind[side], minlength=len(names)) for side in (toxic, ~toxic)]
                yield pa.record_batch([pa.array(names.tolist(), pa.string()), *[pa.array(c, pa.int64()) for c in counts]],
                                      names=["word", "toxic", "clean"])

    parts = docs.select("text", "toxic").mapInArrow(count, "word string, toxic bigint, clean bigint")
    return parts.where("length(word) >= 3").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _having(docs: DataFrame, wanted: set[str]) -> list[set[str]]:
    """The wanted words of each of a bounded number of texts; equal texts once."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded = _Folded()
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column(0)):
                words, place, home = folded.words(data, offsets)
                hits: list[set[str]] = [set() for _ in range(end - row)]
                good = np.array([w in wanted for w in words], dtype=bool)
                for k in np.flatnonzero(good[place]) if len(words) else ():
                    hits[home[k]].add(words[place[k]])
                yield pa.record_batch([pa.array([sorted(h) for h in hits], pa.list_(pa.string()))], names=["words"])

    return [set(r.words) for r in docs.select("text").distinct().mapInArrow(find, "words array<string>").collect()]


def _closest(words: DataFrame, machine: Machine, most: int) -> list[str]:
    def margin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(machine.words(batch.column(0).to_pylist()))], names=["word", "margin"])

    got = words.select("word").mapInArrow(margin, "word string, margin double").orderBy(F.desc("margin"), "word").limit(most)
    return [r.word for r in got.collect()]


def margins(docs: DataFrame, machine: Machine, carry: list[str]) -> DataFrame:
    """`row` (the columns to carry), score and the worst word of each text."""
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), "text")
    schema = given.select("row", F.lit(0.0).alias("margin"), F.lit(0.0).alias("score"), F.lit("").alias("worst")).schema

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded, known = _Folded(), {}
        none = float(machine.words([""])[0]) if machine.slope else 0.0
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column(1)):
                words, place, home = folded.words(data, offsets)
                if WORD * len(known) > CACHED:   # its words are those of the other memory
                    known.clear()
                new = list({w for w in words if w not in known})
                known.update(zip(new, machine.words(new).tolist(), strict=True))
                value = np.array([known[w] for w in words])
                worst, which = np.full(end - row, none), np.full(end - row, -1, dtype=np.int64)
                if len(place):
                    order = np.lexsort((value[place], home))
                    last = np.flatnonzero(np.append(home[order][1:] != home[order][:-1], True))
                    which[home[order[last]]] = place[order[last]]
                    worst = np.where(which >= 0, value[which], none)
                yield pa.record_batch([
                    batch.column(0).slice(row, end - row), pa.array(worst), pa.array(machine.score(worst)),
                    pa.array([words[k] if k >= 0 else "" for k in which.tolist()], pa.string())],
                    names=["row", "margin", "score", "worst"])

    return given.mapInArrow(measure, schema)


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """The machine for documents (doc_id, text) with labels (doc_id, toxic), from a bounded number of them."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        (F.max("toxic") > 0).cast("int").alias("toxic"))
    picked = [known.where(F.col("toxic") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
              for side, most in ((1, TOXIC), (0, CLEAN))]
    picked = picked[0].unionByName(picked[1])   # at most TOXIC + CLEAN ids, small enough to broadcast
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")
    texts = written(texts, "labelled")
    size = {r.toxic: r.texts for r in texts.groupBy("toxic").agg(F.count("*").alias("texts")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    nothing = Machine(np.zeros(_SIZE ** 3))
    if not toxic or not clean:
        return nothing
    counts = written(_word_counts(texts), "word-counts")
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    candidates = {r.word: r.odds for r in counts.where("toxic >= 2").select("word", odds.alias("odds")).where("odds > 1").orderBy(
        F.desc(F.col("odds") * F.log(F.col("toxic"))), "word").limit(CANDIDATES).collect()}
    positive = chosen(_having(texts.where("toxic = 1"), set(candidates)), candidates, max(2, toxic // 1000))
    if not positive:
        return nothing
    plain = counts.where("toxic = 0 or clean > 0").where(~F.col("word").isin(list(positive)))
    negative = [r.word for r in plain.orderBy(F.xxhash64("word"), "word").limit(NEGATIVES).collect()]
    machine = fit_words(positive, negative)
    for _ in range(2):
        close = _closest(plain.where("clean > 0"), machine, CLOSE)
        negative = list(dict.fromkeys(negative + close))
        machine = fit_words(positive, negative, close)
    rows = margins(texts, machine, ["toxic"]).select("row.toxic", "margin").collect()
    return _scaled(machine, np.array([r.margin for r in rows]), np.array([float(r.toxic) for r in rows]))


def _scaled(machine: Machine, margin: np.ndarray, toxic: np.ndarray) -> Machine:
    """Logistic score that is CUT where the labelled texts are told apart with the fewest errors.

    Of equally good places the widest gap counts, a third of the way up; the slope lets half of the toxic
    texts above it score 0.95 or more.
    """
    value, place = np.unique(margin, return_inverse=True)
    bad, good = (np.bincount(place, weights=w, minlength=len(value)) for w in (toxic, 1 - toxic))
    errors = np.cumsum(bad)[:-1] + good.sum() - np.cumsum(good)[:-1]   # a cut above each value but the last
    if not len(errors) or errors.min() >= min(bad.sum(), good.sum()):
        return Machine(machine.weights)
    gaps = np.diff(value)
    best = max(np.flatnonzero(errors == errors.min()), key=lambda k: gaps[k])
    cut = value[best] + gaps[best] / 3
    far = max(float(np.median(margin[(toxic > 0) & (margin > cut)])) - cut, 1e-3)
    low, high = (float(np.log(p / (1 - p))) for p in (CUT, 0.95))
    slope = (high - low) / far
    return Machine(machine.weights, slope, low - slope * cut)


def scored(docs: DataFrame, labels: DataFrame, carry: list[str], held_out: int = 2, folds: int = 4) -> DataFrame:
    """`row`, score and worst word of each text; labels of the held-out fold of ids are not looked at."""
    fold_of = F.crc32(F.col("doc_id").cast("string")) % folds
    machine = fit(docs, labels.where(fold_of != held_out))
    release()   # the driver's memory of the fit
    return margins(docs, machine, carry)
