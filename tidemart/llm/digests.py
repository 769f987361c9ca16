"""Fingerprints of texts made of their improbable features.

Features are windows of WINDOW bytes. A window's Shannon entropy is a whole number of bins; how rare
a bin is among all windows of the corpus ranks the window. In every run of NEAR neighbouring windows
the leftmost of the rarest scores a point, and windows with at least POINTS points are the text's
features. Their hashes go into Bloom filters of BITS bits; a filter that holds FULL features is
followed by the next. Two fingerprints are compared by the bits that filters share beyond what
chance gives, as a share of the most they could share: 1 for equal texts, about 0 for unrelated ones.

A text of fewer bytes than a window, but not none, is one feature. NULL counts as empty: its
fingerprint is '', alike (1) to another empty one and unlike (0) any other. Bytes that aren't UTF-8
are replaced first. Fingerprints depend on the table of ranks, so those to be compared need the same.

`compared` sets each text against an edited one, its second half replaced by the start of the next
document's text, and against that next text. Documents are in the order of doc_id (NULL as the least
long), then of their texts; rows that agree in both come in any order, which changes no result. They
are dealt out by ranges whose first keys are known, so the first document of each range is read
once more and set behind the range before it; no text goes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import bytetext as bt
from .store import parts_for

WINDOW = 16
NEAR = 16                   # at most WINDOW, so that no run sees two texts
POINTS = 4
BITS = 1024
HASHES = 5
FULL = 80
BINS = 1024                 # of entropy, from none to that of a window without repeats
BLOCK = 1 << 22             # window places handled at a time
UNIT = 1 << 20              # entropy is summed in whole numbers
NONE = np.int64(1) << 62


def _steps() -> tuple[np.ndarray, int]:
    """c log c - (c - 1) log (c - 1) for c = 1 .. WINDOW, in units, and the sum for WINDOW equal bytes."""
    c = np.arange(WINDOW + 1, dtype=float)
    whole = np.rint(UNIT * c * np.log2(np.maximum(c, 1))).astype(np.int64)
    return np.diff(whole), int(whole[-1])


STEPS, ALL_EQUAL = _steps()


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """Entropy bin of each full window of the bytes, by exact sliding sums.

    A window's sum of c log c over its byte counts c changes by one step for the byte that leaves and
    one for the byte that comes; the steps need only how often these bytes recur within a window.
    """
    n = len(data) - WINDOW + 1
    if n < 1:
        return np.zeros(0, dtype=np.int16)
    later, earlier = np.zeros(len(data), dtype=np.uint8), np.zeros(len(data), dtype=np.uint8)
    for lag in range(1, WINDOW):
        same = data[lag:] == data[:-lag]
        later[:-lag] += same
        earlier[lag:] += same
    # The first window grows byte by byte: a byte counts the equal ones before it in the window.
    start = int(STEPS[earlier[:WINDOW]].sum())
    sums = np.empty(n, dtype=np.int64)
    sums[0] = start
    sums[1:] = STEPS[earlier[WINDOW:]] - STEPS[later[:n - 1]]
    np.cumsum(sums, out=sums)
    return ((ALL_EQUAL - sums) * (BINS - 1) // ALL_EQUAL).astype(np.int16)


def blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of window places of a chunk, in pieces of bounded size."""
    for begin in range(0, int(offsets[-1]), BLOCK):
        yield begin, min(begin + BLOCK, int(offsets[-1]))


def full_windows(offsets: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Which of the places begin .. end start a window inside one text."""
    change = np.zeros(end - begin + 1, dtype=np.int32)
    low = np.clip(offsets[:-1], begin, end) - begin
    high = np.clip(np.maximum(offsets[1:] - WINDOW + 1, offsets[:-1]), begin, end) - begin
    np.add.at(change, low, 1)
    np.add.at(change, high, -1)
    return np.cumsum(change)[:-1] > 0


def histogram(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many windows of the texts have each entropy bin."""
    total = np.zeros(BINS, dtype=np.int64)
    for begin, end in blocks(offsets):
        own = entropy_bins(data[begin:end + WINDOW - 1])
        total += np.bincount(own[full_windows(offsets, begin, begin + len(own))], minlength=BINS)
    return total


def selected(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Places of the windows that are features, in order."""
    out = []
    for begin, end in blocks(offsets):
        # Points of a place come from runs that start up to NEAR - 1 before it and see as far behind it.
        low, high = max(begin - NEAR + 1, 0), min(end + NEAR - 1, int(offsets[-1]))
        own = entropy_bins(data[low:high + WINDOW - 1])
        size = high - low + 2 * (NEAR - 1)
        key = np.full(size, NONE)
        inside = np.flatnonzero(full_windows(offsets, low, low + len(own)))
        place = inside + NEAR - 1
        key[place] = ranks[own[inside]].astype(np.int64) << 32 | place
        width = 1
        while width < NEAR:   # minimum over runs, doubling their length
            step = min(width, NEAR - width)
            key = np.minimum(key[:-step], key[step:])
            width += step
        points = np.bincount(key[key < NONE] & 0xFFFFFFFF, minlength=size)
        hit = np.flatnonzero(points >= POINTS) - (NEAR - 1) + low
        out.append(hit[(hit >= begin) & (hit < end)])
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def features(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features of each text in order, and the n + 1 offsets of the texts."""
    starts = selected(data, offsets, ranks)
    size = np.diff(offsets)
    short = np.flatnonzero((size > 0) & (size < WINDOW))
    starts = np.concatenate([starts, offsets[:-1][short]])
    ends = np.concatenate([starts[:len(starts) - len(short)] + WINDOW, offsets[1:][short]])
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    return bt.hashes(data, starts, ends), np.searchsorted(starts, offsets)


def filters(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chained filters as rows of bytes, and how many features each holds; a text's repeated features count once."""
    _, first = np.unique(hashes, return_index=True)
    own = hashes[np.sort(first)]
    count = -(-len(own) // FULL)
    bits = np.zeros((count, BITS), dtype=np.uint8)
    which = np.arange(len(own)) // FULL
    for k in range(HASHES):
        bits[which, (own >> np.uint64(12 * k)) % np.uint64(BITS)] = 1
    return np.packbits(bits, axis=1), np.bincount(which, minlength=count)


def fingerprint(hashes: np.ndarray) -> bytes:
    """Two bytes with the number of features and the bits of each filter in turn."""
    bits, held = filters(hashes)
    return np.concatenate([held.astype("<u2").view(np.uint8).reshape(-1, 2), bits], axis=1).tobytes() if len(bits) else b""


def opened(own: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = np.frombuffer(own, dtype=np.uint8).reshape(-1, BITS // 8 + 2)
    return np.unpackbits(rows[:, 2:], axis=1).astype(np.float32), rows[:, :2].copy().view("<u2").reshape(-1).astype(float)


def likeness(left: bytes, right: bytes) -> float:
    """Mean over the filters of the fingerprint with fewer features, weighted by features, of the best match among the
    other's filters; with equally many features the larger mean of both sides."""
    if left == right:
        return 1.0
    if not left or not right:
        return 0.0
    a, held_a = opened(left)
    b, held_b = opened(right)
    if held_a.sum() > held_b.sum():
        return _covered(b, held_b, a)
    if held_a.sum() < held_b.sum():
        return _covered(a, held_a, b)
    return max(_covered(a, held_a, b), _covered(b, held_b, a))


def _covered(a: np.ndarray, held: np.ndarray, b: np.ndarray) -> float:
    best = np.zeros(len(a))
    n_b = b.sum(axis=1, dtype=float)
    for k in range(0, len(a), 64):
        own = a[k:k + 64]
        n_a = own.sum(axis=1, dtype=float)[:, None]
        chance, most = n_a * n_b / BITS, np.minimum(n_a, n_b)
        best[k:k + 64] = np.clip((own @ b.T - chance) / np.maximum(most - chance, 1e-9), 0, 1).max(axis=1)
    return float((best * held).sum() / held.sum())


def rarity_ranks(docs: DataFrame, text: Column) -> np.ndarray:
    """Rank of each entropy bin: 0 for the rarest among all windows of the corpus; on a tie the lower entropy comes first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in bt.chunks(batch.column(0)):
                total += histogram(data, offsets)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bin", "windows"])

    rows = docs.select(F.make_valid_utf8(text).alias("text")).mapInArrow(count, "bin int, windows bigint")
    total = np.zeros(BINS, dtype=np.int64)
    for r in rows.groupBy("bin").agg(F.sum("windows").alias("n")).collect():   # at most BINS rows
        total[r["bin"]] = r["n"]
    ranks = np.empty(BINS, dtype=np.int64)
    ranks[np.lexsort((np.arange(BINS), total))] = np.arange(BINS)
    return ranks


ENTRY = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
         "near_edited double, near_next double")


def _ranges(keys: DataFrame, parts: int) -> pd.DataFrame:
    """The first key (k, h) of each range, rising; every one is the key of some row."""
    dealt = keys.repartitionByRange(parts, "k", "h").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("k", "h")).alias("first"))
    return dealt.select("first.k", "first.h").toPandas().sort_values(["k", "h"], ignore_index=True)   # one row per range


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row of (doc_id, text)."""
    spark = docs.sparkSession
    ranks = rarity_ranks(docs, F.col("text"))
    least = F.lit(-(1 << 63)).cast("bigint")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.make_valid_utf8("text"), F.lit("")).alias("text"))
    keyed = texts.select(F.coalesce("doc_id", least).alias("k"), F.xxhash64("text").alias("h"), "doc_id", "text")
    bounds = _ranges(keyed.select("k", "h"), parts_for(docs))
    k, h = bounds["k"].to_numpy(dtype=np.int64), bounds["h"].to_numpy(dtype=np.int64)

    @F.pandas_udf("int")
    def range_of(own_k: pd.Series, own_h: pd.Series) -> pd.Series:
        """The last range whose first key isn't above the row's."""
        a, b = own_k.to_numpy(), own_h.to_numpy()
        low, high = np.searchsorted(k, a, side="left"), np.searchsorted(k, a, side="right")
        while (low < high).any():   # first keys with the same doc_id are told apart by the hash
            middle = (low + high) // 2
            below = (low < high) & (h[np.minimum(middle, len(h) - 1)] <= b)
            low, high = np.where(below, middle + 1, low), np.where((low < high) & ~below, middle, high)
        return pd.Series(low - 1)

    rows = keyed.withColumn("at", range_of("k", "h")).withColumn("after", F.lit(False))
    # The first document of each range once more, behind the range before; the first of all behind the last.
    first = spark.createDataFrame([(int(x), int(y), (at - 1) % len(k)) for at, (x, y) in enumerate(zip(k, h, strict=True))], "k bigint, h bigint, at int")
    heads = keyed.join(F.broadcast(first), ["k", "h"])   # one row per range, a few bytes each.groupBy("k", "h", "at").agg(F.min(F.struct("text")).getField("text").alias("text"))
    behind = heads.select("k", "h", F.lit(None).cast("bigint").alias("doc_id"), "text", "at", F.lit(True).alias("after"))
    dealt = rows.unionByName(behind).repartition(parts_for(docs), "at").sortWithinPartitions("at", "after", "k", "h", "text")
    return dealt.select("doc_id", "text", "at", "after").mapInArrow(lambda batches: _compared(batches, ranks), ENTRY).select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


def _compared(batches: Iterator[pa.RecordBatch], ranks: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Results of rows (doc_id, text, at, after) in order; each waits for the next row of its range."""
    last = None
    for batch in batches:
        doc_ids, at, after = (batch.column(c).to_pylist() for c in (0, 2, 3))
        for begin, _, data, offsets in bt.chunks(batch.column(1)):
            hashes, rows = features(data, offsets, ranks)
            points = np.flatnonzero((data & 0xC0) != 0x80)
            of_row = np.searchsorted(points, offsets)
            points = np.append(points, len(data))
            done, edited = [], []
            for r in range(len(offsets) - 1):
                n = int(of_row[r + 1] - of_row[r])
                own = fingerprint(hashes[rows[r]:rows[r + 1]])
                if last is not None and last[1] == at[begin + r] and not last[2]:
                    taken = min(last[3] // 2, n)
                    edited.append(last[4] + data[offsets[r]:points[of_row[r] + taken]].tobytes())
                    done.append((last[0], last[3], last[5], likeness(last[5], own)))
                half = data[offsets[r]:points[of_row[r] + n - n // 2]].tobytes()
                last = doc_ids[begin + r], at[begin + r], after[begin + r], n, half, own
            if done:
                yield _results(done, edited, ranks)


def _results(done: list[tuple], edited: list[bytes], ranks: np.ndarray) -> pa.RecordBatch:
    data = np.frombuffer(b"".join(edited), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(e) for e in edited])])
    hashes, rows = features(data, offsets, ranks)
    prints = [fingerprint(hashes[rows[r]:rows[r + 1]]) for r in range(len(edited))]
    doc_ids, n_chars, own, near_next = zip(*done, strict=True)
    return pa.record_batch([
        pa.array(doc_ids, pa.int64()), pa.array(n_chars, pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
        pa.array(own, pa.binary()), pa.array(prints, pa.binary()),
        pa.array([likeness(a, b) for a, b in zip(own, prints, strict=True)]), pa.array(near_next)],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
