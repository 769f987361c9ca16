import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemart.llm import bytetext as bt, digests as dg

W, N = dg.WINDOW, dg.NEAR


def slow_bin(window):
    counts = Counter(window)
    units = sum(round(dg.UNIT * c * math.log2(c)) for c in counts.values())
    return (dg.ALL_EQUAL - units) * (dg.BINS - 1) // dg.ALL_EQUAL


def slow_features(text, ranks):
    """Window by window."""
    if len(text) < W:
        return [text] if text else []
    rank = [ranks[slow_bin(text[k:k + W])] for k in range(len(text) - W + 1)]
    points = Counter()
    for s in range(1 - N, len(rank)):
        points[min((rank[k], k) for k in range(max(s, 0), min(s + N, len(rank))))[1]] += 1
    return [text[k:k + W] for k in sorted(points) if points[k] >= dg.POINTS]


def texts(seed, n=60):
    rng = random.Random(seed)
    bits = ["the ", "word", " of", "aaaa", "é", "漢字", "\n", "x9$", "        ", "lorem ipsum dolor", "Q", "e"]
    return ["".join(rng.choices(bits, k=rng.choice([0, 1, 3, 8, 40, 200]))) for _ in range(n)]


@pytest.mark.parametrize("block", [50, 1 << 22])
def test_features_equal_brute_force(monkeypatch, block):
    """Also across the edges of blocks and of texts."""
    monkeypatch.setattr(dg, "BLOCK", block)
    own = texts(1)
    data, offsets = bt.flat(pa.array(own))
    ranks = np.random.default_rng(0).permutation(dg.BINS)
    want = [slow_features(t.encode(), ranks) for t in own]
    hashes, rows = dg.features(data, offsets, ranks)
    assert np.diff(rows).tolist() == [len(f) for f in want]
    flat, ends = bt.flat(pa.array([f.decode("latin-1") for t in want for f in t]))
    starts = dg.selected(data, offsets, ranks)
    assert [data[s:s + W].tobytes() for s in starts] == [f for t in want for f in t if len(f) == W]
    total = Counter(slow_bin(t.encode()[k:k + W]) for t in own for k in range(len(t.encode()) - W + 1))
    got = dg.histogram(data, offsets)
    assert {k: n for k, n in enumerate(got.tolist()) if n} == dict(total)


def test_filters_are_chained_and_hold_every_feature():
    hashes = np.random.default_rng(3).integers(0, 1 << 63, 200, dtype=np.uint64)
    bits, held = dg.filters(np.concatenate([hashes, hashes[:50]]))
    assert held.tolist() == [80, 80, 40]
    opened = np.unpackbits(bits, axis=1)
    for k, h in enumerate(hashes.tolist()):
        assert all(opened[k // dg.FULL, (h >> 12 * j) % dg.BITS] for j in range(dg.HASHES))


def test_likeness():
    rng = np.random.default_rng(5)
    make = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64)
    for n in (3, 60, 300, 9000):
        a, b = make(n), make(n)
        half = np.concatenate([a[:n // 2], b[n // 2:]])
        fa, fb, fh = dg.fingerprint(a), dg.fingerprint(b), dg.fingerprint(half)
        assert dg.likeness(fa, fa) == 1.0 and dg.likeness(fa, fb) == dg.likeness(fb, fa) < 0.15
        assert 0.3 < dg.likeness(fa, fh) < 0.75
    assert (dg.likeness(b"", b""), dg.likeness(b"", fa)) == (1.0, 0.0)


def brute_force(rows):
    order = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0]))
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True):
        t, nxt = t or "", nxt or ""
        edited = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        yield i, len(t), hashlib.sha256(edited.encode()).hexdigest(), t, edited, nxt


@pytest.mark.parametrize("parts", ["1", "7"])
def test_equals_brute_force(spark, parts):
    rows = [(7 * k % 101, t) for k, t in enumerate(texts(2, 101))]
    rows[5], rows[6] = (None, "null id"), (rows[6][0], None)
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], "doc_id long, text string, k int, h string, at string").repartition(5)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r.doc_id: r for r in dg.compared(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    ranks = dg.rarity_ranks(df, df["text"])

    def own(text):
        data, offsets = bt.flat(pa.array([text]))
        return dg.fingerprint(dg.features(data, offsets, ranks)[0])

    want = list(brute_force(rows))
    assert len(got) == len(want)
    for i, n, digest, text, edited, nxt in want:
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, digest), (i, text)
        assert (r.fingerprint, r.edited_fingerprint) == tuple(own(t).hex() for t in (text, edited))
        assert (r.near_edited, r.near_next) == (dg.likeness(own(text), own(edited)), dg.likeness(own(text), own(nxt)))


def test_hot_id_and_copies(spark):
    """A third of all rows under one id, half of them alike; every row has its result, and equal texts equal fingerprints."""
    rows = [(9, "the very same text of many copies")] * 100 + [(9, f"text number {k} under one id") for k in range(100)] + [(k, f"other {k}") for k in range(400)]
    got = dg.compared(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert sum(r.near_next == 1.0 for r in got) >= 99
    order = sorted(got, key=lambda r: r.doc_id)
    assert len({r.fingerprint for r in order if r.n_chars == 33}) == 1


def test_edges(spark, edge_docs, no_docs):
    got = dg.compared(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    assert all((r.fingerprint == "") == (r.n_chars == 0) for r in got)
    assert dg.compared(no_docs).collect() == []
    alone = dg.compared(edge_docs.where("doc_id = 7")).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256("héé ñhéé ñ".encode()).hexdigest()
