import random

import numpy as np
import pytest

from tidemart.llm import bytetext as bt, components as cc, superminhash as sm


def _sets(rows):
    out = {}
    for doc_id, text in rows:
        words = (text or "").encode().lower().split()
        out[doc_id] = {tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
    return out


def _brute(rows):
    sets = _sets(rows)
    ids = list(sets)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[:i]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    roots = cc.union_find(pairs)
    return {i: (len(sets[i]), roots.get(i, i), roots.get(i, i) == i) for i in ids}


def _family(count, words, most, seed):
    """Copies of one text with up to `most` words changed, some in the same way."""
    random.seed(seed)
    base = [f"b{seed}x{k}" for k in range(words)]
    out = []
    for _ in range(count):
        text = base[:]
        for _ in range(random.randint(0, most)):
            text[random.randrange(words)] = f"e{random.randrange(4 * most)}"
        out.append(" ".join(text))
    return out


def _check(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in sm.near_duplicates(docs).collect()}
    assert got == _brute(docs.select("doc_id", "text").collect())


@pytest.mark.parametrize("direct", [4096, 8])
def test_equals_brute_force(spark, monkeypatch, direct):
    """Also with stars too large to end in one task, which are split by their differences."""
    monkeypatch.setattr(sm, "DIRECT", direct)
    monkeypatch.setattr(sm, "CROWD", 5)
    texts = _family(60, 90, 6, 1) + _family(20, 60, 3, 2) + ["same text of six words here"] * 9 + [f"own {k} a b c d e f g" for k in range(20)]
    texts += ["short one", "short one", "Short ONE", "", " ", "w" * 3000]
    random.seed(9)
    random.shuffle(texts)
    _check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_links_at_the_limit(spark):
    """Intersection 85 of union 100 links, 84 of 100 does not; the texts share one run of words."""
    def pair(shared, a, b):
        run = [f"s{k}" for k in range(shared + 4)]
        return [" ".join(run + [f"a{shared}x{k}" for k in range(a)]), " ".join(run + [f"c{shared}x{k}" for k in range(b)])]

    _check(spark.createDataFrame(list(enumerate(pair(85, 8, 7) + pair(84, 8, 8))), "doc_id long, text string"))


def test_a_passage_of_many_unlike_texts(spark, monkeypatch):
    """Texts that share half of their words with all others (J = 1/3) fill large buckets, which shrink in few rounds."""
    rounds, star = [], sm._star

    def counted(*args):
        rounds.append(1)
        assert len(rounds) <= 3, "buckets don't shrink"
        return star(*args)

    monkeypatch.setattr(sm, "DIRECT", 8)
    monkeypatch.setattr(sm, "_star", counted)
    shared = [f"s{k}" for k in range(54)]
    texts = [" ".join(shared + [f"o{d}x{k}" for k in range(50)]) for d in range(1000)]
    twins = {1000 + k: 50 * k for k in range(20)}
    texts += [f"{texts[d]} more" for d in twins.values()]
    got = {r.doc_id: r.component_id for r in sm.near_duplicates(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {k: twins.get(k, k) for k in range(len(texts))}


def test_a_cut_bucket_keeps_every_match(spark):
    """Members that match meet in a smaller bucket, whatever they share with all others."""
    random.seed(8)
    sets = {}
    for family in range(30):
        own = list(range(50)) + [random.randrange(10**6) for _ in range(random.choice((30, 100, 200)))]
        for k in range(6):
            sets[b"%d-%d" % (family, k)] = set(own) - set(random.sample(own, random.randint(0, len(own) // 8)))
    far = spark.createDataFrame([(7, c, 1) for c in sets], "key long, cls binary, pop long")
    full = spark.createDataFrame([(c, sorted(s)) for c, s in sets.items()], "cls binary, items array<long>")
    met, size = set(), {}
    for r in sm._cut(far, full, 85).groupBy("key").agg({"cls": "collect_list"}).collect():
        members = sorted(bytes(c) for c in r[1])
        size[r.key] = len(members)
        met |= {(a, b) for a in members for b in members if a < b}
    match = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])}
    assert len(match) > 100 and match <= met and max(size.values()) < len(sets) // 2


def test_signature_is_superminhash():
    """Against the definition: element after element, swap after swap."""
    random.seed(2)
    rows = [[random.getrandbits(64) for _ in range(n)] for n in (1, 2, 7, 40, 400)]
    flat = np.array([x for r in rows for x in r], dtype=np.uint64)
    got = sm.signatures(flat, np.cumsum([0, *map(len, rows)]))
    for k, row in enumerate(rows):
        low = [np.inf] * sm.PLACES
        for element in row:
            seed, order = bt.mix(np.array([element], dtype=np.uint64)), list(range(sm.PLACES))
            for step in range(sm.PLACES):
                with np.errstate(over="ignore"):
                    draw = int(bt.mix(seed + np.uint64(step + 1) * sm._STEP)[0])
                pick = step + (draw >> 32) % (sm.PLACES - step)
                order[step], order[pick] = order[pick], order[step]
                low[order[step]] = min(low[order[step]], (step << sm._FRACTION) + (draw & ((1 << sm._FRACTION) - 1)))
        assert got[k].tolist() == low


def test_signature_estimates_similarity():
    random.seed(3)
    common = [random.getrandbits(64) for _ in range(300)]
    sets = [common + [random.getrandbits(64) for _ in range(50)] for _ in range(2)]
    got = sm.signatures(np.array(sets[0] + sets[1], dtype=np.uint64), np.array([0, 350, 700]))
    assert abs((got[0] == got[1]).mean() - 300 / 400) < 0.15


def test_edges(edge_docs, no_docs):
    rows = sm.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[8].component_id == 1 and not by_id[8].kept and by_id[1].kept
    assert [by_id[k].n_shingles for k in (2, 3, 4)] == [0, 0, 0] and all(by_id[k].kept for k in (2, 3, 4, 5, 6, 7))
    assert sm.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("few", [0, 100_000])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(cc, "FEW", few)
    random.seed(4)
    pairs = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [
        (random.randrange(200, 400), random.randrange(200, 400)) for _ in range(90)] + [(7, 7)]
    got = {r.node: r.root for r in cc.components(spark.createDataFrame(pairs, "a long, b long").repartition(6)).collect()}
    want = {k: v for k, v in cc.union_find(pairs).items()}
    assert {k: got.get(k, k) for k in want} == want
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0
