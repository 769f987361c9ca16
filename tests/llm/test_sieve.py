import random

import numpy as np
import pytest

import corpus_pipeline
from tidemart.llm import sieve as sv, superminhash as sm
from tidemart.llm.store import written

FOLDER = "/root/testdata/sf0.001"


def _texts(count, words, seed=5):
    random.seed(seed)
    return [" ".join(f"{random.getrandbits(32):x}" for _ in range(words)) for _ in range(count)]


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
    found = {}
    while files.hasNext():
        f = files.next()
        if f.getName().startswith("shuffle_"):
            found[f.getName()] = f.length()
    return found


@pytest.mark.parametrize("job", [sm.near_duplicates, sm.one_of_each])
def test_unlike_texts_stay_where_they_are_read(spark, job):
    """Only texts with a possible partner, and rows that may go, are dealt out."""
    texts = _texts(400, 2000)
    rows = list(enumerate(texts + [texts[0], texts[1] + " more"]))
    docs = written(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "docs")
    before, limit = _shuffle_files(spark), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as with tables too large for it
    try:
        out = job(docs).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    moved = sum(n for name, n in _shuffle_files(spark).items() if name not in before)
    kept = [r.doc_id for r in out if job is sm.one_of_each or r.kept]
    assert sorted(kept) == list(range(400))
    assert 0 < moved < sum(map(len, texts)) / 5


def test_a_filter_forgets_no_key(spark):
    keys = written(spark.range(20_000).selectExpr("if(id = 7, null, id) as a", "cast(id % 10 as string) as b"), "keys")
    words = sv.sieve(keys, "a", "b")
    asked = spark.range(40_000).selectExpr("if(id = 7, null, id) as a", "cast(id % 10 as string) as b")
    got = asked.where(sv.maybe(words, "a", "b"))
    assert got.where("a is null or a < 20000").count() == 20_000
    assert got.where("a >= 20000").count() < 400
    assert np.count_nonzero(words) <= len(words) <= 20_000 // sv.KEYS + 1
    assert asked.where(sv.maybe(sv.sieve(keys.limit(0), "a", "b"), "a", "b")).count() == 0


@pytest.mark.parametrize("words", [1, sv.WORDS])
def test_a_full_filter_changes_nothing(spark, monkeypatch, words):
    """Also with one word, which passes all; rows repeated, of one id, without id or text."""
    monkeypatch.setattr(sv, "WORDS", words)
    texts = _texts(40, 60)
    rows = [(k, t) for k, t in enumerate(texts)] + [(k, t) for k, t in enumerate(texts[:5])] + [(100 + k, t + " more") for k, t in enumerate(texts[:9])]
    rows += [(20, texts[21]), (None, texts[0]), (None, "x y z"), (None, "x y z"), (None, None), (None, None), (3, None), (3, ""), (3, "")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(4)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.one_of_each(spark, docs, FOLDER).collect()]
    # Text 21 stays under the smaller of its two ids.
    want = [(k, t) for k, t in enumerate(texts) if k != 21] + [(20, texts[21]), (None, "x y z"), (None, None), (3, None), (3, "")]
    assert sorted(got, key=str) == sorted(want, key=str)
