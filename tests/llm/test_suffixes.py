import hashlib
import random
import re

from tidemart.llm import suffixes


def _words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def _brute(docs, items):
    places = {}
    for name, text in items:
        words = _words(text)
        size = min(10, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            places.setdefault(tuple(words[k:k + size]), set()).add(name)
    out = []
    for doc_id, text in docs:
        words, found = _words(text), set()
        hit = [0] * len(words)
        for size in {len(k) for k in places}:
            for k in range(len(words) - size + 1):
                if (names := places.get(tuple(words[k:k + size]))) is not None:
                    found |= {str(n) for n in names if n is not None}
                    hit[k:k + size] = [1] * size
        out.append((doc_id, len(words), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), sum(hit) > 0))
    return sorted(out, key=str)


def _check(docs, bench):
    got = sorted((tuple(r)[:6] for r in suffixes.verdicts(docs, bench).collect()), key=str)
    assert got == _brute(docs.select("doc_id", "text").collect(), bench.select("item_id", "text").collect())


def _made(spark):
    random.seed(1)
    make = lambda n: " ".join(random.choices(["a", "b", "A", "c", "é", "1"], k=n))
    docs = spark.createDataFrame([(i, make(random.randint(0, 60)) if i % 9 else None) for i in range(150)], "doc_id long, text string")
    items = [(i, make(random.choice([0, 4, 6, 9, 10, 11, 13]))) for i in range(12)]
    items += [(50, None), (51, "zz"), (3, "a b c a b c a"), (None, "c c c c"), (52, "b a 1")]
    return docs, spark.createDataFrame(items, "item_id long, text string")


def test_equals_brute_force(spark):
    _check(*_made(spark))


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 40)
    _check(*_made(spark))


def test_edges(spark, edge_docs, no_docs):
    _, bench = _made(spark)
    _check(edge_docs, bench)
    _check(edge_docs, spark.createDataFrame([(1, "two three")], "item_id long, text string"))
    assert suffixes.verdicts(no_docs, bench).count() == 0
    _check(edge_docs, bench.limit(0))
    kept = suffixes.decontaminated(edge_docs, spark.createDataFrame([(1, "two three")], "item_id long, text string"))
    assert kept.columns == edge_docs.columns and kept.where("text like '%two three%'").count() == 0
    assert kept.count() == edge_docs.count() - 3


def test_longest_match(spark):
    item = " ".join(f"w{k}" for k in range(30))
    text = "x y " + " ".join(f"w{k}" for k in range(5, 22)) + " z " + " ".join(f"w{k}" for k in range(0, 11))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = suffixes.verdicts(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).first()
    assert (r.longest_words, r.longest_item, r.longest_at, r.n_hit) == (17, "7", 2, 28)


def test_thirty_blocks_one_after_another(spark, monkeypatch):
    """Every item a block of its own; the driver takes up a block only when those before are written."""
    monkeypatch.setattr(suffixes, "BLOCK_BYTES", 60)
    items = [(f"i{k:02d}", " ".join(f"w{k}x{j}" for j in range(12))) for k in range(30)]
    docs = spark.createDataFrame([(k, f"before {text} after") for k, (_, text) in enumerate(items)] + [(99, "clean text")], "doc_id long, text string")
    taken, written = [], suffixes.written
    monkeypatch.setattr(suffixes, "written", lambda df, name: (taken.append(name), written(df, name))[1])
    rows = {r.doc_id: r for r in suffixes.verdicts(docs, spark.createDataFrame(items, "item_id string, text string"), 10).collect()}
    assert all(rows[k].n_hit == 12 and rows[k].n_items == 1 and rows[k].longest_item == items[k][0] for k in range(30)) and not rows[99].contaminated
    assert len(taken) >= 10
