import os

import pytest

import corpus_pipeline
from tidemart.llm import queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables missing")


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, FOLDER), name.replace(" ", "-"))
        left = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(set(left)) == len(left) and set(left) <= ids, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns, name
        ids = set(left)
    assert {"doc_id", "n_tokens", "ids"} <= set(docs.columns) and ids


def test_pipeline_edges(spark, edge_docs, monkeypatch, folder):
    """NULLs, repeated rows and empty tables pass through every stage."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    story = "the {} of the old house and a river were near the tree when birds sang songs to many friends in green gardens"
    rows = [(k, story.format(f"number{k} is {'xyz'[k % 3]}{k}"), "en", "s", 1) for k in range(40)] + [(3, None, None, None, None)] * 2 + [
        (None, story.format("nothing"), "en", "s", 1)] * 2 + [(0, story.format("number0 is x0"), "en", "s", 1)]
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([*range(40), None], key=str)


def test_different_texts_under_one_id_stay(spark):
    """Under NULL and under a repeated id; of near duplicates one row stays, whatever ids they have."""
    def text(name, words=60):
        return " ".join(f"{name}{k}" for k in range(words))

    rows = [(None, text("a")), (None, text("b")), (None, text("b") + " more"), (7, text("c")), (7, text("d")), (7, text("d")), (3, text("d") + " more"),
            (None, text("c")), (8, text("e")), (9, ""), (9, None)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    got = corpus_pipeline.one_of_each(spark, docs, FOLDER)
    assert got.columns == docs.columns
    got = [(r.doc_id, r.text) for r in got.collect()]
    b = [x for x in got if x[1] and x[1].startswith("b0")]
    assert len(b) == 1 and b[0] in rows
    assert sorted((x for x in got if x not in b), key=str) == sorted(
        [(None, text("a")), (7, text("c")), (3, text("d") + " more"), (8, text("e")), (9, ""), (9, None)], key=str)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_runs(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)
