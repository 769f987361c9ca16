import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemart.llm import bpe, bytetext as bt, grammar, pieces

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = public_tokenizers.path("byte_bpe_50k.json")
BITS = ["'s", "'ll", "'", "re", " ", "  ", "\n", "\t", "a", "é", "ß", "1", "²", "!", "漢", "\x1c", "\x85", "😀", "'ve", "'RE", "don't",
        "the", "aaaa", "\r\n", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load(RANKS)[0].ranks, special_tokens={})


def test_bpe_equals_the_library(library):
    random.seed(3)
    texts = ["".join(random.choices(BITS, k=random.randint(0, 14))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 3000, " " * 300, "'" * 50, "é" * 999, None]
    engine, pieces = bpe.load(RANKS)
    for row, _, data, offsets in bt.chunks(pa.array(texts)):
        for k, (ids, decoded) in enumerate(bpe._checked(engine, pieces, data, offsets)):
            assert ids.tolist() == library.encode_ordinary(texts[row + k] or "")
            assert decoded.decode() == (texts[row + k] or "")


def test_rank_queue_gives_lowest_rank_first():
    random.seed(4)
    queue = bpe.RankQueue(50_000)
    want = [(random.randrange(50_000), k) for k in range(2000)]
    for rank, k in want:
        queue.push(rank, k)
    got = []
    while queue.buckets:
        rank, places = queue.pop()
        got += [(rank, k) for k in places]
    assert got == sorted(want)


def test_merge_that_opens_a_lower_rank():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"abc": 256, b"cd": 299}
    engine = bpe.Bpe(ranks)
    own = tiktoken.Encoding("t", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "abcdabcd", "bcbcd", "abcabcd", "aabbccdd"):
        assert engine.encode([text.encode()])[0] == own.encode_ordinary(text)


def test_hash_clash_is_repaired(library):
    engine, pieces = bpe.load(RANKS)
    data, offsets = bt.flat(pa.array(["clashing words"]))
    pieces.ids(data, offsets)
    pieces.memo.pool[:] = pieces.memo.pool[::-1] + 1
    (ids, decoded), = bpe._checked(engine, pieces, data, offsets)
    pieces.clear()
    assert ids.tolist() == library.encode_ordinary("clashing words") and decoded == b"clashing words"


def test_bpe_edges(edge_docs, no_docs, library):
    rows = bpe.digests(edge_docs, RANKS).collect()
    want = sorted((str(r.doc_id), hashlib.sha256(np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes()).hexdigest(),
                   hashlib.sha256((r.text or "").encode()).hexdigest()) for r in edge_docs.collect())
    assert sorted((str(r.doc_id), r.ids_sha256, r.decoded_sha256) for r in rows) == want
    assert bpe.digests(no_docs, RANKS).count() == 0
    assert sorted(r.decoded for r in bpe.encoded(edge_docs, RANKS).collect()) == sorted(r.text or "" for r in edge_docs.collect())


def test_repair_round_trip():
    random.seed(5)
    for ids in ([], [7], [1, 1, 1, 1, 1], random.choices(range(5), k=5000), random.choices(range(50_000), k=500)):
        ids = np.array(ids, dtype=np.int64)
        symbols, rules, lengths = grammar.repair(ids, 50_000)
        assert np.array_equal(grammar.expand(symbols, rules, 50_000), ids)
        for k, length in enumerate(lengths):
            assert len(grammar.expand(np.array([50_000 + k]), rules, 50_000)) == length
        for _ in range(5):
            a, b = sorted(random.choices(range(len(ids) + 1), k=2))
            if a < b:
                assert np.array_equal(grammar.decode_range(symbols, rules, lengths, 50_000, a, b), ids[a:b])
    assert len(grammar.repair(np.array([3, 4] * 1000), 50)[0]) < 100


def test_token_files(spark, edge_docs, no_docs, monkeypatch, folder):
    monkeypatch.setattr(grammar, "SHARD_IDS", 50)
    tokenizer = Tokenizer.from_file(LIBRARY)
    extra = spark.createDataFrame([(k, f"text {k % 7} " * (k % 5)) for k in range(10, 80)], "doc_id long, text string")
    special = spark.createDataFrame([(90, "a<|endoftext|>b"), (91, "<|endoftext|>"), (92, " <|endoftext|> <|endoftext|"), (93, ">b <|endoftext|>"),
                                     *[(94, f"one of many under one id {k}") for k in range(60)]], "doc_id long, text string")
    docs = edge_docs.select("doc_id", "text").unionByName(extra).unionByName(special).repartition(5)
    rows = sorted(docs.withColumn("h", F.xxhash64("text")).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h))
    got = sorted(grammar.indexed(docs, LIBRARY).collect(), key=lambda r: r.start)
    start = 0
    for r, g in zip(rows, got, strict=True):
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (r.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    path = f"{folder}/ids"
    grammar.write_ids(extra, LIBRARY, 2, path)
    back = {r.doc_id: r.ids for r in grammar.read_ids(spark, path).collect()}
    assert back == {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2] for r in extra.collect()}
    assert grammar.indexed(no_docs, LIBRARY).count() == 0
    own = grammar.write_ids(spark.createDataFrame([(7, f"text {k}") for k in range(400)], "doc_id long, text string").repartition(3), LIBRARY, 2, f"{folder}/one")
    assert own is None and spark.read.parquet(f"{folder}/one").select("part").distinct().count() > 1   # one id, several partitions


def test_memory_of_pieces_is_bounded_and_forgets_whole(monkeypatch):
    memo = pieces.Memo(limit=4000)
    rng, sizes = np.random.default_rng(1), []
    for _ in range(40):
        hashes = np.unique(rng.integers(0, 500, 60)).astype(np.uint64)
        begin, size = memo.lookup(hashes, lambda new, h=hashes: (np.repeat(h[new], (h[new] % 4).astype(int)), (h[new] % 4).astype(np.int64)))
        for h, b, n in zip(hashes.tolist(), begin.tolist(), size.tolist(), strict=True):
            assert memo.pool[b:b + n].tolist() == [h] * (h % 4)
        sizes.append(memo.held())
    assert max(sizes) < 4000 + 60 * 40 and any(b < a for a, b in zip(sizes, sizes[1:], strict=False))


def test_bytes_that_are_no_text(spark):
    docs = spark.createDataFrame([(1, bytearray(b"ab\xff cd")), (2, bytearray(b"\xe6\xbc"))], "doc_id long, raw binary").selectExpr("doc_id", "cast(raw as string) text")
    want = {r.doc_id: bytes(r.t) for r in docs.select("doc_id", F.make_valid_utf8("text").cast("binary").alias("t")).collect()}
    assert {r.doc_id: r.decoded_sha256 for r in bpe.digests(docs, RANKS).collect()} == {k: hashlib.sha256(t).hexdigest() for k, t in want.items()}
    assert grammar.indexed(docs, LIBRARY).count() == 2


def test_ranks_file_is_complete():
    with open(RANKS, "rb") as file:
        assert {base64.b64decode(line.split()[0]) for line in file} >= {bytes([b]) for b in range(256)}
