import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemart.llm import alignment, bytetext as bt, ends

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BITS = [" ", "  ", "   ", "\n", "\t", "a", "the", "ing", "é", "ß", "1", "²", "!", "漢字", "\x1c", "\x00", "\x85", "😀", "'ve", "don't", "aaaa", "\r\n",
        "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "　", "Ünder", "-", ",", "word", " word", "ﬁ"]


def test_common_values_whatever_the_pieces():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = np.unique(rng.integers(0, rng.integers(2, 200), rng.integers(0, 120)))
        b = np.unique(rng.integers(0, rng.integers(2, 200), rng.integers(0, 120)))
        want = np.intersect1d(a, b)
        for piece in (1, 2, 3, 7, 50, 1000):
            i, j = ends.common(a, b, piece)
            assert a[i].tolist() == b[j].tolist() == want.tolist()


def test_pieces_have_equal_work():
    a, b = np.arange(0, 5000), np.arange(4990, 5040)       # very unlike in length and place
    diagonals = np.append(np.arange(0, len(a) + len(b), 101), len(a) + len(b))
    left = ends.cuts(a, b, diagonals)
    assert (np.diff(left) + np.diff(diagonals - left) <= 101).all()
    merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    for d, i in zip(diagonals.tolist(), left.tolist(), strict=True):
        assert sum(side == 0 for _, side in merged[:d]) == i


class Truth:
    """The contract, token by token, with whole texts given to both libraries."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.byte = {v: k for k, v in alignment.byte_symbols().items()}
        self.sign = alignment.byte_symbols()

    def a_bytes(self, k):
        return bytes(self.sign[c] for c in self.a.id_to_token(k))

    def b_bytes(self, k):
        return bytes([int(self.b.id_to_piece(k)[3:-1], 16)]) if self.b.is_byte(k) else self.b.id_to_piece(k).replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        want = (" " + text).encode()
        if b"".join(map(self.a_bytes, a)) != want or b"".join(map(self.b_bytes, b)) != want:
            return [], []
        return a, b

    def rows(self, texts):
        """One result per text: counts, digest; by brute force over all ends."""
        links, shown = [], []
        for text in texts:
            a, b = self.tokens(text)
            ea, eb = np.cumsum([len(self.a_bytes(k)) for k in a]).tolist(), np.cumsum([len(self.b_bytes(k)) for k in b]).tolist()
            links.append([(x, y) for x, end in zip(a, ea, strict=True) for y, other in zip(b, eb, strict=True) if end == other])
            cut = sorted(set(ea) & set(eb))
            groups = [(",".join(str(x) for x, e in zip(a, ea, strict=True) if s < e <= t), ",".join(str(y) for y, e in zip(b, eb, strict=True) if s < e <= t))
                      for s, t in zip([0, *cut], cut, strict=False)]
            shown.append((len(a), len(b), len(groups), hashlib.sha256(";".join(f"{x}|{y}" for x, y in groups).encode()).hexdigest() if a else ""))
        count = Counter(p for own in links for p in own)
        best = defaultdict(int)
        for (_, y), n in count.items():
            best[y] = max(best[y], n)
        return [(na, nb, ng, len(own), sum(count[p] == best[p[1]] for p in own), sum(count[p] for p in own), digest)
                for own, (na, nb, ng, digest) in zip(links, shown, strict=True)]


@pytest.fixture(scope="module")
def truth():
    return Truth()


def odd_texts(n, seed):
    random.seed(seed)
    return ["".join(random.choices(BITS, k=random.randint(0, 12))) for _ in range(n)]


def test_ids_equal_the_libraries(truth):
    a, b = alignment.vocabularies(A, B)
    texts = odd_texts(3000, 5) + ["a" * 3000, " " * 400, "word " * 900]
    data, offsets = alignment.spaced(*bt.flat(pa.array(texts)))
    for vocabulary, library in ((a, lambda t: truth.a.encode(" " + t, add_special_tokens=False).ids), (b, truth.b.encode)):
        ids, rows, ok = alignment.spelled_ids(vocabulary, data, offsets)
        for k, text in enumerate(texts):
            if ok[k] and text:
                assert ids[rows[k]:rows[k + 1]].tolist() == library(text), repr(text)
            elif text:
                assert "▁" in text


def test_a_clash_of_hashes_is_mended(truth):
    a, _ = alignment.vocabularies(A, B)
    data, offsets = alignment.spaced(*bt.flat(pa.array(["one two three", "four"])))
    a.pieces.clear()
    a.ids(data, offsets)
    a.pieces.memo.pool[:] = a.pieces.memo.pool[::-1].copy()
    ids, rows, ok = alignment.spelled_ids(a, data, offsets)
    a.pieces.clear()
    assert ok.all() and ids[:rows[1]].tolist() == truth.a.encode(" one two three", add_special_tokens=False).ids


def test_equals_brute_force(spark, truth):
    texts = [*odd_texts(150, 6), None, "", "the word the word", "the word the word", "x▁y", "long and longer " * 200]
    df = spark.createDataFrame([(k if k % 9 else None, t, 1, "z") for k, t in enumerate(texts)], "doc_id long, text string, n_a int, row string").repartition(3)
    rows = alignment.aligned(df, A, B, carry=["doc_id", "text", "row"]).collect()
    assert len(rows) == len(texts)
    want = Counter(zip(texts, truth.rows(texts), strict=True))
    got = Counter((r.row.text, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)) for r in rows)
    assert got == want


def test_edges(spark, edge_docs, no_docs):
    rows = alignment.aligned(edge_docs, A, B, carry=edge_docs.columns).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        assert (r.groups_sha256 == "") == (not r.row.text) == (r.n_a == 0)
    assert alignment.aligned(no_docs, A, B, carry=["doc_id"]).count() == 0


def test_bytes_that_are_no_text(spark):
    df = spark.createDataFrame([(1, bytearray(b"ab\xff cd"))], "doc_id long, raw binary").selectExpr("doc_id", "cast(raw as string) text")
    assert alignment.aligned(df, A, B, carry=["doc_id"]).first().n_a > 0


def test_pairs_are_bounded_by_the_vocabularies(truth):
    """One token of a linked pair is a suffix of the other."""
    for text in odd_texts(200, 8):
        a, b = truth.tokens(text)
        ea, eb = np.cumsum([len(truth.a_bytes(k)) for k in a]).tolist(), np.cumsum([len(truth.b_bytes(k)) for k in b]).tolist()
        for x, end in zip(a, ea, strict=True):
            if end in eb:
                p, q = truth.a_bytes(x), truth.b_bytes(b[eb.index(end)])
                assert p.endswith(q) or q.endswith(p)
