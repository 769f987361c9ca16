import random
import re

import numpy as np
import pyarrow as pa

from tidemart.llm import bytetext as bt

TEXTS = ["Hello  World", "", None, "a b\tc", "é x", "one two three four five six seven", " lead", "x" * 400_000 + " y"]


def test_words_and_hashes():
    seen = {}
    for row, end, data, offsets in bt.chunks(pa.array(TEXTS), 64):
        starts, ends, rows = bt.words(data, offsets, bt.ASCII_SPACE)
        codes = bt.hashes(data, starts, ends)
        for k in range(end - row):
            got = [bytes(data[starts[i]:ends[i]]) for i in range(rows[k], rows[k + 1])]
            assert got == (TEXTS[row + k] or "").encode().split()
            for word, code in zip(got, codes[rows[k]:rows[k + 1]].tolist(), strict=True):
                assert seen.setdefault(word, code) == code
    assert len(set(seen.values())) == len(seen)


def test_windows_follow_the_words():
    random.seed(1)
    texts = [" ".join(random.choices("abc", k=random.randint(0, 9))) for _ in range(300)]
    data, offsets = bt.flat(pa.array(texts))
    starts, ends, rows = bt.words(data, offsets, bt.ASCII_SPACE)
    codes, out = bt.windows(bt.hashes(data, starts, ends), rows, 3)
    known = {}
    for k, text in enumerate(texts):
        words = text.split()
        want = [tuple(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [tuple(words)] if words else []
        got = codes[out[k]:out[k + 1]].tolist()
        assert len(got) == len(want)
        for a, b in zip(want, got, strict=True):
            assert known.setdefault(a, b) == b
    assert len(set(known.values())) == len(known)


def test_lower_and_word_bytes():
    text = "Ab-9 É\x00z_"
    data, offsets = bt.flat(pa.array([text]))
    data = bt.LOWER[data]
    starts, ends, _ = bt.words(data, offsets, bt.WORD_BYTES)
    assert [bytes(data[s:e]).decode() for s, e in zip(starts, ends, strict=True)] == re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "ab-9 É\x00z_")


def test_empty_column():
    assert list(bt.chunks(pa.array([], pa.string()))) == []
    assert np.array_equal(bt.words(*bt.flat(pa.array(["", None])), bt.ASCII_SPACE)[2], [0, 0, 0])
