"""Quality rules from base counts and tokeniser fertility.

Base counts: words, characters, symbols, lines equal to an earlier line, words inside repeated
five-word windows. Fertility: two public vocabularies measure how a text falls into tokens,
namely characters per token, the share of byte-fallback tokens and the entropy of the tokens. A
text is rejected when one of them leaves the band of its language, or when a measure leaves the
script's limits.

Bands come from all texts that pass the base rule, as medians and spreads of exact histograms on a
fixed grid, so they don't depend on how the rows are dealt out; entropy, which grows with the
number of tokens, has bands for each half octave of it. No count switches a rule on or off: a language
with n texts has the weight n / (n + FEW) against its script, the script's spread has such a weight
against the corpus, and bands of scripts with few texts are wider by sqrt(1 + FEW / n).

Rows: NULL or empty text has no words and fails the base rule. Repeated rows and equal ids keep
one row each. NULL languages use the band of the script. Columns of the documents are
carried in a struct, so their names can't clash with the results.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from . import bytetext as bt
from .caches import hold
from .pieces import Memo
from .store import written

SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", dtype=np.uint8))
#: First code point after each script's first block, with the script's name; a coarse table is enough for bands.
SCRIPTS = ((0x0250, "latin"), (0x0370, "other"), (0x0400, "greek"), (0x0530, "cyrillic"), (0x0900, "semitic"),
           (0x1100, "indic"), (0x1200, "hangul"), (0x1E00, "other"), (0x2000, "latin"), (0x2E80, "other"),
           (0xAC00, "han"), (0xD800, "hangul"), (0xF900, "other"), (0xFB00, "han"), (0x20000, "other"), (0x110000, "han"))
#: Limits of the measures per script, whatever the corpus holds: characters per token in both
#: vocabularies (least, most), most byte tokens, least bits per token for a very long text; a text of n
#: tokens needs n / (n + LONG) of them.
LIMITS = {
    "latin": (1.0, 12.0, 1.0, 12.0, 0.25, 3.0),
    "greek": (0.5, 12.0, 0.4, 12.0, 0.60, 3.0),
    "cyrillic": (0.6, 12.0, 0.5, 12.0, 0.60, 3.0),
    "semitic": (0.4, 12.0, 0.3, 12.0, 0.80, 3.0),
    "indic": (0.2, 12.0, 0.2, 12.0, 1.00, 2.5),
    "hangul": (0.2, 6.0, 0.2, 6.0, 1.00, 2.5),
    "han": (0.2, 6.0, 0.2, 6.0, 1.00, 2.5),
    "other": (0.2, 12.0, 0.2, 12.0, 1.00, 2.5),
}
#: Half width of a language's or script's band around its median, in spreads (interquartile range
#: / 1.349). A text of n tokens gets sqrt(1 + SHORT / n) times that, since few tokens vary more.
WIDTH, SHORT = 5.0, 200
#: Byte share: only above the median, in spreads of the upper half (95th percentile / 1.645) plus what
#: one character more or less, of up to BYTES tokens, makes in a text of n tokens.
BYTE_WIDTH, BYTES = 5.0, 4
#: Entropy: spreads around the median of the texts with about as many tokens, each spread LEAST bits at least.
ENTROPY_WIDTH, LEAST = 4.0, 0.05
LONG = 200
#: Texts at which a language weighs as much as its script, a script as much as the corpus: of all texts, and of a half octave.
FEW, FEW_ENTROPY = 500, 100
#: Each measure with the step of its histogram's grid and its largest value there.
GRID = {"chars_per_piece": (0.01, 100.0), "chars_per_rank": (0.01, 100.0), "byte_share": (0.0005, 1.0), "entropy": (0.01, 64.0)}


class _Vocabularies:
    """Token ids of words in the piece vocabulary, and token counts in the byte vocabulary."""

    def __init__(self, piece_path: str, rank_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.piece = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.byte = np.array([self.piece.is_byte(k) for k in range(self.piece.get_piece_size())])
        with open(rank_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.memo = Memo()   # of each word: its tokens in the byte vocabulary, then its ids in the piece vocabulary

    def measure(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [w.decode("utf-8", "replace") for w in words]
        own = self.piece.encode(texts, num_threads=1)
        numbers = [x for ids, text in zip(own, texts, strict=True) for x in (len(self.ranks.encode_ordinary(" " + text)), *ids)]
        return np.array(numbers, dtype=np.int64), np.array([len(ids) + 1 for ids in own], dtype=np.int64)


@lru_cache(maxsize=1)
def _vocabularies(piece_path: str, rank_path: str) -> _Vocabularies:
    return _Vocabularies(piece_path, rank_path)


def base_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], tuple]:
    """Base counts of each row of a chunk, and the words' starts, ends, row offsets and hashes."""
    starts, ends, rows = bt.words(data, offsets, bt.ASCII_SPACE)
    code = bt.hashes(data, starts, ends)
    char = ((data & 0xC0) != 0x80) & bt.ASCII_SPACE[data]
    line_end = np.unique(np.concatenate([np.flatnonzero(data == 10), offsets[1:]])) if len(data) else np.zeros(0, dtype=np.int64)
    begin = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, offsets[:-1]])) if len(data) else line_end
    begin = begin[begin < len(data)]
    begin = begin[data[begin] != 10]
    stop = line_end[np.searchsorted(line_end, begin, side="right")] if len(begin) else begin
    filled = np.searchsorted(starts, begin) < np.searchsorted(starts, stop)
    begin, stop = begin[filled], stop[filled]
    row = np.searchsorted(offsets, begin, side="right") - 1
    again = pd.Series(_keyed(bt.hashes(data, begin, stop), row)).duplicated().to_numpy()
    window, window_rows = bt.windows(code, rows, 5)
    home = bt.row_of(window_rows)
    twice = np.flatnonzero(pd.Series(_keyed(window, home)).duplicated(keep=False).to_numpy())
    at = twice - window_rows[home[twice]] + rows[home[twice]]
    change = np.zeros(len(code) + 6, dtype=np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + 5, -1)
    covered = (np.cumsum(change)[:len(code)] > 0).astype(np.int64)
    counts = {"n_words": np.diff(rows), "word_chars": bt.rows_sum(char.astype(np.int64), offsets),
              "n_symbols": bt.rows_sum(SYMBOLS[data].astype(np.int64), offsets),
              "n_dup_lines": np.bincount(row[again], minlength=len(offsets) - 1).astype(np.int64),
              "n_repeat_words": bt.rows_sum(covered, rows)}
    return counts, (starts, ends, rows, code)


def _keyed(hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return bt.mix(hashes + bt.mix(row.astype(np.uint64) + np.uint64(1)))


def fertility(data: np.ndarray, words: tuple, vocabularies: _Vocabularies) -> dict[str, np.ndarray]:
    """Tokens in both vocabularies, byte tokens and bits per token of each row of a chunk."""
    starts, ends, rows, code = words
    n = len(rows) - 1
    if not len(code):
        zero = np.zeros(n, dtype=np.int64)
        return {"n_pieces": zero, "n_bytes": zero, "n_ranks": zero, "entropy": zero.astype(float)}
    place, distinct = pd.factorize(code)
    first = np.empty(len(distinct), dtype=np.int64)
    first[place[::-1]] = np.arange(len(place))[::-1]
    text = data.tobytes()
    begin, size = vocabularies.memo.lookup(distinct, lambda new: vocabularies.measure(
        [text[s:e] for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]))
    pool = vocabularies.memo.pool
    n_ranks, length = pool[begin].astype(np.int64), size - 1
    stop = np.cumsum(length)
    flat = pool[np.repeat(begin + 1 - (stop - length), length) + np.arange(stop[-1] if len(stop) else 0)]
    n_bytes = bt.rows_sum(vocabularies.byte[flat].astype(np.int64), np.append(0, stop))
    per = length[place]
    total = np.append(0, np.cumsum(per))
    where = np.repeat((stop - length)[place] - total[:-1], per) + np.arange(total[-1])
    token_rows = total[rows]
    ordered = np.sort(bt.row_of(token_rows).astype(np.uint64) << np.uint64(16) | flat[where].astype(np.uint64))
    at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, dtype=np.int64)
    times = np.diff(np.append(at, len(ordered))).astype(float)
    home = (ordered[at] >> np.uint64(16)).astype(np.int64)
    tokens = np.diff(token_rows)
    share = times / np.maximum(tokens, 1)[home]
    return {"n_pieces": tokens, "n_bytes": bt.rows_sum(n_bytes[place], rows),
            "n_ranks": bt.rows_sum(n_ranks[place], rows),
            "entropy": np.bincount(home, weights=-share * np.log2(share), minlength=n)}


def scripts(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The script of most letters of each row of a chunk; Latin if it has none."""
    chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    limits = np.array([limit for limit, _ in SCRIPTS])
    names = [name for _, name in SCRIPTS]
    kinds = list(dict.fromkeys(names))
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    cuts = np.searchsorted(lead, offsets)
    letter = (chars >= 0xC0) | ((chars | 0x20) >= 0x61) & ((chars | 0x20) <= 0x7A)
    kind = np.array([kinds.index(x) for x in names])[np.searchsorted(limits, chars, side="right").clip(max=len(names) - 1)]
    many = np.stack([bt.rows_sum((letter & (kind == k)).astype(np.int64), cuts) for k in range(len(kinds))], axis=1)
    return [kinds[k] for k in many.argmax(axis=1)]


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_pieces", "n_bytes", "n_ranks")


def measured(docs: DataFrame, piece_path: str, rank_path: str, carry: list[str]) -> DataFrame:
    """`row` (the columns to carry), base counts, fertility counts, entropy and script."""
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.make_valid_utf8("text").alias("text"))
    schema = given.select("row", *[F.lit(0).cast("bigint").alias(c) for c in COUNTS],
                          F.lit(0.0).alias("entropy"), F.lit("").alias("script")).schema

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = _vocabularies(piece_path, rank_path)
        hold("fertility", lambda: (vocabularies.memo.clear(), _vocabularies.cache_clear()))
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column(1)):
                counts, words = base_counts(data, offsets)
                counts |= fertility(data, words, vocabularies)
                yield pa.record_batch([
                    batch.column(0).slice(row, end - row), *[pa.array(counts[c], pa.int64()) for c in COUNTS],
                    pa.array(counts["entropy"], pa.float64()), pa.array(scripts(data, offsets), pa.string())],
                    names=["row", *COUNTS, "entropy", "script"])

    return given.mapInArrow(measure, schema)


def histogram(rows: DataFrame) -> DataFrame:
    """language, script, measure, octave (of the entropy, else -1), bin and the number of texts that pass the base rule."""
    cells = [F.struct(F.lit(m).alias("measure"), (F.col("octave") if m == "entropy" else F.lit(-1)).cast("int").alias("octave"),
                      F.round(F.least(F.col(m), F.lit(top)) / step).cast("int").alias("bin")) for m, (step, top) in GRID.items()]
    return rows.where(~F.col("base_failed")).select("language", "script", F.inline(F.array(*cells))).where(
        F.col("bin").isNotNull() & F.col("octave").isNotNull()).groupBy("language", "script", "measure", "octave", "bin").agg(F.count("*").alias("n"))


def _statistics(found: DataFrame, *key: str) -> DataFrame:
    """Texts, median and spread of each measure and octave under a key, from a histogram."""
    bins = found.groupBy(*key, "measure", "octave", "bin").agg(F.sum("n").alias("n"))
    whole = W.partitionBy(*key, "measure", "octave")
    bins = bins.withColumn("upto", F.sum("n").over(whole.orderBy("bin"))).withColumn("texts", F.sum("n").over(whole))
    quantile = lambda q: F.min(F.when(F.col("upto") >= q * F.col("texts"), F.col("bin")))
    step = F.create_map(*[F.lit(x) for m, (width, _) in GRID.items() for x in (m, width)])[F.col("measure")]
    got = bins.groupBy(*key, "measure", "octave").agg(F.max("texts").alias("texts"), *[quantile(q).alias(f"q{int(100 * q)}") for q in (0.25, 0.5, 0.75, 0.95)])
    spread = F.when(F.col("measure") == "byte_share", (F.col("q95") - F.col("q50")) * step / 1.645).otherwise((F.col("q75") - F.col("q25")) * step / 1.349)
    return got.select(*key, "measure", "octave", "texts", (F.col("q50") * step).alias("middle"),
                      F.when(F.col("measure") == "entropy", F.greatest(F.lit(LEAST), spread)).otherwise(spread).alias("spread"))


def bands(found: DataFrame) -> DataFrame:
    """The middle and the spread (widened where few texts speak) of each language, script, measure and octave that occurs."""
    def named(df: DataFrame, prefix: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in ("texts", "middle", "spread")})

    at = ["measure", "octave"]
    here = found.select("language", "script", *at).distinct()
    both = here.join(named(_statistics(found, "script"), "script"), ["script", *at]).join(named(_statistics(found), "corpus"), at).join(
        named(_statistics(found.where(F.col("language").isNotNull()), "language"), "language"), ["language", *at], "left")
    few = F.when(F.col("measure") == "entropy", float(FEW_ENTROPY)).otherwise(float(FEW))
    weight = lambda n: F.coalesce(n / (n + few), F.lit(0.0))
    mixed = lambda w, own, other: F.when(w > 0, w * own + (1 - w) * other).otherwise(other)
    script = mixed(weight(F.col("script_texts")), F.col("script_spread"), F.col("corpus_spread"))
    own = weight(F.col("language_texts"))
    return both.select("language", "script", *at, mixed(own, F.col("language_middle"), F.col("script_middle")).alias("middle"),
                       (mixed(own, F.col("language_spread"), script) * F.sqrt(1 + few / F.col("script_texts"))).alias("spread"))


def ruled(docs: DataFrame, piece_path: str, rank_path: str, carry: list[str], lang: str = "lang") -> DataFrame:
    """`measured` with the characters per token, base_failed and kept.

    The measures are written once; the bands come from all of them.
    """
    rows = measured(docs, piece_path, rank_path, carry)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = written(rows.select(
        "*", F.try_divide("word_chars", "n_pieces").alias("chars_per_piece"),
        F.try_divide("word_chars", "n_ranks").alias("chars_per_rank"), failed.alias("base_failed"),
        F.try_divide("n_bytes", "n_pieces").alias("byte_share"),
        F.when(F.col("n_pieces") > 0, F.floor(2 * F.log2("n_pieces"))).cast("int").alias("octave"),
        (F.col(f"row.`{lang}`").cast("string") if lang in carry else F.lit(None).cast("string")).alias("language")), "measured")
    # Written, so that its size is known when the joins are planned: some rows per language, no shuffle of the texts.
    found = written(bands(written(histogram(rows), "histogram")), "bands")
    plain = found.where("octave = -1").groupBy("language", "script").agg(*[
        F.max(F.when(F.col("measure") == m, F.struct("middle", "spread"))).alias(f"_{m}") for m in GRID if m != "entropy"])
    bits = found.where("measure = 'entropy'").select("language", "script", "octave", F.struct("middle", "spread").alias("_entropy"))
    for band, keys in ((plain, ("language", "script")), (bits, ("language", "script", "octave"))):
        own = band.withColumnsRenamed({k: f"_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        rows = rows.join(own, reduce(lambda a, b: a & b, same), "left").drop(*[f"_{k}" for k in keys])
    inside = F.lit(False)
    for script, (low, high, low_rank, high_rank, most_bytes, least_bits) in LIMITS.items():
        inside = inside | (F.col("script") == script) & F.col("chars_per_piece").between(low, high) & F.col(
            "chars_per_rank").between(low_rank, high_rank) & (F.col("n_bytes") <= most_bytes * F.col("n_pieces")) & (
            F.col("entropy") >= least_bits * F.col("n_pieces") / (F.col("n_pieces") + LONG))
    for measure, tokens in (("chars_per_piece", "n_pieces"), ("chars_per_rank", "n_ranks")):
        band = F.col(f"_{measure}")
        width = WIDTH * band["spread"] * F.sqrt(1 + F.try_divide(F.lit(SHORT), F.col(tokens)))
        inside = inside & (F.abs(F.col(measure) - band["middle"]) <= width)
    band = F.col("_byte_share")
    noise = BYTES * (band["middle"] + BYTES / F.col("n_pieces")) / F.col("n_pieces")
    width = BYTE_WIDTH * F.sqrt(band["spread"] * band["spread"] + noise)
    inside = inside & (F.col("byte_share") <= band["middle"] + width)
    band = F.col("_entropy")
    inside = inside & (F.abs(F.col("entropy") - band["middle"]) <= ENTROPY_WIDTH * band["spread"])
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return rows.select("row", *COUNTS, "entropy", "script", "chars_per_piece", "chars_per_rank", "base_failed", kept.alias("kept"))
