"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

One pass over the texts makes a signature per document. An element's j-th draw is j plus a
random fraction and goes to the j-th place of the element's own random permutation of the
signature; a document stops as soon as no later draw could lower any of its places.

Documents with equal shingle sets are one class from then on. Classes that share a band go
through rounds. In a round each bucket gets a centre, the member that sits in the largest
buckets, and every member is compared with the centre on full sets (a star, never all pairs).
What stays open is split by the differences from the centre: two members that match although
not both match the centre must share difference elements, so only members that share one of
a prefix of them meet again, in a smaller bucket. Members unlike the centre meet in a bucket
of their own; with more than DIRECT members it is split by the rarest elements of their sets.
Stars of up to DIRECT members are finished in one task instead of being split.
Rounds end when no bucket is open.

Disk and network: bands of one class, texts no one else is like, and rows that surely stay are kept
out of the shuffles by Bloom filters (sieve.py), with the exact join behind them. Texts travel
instead of their sets, which are larger; a pair's sets are made where its texts meet.

Rows: NULL, empty or blank text has an empty set and links with nothing. Repeated rows and
equal doc_ids keep one row each. A NULL doc_id stays NULL; a group's id is the smallest doc_id
that is not NULL. Further columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import bytetext as bt
from .caches import hold, release
from .components import components
from .sieve import code, may_know, maybe, sieve
from .store import written

PLACES = 80          # signature length
BAND = 4             # places per band; a pair at 0.85 shares none of 20 bands with p = 4e-7
DIRECT, DIRECT_ITEMS = 4096, 1 << 20  # stars of at most so many members and differences are finished in one task
NEAR, FAR = 0.3, 0.6  # share of equal places: compared on full sets from NEAR; below it bucketed anew, with all below FAR
PAIR, CROWD = 0.65, 50  # two members of a finished bucket meet from PAIR on (5 deviations below 0.85)

_COLUMNS = 2048
_FRACTION = 24       # bits of a draw's random fraction
_STEP = np.uint64(0xD1342543DE82EF95)
SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.binary()),
                    ("sig", pa.list_(pa.int32()))])


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row of a chunk, and the n + 1 offsets of the rows."""
    import pandas as pd

    starts, ends, rows = bt.words(data, offsets, bt.ASCII_SPACE)
    shingles, rows = bt.windows(bt.hashes(bt.LOWER[data], starts, ends), rows, size)
    row = bt.row_of(rows)
    with np.errstate(over="ignore"):
        again = pd.Series(bt.mix(shingles + bt.mix(row.astype(np.uint64) + np.uint64(1)))).duplicated().to_numpy()
    kept = np.flatnonzero(~again)
    return shingles[kept], np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=len(rows) - 1))])


def signatures(elements: np.ndarray, rows: np.ndarray, places: int = PLACES) -> np.ndarray:
    """SuperMinHash signatures, one line of `places` numbers per row; empty rows keep the maximum."""
    n = len(rows) - 1
    out = np.full((n, places), np.iinfo(np.int32).max, dtype=np.int32)
    row = bt.row_of(rows)
    seeds = bt.mix(elements)
    order = None      # each element's permutation so far: the places that later swaps have moved
    for step in range(places):
        with np.errstate(over="ignore"):
            draw = bt.mix(seeds + np.uint64(step + 1) * _STEP)
        pick = step + ((draw >> np.uint64(32)) % np.uint64(places - step)).astype(np.int64)
        if order is None:
            place = pick
        else:
            line = np.arange(len(row))
            place = order[line, pick].astype(np.int64)
            order[line, pick] = order[:, step]
        value = (np.int64(step) << _FRACTION) + (draw & np.uint64((1 << _FRACTION) - 1)).astype(np.int64)
        np.minimum.at(out.reshape(-1), row * places + place, value.astype(np.int32))
        open_rows = out.max(axis=1) >= (step + 1) << _FRACTION
        go_on = open_rows[row]
        if not go_on.any():
            break
        if order is None:  # only rows that go on need their permutations
            order = np.broadcast_to(np.arange(places, dtype=np.uint8), (int(go_on.sum()), places)).copy()
            line = np.arange(len(order))
            order[line, pick[go_on]] = 0
        elif not go_on.all():
            order = order[go_on]
        if not go_on.all():
            row, seeds = row[go_on], seeds[go_on]
    return out


def band_keys(signature: Column, places: int = PLACES, band: int = BAND) -> Column:
    return F.array(*[F.xxhash64(F.lit(low), *[F.get(signature, F.lit(low + k)) for k in range(band)]) for low in range(0, places, band)])


def set_digest(elements: np.ndarray, rows: np.ndarray) -> list[bytes | None]:
    """128 bits that stand for a row's set whatever its order; None for an empty set."""
    with np.errstate(over="ignore"):
        parts = [bt.rows_sum(bt.mix(elements + np.uint64(k)), rows) for k in (17, 291)]
    sums = np.stack(parts, axis=1).astype(">u8")
    return [sums[i].tobytes() if rows[i + 1] > rows[i] else None for i in range(len(rows) - 1)]


def _lists(values: np.ndarray, rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), pa.array(values))


def signed(docs: DataFrame, size: int, digest: bool = False) -> DataFrame:
    """doc_id, set size, class digest and signature of each row; with `digest` its text's as `text_key`."""
    extra = [F.md5("text").alias("text_key")] if digest else []
    schema = pa.schema([*SIGNED, *[pa.field("text_key", pa.string())] * digest])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("signatures")
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column(1)):
                sets, rows = shingle_sets(data, offsets, size)
                signature = signatures(sets, rows)
                full = np.flatnonzero(np.diff(rows))
                n = end - row
                per = np.zeros(n + 1, dtype=np.int64)
                per[full + 1] = 1
                per = np.cumsum(per)
                yield pa.record_batch([
                    batch.column(0).slice(row, n), pa.array(np.diff(rows)), pa.array(set_digest(sets, rows), pa.binary()),
                    _lists(signature[full].reshape(-1), per * PLACES),
                    *[c.slice(row, n) for c in batch.columns[2:]]], schema=schema)

    return docs.select(F.col("doc_id").cast("bigint"), "text", *extra).mapInArrow(
        sign, "doc_id bigint, n_shingles bigint, cls binary, sig array<int>" + ", text_key string" * digest)


def _texts(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """cls and the text of its first document, for the classes wanted (cls, rep); a text is shorter than its set.

    Texts stay where they are read: a filter of the first documents' ids passes few others, and these
    fall out where the texts meet the classes.
    """
    ids = sieve(wanted, "rep")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).filter(pa.array(may_know(ids, batch.column(0).to_numpy(zero_copy_only=False))))
            for row, end, data, offsets in bt.chunks(texts):
                yield pa.record_batch([pa.array(set_digest(*shingle_sets(data, offsets, size)), pa.binary()), texts.slice(row, end - row)],
                                      names=["cls", "text"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").select(code("doc_id"), "text")
    made = texts.mapInArrow(named, "cls binary, text string").join(wanted.select("cls"), "cls", "left_semi")
    return made.groupBy("cls").agg(F.first("text").alias("text"))


def _full_sets(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """cls and its whole set, for the classes of a written table."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column(1)):
                sets, rows = shingle_sets(data, offsets, size)
                yield pa.record_batch([batch.column(0).slice(row, end - row), _lists(sets.view(np.int64), rows)], names=["cls", "items"])

    return texts.where(maybe(sieve(wanted, "cls"), "cls")).select("cls", "text").mapInArrow(make, "cls binary, items array<bigint>")


def _differences(pairs: DataFrame, size: int) -> DataFrame:
    """Elements that the text `own` has beyond `heart` (`added`) and the other way (`gone`), next to the pairs' other columns."""
    kept = [c for c in pairs.columns if c not in ("own", "heart")]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in bt.chunks(batch.column("own")):
                part = batch.slice(row, end - row)
                a, a_rows = shingle_sets(data, offsets, size)
                b, b_rows = shingle_sets(*bt.flat(part.column("heart")), size)
                both = [(a[a_rows[k]:a_rows[k + 1]], b[b_rows[k]:b_rows[k + 1]]) for k in range(end - row)]
                lists = []
                for found in ([np.setdiff1d(x, y, assume_unique=True) for x, y in both], [np.setdiff1d(y, x, assume_unique=True) for x, y in both]):
                    lists.append(_lists(np.concatenate(found).view(np.int64), np.cumsum([0, *map(len, found)])))
                yield pa.record_batch([*[part.column(c) for c in kept], *lists], names=[*kept, "added", "gone"])

    schema = ", ".join(f"{c} {pairs.schema[c].dataType.simpleString()}" for c in kept)
    return pairs.select(*kept, "own", "heart").mapInArrow(compare, f"{schema}, added array<bigint>, gone array<bigint>")


def _agreement(a: Column, b: Column) -> Column:
    """Share of equal places of two signatures."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)


def _linked(shared: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * shared >= percent * (a + b - shared)


def _matches(members: list[dict], percent: int) -> list[tuple[bytes, bytes]]:
    """Links that join the components among a star's members, from their differences to its centre."""
    lengths = np.array([len(m["delta"]) for m in members])
    owner = np.repeat(np.arange(len(members)), lengths)
    _, item, often = np.unique(np.concatenate([np.array(m["delta"], dtype=np.int64) for m in members]),
                               return_inverse=True, return_counts=True)
    met = often[item] > 1
    _, item = np.unique(item[met], return_inverse=True)
    owner = owner[met]
    order = np.argsort(item, kind="stable")
    owner, item = owner[order], item[order]
    outer = np.array([i for i, m in enumerate(members) if not m["linked"]])
    shared = np.zeros((len(outer), len(members)), dtype=np.float32)
    for low in range(0, int(item[-1]) + 1 if len(item) else 0, _COLUMNS):
        a, b = np.searchsorted(item, [low, low + _COLUMNS])
        has = np.zeros((len(members), _COLUMNS), dtype=np.float32)
        has[owner[a:b], item[a:b] - low] = 1
        shared += has[outer] @ has.T
    n = np.array([m["n"] for m in members])
    apart = lengths[outer][:, None] + lengths[None, :] - 2 * shared.astype(np.int64)
    total = n[outer][:, None] + n[None, :]
    roots = [m["root"] for m in members]
    found, known = [], {r: r for r in roots}
    for i, j in zip(*np.nonzero(100 * (total - apart) >= percent * (total + apart)), strict=True):
        a, b = roots[outer[i]], roots[j]
        while known[a] != a:
            a = known[a]
        while known[b] != b:
            b = known[b]
        if a != b:
            known[max(a, b)] = min(a, b)
            found.append((members[outer[i]]["cls"], members[j]["cls"]))
    return found


def _compared(groups: DataFrame, percent: int) -> DataFrame:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = _matches(batch.column(0)[k].as_py(), percent)
                yield pa.record_batch([pa.array([x for x, _ in found], pa.binary()), pa.array([y for _, y in found], pa.binary())],
                                      names=["a", "b"])

    return groups.select("members").mapInArrow(compare, "a binary, b binary")


def links(docs: DataFrame, size: int = 5, percent: int = 85, digest: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows with their class, links between classes)."""
    release()   # what the driver holds of jobs before
    rows = written(signed(docs, size, digest), "signed")
    each = rows.where("cls is not null").select("cls", F.explode(band_keys(F.col("sig"))).alias("key"))
    # Most bands are one class's own. 64 bits tell a band's classes apart, and only rows of shared bands are dealt out.
    shared = each.groupBy("key").agg(F.min(code("cls")).alias("low"), F.max(code("cls")).alias("high")).where("low < high")
    shared = written(shared.select("key"), "shared")
    buckets = written(each.where(maybe(sieve(shared, "key"), "key")).distinct().join(shared, "key"), "buckets")
    members = buckets.groupBy("key").agg(F.count("*").alias("members"))
    popular = written(buckets.join(members, "key").groupBy("cls").agg(F.sum("members").alias("pop")), "popular")
    # Copies fold into one row a class before the shuffle, and only then meet the other classes.
    classes = rows.where("cls is not null").where(maybe(sieve(popular, "cls"), "cls")).groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.min("sig").alias("sig"))
    known = written(classes.join(popular, "cls").select("cls", "rep", "n", "sig", "pop"), "known")
    texts = written(_texts(docs, known.select("cls", "rep"), size), "texts")
    buckets = buckets.join(known.select("cls", "pop"), "cls").select("key", "cls", "pop")
    found = roots = None
    open_rows = _centred(_open(buckets, roots))
    while True:
        open_rows = written(open_rows, "open")
        if open_rows.isEmpty():
            none = open_rows.select(F.col("centre").alias("a"), F.col("cls").alias("b"))
            return rows.drop("sig"), none if found is None else found
        star, far = _star(open_rows, known, texts, size, percent)
        hits = star.where("linked").select(F.col("centre").alias("a"), F.col("cls").alias("b"))
        found = hits if found is None else found.unionByName(hits)
        roots = components(found)
        pairs, parts = _torn(star, roots, percent)
        found = written((found if pairs is None else found.unionByName(pairs)).distinct(), "links")
        pop = known.select("cls", "pop")
        far = _open(far.join(pop, "cls").select("key", "cls", "pop"), roots)
        count = far.groupBy("key").agg(F.count("*").alias("members"))
        far = written(far.join(count, "key"), "far")
        largest = far.agg(F.max("members")).first()[0] or 0
        # What has no rows is not planned at all: plans of many joins cost the driver time and memory.
        more = [] if parts is None else [_centred(_open(parts.join(pop, "cls").select("key", "cls", "pop"), roots))]
        if largest:
            more.append(_led(far.where(F.col("members") <= DIRECT), known))
        if largest > DIRECT:
            far = far.where(F.col("members") > DIRECT).select("key", "cls", "pop")
            wide = written(far.select("cls").distinct(), "wide")
            more.append(_centred(_open(_cut(far, _full_sets(texts, wide, size), percent), roots)))
        if not more:
            return rows.drop("sig"), found
        open_rows = reduce(DataFrame.unionByName, more)


def _centred(buckets: DataFrame) -> DataFrame:
    """(key, centre, cls): each bucket's most popular member is its centre."""
    centre = buckets.groupBy("key").agg(F.max(F.struct("pop", "cls")).getField("cls").alias("centre"))
    return buckets.select("key", "cls").join(centre, "key").select("key", "centre", "cls").where("cls <> centre")


def _leaders(members: list[dict]) -> list[tuple[bytes, bytes]]:
    """(centre, member) pairs to compare, so that any two members whose signatures allow a match meet.

    A member like many others becomes the centre of all members near it and settles those like
    it: whoever matches one of these is near the centre too. The rest meet in pairs.
    """
    members = sorted(members, key=lambda m: (-m["pop"], m["cls"]))
    signature = np.array([m["sig"] for m in members], dtype=np.int32)
    settled = np.zeros(len(members), dtype=bool)
    pairs = []
    for i, m in enumerate(members):
        if settled[i]:
            continue
        like = (signature == signature[i]).mean(axis=1)
        settled[i] = True
        if (like >= FAR).sum() > CROWD:
            settled |= like >= FAR
            meets = like >= NEAR
            meets[i] = False
        else:
            meets = (like >= PAIR) & ~settled
        pairs += [(m["cls"], members[j]["cls"]) for j in np.flatnonzero(meets)]
    return pairs


def _led(far: DataFrame, known: DataFrame) -> DataFrame:
    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                pairs = _leaders(batch.column(0)[k].as_py())
                yield pa.record_batch([pa.array([x for x, _ in pairs], pa.binary()), pa.array([y for _, y in pairs], pa.binary())],
                                      names=["centre", "cls"])

    groups = far.select("key", "cls", "pop").join(known.select("cls", "sig"), "cls").groupBy("key").agg(
        F.collect_list(F.struct("cls", "pop", "sig")).alias("members"))
    return groups.select("members").mapInArrow(lead, "centre binary, cls binary").select(
        F.lit(None).cast("bigint").alias("key"), "centre", "cls")


def _labelled(df: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Adds the known component of each class as `root`."""
    if roots is None:
        return df.withColumn("root", F.col("cls"))
    return df.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn(
        "root", F.coalesce("root", "cls"))


def _open(buckets: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Buckets (key, cls, pop) that still hold two classes not known to be connected."""
    label = _labelled(buckets, roots)
    torn = label.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return label.select("key", "cls", "pop").join(torn.select("key"), "key")


def _star(open_rows: DataFrame, known: DataFrame, texts: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(members compared with their centre, with the differences; buckets of the members unlike it)."""
    sig = known.select("cls", "n", "sig")
    near = open_rows.select("centre", "cls").distinct().join(sig, "cls").join(
        sig.select(F.col("cls").alias("centre"), F.col("n").alias("centre_n"), F.col("sig").alias("centre_sig")), "centre")
    near = written(near.select("centre", "cls", "n", "centre_n", _agreement(F.col("sig"), F.col("centre_sig")).alias("like")),
                   "near")
    met = near.where(F.col("like") >= NEAR)
    both = written(met.select("cls").unionByName(met.select(F.col("centre").alias("cls"))).distinct(), "both")
    texts = texts.where(maybe(sieve(both, "cls"), "cls"))
    # Named apart by alias only, so that members and centres read one and the same exchange.
    own, heart = texts.alias("own"), texts.alias("heart")
    pairs = met.alias("met").join(own, F.col("met.cls") == F.col("own.cls")).join(heart, F.col("met.centre") == F.col("heart.cls"))
    star = _differences(pairs.select("met.centre", "met.cls", "n", "centre_n", F.col("own.text").alias("own"),
                                     F.col("heart.text").alias("heart")), size)
    star = star.withColumn("linked", _linked(F.col("n") - F.size("added"), F.col("n"), F.col("centre_n"), percent))
    unlike = open_rows.where("key is not null").join(near.where(F.col("like") < FAR).select("centre", "cls", "like"), ["centre", "cls"]).select(
        F.xxhash64("key", "centre").alias("key"), "cls", "like")
    far = unlike.join(unlike.groupBy("key").agg(F.min("like").alias("least")).where(F.col("least") < NEAR).select("key"), "key")
    far = far.select("key", "cls")
    return written(star, "star"), far


def _cut(far: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Smaller buckets (key, cls, pop) of a bucket too large for one task, by the rarest elements of the whole sets.

    Two members that match share at least `percent` of the elements of each, so they share one of the
    first n - least + 1 in any common order: here by the number of the bucket's members that have them.
    An element that many have is among the first only of members that consist of such elements; these
    are like each other and meet in the next round's star.
    """
    items = far.join(sets, "cls").select("key", "cls", "pop", F.size("items").alias("n"), F.explode("items").alias("item"))
    often = items.groupBy("key", "item").agg(F.count("*").alias("k")).where("k > 1")
    # As in _torn, an element of one member alone joins nothing, but takes its place in the order.
    order = items.join(often, ["key", "item"]).groupBy("key", "cls", "pop", "n").agg(
        F.sort_array(F.collect_list(F.struct("k", "item"))).alias("often"))
    first = F.floor((100 - percent) * F.col("n") / 100).cast("int") + 1 - (F.col("n") - F.size("often"))
    firsts = order.select("key", "cls", "pop", F.explode(F.slice("often", F.lit(1), F.greatest(first, F.lit(0)))).alias("o"))
    return firsts.select(F.xxhash64("key", "o.item").alias("key"), "cls", "pop")


def _torn(star: DataFrame, roots: DataFrame, percent: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Links between members of a star that don't both match its centre: (links, buckets for another round), None without any.

    Stars of bounded size are finished in one task. A larger one is split by its differences from
    the centre. With `size` of them, two such members share more than half, less a margin, and at
    least size - `most`; so two that match share one of the first size - bound + 1, rarest first.
    """
    # Few stars are torn: the differences are dealt out for those only.
    label = _labelled(star.select("centre", "cls", "linked", (F.size("added") + F.size("gone")).alias("size")), roots)
    torn = label.groupBy("centre").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.max((~F.col("linked")).cast("int")).alias("torn"),
        F.count("*").alias("members"), F.sum("size").alias("differences")).where("torn = 1 and low < high")
    small = (F.col("members") <= DIRECT) & (F.col("differences") <= DIRECT_ITEMS)
    label = written(label.join(torn.select("centre", small.alias("small")), "centre").drop("size"), "torn")
    if label.isEmpty():
        return None, None
    deltas = star.where(maybe(sieve(label, "centre", "cls"), "centre", "cls")).select("centre", "cls", "n", F.concat("added", "gone").alias("delta"))
    label = written(label.join(deltas, ["centre", "cls"]), "deltas")
    groups = label.where("small").groupBy("centre").agg(
        F.collect_list(F.struct("cls", "n", "linked", "root", "delta")).alias("members"))
    pairs = _compared(groups, percent)
    rest = label.where("not small")
    if rest.isEmpty():
        return pairs, None
    items = rest.select("centre", "cls", F.explode("delta").alias("item"))
    often = items.groupBy("centre", "item").agg(F.count("*").alias("k")).where("k > 1")
    # An element of one member alone joins nothing, but takes its place in the order.
    order = items.join(often, ["centre", "item"]).groupBy("centre", "cls").agg(
        F.sort_array(F.collect_list(F.struct("k", "item"))).alias("often"))
    rest = rest.join(order, ["centre", "cls"]).withColumn("size", F.size("delta"))
    most = F.floor((100 - percent) * F.col("n") / percent)
    half = F.floor((1 - (100 - percent) / (100 + percent)) * F.col("size") / 2) + 1
    first = F.col("size") - F.greatest(half, F.col("size") - most) + 1 - (F.col("size") - F.size("often"))
    far = F.when(F.col("linked"), first).otherwise(
        F.col("size") - F.greatest(F.lit(1), F.col("size") - most) + 1 - (F.col("size") - F.size("often")))
    rest = rest.withColumn("first", first).withColumn("upto", F.greatest(first, far, F.lit(0)).cast("int"))
    parts = rest.select("centre", "cls", "linked", "root", "first", F.posexplode(F.slice("often", F.lit(1), F.col("upto"))).alias(
        "at", "o")).select("centre", "cls", "linked", "root", F.col("o.item").alias("item"), (F.col("at") < F.col("first")).alias("first"))
    heads = parts.groupBy("centre", "item").agg(
        F.sum(F.when(F.col("linked"), 1).otherwise(0)).alias("inner"),
        F.sum(F.when(~F.col("linked"), 1).otherwise(0)).alias("outer"),
        F.sum(F.when(~F.col("linked") & F.col("first"), 1).otherwise(0)).alias("outer_first"),
        F.min("root").alias("low"), F.max("root").alias("high"))
    heads = heads.where("low < high and (outer_first > 1 or (inner > 0 and outer > 0))")
    parts = parts.join(heads.select("centre", "item", "inner"), ["centre", "item"]).where("linked or first or inner > 0")
    return pairs, parts.select(F.xxhash64("centre", "item").alias("key"), "cls")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of `docs` (doc_id, text).

    Rows are linked when 100 * intersection >= percent * union of their shingle sets.
    """
    rows, edges = links(docs, size, percent)
    own = rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"))
    roots = components(edges).withColumnRenamed("node", "cls")
    groups = own.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    lowest = groups.groupBy("root").agg(F.min("rep").alias("component_id"))
    groups = groups.join(lowest, "root").select("cls", "component_id")
    out = rows.join(groups, "cls", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 85) -> DataFrame:
    """One row of `docs` for each group of near duplicates, by (doc_id, class, text); a NULL doc_id comes last.

    Rows are told apart by doc_id and text, so texts that are not alike stay whatever ids they share.
    Texts without shingles are like nothing: each stays, equal rows once.
    """
    rows, edges = links(docs, size, percent, digest=True)
    roots = components(edges).withColumnRenamed("node", "cls")
    full = rows.where("cls is not null").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    first = full.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "cls", "text_key")).alias("row"))
    kept = first.select("row.doc_id", "row.text_key").unionByName(rows.where("cls is null").select("doc_id", "text_key").distinct())
    kept = written(kept.select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key")), "kept")
    # Rows that go or come more than once; the others stay where they are read.
    counts = rows.select("doc_id", "text_key", F.lit(1).alias("come"), F.lit(0).alias("stay")).unionByName(
        kept.select(F.col("kept_id").alias("doc_id"), F.col("kept_key").alias("text_key"), F.lit(0).alias("come"), F.lit(1).alias("stay")))
    doubtful = written(counts.groupBy("doc_id", "text_key").agg(F.sum("come").alias("come"), F.sum("stay").alias("stay")).where(
        "come > 1 or stay = 0").select("doc_id", "text_key"), "doubtful")
    # Names that no column of the documents has.
    name = "_".join(["text_key", *docs.columns])
    row_id = f"{name}_id"
    keyed = docs.withColumn(name, F.md5("text")).withColumn(row_id, F.col("doc_id").cast("bigint"))
    doubt = maybe(sieve(doubtful, "doc_id", "text_key"), row_id, name)
    asked = keyed.where(doubt)
    same = asked[row_id].eqNullSafe(kept["kept_id"]) & asked[name].eqNullSafe(kept["kept_key"])
    asked = asked.join(kept, same, "left_semi").dropDuplicates(["doc_id", name])
    return keyed.where(~doubt).unionByName(asked).drop(name, row_id)
