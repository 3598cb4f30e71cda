"""Near-duplicates by one-permutation MinHash."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.graph import components
from loomwork.llm.hashing import ODD, SPACE, Texts, mix, windows, words
from loomwork.llm.ship import map_batches
from loomwork.session import stage

BIN_BITS = 8
BINS = 1 << BIN_BITS
# Bits kept of each bin's value to judge pairs by.
MARK_BITS = 2
# Shingles whose counts order them by rarity: the most frequent ones, at most so many.
ORDERED = 1 << 20
MARK_WORDS = BINS * MARK_BITS // 64
# Sets of so few shingles leave most bins empty, and what shares a bin by chance
# weighs much: pairs are judged on full sets only up to ``UNMARKED`` shingles,
# and found without buckets up to ``SMALL`` (of the smaller set).
UNMARKED = 128
SMALL = 32
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BIN_BITS)
_rng = np.random.Generator(np.random.PCG64(7))
# For each empty bin, the bins it may borrow from in an order of its own: the
# same for all documents, so that two sets borrow alike as often as they agree.
_BORROW = np.stack([_rng.permutation(BINS) for _ in range(BINS)])


@dataclass(frozen=True)
class Near:
    """Parameters: words per shingle, similarity in percent, bands and bins per band.

    With 32 bands of 4 bins a pair of similarity 0.8 meets in no band with a
    chance of 5e-8.  The other bins serve to judge pairs.
    """

    shingle: int = 4
    percent: int = 80
    rows: int = 4
    bands: int = 32


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text.

    A-Z count as a-z; words are what white space separates.  A text of fewer
    words than ``size`` is one shingle; one without words, or null, has none.
    """
    found = words(Texts.of(column), SPACE == 0)
    every = windows(found.hashes, size)
    sets = []
    for a, b in zip(found.bounds[:-1], found.bounds[1:]):
        if b - a >= size:
            own = np.sort(every[a : b - size + 1])
            sets.append(own[np.append(True, own[1:] != own[:-1])])
        elif b > a:
            sets.append(mix(windows(found.hashes[a:b], b - a) + ODD[b - a]))
        else:
            sets.append(every[:0])
    return sets


def signature(own: np.ndarray) -> np.ndarray:
    """One-permutation signature of a non-empty sorted set of hashes.

    The leading bits choose a bin, the least hash stays in it.  An empty bin
    borrows from the first filled bin in its own order (optimal densification
    without replacement), which keeps agreement at the similarity of the sets.
    """
    places = np.searchsorted(own, _EDGES)
    filled = np.append(places[1:], len(own)) > places
    values = own[np.minimum(places, len(own) - 1)]
    if not filled.all():
        empty = np.flatnonzero(~filled)
        order = _BORROW[empty]
        source = order[np.arange(len(empty)), filled[order].argmax(axis=1)]
        values[empty] = mix(values[source] + ODD[0])
    return values


def signatures(docs: DataFrame, near: Near) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, keys, bits`` of every row.

    ``set_a, set_b`` are a 128-bit mark of the set, null for an empty set;
    ``keys`` one bucket per band; ``bits`` two bits of each bin's value, which
    tell dissimilar pairs apart without their texts.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows, bands = near.rows, near.bands

    def run(batch: pa.RecordBatch):
        sets = shingle_sets(batch.column(1), near.shingle)
        n = len(sets)
        counts = np.array([len(s) for s in sets], np.int64)
        marks = np.zeros((2, n), np.uint64)
        values = np.zeros((n, BINS), np.uint64)
        for i, own in enumerate(sets):
            if len(own):
                marks[0, i] = own.sum()
                marks[1, i] = mix(own ^ ODD[1]).sum()
                values[i] = signature(own)
        none = counts == 0
        banded = values[:, : bands * rows].reshape(n, bands, rows)
        keys = np.arange(bands, dtype=np.uint64)[None, :] * ODD[2]
        for k in range(rows):
            keys = keys + mix(banded[:, :, k] * ODD[3 + k])
        keys = mix(keys).astype(np.int64)
        # With the bin's number, or all bits of small sets would be those of few values.
        hashed = mix(values + np.arange(BINS, dtype=np.uint64) * ODD[1])
        marks_of = [(hashed >> np.uint64(k)) & np.uint64(1) for k in range(MARK_BITS)]
        bits = np.packbits(np.concatenate(marks_of, axis=1).astype(np.uint8), axis=1).view(np.int64)

        def lists(matrix):
            ends = np.arange(n + 1, dtype=np.int32) * matrix.shape[1]
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))

        columns = [
            batch.column(0),
            pa.array(counts),
            pa.array(marks[0].astype(np.int64), mask=none),
            pa.array(marks[1].astype(np.int64), mask=none),
            lists(keys),
            lists(bits),
        ]
        yield pa.RecordBatch.from_arrays(
            columns, names=["doc_id", "n_shingles", "set_a", "set_b", "keys", "bits"]
        )

    schema = (
        f"doc_id {kind}, n_shingles bigint, set_a bigint, set_b bigint, keys array<bigint>, bits array<bigint>"
    )
    return map_batches(docs.select("doc_id", "text"), run, schema, max_bytes=4 << 20)


def verified(pairs: DataFrame, docs: DataFrame, near: Near) -> DataFrame:
    """Pairs ``(a, b)`` of which the full sets are similar enough.

    Only texts in some pair leave their partition a second time.  ``b`` is the
    centre of a star: pairs arrive by centre, and a centre's set is made once.
    """
    texts_a = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    texts_b = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(texts_a, "a").join(texts_b, "b")

    def run(batch: pa.RecordBatch):
        b_ids = batch.column(1).to_pylist()
        lefts = shingle_sets(batch.column(2), near.shingle)
        linked = np.zeros(batch.num_rows, bool)
        last: tuple = (None, None, None)
        for i, left in enumerate(lefts):
            text = batch.column(3)[i]
            if last[0] != b_ids[i] or last[1] != text:
                last = (b_ids[i], text, shingle_sets(batch.column(3).slice(i, 1), near.shingle)[0])
            right = last[2]
            if 100 * min(len(left), len(right)) < near.percent * max(len(left), len(right)):
                continue
            shared = len(np.intersect1d(left, right, assume_unique=True))
            linked[i] = 100 * shared >= near.percent * (len(left) + len(right) - shared)
        mask = pa.array(linked)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"]
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    ordered = both.select("a", "b", "text_a", "text_b")
    return map_batches(ordered, run, f"a {kind}, b {kind}", max_bytes=8 << 20).distinct()


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """Classes of documents linked by similar shingle sets.

    Two documents are linked when 100 * |A and B| >= percent * |A or B|.

    1. Equal sets form a class, known by its smallest id, so copies cost one row.
    2. Classes fall into buckets by band.  In each bucket all members are paired
       with the smallest id: a star, so pairs grow as members do.
    3. Pairs of larger sets whose bits rule similarity out are dropped: agreement
       six standard deviations below what the asked similarity gives.
    4. The rest are confirmed on their full sets, and linked classes become
       components.
    5. A bucket that still holds members of different components may hide a link
       that its centre did not show.  Of two sets similar enough, the rarest
       shingles of each, down to a length that the similarity fixes, must share
       one (prefix filter).  Classes in such buckets are paired by these, again
       only across components and past the bits, and confirmed.  A passage that
       many texts share is no rare shingle of theirs, so they do not all meet,
       and members of the component that most of a shingle's texts belong to are
       compared with the others only.
       Classes of few shingles, whose buckets are less sure, are all paired so.

    Texts without a word, null included, are linked with nothing.  Rows that
    share an id are separate rows, which one id stands for; a null id is a
    member of its class but never stands for it.  Empty tables give no rows and
    other columns are ignored.

    Returns ``doc_id, n_shingles, component_id, kept``.
    """
    signed = stage(signatures(docs, near), "signatures")
    classes = signed.where("set_a IS NOT NULL").groupBy("set_a", "set_b", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.first("keys").alias("keys"), F.first("bits").alias("bits")
    )
    classes = stage(classes, "classes")
    found = components(_links(classes.where("rep IS NOT NULL"), docs, near))
    named = classes.join(found, classes["rep"] == found["node"], "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    rows = signed.select("doc_id", "n_shingles", "set_a", "set_b")
    joined = rows.join(named, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("set_a").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _links(classes: DataFrame, docs: DataFrame, near: Near) -> DataFrame:
    """All confirmed links needed to know the components."""
    entries = classes.select("rep", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.min("rep").alias("centre"), F.count(F.lit(1)).alias("_n"))
    members = entries.join(shared.where("_n > 1"), "key").select("key", "rep", "centre")
    members = stage(members, "members")
    # Plain columns: a pair is compared in compiled code.
    bits = classes.select("rep", "n_shingles", *[F.get("bits", F.lit(k)).alias(f"bits{k}") for k in range(MARK_WORDS)])
    small = classes.where(near.percent * F.col("n_shingles") <= 100 * SMALL).select("rep")
    wanted = members.select("rep").unionByName(small).distinct().withColumnRenamed("rep", "doc_id")
    texts = stage(docs.select("doc_id", "text").join(wanted, "doc_id"), "texts")

    def confirm(pairs: DataFrame) -> DataFrame:
        return stage(verified(_plausible(pairs, bits, near), texts, near), "confirmed")

    links = confirm(members.where("rep <> centre").select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct())
    found = components(links)

    def named(rows: DataFrame) -> DataFrame:
        joined = rows.join(found, rows["rep"] == found["node"], "left")
        return joined.select(*rows.columns, F.coalesce("component", "rep").alias("component"))

    placed = named(members.select("key", "rep"))
    mixed = _of_several(placed, "key")
    opened = placed.join(mixed, "key").select("rep", "component")
    loose = stage(opened.unionByName(named(small)).distinct(), "open")
    if loose.isEmpty():
        return links
    rare = _rare_shingles(texts.join(loose.select(F.col("rep").alias("doc_id")), "doc_id"), near)
    met = _across(stage(rare.join(loose, "rep"), "rare-shingles")).join(bits, "rep")
    one, other = _side(met.where("component <> hub"), "a"), _side(met, "b")
    # Two members outside of the hub meet twice.
    apart = (F.col("component_a") != F.col("component_b")) & (
        (F.col("component_b") == F.col("hub_b")) | (F.col("a") > F.col("b"))
    )
    # What follows the first shared shingle in either order bounds the overlap
    # (positional filter).
    rest = F.least(F.col("n_shingles_a") - F.col("place_a"), F.col("n_shingles_b") - F.col("place_b"))
    enough = (100 + near.percent) * rest >= near.percent * (F.col("n_shingles_a") + F.col("n_shingles_b"))
    pairs = one.join(other, (one["key"] == other["key"]) & apart & enough & _alike(near))
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return links.unionByName(stage(verified(pairs, texts, near), "confirmed"))


def _of_several(placed: DataFrame, key: str) -> DataFrame:
    """Keys that members of more than one component share."""
    spans = placed.groupBy(key).agg(F.min("component").alias("_least"), F.max("component").alias("_most"))
    return spans.where("_least <> _most").select(key)


def _across(met: DataFrame) -> DataFrame:
    """Rows under keys that several components share, with the ``hub`` of the key.

    The hub is the component with most rows under the key.  To compare rows of
    different components it is enough to pair those outside of the hub with all:
    a large component costs a key its rows times those of the others.
    """
    counts = met.groupBy("key", "component").agg(F.count(F.lit(1)).alias("_n"))
    hubs = counts.groupBy("key").agg(
        F.max_by("component", F.struct("_n", "component")).alias("hub"), F.count(F.lit(1)).alias("_components")
    )
    return met.join(hubs.where("_components > 1").select("key", "hub"), "key")


def _rare_shingles(docs: DataFrame, near: Near) -> DataFrame:
    """``rep, key, place``: the rarest shingles of each text that a similar set must touch.

    Sets of similarity s that are ordered alike share an element among the first
    |A| - ceil(s |A|) + 1 of each, whatever the order; ``place`` is that in the
    order, from 0.  The order is by the number of texts, then by hash.  All
    shingles are counted; counts under a power of two, the least that leaves
    ``ORDERED`` shingles at most, are taken as equal.
    """

    def count(batch: pa.RecordBatch):
        sets = shingle_sets(batch.column(1), near.shingle)
        if sets:
            own, n = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int64)), pa.array(n)], names=["shingle", "n"])

    counted = map_batches(docs.select("doc_id", "text"), count, "shingle bigint, n bigint", max_bytes=4 << 20)
    several = stage(counted.groupBy("shingle").agg(F.sum("n").alias("n")).where("n > 1"), "shingle-counts")
    # One row per power of two.
    powers = several.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count(F.lit(1)).alias("n"))
    least, room = 63, ORDERED
    for power, n in sorted(map(tuple, powers.collect()), reverse=True):
        if n > room:
            break
        least, room = power, room - n
    # At most ORDERED rows, whatever the data.
    rows = several.where(F.floor(F.log2("n")) >= least).toArrow()
    frequent = rows["shingle"].to_numpy().astype(np.uint64)
    order = np.argsort(frequent)
    shared = docs.sparkSession.sparkContext.broadcast((frequent[order], rows["n"].to_numpy()[order]))

    def first(batch: pa.RecordBatch):
        (known, counts), keys, lengths = shared.value, [], []
        for own in shingle_sets(batch.column(1), near.shingle):
            n = np.zeros(len(own), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                n = np.where(known[at] == own, counts[at], 0)
            order = np.lexsort((own, n))
            size = len(own) + (near.percent * len(own)) // -100 + 1 if len(own) else 0
            keys.append(own[order[:size]])
            lengths.append(size)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(np.repeat(np.arange(len(lengths)), lengths))),
                pa.array(np.concatenate(keys).astype(np.int64) if keys else np.zeros(0, np.int64)),
                pa.array(np.concatenate([np.arange(size) for size in lengths]) if keys else np.zeros(0, np.int64)),
            ],
            names=["rep", "key", "place"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), first, f"rep {kind}, key bigint, place bigint", max_bytes=4 << 20)


def _alike(near: Near) -> Column:
    """Whether sizes, and bits of larger sets, allow the two sides of a pair to be similar."""
    share = near.percent / 100
    # Per bin: all bits agree with the chance ``share``, else each does with 1/2.
    # Shingles that meet in one bin hide each other, which varies the share itself.
    mean = MARK_BITS * (1 + share) / 2
    variance = (1 - share) * MARK_BITS / 4 + 2 * share * (1 - share) * (MARK_BITS / 2) ** 2
    most = BINS * (MARK_BITS - mean) + 6 * (BINS * variance) ** 0.5
    parts = [F.bit_count(F.col(f"bits{k}_a").bitwiseXOR(F.col(f"bits{k}_b"))) for k in range(MARK_WORDS)]
    n_a, n_b = F.col("n_shingles_a"), F.col("n_shingles_b")
    sized = 100 * F.least(n_a, n_b) >= near.percent * F.greatest(n_a, n_b)
    return sized & ((F.least(n_a, n_b) <= UNMARKED) | (reduce(add, parts) <= most))


def _side(rows: DataFrame, side: str) -> DataFrame:
    """Columns of one side of a pair, which is known by its class."""
    named = {c: f"{c}_{side}" for c in rows.columns if c != "key"}
    return rows.withColumnsRenamed({**named, "rep": side})


def _plausible(pairs: DataFrame, bits: DataFrame, near: Near) -> DataFrame:
    """Pairs that sizes and bits do not rule out."""
    return pairs.join(_side(bits, "a"), "a").join(_side(bits, "b"), "b").where(_alike(near)).select("a", "b")


def drop_near_duplicates(docs: DataFrame, near: Near = Near(shingle=5)) -> DataFrame:
    """``docs`` with one document of each group: the smallest id, all columns."""
    kept = near_duplicates(docs, near).where("kept").select(F.col("doc_id").alias("_id")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return rows.join(kept, F.col("_row.doc_id").eqNullSafe(F.col("_id")), "left_semi").select("_row.*")
