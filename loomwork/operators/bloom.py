"""Semi-join reduction: drop rows that cannot match before they are shuffled.

A Bloom filter over the keys of the smaller side is built by aggregation, in
64-bit words of a bounded number, and tested row by row inside the scan stage.
It never drops a row that has a match; the exact join follows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.operators.joins import matched

MAX_BYTES = 4 << 20
BITS_PER_KEY = 10
HASHES = 4


@dataclass(frozen=True)
class Bloom:
    """``words``: a one-row frame with the filter as an array of 64-bit numbers; ``size`` of them."""

    words: DataFrame
    size: int

    def may_hold(self, *keys: Column) -> Column:
        """False only for keys that were not put in; null keys are keys like any other."""
        words = self.words.scalar()
        hit = F.lit(True)
        for word, bit in _places(keys, self.size):
            hit = hit & (F.getbit(F.get(words, word), bit) == 1)
        return hit


def _places(keys: Sequence[Column], size: int) -> list[tuple[Column, Column]]:
    """Word and bit of each hash of a key."""
    found = []
    for seed in range(HASHES):
        hashed = F.xxhash64(F.lit(seed), *keys)
        # Apart from the sign bit, so that no shift is negative.
        found.append((F.pmod(F.shiftright(hashed, 6), F.lit(size)).cast("int"), F.pmod(hashed, F.lit(64)).cast("int")))
    return found


def bloom_of(df: DataFrame, keys: Sequence[str], expected: int | None = None, max_bytes: int = MAX_BYTES) -> Bloom | None:
    """The filter of a frame's keys, or None if there are too many for ``max_bytes``.

    ``expected`` is about the number of distinct keys; without it they are
    counted by a sketch.  Words are combined before their shuffle, which carries
    at most one row per word and task.
    """
    if expected is None:
        expected = df.agg(F.approx_count_distinct(F.struct(*keys))).first()[0]
    size = max(64, -(-expected * BITS_PER_KEY // 64))
    if size * 8 > max_bytes:
        return None
    places = F.array(*[F.struct(w.alias("w"), b.alias("b")) for w, b in _places([F.col(k) for k in keys], size)])
    set_bits = df.select(F.inline(places)).select("w", F.expr("shiftleft(1L, b)").alias("bits"))
    # Every word once, in a row at least; as many as the filter has.
    every = df.sparkSession.range(size).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("bigint").alias("bits"))
    words = set_bits.unionByName(every).groupBy("w").agg(F.bit_or("bits").alias("bits"))
    listed = F.array_sort(F.collect_list(F.struct("w", "bits")))
    return Bloom(words.agg(F.transform(listed, lambda x: x["bits"]).alias("words")), size)


def reduced(
    fact: DataFrame, lookup: DataFrame, on: Sequence[str | tuple[str, str]], max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Rows of ``fact`` that may have a match, and all that have one; ``fact`` itself if the filter would be too large."""
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    found = bloom_of(lookup, [r for _, r in pairs], max_bytes=max_bytes)
    if found is None:
        return fact
    for left, right in pairs:
        if fact.schema[left].dataType != lookup.schema[right].dataType:
            raise ValueError(f"{left} and {right} hash alike only if their types are the same")
    return fact.where(found.may_hold(*[F.col(f"`{k}`") for k, _ in pairs]))


def matched_reduced(
    fact: DataFrame, lookup: DataFrame, on: Sequence[str | tuple[str, str]], max_bytes: int = MAX_BYTES
) -> DataFrame:
    """``matched`` for a lookup too large to broadcast that matches few rows of ``fact``.

    Rows without a match mostly go before the shuffle, the exact semi join
    settles the rest.
    """
    return matched(reduced(fact, lookup, on, max_bytes), lookup, on)
