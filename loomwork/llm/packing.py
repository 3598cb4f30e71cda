"""Packing documents into sequences of several permitted lengths."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.ship import importable, words_of
from loomwork.operators.windows import number_all
from loomwork.session import stage

# Pieces that one task packs together.
SHARD_ROWS = 50_000


@dataclass(frozen=True)
class Lengths:
    """Permitted sequence lengths and what a sequence of each costs.

    The cost defaults to the length, plus its square times ``attention``, plus
    ``per_bin``: long sequences pay for attention, short ones for their number.
    """

    capacities: tuple[int, ...] = (512, 1024, 2048, 4096, 8192)
    per_bin: float = 64.0
    attention: float = 1 / 16384
    costs: Mapping[int, float] | None = field(default=None)

    def cost(self, capacity: int) -> float:
        if self.costs:
            return self.costs[capacity]
        return capacity + self.attention * capacity**2 + self.per_bin


class _Levels:
    """How many things there are of each size up to a bound, with the next size found in a bit set."""

    def __init__(self):
        self.bits = 0
        self.things: dict[int, list[int]] = {}

    def add(self, size: int, thing: int) -> None:
        self.things.setdefault(size, []).append(thing)
        self.bits |= 1 << size

    def take(self, size: int) -> int:
        found = self.things[size]
        thing = found.pop()
        if not found:
            self.bits &= ~(1 << size)
        return thing

    def at_least(self, size: int) -> int:
        """The least size present from ``size`` on, or -1."""
        above = self.bits >> size
        return size + (above & -above).bit_length() - 1 if above else -1


def _opened(item: int, counts: list[int], bits: int, lengths: Lengths) -> int:
    """The capacity that holds ``item`` at the least cost per token.

    For each capacity the rest is thought to be filled greedily by what is still
    unpacked, largest first.  Ties go to the larger capacity.
    """
    best, best_rate = -1, float("inf")
    for capacity in sorted(lengths.capacities, reverse=True):
        if capacity < item:
            break
        room, used = capacity - item, {item: 1}
        while room:
            below = bits & ((1 << (room + 1)) - 1)
            while below:
                size = below.bit_length() - 1
                free = counts[size] - used.get(size, 0)
                if free > 0:
                    break
                below &= ~(1 << size)
            if not below:
                break
            some = min(free, room // size)
            used[size] = used.get(size, 0) + some
            room -= some * size
        rate = lengths.cost(capacity) / (capacity - room)
        if rate < best_rate:
            best, best_rate = capacity, rate
    return best


def pack(sizes: Sequence[int], lengths: Lengths = Lengths()) -> tuple[list[int], list[int], list[int]]:
    """Variable-capacity best fit of positive sizes.

    Sizes are placed from large to small, each into the open bin with the least
    room that holds it.  If there is none, a bin of the capacity with the least
    cost per token is opened, with the sizes still to come in mind.  At the end
    every bin shrinks to the smallest capacity that holds its contents.

    Returns the bin and offset of every size, and the capacity of every bin.
    """
    largest = max(lengths.capacities)
    if any(s < 1 or s > largest for s in sizes):
        raise ValueError("sizes must be between 1 and the largest capacity")
    counts = np.bincount(np.asarray(sizes, np.int64), minlength=largest + 1).tolist()
    bits = sum(1 << s for s, n in enumerate(counts) if n)
    open_bins = _Levels()
    room, fill = [], []
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        fits = open_bins.at_least(size)
        if fits < 0:
            chosen = len(room)
            room.append(_opened(size, counts, bits, lengths))
            fill.append(0)
        else:
            chosen = open_bins.take(fits)
        bins[i], offsets[i] = chosen, fill[chosen]
        fill[chosen] += size
        room[chosen] -= size
        if room[chosen]:
            open_bins.add(room[chosen], chosen)
        counts[size] -= 1
        if not counts[size]:
            bits &= ~(1 << size)
    ordered = sorted(lengths.capacities)
    final = np.searchsorted(ordered, fill)
    return bins, offsets, [ordered[k] for k in final]


def packed(
    items: DataFrame, id_col: str, size_col: str, lengths: Lengths = Lengths(), shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """Place every item in a sequence.

    An item longer than the largest capacity is cut into pieces of that
    capacity and a rest, so no token is dropped.  Pieces are numbered by length,
    id and piece, and dealt to shards of about ``shard_rows`` in turn, so every
    shard has the same mixture of lengths, a repeated id or size cannot fill one,
    and another run packs alike.  Each shard is packed on its own and leaves at
    most a few sequences part-filled, which shrink.  Rows of size
    0, negative or null appear once with length 0 and no sequence.  Null ids and
    repeated rows are kept; an empty table gives no rows.

    Returns ``<id_col>, piece, start, length, bin_id, bin_capacity, bin_fill, offset``.
    """
    largest = max(lengths.capacities)
    size = F.greatest(F.coalesce(F.col(size_col).cast("bigint"), F.lit(0)), F.lit(0))
    pieces = items.select(F.col(id_col), size.alias("_size"))
    last = F.greatest(F.ceil(F.col("_size") / largest), F.lit(1)) - 1
    pieces = pieces.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    start = F.col("piece") * largest
    pieces = stage(
        pieces.select(
            id_col, "piece", start.alias("start"), F.least(F.col("_size") - start, F.lit(largest)).alias("length")
        ),
        "pieces",
    )
    total = pieces.where("length > 0").count()
    shards = max(1, -(-total // shard_rows))
    numbered = number_all(pieces.where("length > 0"), ["-length", id_col, "piece"], "_place")
    dealt = numbered.withColumn("shard", F.pmod("_place", F.lit(shards)).cast("int"))
    kind = items.schema[id_col].dataType.simpleString()
    importable(items.sparkSession)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_place")
        bins, offsets, capacities = pack(rows["length"].tolist(), lengths)
        chosen = np.asarray(bins, np.int64)
        fill = np.bincount(chosen, rows["length"], minlength=len(capacities)).astype(np.int64)
        return pd.DataFrame(
            {
                id_col: rows[id_col],
                "piece": rows["piece"],
                "start": rows["start"],
                "length": rows["length"],
                "bin_id": (np.int64(key[0]) << 32) + chosen,
                "bin_capacity": np.asarray(capacities, np.int64)[chosen],
                "bin_fill": fill[chosen],
                "offset": np.asarray(offsets, np.int64),
            }
        )

    schema = (
        f"{id_col} {kind}, piece bigint, start bigint, length bigint, bin_id bigint, "
        "bin_capacity bigint, bin_fill bigint, offset bigint"
    )
    placed = dealt.groupBy("shard").applyInPandas(run, schema)
    nothing = F.lit(None).cast("bigint")
    empty = pieces.where("length = 0").select(
        id_col, "piece", "start", "length", *[nothing.alias(c) for c in ("bin_id", "bin_capacity", "bin_fill", "offset")]
    )
    return placed.unionByName(empty)


def packed_documents(docs: DataFrame, lengths: Lengths = Lengths()) -> DataFrame:
    """Documents packed by their number of words."""
    sized = docs.select("doc_id", F.size(words_of(F.col("text"))).alias("size"))
    return packed(sized, "doc_id", "size", lengths)
