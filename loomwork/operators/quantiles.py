"""Exact quantiles of columns of any length."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Values between two bounds that one task may sort.
MOST_VALUES = 1 << 20
ACCURACY = 10_000


@dataclass
class _Wanted:
    """A quantile with the bounds its values lie in; ``inside`` values, ``below`` smaller ones."""

    column: str
    share: float
    n: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    inside: int = 0

    @property
    def ranks(self) -> tuple[int, int]:
        place = self.share * (self.n - 1)
        return math.floor(place), math.ceil(place)

    @property
    def between(self) -> Column:
        value = _value(self.column)
        hit = value.isNotNull()
        if self.low is not None:
            hit = hit & (value >= F.lit(self.low))
        if self.high is not None:
            hit = hit & (value <= F.lit(self.high))
        return F.coalesce(hit, F.lit(False))


def _value(column: str) -> Column:
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    shares: Sequence[float],
    accuracy: int = ACCURACY,
    most_values: int = MOST_VALUES,
) -> DataFrame:
    """``column_name, share, value``: quantiles with linear interpolation between neighbours.

    A mergeable quantile sketch brackets each rank, the bracket is counted
    exactly, and only values inside it are sorted: at most ``4 / accuracy`` of
    the column.  A bracket of more than ``most_values`` values is bracketed
    again, so no task holds a column; all columns share each pass.  Values are
    compared as doubles; nulls and NaN are no values, and a column without
    values gives null.
    """
    spark = df.sparkSession
    counts = df.agg(*[F.count(_value(c)).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    wanted = [_Wanted(c, p, counts[i]) for i, c in enumerate(columns) for p in shares]
    for one in wanted:
        one.inside = one.n
    for _ in range(16):
        wide = [w for w in wanted if w.inside > most_values and (w.low is None or w.low != w.high)]
        if not wide or not _narrow(df, wide, accuracy):
            break
    rows = [(i, w.column, float(w.share), w.below, *w.ranks) for i, w in enumerate(wanted)]
    asked = spark.createDataFrame(rows, "i int, column_name string, share double, below bigint, r0 bigint, r1 bigint")
    hits = F.array(
        *[F.when(w.between, F.struct(F.lit(i).alias("i"), _value(w.column).alias("v"))) for i, w in enumerate(wanted)]
    )
    found = df.select(F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("_h")).select("_h.i", "_h.v")
    counted = found.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("i").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    placed = asked.join(counted, "i", "left").withColumn("before", F.col("before") + F.col("below"))

    def at(rank: str) -> Column:
        hit = (F.col("before") <= F.col(rank)) & (F.col(rank) < F.col("before") + F.col("n"))
        return F.max(F.when(hit, F.col("v")))

    # Both neighbours, then the part of the way between them.
    picked = placed.groupBy("i", "column_name", "share", "r0").agg(at("r0").alias("v0"), at("r1").alias("v1"))
    totals = spark.createDataFrame([(i, w.n) for i, w in enumerate(wanted)], "i int, total bigint")
    picked = picked.join(totals, "i")
    part = F.col("share") * (F.col("total") - 1) - F.col("r0")
    value = F.when(F.col("v0") == F.col("v1"), F.col("v0")).otherwise(F.col("v0") + (F.col("v1") - F.col("v0")) * part)
    return picked.select("column_name", "share", value.alias("value"))


def _narrow(df: DataFrame, wanted: Sequence[_Wanted], accuracy: int) -> bool:
    """Tighten the bounds of each; False if none could be."""
    slack = 2.0 / accuracy
    sketches = []
    for i, w in enumerate(wanted):
        low, high = ((r - w.below) / w.inside for r in w.ranks)
        ends = [max(0.0, low - slack), min(1.0, high + slack)]
        value = F.when(w.between, _value(w.column))
        sketches.append(F.percentile_approx(value, ends, accuracy).alias(f"_{i}"))
    bounds = df.agg(*sketches).first()
    tried = [_Wanted(w.column, w.share, w.n, *bounds[i]) for i, w in enumerate(wanted)]
    measures = []
    for i, w in enumerate(tried):
        measures.append(F.count_if(_value(w.column) < F.lit(w.low)).alias(f"_b{i}"))
        measures.append(F.count_if(w.between).alias(f"_n{i}"))
    counts = df.agg(*measures).first()
    better = False
    for i, (old, new) in enumerate(zip(wanted, tried)):
        below, inside = counts[f"_b{i}"], counts[f"_n{i}"]
        # The exact counts decide whether the sketch kept its promise.
        if below <= old.ranks[0] and old.ranks[1] < below + inside < below + old.inside:
            old.low, old.high, old.below, old.inside = new.low, new.high, below, inside
            better = True
    return better


def summary_table(df: DataFrame, columns: Sequence[str], shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, standard deviation, least, quantiles and largest of numeric columns, all exact.

    One row per measure, named in ``summary``, and one double column per input column.
    """
    makers = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    names = {c: i for i, c in enumerate(columns)}
    measures = [m(F.col(f"`{c}`")).cast("double").alias(f"_{k}{i}") for k, m in makers.items() for c, i in names.items()]

    def rows(kinds: Sequence[str]) -> DataFrame:
        structs = [
            F.struct(F.lit(k).alias("summary"), *[F.col(f"_{k}{i}").alias(c) for c, i in names.items()]) for k in kinds
        ]
        return df.agg(*measures).select(F.inline(F.array(*structs)))

    found = exact_quantiles(df, columns, shares)
    label = F.coalesce(*[F.when(F.col("share") == F.lit(float(p)), F.lit(f"{p * 100:g}%")) for p in shares])
    per_share = found.groupBy(label.alias("summary")).agg(*[F.max(F.when(F.col("column_name") == c, F.col("value"))).alias(c) for c in columns])
    return rows(list(makers)).unionByName(per_share)
