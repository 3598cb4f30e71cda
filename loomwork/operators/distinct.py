"""Distinct counts over deliveries, from stored sketches that merge."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 14


def relative_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Share by which an estimate may miss, at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << lg_k)


def distinct_states(df: DataFrame, columns: Sequence[str], delivery: str, lg_k: int = LG_K) -> DataFrame:
    """One row per column of a delivery: rows, present values and a distinct-count sketch.

    One pass; a sketch takes at most ``2 ** lg_k`` bytes whatever the column.
    Values are compared as text, nulls are not counted.  Append the rows to a
    table and merge with ``distinct_from_states``; old deliveries are not read again.
    """
    measures = [F.count(F.lit(1)).alias("_total")]
    for i, name in enumerate(columns):
        measures.append(F.count(F.col(f"`{name}`")).alias(f"_present{i}"))
        measures.append(F.hll_sketch_agg(F.col(f"`{name}`").cast("string"), lg_k).alias(f"_sketch{i}"))
    rows = [
        F.struct(
            F.lit(delivery).alias("delivery"),
            F.lit(name).alias("column_name"),
            F.col("_total").alias("total_rows"),
            F.col(f"_present{i}").alias("present_rows"),
            F.col(f"_sketch{i}").alias("sketch"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def distinct_from_states(states: DataFrame) -> DataFrame:
    """Counts, estimated distinct values, uniqueness and completeness in percent, over all deliveries.

    A delivery that was stored twice counts once.  The estimate misses by no
    more than ``relative_error`` in all but a few of a thousand cases.
    """
    once = states.groupBy("delivery", "column_name").agg(
        F.max("total_rows").alias("total_rows"),
        F.max("present_rows").alias("present_rows"),
        F.hll_union_agg("sketch").alias("sketch"),
    )
    merged = once.groupBy("column_name").agg(
        F.sum("total_rows").alias("total_rows"),
        F.sum("present_rows").alias("present_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_estimate"),
    )

    def percent(part: str, whole: str):
        return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")) * 100

    return merged.withColumns(
        {
            "uniqueness_pct": percent("distinct_estimate", "present_rows"),
            "completeness_pct": percent("present_rows", "total_rows"),
        }
    )
