"""Frequent values over deliveries, from stored states that merge."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frequent_state(df: DataFrame, column: str, delivery: str, keep: float) -> DataFrame:
    """The values that make up at least ``keep`` of a delivery, with their exact counts.

    One more row, marked ``whole``, has the number of rows and, as ``cut``, the
    largest count left out.  At most ``1 / keep + 1`` rows, whatever the column;
    a null is a value.  Append them to a table for ``frequent_from_states``.
    """
    if not 0 < keep <= 1:
        raise ValueError("keep must be above 0 and at most 1")
    total = df.count()
    kind = df.schema[column].dataType
    counts = df.groupBy(F.col(f"`{column}`").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    large = F.col("n") >= keep * total
    both = counts.agg(
        F.collect_list(F.when(large, F.struct("value", "n"))).alias("kept"),
        F.coalesce(F.max(F.when(~large, F.col("n"))), F.lit(0)).alias("cut"),
    )
    none = F.struct(F.lit(None).cast(kind).alias("value"), F.lit(total).cast("bigint").alias("n"))
    shape = f"array<struct<value:{kind.simpleString()},n:bigint,whole:boolean>>"
    whole = F.array(F.struct(none["value"].alias("value"), none["n"].alias("n"), F.lit(True).alias("whole"))).cast(shape)
    kept = F.transform("kept", lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n"), F.lit(False).alias("whole")))
    rows = both.select("cut", F.inline(F.concat(kept.cast(shape), whole)))
    return rows.select(F.lit(delivery).alias("delivery"), "value", "n", "whole", "cut")


def frequent_from_states(
    states: DataFrame, support: float, recount: Callable[[str], DataFrame] | None = None
) -> DataFrame:
    """``value, n``: values that make up at least ``support`` of all deliveries, with exact counts.

    A value is a candidate if its stored counts, plus the ``cut`` of every
    delivery that lacks it, could reach the support.  Candidates stored in every
    delivery, or lacking only where nothing was cut, need no further reading;
    for the others ``recount`` gives a delivery's values again as a column
    ``value``, and only the lacking deliveries are read.  Without it, such
    candidates are an error: they cannot be decided.
    """
    states = states.dropDuplicates(["delivery", "value", "whole"])
    wholes = {r.delivery: (r.n, r.cut) for r in states.where("whole").collect()}
    total, cuts = sum(n for n, _ in wholes.values()), sum(c for _, c in wholes.values())
    stored = states.where("NOT whole").groupBy("value")
    stored = stored.agg(F.sum("n").alias("n"), F.sum("cut").alias("_cut"), F.collect_set("delivery").alias("_in"))
    could = F.col("n") + F.lit(cuts) - F.col("_cut")
    # Few: each makes up nearly the support of all rows.
    candidates = stored.where(could >= support * total).select("value", "n", "_in", could.alias("_could")).collect()
    counted = states.where("NOT whole").select("value", "n")
    kind = states.schema["value"].dataType.simpleString()
    named = states.sparkSession.createDataFrame([(r.value,) for r in candidates], f"_value {kind}")
    for delivery in wholes:
        lacking = [(r.value,) for r in candidates if r._could > r.n and delivery not in r._in and wholes[delivery][1]]
        if not lacking:
            continue
        if recount is None:
            raise ValueError(f"values of delivery {delivery} must be counted again: {[v for (v,) in lacking]}")
        wanted = states.sparkSession.createDataFrame(lacking, f"_value {kind}")
        rows = recount(delivery).select("value")
        rows = rows.join(wanted, F.col("value").eqNullSafe(F.col("_value")), "left_semi")
        counted = counted.unionByName(rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")))
    counted = counted.join(named, F.col("value").eqNullSafe(F.col("_value")), "left_semi")
    return counted.groupBy("value").agg(F.sum("n").alias("n")).where(F.col("n") >= support * total)
