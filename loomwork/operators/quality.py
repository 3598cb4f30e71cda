"""Data quality measures, each computed in a single pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.operators.columns import hashable_columns


def tried(df: DataFrame, *expected: str) -> tuple[int | None, str | None]:
    """Rows of a frame, every column computed; or which of ``expected`` it failed with.

    An error that names none of the expected conditions is raised.
    """
    whole = F.bit_xor(F.xxhash64(*hashable_columns(df)))
    try:
        return df.agg(F.count(F.lit(1)).alias("n"), whole.alias("_all")).first()["n"], None
    except (PySparkException, Py4JJavaError) as error:
        found = next((name for name in expected if name in str(error)), None)
        if found is None:
            raise
        return None, found


def quality_report(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """One row per column: counts, uniqueness and completeness in percent.

    Exact distinct counts shuffle one row per distinct value and column.  For
    wide tables ``approx=True`` uses sketches, which need no such shuffle.
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    measures = [F.count(F.lit(1)).alias("_total")]
    for i, name in enumerate(columns):
        measures.append(F.count(name).alias(f"_present{i}"))
        measures.append(distinct(F.col(name)).alias(f"_distinct{i}"))
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("_total").alias("total_rows"),
            F.col(f"_present{i}").alias("present_rows"),
            F.col(f"_distinct{i}").alias("distinct_values"),
            _percent(f"_distinct{i}", f"_present{i}").alias("uniqueness_pct"),
            _percent(f"_present{i}", "_total").alias("completeness_pct"),
        )
        for i, name in enumerate(columns)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def uniqueness_pct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean over the columns of distinct / present values, in percent.

    Exact distinct counts send each row once per column to the shuffle, less
    what is combined before; ``quality_report`` has an approximate form.
    """
    return quality_report(df, columns).agg(F.avg("uniqueness_pct").alias("uniqueness_pct"))


def completeness_pct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean over the columns of present values / rows, in percent: counts only, one pass."""
    shares = [F.try_divide(F.count(c).cast("double"), F.count(F.lit(1)).cast("double")) * 100 for c in columns]
    return df.agg((reduce(lambda a, b: a + b, shares) / len(columns)).alias("completeness_pct"))


def key_checks(df: DataFrame, key: str, kind: str) -> DataFrame:
    """Row, distinct, null and wrong-type counts of a text key column."""
    bad_type = F.col(key).isNotNull() & F.col(key).try_cast(kind).isNull()
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(key).alias("distinct_keys"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.count_if(bad_type).alias("wrong_type_keys"),
    )


def schema_diff(a: DataFrame, b: DataFrame, types: bool = True) -> list[str]:
    """Differences between two schemas, ignoring column order; empty when equal."""
    left = {f.name: f.dataType.simpleString() for f in a.schema.fields}
    right = {f.name: f.dataType.simpleString() for f in b.schema.fields}
    found = [f"missing: {n}" for n in sorted(left.keys() - right.keys())]
    found += [f"extra: {n}" for n in sorted(right.keys() - left.keys())]
    if types:
        found += [
            f"type of {n}: {left[n]} != {right[n]}"
            for n in sorted(left.keys() & right.keys())
            if left[n] != right[n]
        ]
    return found


def _percent(part: str, whole: str):
    """Null for an empty whole rather than a division error."""
    return F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")) * 100
