"""Insert, update and delete in a partitioned folder, rewriting only what changes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.session import scratch_path, stage
from loomwork.tables.files import Store


def _values(df: DataFrame, columns: Sequence[str]) -> list[tuple]:
    """Distinct partition values; as many as there are partitions."""
    return [tuple(r) for r in df.select(*columns).distinct().collect()]


def _in(columns: Sequence[str], found: Sequence[tuple]) -> Column:
    """Rows in one of the partitions, in a form that prunes folders."""

    def one(values: tuple) -> Column:
        parts = [F.col(c).isNull() if v is None else F.col(c) == F.lit(v) for c, v in zip(columns, values)]
        return reduce(lambda a, b: a & b, parts)

    if len(columns) == 1:
        plain = [v for (v,) in found if v is not None]
        hit = F.col(columns[0]).isin(plain)
        return hit | F.col(columns[0]).isNull() if len(plain) < len(found) else hit
    return reduce(lambda a, b: a | b, map(one, found), F.lit(False))


def merge_partitions(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    deleted: str | None = None,
) -> list[tuple]:
    """Merge changes into a Parquet folder; returns the partitions written or emptied.

    A change replaces the row of its key wherever that lies, so a row may move
    to another partition; rows for which ``deleted`` is true only remove their
    key.  ``changes`` holds a key at most once; null keys match null keys.

    The keys of the base are read once, without other columns, to find the
    partitions that hold a changed key; these and the ones the changes fall in
    are read whole, merged, staged, and then swapped in.  Files of all other
    partitions are neither read whole nor written.
    """
    store = Store(spark, path)
    gone = F.lit(False) if deleted is None else F.coalesce(F.col(deleted).cast("boolean"), F.lit(False))
    taken = stage(changes.withColumn("_gone", gone), "merge-changes")
    base = spark.read.parquet(path)
    columns = base.columns
    named = taken.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    held = _values(base.select(*keys, *partition_by).join(named, same, "left_semi"), partition_by)
    coming = _values(taken.where("NOT _gone"), partition_by)
    touched = sorted({*held, *coming}, key=lambda v: tuple((x is not None, str(x)) for x in v))
    if not touched:
        return []
    old = base.where(_in(partition_by, touched)).join(named, same, "left_anti")
    merged = old.select(*columns).unionByName(taken.where("NOT _gone").select(*columns))
    fresh = scratch_path(spark, "merge-rows")
    # Rows of a partition gather in few files; a huge partition is still split.
    merged.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(fresh)
    staged = spark.read.schema(base.schema).parquet(fresh)
    filled = set(_values(staged, partition_by))
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    emptied = [v for v in touched if v not in filled]
    if emptied:
        # What an overwrite of filled partitions leaves behind, by the folder names the reader saw.
        left = base.where(_in(partition_by, emptied)).select(F.input_file_name().alias("f")).distinct().collect()
        for row in left:
            store.delete(row.f)
    return touched
