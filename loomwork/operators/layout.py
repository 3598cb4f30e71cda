"""Partition layout, caching and lineage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.operators.joins import SMALL_ROWS, is_small
from loomwork.session import shared_dir


def layout(
    df: DataFrame,
    partitions: int | None = None,
    by: Sequence[str] = (),
    shrink: bool = False,
) -> DataFrame:
    """Repartition, or merge partitions without a shuffle when ``shrink`` is set.

    Without a number Spark sizes the partitions from the data (a rebalance),
    also splitting the ones a heavy key would swell; no counting job is run.
    """
    if shrink:
        if partitions is None:
            raise ValueError("shrinking needs a partition count")
        return df.coalesce(partitions)
    if partitions is None:
        return df.hint("rebalance", *by)
    return df.repartition(partitions, *by)



def parts_for(df: DataFrame, rows_each: int, least: int = 1) -> int:
    """How many files or buckets of about ``rows_each`` rows a frame fills.

    Meant for stored tables, whose row counts Spark takes from file footers.
    """
    return max(least, -(-df.count() // rows_each))


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep a frame with several consumers cached for the length of a block."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint to the shared folder named in ``spark.checkpoint.dir``."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def broadcast_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """Hint a broadcast when the frame is proven small, else leave it alone."""
    return F.broadcast(df) if is_small(df, rows) else df


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition, counted where the rows are."""
    return (
        df.select(F.spark_partition_id().alias("partition"))
        .groupBy("partition")
        .agg(F.count(F.lit(1)).alias("n"))
    )
