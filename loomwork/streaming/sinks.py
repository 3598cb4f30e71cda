"""Stream sinks, all with a checkpoint wherever the sink keeps results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomwork.operators.windows import top_per_key


def trigger(every: str | None) -> dict[str, object]:
    """``"30 seconds"`` for a running job, ``None`` to take what is there and stop."""
    return {"processingTime": every} if every else {"availableNow": True}


def to_files(
    df: DataFrame,
    fmt: str,
    path: str,
    checkpoint: str,
    every: str | None = None,
    files: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append to files exactly once; ``files`` gathers each batch into that many."""
    if files is not None:
        df = df.repartition(files)
    writer = df.writeStream.format(fmt).outputMode("append").trigger(**trigger(every))
    if name is not None:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).start(path)


def to_console(df: DataFrame, every: str | None = None) -> StreamingQuery:
    return df.writeStream.format("console").outputMode("append").trigger(**trigger(every)).start()


def to_index(
    df: DataFrame,
    fmt: str,
    resource: str,
    key: str,
    checkpoint: str,
    name: str,
    options: Mapping[str, str] | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Upsert into a document index through its own connector, keyed by ``key``."""
    writer = df.writeStream.format(fmt).outputMode("append").queryName(name)
    writer = writer.options(**index_options(resource, key, options))
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger(every)).start()


def index_options(
    resource: str, key: str, options: Mapping[str, str] | None = None
) -> dict[str, str]:
    return {"es.resource": resource, "es.mapping.id": key, **(options or {})}


def to_keyed(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Keep the latest row per key.

    Each batch is reduced to one row per key and written as its own partition,
    named by the batch id: a batch replayed after a failure overwrites itself,
    and no batch rewrites older data.  ``latest`` reads the result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = top_per_key(batch, keys, order)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.foreachBatch(write).trigger(**trigger(every))
    return writer.option("checkpointLocation", checkpoint).start()


def latest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Current row of each key of a table written by ``to_keyed``."""
    rows = spark.read.option("basePath", path).parquet(path)
    return top_per_key(rows, keys, [*order, "-batch_id"]).drop("batch_id")


def compact(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], target: str
) -> None:
    """Write the current rows as a fresh table, the start of a new series of batches."""
    rows = latest(spark, path, keys, order).withColumn("batch_id", F.lit(-1))
    rows.write.partitionBy("batch_id").parquet(target)
