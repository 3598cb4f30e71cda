"""Publishing frames to files and catalog tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from loomwork.sources.files import SourceSpec, load


@dataclass(frozen=True)
class SinkSpec:
    """Where and how to write.

    ``table`` without ``path`` is a managed table, with ``path`` an external
    one.  ``touched_partitions_only`` makes an overwrite replace just the
    partitions present in the data, of a folder or of an existing table.  ``files`` gathers the output into that many
    files and is meant for small results; ``rows_per_file`` bounds file sizes
    without squeezing the write through few tasks.
    """

    format: str = "parquet"
    path: str | None = None
    table: str | None = None
    mode: str = "errorifexists"
    partition_by: Sequence[str] = ()
    bucket_by: tuple[int, Sequence[str]] | None = None
    touched_partitions_only: bool = False
    files: int | None = None
    rows_per_file: int | None = None
    options: Mapping[str, str] = field(default_factory=dict)


def save(df: DataFrame, spec: SinkSpec) -> None:
    if spec.files is not None:
        # A shuffle rather than a coalesce: what comes before keeps its parallelism.
        df = df.repartition(spec.files)
    elif spec.bucket_by is not None:
        # One task per bucket instead of a file per task and bucket.
        df = df.hint("rebalance", spec.bucket_by[0], *spec.bucket_by[1])
    elif spec.partition_by:
        # Rows of a partition gather in few files; a huge partition is still split.
        df = df.hint("rebalance", *spec.partition_by)
    writer = df.write.format(spec.format).mode(spec.mode).options(**spec.options)
    if spec.partition_by:
        writer = writer.partitionBy(*spec.partition_by)
    if spec.touched_partitions_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if spec.rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", spec.rows_per_file)
    if spec.bucket_by is not None:
        buckets, columns = spec.bucket_by
        writer = writer.bucketBy(buckets, *columns).sortBy(*columns)
    if spec.table is not None:
        spark = df.sparkSession
        if spec.touched_partitions_only and spec.mode == "overwrite" and spark.catalog.tableExists(spec.table):
            _replace_partitions(df, spec.table)
            return
        if spec.path is not None:
            writer = writer.option("path", spec.path)
        writer.saveAsTable(spec.table)
    elif spec.path is not None:
        writer.save(spec.path)
    elif spec.format == "jdbc":
        writer.save()
    else:
        raise ValueError("a sink needs a path or a table")


def _replace_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions of an existing table that ``df`` holds rows of.

    Saving as a table would replace the table; an insert keeps the rest.
    Columns are put in the table's order by name.
    """
    spark = df.sparkSession
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "dynamic")
    try:
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def migrate(spark: SparkSession, source: SourceSpec, sink: SinkSpec) -> None:
    """Move data from one format to another."""
    save(load(spark, source), sink)


def append_by_position(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert into an existing table; columns match by position, not by name."""
    df.write.insertInto(table, overwrite=overwrite)


def rebuild_external(
    spark: SparkSession, table: str, path: str, fmt: str = "orc"
) -> DataFrame:
    """Point an external table at files whose columns have changed.

    The schema is merged from the file footers; no data is rewritten.
    """
    schema = load(spark, SourceSpec(fmt, path, merge_schema=True)).schema
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=path, source=fmt, schema=schema)
    return spark.table(table)


def discover_partitions(spark: SparkSession, table: str, statistics: bool = True) -> None:
    """Take in partition folders that others have added or removed below a table's folder.

    With ``statistics`` the sizes, row counts and column statistics are computed
    anew, so that Spark decides broadcasts and join orders by what is there.
    """
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    if statistics:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    spark.catalog.refreshTable(table)
