"""Stream sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(brokers: str, topic: str, group: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": brokers, "subscribe": topic}
    if group is not None:
        options["kafka.group.id"] = group
    return options


def read_kafka(
    spark: SparkSession,
    brokers: str,
    topic: str,
    group: str | None = None,
    max_offsets: int | None = None,
) -> DataFrame:
    """Topic records with binary ``value``; needs the connector package at submit time."""
    reader = spark.readStream.format("kafka").options(**kafka_options(brokers, topic, group))
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def read_files(
    spark: SparkSession,
    fmt: str,
    path: str,
    schema: str,
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Files arriving in a folder; at most ``max_files`` per batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of text files arriving in a folder, as column ``value``."""
    return read_files(spark, "text", path, "value STRING", max_files)


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket; for trying things out, it cannot replay after a failure."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()
