"""Line and token operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.functions.text import split_on
from loomwork.operators.windows import number_all


def tokens(df: DataFrame, text: str, separator: str = " ", name: str = "word") -> DataFrame:
    """One row per token of ``text``, other columns repeated."""
    return df.withColumn(name, F.explode(split_on(text, separator)))


def word_count(df: DataFrame, text: str, separator: str = " ") -> DataFrame:
    """Occurrences of each token; counts are combined before the shuffle."""
    words = df.select(F.explode(split_on(text, separator)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def without_header(lines: DataFrame, column: str, header: str) -> DataFrame:
    """Lines other than the header line, wherever files repeat it."""
    return lines.where(F.col(column) != F.lit(header))


def split_columns(
    df: DataFrame, line: str, separator: str, names: Sequence[tuple[str, str]]
) -> DataFrame:
    """Typed columns from delimited lines; short lines and bad values give nulls."""
    parts = split_on(line, separator)
    return df.select(
        *[F.get(parts, F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(names)]
    )


def level_counts(lines: DataFrame, line: str, position: int = 2) -> DataFrame:
    """Rows per severity word of a space-separated log line; short lines are skipped."""
    parts = F.split(line, " ")
    return (
        lines.where(F.size(parts) > position)
        .groupBy(F.get(parts, F.lit(position)).alias("level"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def line_order(lines: DataFrame) -> DataFrame:
    """Add ``_file``, ``_block`` and ``_line``, which sort as the lines stand in their files."""
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )


LINE_ORDER = ("_file", "_block", "_line")


def zip_rows(
    a: DataFrame, b: DataFrame, order_a: Sequence[str], order_b: Sequence[str], name: str = "row_no"
) -> DataFrame:
    """Join two tables without a key, by position in their given total orders.

    Rows past the end of the shorter table keep nulls for the other side, so
    unequal lengths show instead of passing unseen.
    """
    left = number_all(a, order_a, name)
    right = number_all(b, order_b, name)
    return left.join(right, name, "full")

