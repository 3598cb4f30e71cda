"""Stateless transformations; each works on batch frames just the same."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decode_json(df: DataFrame, schema: str, fields: Sequence[str], value: str = "value") -> DataFrame:
    """Named fields of JSON held in a binary or text column."""
    body = df.select(F.from_json(F.col(value).cast("string"), schema).alias("body"))
    return body.select(*[F.col(f"body.{f}") for f in fields])


def with_total(df: DataFrame, columns: Sequence[str], name: str = "total") -> DataFrame:
    """Sum of several columns of one row, null when any of them is."""
    return df.withColumn(name, reduce(lambda a, b: a + b, [F.col(c) for c in columns]))


def with_load_date(df: DataFrame, name: str = "current_dt", run_date: str | None = None) -> DataFrame:
    """Load date column; pass ``run_date`` for output that can be repeated."""
    day: Column = F.current_date() if run_date is None else F.lit(run_date).cast("date")
    return df.withColumn(name, day)


def sql_over(df: DataFrame, view: str, text: str) -> DataFrame:
    """SQL on a stream through a temporary view."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(text)
