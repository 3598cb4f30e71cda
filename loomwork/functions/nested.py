"""JSON text and nested values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_json(column: str | Column, schema: str) -> Column:
    """Struct from JSON text; unknown fields are ignored, missing ones are null."""
    return F.from_json(column, schema)


def pick(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Flat columns from nested paths: ``{"title": "info.title"}``."""
    return df.select(*[F.col(path).alias(name) for name, path in fields.items()])


def one_per_element(df: DataFrame, array: str, name: str, position: str | None = None) -> DataFrame:
    """One row per array element, with its position on request."""
    if position is None:
        return df.withColumn(name, F.explode(array)).drop(array)
    others = [c for c in df.columns if c != array]
    return df.select(*others, F.posexplode(array).alias(position, name))
