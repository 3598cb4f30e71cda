"""Removing, filling, replacing and de-duplicating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.text import split_on
from loomwork.operators.joins import lookup
from loomwork.operators.windows import top_per_key


@dataclass(frozen=True)
class TidyRules:
    """Null handling and value replacement, applied as drop, fill, replace."""

    drop_any: Sequence[str] = ()
    drop_all: Sequence[str] = ()
    fill: Mapping[str, object] = field(default_factory=dict)
    replace: Mapping[str, Mapping] = field(default_factory=dict)


def tidy(df: DataFrame, rules: TidyRules) -> DataFrame:
    """Drop, fill and replace; all narrow, so Spark runs the chain in one generated stage."""
    if rules.drop_any:
        df = df.na.drop("any", subset=list(rules.drop_any))
    if rules.drop_all:
        df = df.na.drop("all", subset=list(rules.drop_all))
    if rules.fill:
        df = df.na.fill(dict(rules.fill))
    for column, mapping in rules.replace.items():
        df = df.na.replace(dict(mapping), subset=[column])
    return df


def replace_from(df: DataFrame, column: str, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """Replace values through a mapping table; values it lacks stay as they are."""
    pairs = mapping.select(F.col(key).alias("_from"), F.col(value).alias("_to"))
    joined = lookup(df, pairs, [(column, "_from")], "left")
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")


def keep_best(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first under ``order``, which should be total."""
    return top_per_key(df, keys, order, 1)


def distinct_complete(df: DataFrame) -> DataFrame:
    """Distinct rows without any null, as handed to downstream consumers."""
    return df.na.drop("any").dropDuplicates()


def is_not_numeric(column: Column) -> Column:
    """True for text holding letters, found by its case forms differing."""
    return F.upper(column) != F.lower(column)


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail the query on the first row with a null in one of ``columns``.

    The check rides along with the scan.  Readers ignore ``nullable=False`` in
    a declared schema, so a key column needs it spelled out.
    """
    checked = {
        c: F.coalesce(
            F.col(c),
            F.raise_error(F.lit(f"null in required column {c}")).cast(df.schema[c].dataType),
        )
        for c in columns
    }
    return df.withColumns(checked)


def wide_enough(df: DataFrame, line: str, separator: str, fields: int) -> DataFrame:
    """Lines with at least ``fields`` fields."""
    return df.where(F.size(split_on(line, separator)) >= fields)

