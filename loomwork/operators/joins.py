"""Lookups, enrichment and membership tests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from loomwork.operators.skew import require_distinct_names, skew_join

# Rows and bytes up to which a side counts as proven small.
SMALL_ROWS = 20_000
SMALL_BYTES = 64 << 20


def is_small(df: DataFrame, rows: int = SMALL_ROWS, size: int = SMALL_BYTES) -> bool:
    """True when ``df`` has at most ``rows`` rows holding at most ``size`` bytes.

    Rows without columns are taken from one partition, then from more until
    there are too many, so a large table is hardly read and no task gathers it.
    Bytes are only added up when there are few rows and some column has no fixed
    width.
    """
    if len(df.select(F.lit(1)).take(rows + 1)) > rows:
        return False
    widths = [_width(f.name, f.dataType) for f in df.schema.fields]
    widths = [w for w in widths if w is not None]
    if not widths:
        return True
    total = df.agg(F.sum(reduce(lambda a, b: a + b, widths))).first()[0]
    return total is None or total <= size


def _width(name: str, kind: DataType) -> Column | None:
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)).cast("long")
    if isinstance(kind, (ArrayType, MapType, StructType)):
        text = F.to_json(F.struct(name))
        return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return None


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str | tuple[str, str]],
    how: str = "inner",
    small_rows: int | None = None,
    group_rows: int | None = None,
) -> DataFrame:
    """Join a large table with a lookup table.

    Spark broadcasts a lookup table that its statistics, or the shuffle it has
    just measured, show to be small, and else splits hot keys.  ``small_rows``
    asks for a check of the table's rows instead, and a broadcast up to that
    many, which pays for tables beyond Spark's own limit.  Names on both sides
    other than shared keys are refused in every case.
    """
    pairs = [(k, k) if isinstance(k, str) else tuple(k) for k in on]
    require_distinct_names(fact, dim, pairs, how)
    if small_rows is not None and how in ("inner", "left") and is_small(dim, small_rows):
        return skew_join(fact, F.broadcast(dim), on, how, group_rows=0)
    return skew_join(fact, dim, on, how, hot="left", group_rows=group_rows)


def matched(df: DataFrame, other: DataFrame, on: Sequence[str | tuple[str, str]]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other`` (semi join)."""
    return skew_join(df, other, on, "left_semi")


def unmatched(df: DataFrame, other: DataFrame, on: Sequence[str | tuple[str, str]]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; null keys are kept."""
    return skew_join(df, other, on, "left_anti")


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """``column NOT IN (select other_column ...)`` with SQL null semantics.

    One null in the list leaves no row; an empty list keeps every row.  Written
    as an anti join plus a one-row null check, so the list is never broadcast.
    """
    values = other.select(other_column).distinct()
    state = values.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(other_column).isNull()).alias("nulls"),
    )
    empty = state.select(F.col("n") == 0).scalar()
    no_null = state.select(F.col("nulls") == 0).scalar()
    kept = unmatched(df, values, [(column, other_column)])
    return kept.where(empty | (no_null & F.col(column).isNotNull()))


def grid(a: DataFrame, b: DataFrame, max_cells: int = 1_000_000) -> DataFrame:
    """Every pair of two bounded lists, of which there may be at most ``max_cells``.

    A scaffold for reports; larger products are refused before any pair is made.
    """
    rows = len(a.select(F.lit(1)).take(max_cells + 1))
    columns = len(b.select(F.lit(1)).take(max_cells // max(rows, 1) + 1))
    if rows * columns > max_cells:
        raise ValueError(f"a grid may have at most {max_cells} cells")
    return a.crossJoin(F.broadcast(b))


def totals_per_key(
    dim: DataFrame,
    fact: DataFrame,
    on: tuple[str, str],
    measures: Sequence,
    how: str = "left",
) -> DataFrame:
    """Aggregate the fact table by key, then attach the totals to the dimension.

    Aggregating first sends one row per key through the join, so a heavy key
    costs nothing extra.
    """
    dim_key, fact_key = on
    totals = fact.groupBy(F.col(fact_key).alias("_fk")).agg(*measures)
    return dim.join(totals, F.col(dim_key) == F.col("_fk"), how).drop("_fk")


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert-else-update: changed keys replace base rows, new keys are added.

    Both sides hold a key at most once; ``changes`` is usually the small one,
    and then Spark broadcasts its keys by size instead of shuffling the base.
    """
    kept = base.join(changes.select(*keys), list(keys), "left_anti")
    return kept.select(*base.columns).unionByName(changes.select(*base.columns))


def rules_lookup(
    df: DataFrame,
    rules: DataFrame,
    levels: Sequence[str],
    value: str,
    default: object = None,
) -> DataFrame:
    """Attach ``value`` from the most specific matching rule.

    A rule leaves the finer levels null to mean "any"; one with all levels null
    matches everything, and ``default`` stands where no rule does.  A rule with
    a null above a filled level says nothing that can be looked up, and two
    rules for the same place contradict each other: both are refused.  Tables
    of any length are joined once per level.
    """
    holes = [F.col(a).isNull() & F.col(b).isNotNull() for a, b in zip(levels, levels[1:])]
    if holes and not rules.where(reduce(lambda a, b: a | b, holes)).isEmpty():
        raise ValueError("a rule must fill its levels from the first on")
    if not rules.groupBy(*levels).count().where("count > 1").isEmpty():
        raise ValueError("two rules for the same levels")
    found = []
    result = df
    for depth in range(len(levels), 0, -1):
        used, rest = levels[:depth], levels[depth:]
        part = rules.where(F.col(used[-1]).isNotNull())
        for name in rest:
            part = part.where(F.col(name).isNull())
        hit = f"_rule{depth}"
        result = lookup(result, part.select(*used, F.col(value).alias(hit)), list(used), "left")
        found.append(F.col(hit))
    everywhere = rules.where(F.col(levels[0]).isNull()).select(F.max(value))
    picked = F.coalesce(*found, everywhere.scalar(), F.lit(default))
    return result.select(*df.columns, picked.cast(rules.schema[value].dataType).alias(value))
