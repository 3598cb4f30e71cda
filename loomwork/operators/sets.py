"""Set operations on whole rows.

Each is one aggregation over the tagged union of both inputs: copies collapse
before the shuffle, nulls compare equal, and no join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def presence(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of both frames with flags ``in_a`` and ``in_b``."""
    columns = a.columns
    tagged = a.select("*", F.lit(True).alias("in_a"), F.lit(False).alias("in_b")).union(
        b.select("*", F.lit(False).alias("in_a"), F.lit(True).alias("in_b"))
    )
    return tagged.groupBy(*columns).agg(
        F.bool_or("in_a").alias("in_a"), F.bool_or("in_b").alias("in_b")
    )


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def common_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in both."""
    return presence(a, b).where("in_a and in_b").drop("in_a", "in_b")


def rows_only_in(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that are not in ``b``."""
    return presence(a, b).where("in_a and not in_b").drop("in_a", "in_b")


def rows_in_one(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in exactly one of the two."""
    return presence(a, b).where("in_a <> in_b").drop("in_a", "in_b")


def relation(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: is ``a`` a subset or superset of ``b``, or are they disjoint?"""
    return presence(a, b).agg(
        F.coalesce(F.bool_and(~F.col("in_a") | F.col("in_b")), F.lit(True)).alias("subset"),
        F.coalesce(F.bool_and(~F.col("in_b") | F.col("in_a")), F.lit(True)).alias("superset"),
        F.coalesce(F.bool_and(~(F.col("in_a") & F.col("in_b"))), F.lit(True)).alias("disjoint"),
    )
