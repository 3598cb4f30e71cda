"""Descriptive statistics, samples and frequent values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_statistics(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One row per column pair with correlation and sample covariance, one pass."""
    measures = []
    for i, (x, y) in enumerate(pairs):
        measures.append(F.corr(x, y).alias(f"_r{i}"))
        measures.append(F.covar_samp(x, y).alias(f"_c{i}"))
    rows = [
        F.struct(
            F.lit(x).alias("x"),
            F.lit(y).alias("y"),
            F.col(f"_r{i}").alias("correlation"),
            F.col(f"_c{i}").alias("covariance"),
        )
        for i, (x, y) in enumerate(pairs)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def sample_rows(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Random sample; the rows drawn depend on how the input is partitioned."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_hash(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Sample by the hash of a key: the same rows for any partitioning.

    A fraction of 0 gives no row, 1 all of them.  Null keys hash as one value,
    so they are all drawn or none is.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be between 0 and 1")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    drawn = F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")
    return df.where(drawn < F.lit(round(fraction * (1 << 48))))


def frequent_values(df: DataFrame, columns: Sequence[str], support: float) -> DataFrame:
    """Values above ``support``; may contain some that are not (one-pass sketch)."""
    return df.freqItems(list(columns), support)


def frequent_exact(df: DataFrame, column: str, support: float) -> DataFrame:
    """Values making up at least ``support`` of the rows, with their counts.

    The sketch names at most ``1 / support`` candidates, null among them; the
    exact count of these is a filter and a map-side combined aggregation.
    """
    sketch = df.freqItems([column], support)
    candidates = sketch.select(F.explode(f"{column}_freqItems").alias("value"))
    rows = df.select(F.col(column).alias("value"))
    named = candidates.select(F.col("value").alias("_candidate"))
    matched = rows.join(named, F.col("value").eqNullSafe(F.col("_candidate")), "left_semi")
    counts = matched.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("total")).scalar()
    return counts.where(F.col("n") >= total * support)


def profile(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]],
    frequent: Sequence[str],
    fraction: float = 0.2,
    seed: int = 10,
    support: float = 0.4,
) -> Mapping[str, DataFrame]:
    """The usual exploratory set."""
    return {
        "sample": sample_rows(df, fraction, seed),
        "summary": df.summary(),
        "pairs": pair_statistics(df, pairs),
        "frequent": frequent_values(df, frequent, support),
    }
