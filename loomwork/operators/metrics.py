"""Grouped measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.operators.windows import shift_rows, sort_columns


def money_sum(column: str, scale: int) -> Column:
    """Sum of an amount held as double, the same whatever order rows arrive in.

    Every amount is taken at ``scale`` digits after the point, which the caller
    states; finer parts are rounded away.
    """
    return F.sum(F.col(column).cast(f"decimal(28,{scale})")).cast("double")


def money_avg(column: str, scale: int) -> Column:
    """Average from the exact sum; null for an empty group."""
    return F.try_divide(money_sum(column, scale), F.count(column).cast("double"))


def dim_metrics(
    df: DataFrame,
    dims: Sequence[str | Column],
    metrics: Mapping[str, Column],
    where: str | Column | None = None,
    having: str | Column | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Filter, group, measure, filter the groups, sort.

    Spark aggregates before and after the shuffle, and splits distinct counts
    into two rounds, so one large group does not land on one task.
    """
    if where is not None:
        df = df.where(where)
    result = df.groupBy(*dims).agg(*[m.alias(n) for n, m in metrics.items()])
    if having is not None:
        result = result.where(having)
    return result.orderBy(*sort_columns(order)) if order else result


def change_over_periods(
    df: DataFrame,
    keys: Sequence[str],
    period: Mapping[str, Column],
    measure: Mapping[str, Column],
    prior: str,
    default: object = None,
) -> DataFrame:
    """Aggregate per key and period and put the previous period's value beside it.

    A key has one row per period then, so no key is heavy and none are counted.
    """
    (name, _), = measure.items()
    per_period = df.groupBy(*keys, *[c.alias(n) for n, c in period.items()]).agg(
        *[c.alias(n) for n, c in measure.items()]
    )
    return shift_rows(per_period, keys, list(period), {prior: (name, 1, default)}, group_rows=0)
