"""Row numbers, ranks, top rows and neighbours, per key and over a whole table.

Sort orders are given as names; a leading ``-`` means descending.  Callers add
a tie-break that makes the order total wherever a row number is produced.

A window function needs all rows of its partition in one task.  Ordinary keys
use it as it is.  Rows of heavy keys, and tables numbered as a whole, are laid
out by range over the full sort order instead, which balances whatever the key
distribution, and the per-segment results are joined up through a summary with
one row per segment.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.operators.columns import hashable_columns
from loomwork.operators.skew import GROUP_ROWS, heavy_keys, skew_join, split_heavy
from loomwork.session import stage

# Largest n that Spark reduces to before the shuffle.
GROUP_LIMIT = "spark.sql.window.group.limit.threshold"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def sort_columns(order: Sequence[str]) -> list[Column]:
    """``["-amt", "id"]`` as sort columns; nulls come last when descending."""
    return [F.desc(n[1:]) if n.startswith("-") else F.asc(n) for n in order]


def number_all(df: DataFrame, order: Sequence[str], name: str = "row_no") -> DataFrame:
    """Contiguous row number over the whole table, without a one-task window."""
    rows = _segments(df, [], order)
    sizes = rows.groupBy("_seg").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_seg", F.coalesce(before, F.lit(0)).alias("_before"))
    in_segment = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per segment: as many rows as the layout has partitions.
    return (
        rows.join(F.broadcast(starts), "_seg")
        .withColumn(name, F.col("_before") + in_segment + 1)
        .drop("_seg", "_pos", "_before")
    )


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "row_no",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Row number within each key."""

    def plain(part: DataFrame) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
        return part.withColumn(name, F.row_number().over(window).cast("long"))

    def wide(part: DataFrame) -> DataFrame:
        return _rank_segments(part, keys, order, [], {"row": name})

    return _per_key(df, keys, group_rows, plain, wide)


def rank_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    names: tuple[str, str, str] = ("row_no", "rank_no", "dense_no"),
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Row number, rank and dense rank by ``order``; ``ties`` settles row numbers."""

    def plain(part: DataFrame) -> DataFrame:
        by_key = Window.partitionBy(*keys)
        total = by_key.orderBy(*sort_columns([*order, *ties]))
        value = by_key.orderBy(*sort_columns(order))
        return part.withColumns(
            {
                names[0]: F.row_number().over(total).cast("long"),
                names[1]: F.rank().over(value).cast("long"),
                names[2]: F.dense_rank().over(value).cast("long"),
            }
        )

    def wide(part: DataFrame) -> DataFrame:
        wanted = dict(zip(("row", "rank", "dense"), names))
        return _rank_segments(part, keys, order, ties, wanted)

    return _per_key(df, keys, group_rows, plain, wide)


def shift_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, tuple[str, int, object]],
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Values of earlier (offset > 0) or later (offset < 0) rows of the same key.

    ``columns`` maps a new name to ``(column, offset, default)``; the default
    stands where there is no such row.  ``group_rows`` of 0 says that no key is
    heavy.
    """

    def plain(part: DataFrame) -> DataFrame:
        window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
        return part.withColumns(
            {n: F.lag(c, k, d).over(window) for n, (c, k, d) in columns.items()}
        )

    def wide(part: DataFrame) -> DataFrame:
        # Numbered rows fall into chunks of a bounded size.  Inside a chunk the
        # window does it; a row near the edge finds its neighbour among the few
        # edge rows of all chunks, so the rows move once and are not joined
        # with themselves.
        rows = stage(_rank_segments(part, keys, order, [], {"row": "_n"}), "numbered")
        reach = max(abs(k) for _, k, _ in columns.values())
        size = max(group_rows, 4 * reach)
        place = F.col("_n") - 1
        rows = rows.withColumn("_chunk", F.floor(place / size))
        at = F.pmod(place, F.lit(size))
        edges = rows.where((at < reach) | (at >= size - reach))
        window = Window.partitionBy(*keys, "_chunk").orderBy("_n")
        inner = {f"_v{i}": F.lag(c, k).over(window) for i, (c, k, _) in enumerate(columns.values())}
        result = rows.withColumns(inner)
        for i, (name, (column, offset, default)) in enumerate(columns.items()):
            other = edges.select(
                *[F.col(k).alias(f"_k{j}") for j, k in enumerate(keys)],
                (F.col("_n") + offset).alias("_m"),
                F.col(column).alias("_edge"),
                F.lit(True).alias("_hit"),
            )
            crosses = F.floor((F.col("_n") - offset - 1) / size) != F.col("_chunk")
            same = (F.col("_n") == F.col("_m")) & crosses
            for j, key in enumerate(keys):
                same = same & F.col(key).eqNullSafe(F.col(f"_k{j}"))
            kind = part.schema[column].dataType
            missing = F.lit(default).cast(kind)
            # Inside a chunk the neighbour is missing only past the key's end.
            past = (F.col("_n") - offset < 1) | (F.col("_n") - offset > F.col("_last"))
            value = F.when(F.col("_hit"), F.col("_edge")).when(crosses | past, missing).otherwise(F.col(f"_v{i}"))
            if i == 0:
                last = rows.groupBy(*keys).agg(F.max("_n").alias("_last"))
                last = last.select(*[F.col(k).alias(f"_l{j}") for j, k in enumerate(keys)], "_last")
                ends = F.lit(True)
                for j, key in enumerate(keys):
                    ends = ends & F.col(key).eqNullSafe(F.col(f"_l{j}"))
                # One row per heavy key.
                result = result.join(F.broadcast(last), ends).drop(*[f"_l{j}" for j in range(len(keys))])
            result = (
                result.join(other, same, "left")
                .withColumn(name, value)
                .drop("_m", "_hit", "_edge", *[f"_k{j}" for j in range(len(keys))])
            )
        return result.select(*part.columns, *columns)

    return _per_key(df, keys, group_rows, plain, wide)


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 1, name: str | None = None
) -> DataFrame:
    """First ``n`` rows of each key under a total order.

    The filter on the row number lets Spark drop all but ``n`` rows per key
    before the shuffle, so a heavy key arrives already reduced.  Spark does so
    only up to a limit; above it heavy keys are numbered in segments.
    """
    number = name or "_n"
    if n > int(df.sparkSession.conf.get(GROUP_LIMIT, "1000")):
        kept = number_rows(df, keys, order, number).where(F.col(number) <= n)
        return kept.withColumn(number, F.col(number).cast("int")) if name else kept.drop(number)
    window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    kept = df.withColumn(number, F.row_number().over(window).cast("int")).where(F.col(number) <= n)
    return kept if name else kept.drop(number)


def nth_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The ``n``-th row of each key under a total order."""
    return top_per_key(df, keys, order, n, name="_n").where(F.col("_n") == n).drop("_n")


def nth_value_rows(
    df: DataFrame, keys: Sequence[str], value: str, n: int = 1, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Every row holding the ``n``-th highest distinct value of its key.

    The values are made distinct before they are ranked, so neither a heavy key
    nor a large group of ties reaches one task.
    """
    distinct = df.where(F.col(value).isNotNull()).select(*keys, value).distinct()
    wanted = nth_per_key(distinct, keys, [f"-{value}"], n)
    return skew_join(
        df, wanted, [*keys, value], "left_semi", group_rows=group_rows, null_safe=True
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows of the whole table, taken per partition and then merged."""
    return df.orderBy(*sort_columns(order)).limit(n)


def last_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Last ``n`` rows of the whole table, found the same way from the other end."""
    return first_rows(df, [c[1:] if c.startswith("-") else f"-{c}" for c in order], n)


def _per_key(
    df: DataFrame,
    keys: Sequence[str],
    group_rows: int,
    plain: Callable[[DataFrame], DataFrame],
    wide: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    heavy = heavy_keys(df, keys, group_rows) if group_rows else None
    if heavy is None:
        return plain(df)
    ordinary, large = split_heavy(df, keys, heavy)
    return plain(ordinary).unionByName(wide(large))


def _segments(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Range-partitioned, sorted and staged rows with their position and segment.

    Rows that tie on the whole sort order are spread by their hash, and copies
    by the input partition they come from.  Both stay the same when a task is
    retried, so a row never changes its segment.
    """
    layout = [*[F.asc(k) for k in keys], *sort_columns(order)]
    spread = {"_hash": F.xxhash64(*hashable_columns(df)), "_part": F.spark_partition_id()}
    placed = (
        df.withColumns(spread)
        .repartitionByRange(*layout, "_hash", "_part")
        .drop(*spread)
        .sortWithinPartitions(*layout)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    return stage(placed, "segments").withColumn("_seg", F.shiftright("_pos", _ROW_BITS))


def _rank_segments(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str],
    wanted: Mapping[str, str],
) -> DataFrame:
    rows = _segments(df, keys, [*order, *ties])
    piece = Window.partitionBy(*keys, "_seg")
    by_value = piece.orderBy(*sort_columns(order))
    local = {"_row": F.row_number().over(piece.orderBy(*sort_columns(order), "_pos"))}
    if "rank" in wanted or "dense" in wanted:
        local["_rank"] = F.rank().over(by_value)
        local["_dense"] = F.dense_rank().over(by_value)
    rows = rows.withColumns(local)

    starts = _segment_starts(rows, keys, order, ranked="_rank" in local)
    same = F.col("_seg") == F.col("_sseg")
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_s{i}"))
    # One row per (key, segment): at most segments + heavy keys.
    rows = rows.join(F.broadcast(starts), same)

    made = {"row": F.col("_before") + F.col("_row")}
    if "_rank" in local:
        made["rank"] = F.when(F.col("_rank") == 1, F.col("_first_rank")).otherwise(
            F.col("_before") + F.col("_rank")
        )
        made["dense"] = F.col("_dense") + F.col("_dense_before")
    result = rows.withColumns({name: made[kind].cast("long") for kind, name in wanted.items()})
    return result.select(*df.columns, *wanted.values())


def _segment_starts(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], ranked: bool
) -> DataFrame:
    """What precedes each (key, segment): row count, open tie group, distinct values."""
    measures = [F.count(F.lit(1)).alias("_rows")]
    if ranked:
        value = F.struct(*[n.lstrip("-") for n in order])
        measures += [
            F.max("_rank").alias("_last_rank"),
            F.max("_dense").alias("_values"),
            F.min_by(value, "_pos").alias("_first"),
            F.max_by(value, "_pos").alias("_last"),
        ]
    summary = rows.groupBy(*keys, "_seg").agg(*measures)
    by_key = Window.partitionBy(*keys).orderBy("_seg")
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    upto = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = [*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)], F.col("_seg").alias("_sseg")]
    summary = summary.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    if not ranked:
        return summary.select(*named, "_before")

    # A tie group may run on from the previous segment, and through whole ones.
    summary = summary.withColumn("_open", F.col("_first").eqNullSafe(F.lag("_last").over(by_key)))
    closes = (F.col("_values") > 1) | ~F.col("_open")
    summary = summary.withColumn(
        "_run_rank",
        F.last(
            F.when(closes, F.col("_before") + F.col("_last_rank")), ignorenulls=True
        ).over(upto),
    )
    first_rank = F.when(F.col("_open"), F.lag("_run_rank").over(by_key)).otherwise(
        F.col("_before") + 1
    )
    dense_before = F.coalesce(F.sum("_values").over(earlier), F.lit(0)) - F.sum(
        F.col("_open").cast("long")
    ).over(upto)
    return summary.select(
        *named, "_before", first_rank.alias("_first_rank"), dense_before.alias("_dense_before")
    )
