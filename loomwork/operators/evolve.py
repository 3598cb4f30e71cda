"""Combining tables whose columns differ."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column one frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_padded(a: DataFrame, b: DataFrame, padding: Mapping[str, object]) -> DataFrame:
    """Positional union after giving each side its missing columns as constants."""
    names = list(dict.fromkeys([*a.columns, *b.columns]))
    unknown = [n for n in names if (n not in a.columns or n not in b.columns) and n not in padding]
    if unknown:
        raise ValueError(f"no padding given for {unknown}")

    def padded(df: DataFrame) -> DataFrame:
        return df.select(
            *[F.col(n) if n in df.columns else F.lit(padding[n]).alias(n) for n in names]
        )

    return padded(a).union(padded(b))


def combine(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name where columns may also change type between frames.

    Numeric types widen to one that holds both.  Any other clash is carried as
    text; left to itself the union would settle on the numeric type and fail on
    the first word.
    """
    kinds: dict[str, set[str]] = {}
    numeric: dict[str, bool] = {}
    for df in frames:
        for field in df.schema.fields:
            kinds.setdefault(field.name, set()).add(field.dataType.simpleString())
            numeric[field.name] = numeric.get(field.name, True) and isinstance(field.dataType, NumericType)
    clashing = {name for name, seen in kinds.items() if len(seen) > 1 and not numeric[name]}
    aligned = [
        df.withColumns({n: F.col(n).cast("string") for n in df.columns if n in clashing})
        for df in frames
    ]
    return union_by_name(aligned)
