"""Column layout: select, add, rename, drop, replace."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


@dataclass(frozen=True)
class ColumnPlan:
    """How to bring a table into its standard column layout, in this order."""

    keep: Sequence[str] = ()
    constants: Mapping[str, object] = field(default_factory=dict)
    replace: Mapping[str, str] = field(default_factory=dict)
    rename: Mapping[str, str] = field(default_factory=dict)
    drop: Sequence[str] = ()


def reshape(df: DataFrame, plan: ColumnPlan) -> DataFrame:
    """Apply a column plan; the steps collapse into one projection."""
    if plan.keep:
        df = df.select(*plan.keep)
    if plan.constants:
        df = df.withColumns({n: F.lit(v) for n, v in plan.constants.items()})
    for target, source in plan.replace.items():
        df = replace_column(df, target, source)
    if plan.rename:
        df = rename_columns(df, plan.rename)
    return df.drop(*plan.drop) if plan.drop else df


def replace_column(df: DataFrame, target: str, source: str) -> DataFrame:
    """Give ``target`` the values of ``source`` and drop ``source``."""
    return df.withColumn(target, F.col(source)).drop(source)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename in place, refusing a name that another column already has."""
    kept = set(df.columns) - set(names)
    clash = kept & set(names.values())
    if clash:
        raise ValueError(f"names already taken: {sorted(clash)}; use replace_column")
    return df.withColumnsRenamed(dict(names))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast some columns; text that does not parse becomes null."""
    return df.withColumns({n: F.col(n).try_cast(t) for n, t in types.items()})


def shared_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Column names both frames have, in the order of the first."""
    names = set(b.columns)
    return [c for c in a.columns if c in names]


def hashable_columns(df: DataFrame) -> list[str]:
    """Columns Spark can hash: all but those holding maps or variants."""

    def hashable(kind: DataType) -> bool:
        if isinstance(kind, (MapType, VariantType)):
            return False
        if isinstance(kind, ArrayType):
            return hashable(kind.elementType)
        if isinstance(kind, StructType):
            return all(hashable(f.dataType) for f in kind.fields)
        return True

    return [f.name for f in df.schema.fields if hashable(f.dataType)]
