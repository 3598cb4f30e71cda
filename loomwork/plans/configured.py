"""Jobs described by JSON: a list of activities, or one query over many sources."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.text import mask
from loomwork.operators.cleanse import TidyRules, keep_best, tidy
from loomwork.operators.columns import ColumnPlan, reshape
from loomwork.operators.evolve import union_by_name
from loomwork.sources.files import SourceSpec, load
from loomwork.sources.sinks import SinkSpec, save

_STEPS: dict[str, Callable[[DataFrame, Mapping], DataFrame]] = {
    "where": lambda df, a: df.where(a["condition"]),
    "select": lambda df, a: df.selectExpr(*a["columns"]),
    "keep_best": lambda df, a: keep_best(df, a["keys"], a["order"]),
    "tidy": lambda df, a: tidy(df, TidyRules(**a["rules"])),
    "reshape": lambda df, a: reshape(df, ColumnPlan(**a["plan"])),
    "mask": lambda df, a: mask(df, a["columns"]),
}


def run_activities(spark: SparkSession, text: str) -> DataFrame:
    """Run ``[{"activity": "read", ...}, ..., {"activity": "write", ...}]`` in order."""
    df = None
    for activity in json.loads(text):
        arguments = {k: v for k, v in activity.items() if k != "activity"}
        kind = activity["activity"]
        if kind == "read":
            df = load(spark, SourceSpec(**arguments))
        elif df is None:
            raise ValueError("the first activity must read")
        elif kind == "write":
            save(df, SinkSpec(**arguments))
        elif kind in _STEPS:
            df = _STEPS[kind](df, arguments)
        else:
            raise ValueError(f"unknown activity {kind!r}")
    return df


def query_sources(spark: SparkSession, text: str, name: str = "source_name") -> DataFrame:
    """One query over several sources, rows tagged with the source they came from.

    The specification holds ``select`` (expressions), ``where`` and ``sources``
    (name to read options).
    """
    spec = json.loads(text)
    parts = []
    for source, options in spec["sources"].items():
        df = load(spark, SourceSpec(**options))
        if spec.get("where"):
            df = df.where(spec["where"])
        parts.append(df.selectExpr(*spec["select"]).withColumn(name, F.lit(source)))
    return union_by_name(parts)
