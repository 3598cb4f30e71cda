"""The query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


class Tables:
    """Test tables by name: ``t.orders`` reads only when used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def portable(df: DataFrame, *nullable: str) -> DataFrame:
    """Dates as ISO text and the named nullable integers as doubles.

    Client libraries show these two kinds in different ways; in this form every
    client gives the same values.
    """
    dates = {f.name: F.col(f.name).cast("string") for f in df.schema.fields if f.dataType == DateType()}
    return df.withColumns({**dates, **{n: F.col(n).cast("double") for n in nullable}})


def query(sql: str | None = None) -> Callable:
    """Register a function under its own name with its equivalent DuckDB SQL."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if build.__name__ in REGISTRY:
            raise ValueError(f"query {build.__name__} registered twice")
        REGISTRY[build.__name__] = Query(build.__name__, build, sql)
        return build

    return register
