"""Column types of many files, and reading files whose columns have drifted apart."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import DataType, DecimalType, DoubleType, StringType, StructField, StructType, TimestampType

from loomwork.tables.files import Store

# Types that hold all values of those before them.
_WIDTH = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"file:/(?!/)", path):
        path = "file://" + path[len("file:") :]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def file_schemas(spark: SparkSession, path: str, files_per_task: int = 64) -> DataFrame:
    """``file, rows, schema``: row count and schema (as JSON) of every Parquet file below a folder.

    Only footers are read, by tasks of ``files_per_task`` files each.
    """
    paths = [(f.path,) for f in Store(spark, path).files() if f.path.endswith(".parquet")]
    listed = spark.createDataFrame(paths, "file string").repartition(max(1, -(-len(paths) // files_per_task)), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                files, place = _opened(name)
                with files.open_input_file(place) as source:
                    footer = pq.ParquetFile(source)
                    schema = from_arrow_schema(footer.schema_arrow)
                    rows.append({"file": name, "rows": footer.metadata.num_rows, "schema": schema.json()})
            yield pa.RecordBatch.from_pylist(rows, schema=out)

    out = pa.schema([("file", pa.string()), ("rows", pa.int64()), ("schema", pa.string())])
    return listed.mapInArrow(run, "file string, rows bigint, schema string")


def type_census(schemas: DataFrame) -> DataFrame:
    """``column_name, type, files, rows``: one row per column and type that occurs.

    ``type`` is as in a schema's JSON, a plain name for plain types.
    """
    fields = F.from_json("schema", "fields array<struct<name:string,type:string>>")
    each = schemas.select("rows", F.inline(fields["fields"]))
    return each.groupBy(F.col("name").alias("column_name"), "type").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows")
    )


def widened(schemas: list[StructType]) -> StructType:
    """Columns of all schemas, in order of appearance, each of a type that holds all its types.

    Numbers widen, decimals and whole numbers meet in a decimal or a double, and
    types that have nothing in common become text.
    """
    found: dict[str, DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            old = found.get(field.name)
            found[field.name] = field.dataType if old is None else _wider(old, field.dataType)
    return StructType([StructField(n, t) for n, t in found.items()])


def _wider(a: DataType, b: DataType) -> DataType:
    names = [a.simpleString(), b.simpleString()]
    if names[0] == names[1]:
        return a
    if all(n in _WIDTH for n in names):
        best = max(names, key=_WIDTH.index)
        # A float does not hold every whole number of its width.
        best = "double" if best == "float" and {"int", "bigint"} & set(names) else best
        return next(t for t in (a, b) if t.simpleString() == best) if best in names else DoubleType()
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()
    if {"decimal"} == {n.split("(")[0] for n in names if n not in _WIDTH}:
        return DoubleType()
    if {*names} == {"date", "timestamp"}:
        return TimestampType()
    return StringType()


def load_drifted(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below a folder under their widened schema.

    Files of one schema are read together and cast; columns a file lacks are
    null.  There are as many reads as schemas, however many files.  Partition
    folders are not turned into columns.
    """
    kinds = file_schemas(spark, path).groupBy("schema").agg(F.sort_array(F.collect_list("file")).alias("files"))
    groups = sorted(kinds.collect(), key=lambda r: r.files[0])
    if not groups:
        raise ValueError(f"no Parquet files below {path}")
    schemas = [StructType.fromJson(json.loads(g.schema)) for g in groups]
    target = widened(schemas)

    def read(schema: StructType, files: list[str]) -> DataFrame:
        rows = spark.read.schema(schema).parquet(*files)
        present = {f.name: f.dataType.simpleString() for f in schema.fields}

        def column(field: StructField) -> Column:
            own = F.col(f"`{field.name}`") if field.name in present else F.lit(None)
            same = present.get(field.name) == field.dataType.simpleString()
            return own if same else own.cast(field.dataType).alias(field.name)

        return rows.select(*map(column, target.fields))

    return reduce(DataFrame.unionByName, [read(s, g.files) for s, g in zip(schemas, groups)])
