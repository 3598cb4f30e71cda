"""File sources described by a small specification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from loomwork.operators.cleanse import require_not_null
from loomwork.operators.columns import hashable_columns
from loomwork.session import stage

REJECT_COLUMN = "reject_data"


@dataclass(frozen=True)
class SourceSpec:
    """Where and how to read.

    A declared ``schema`` is the default way; ``infer`` costs an extra scan of
    the whole input and is opt-in.  ``mode`` is PERMISSIVE, DROPMALFORMED or
    FAILFAST.  ``rejects`` adds the text of malformed records as a column.
    """

    format: str
    path: str | Sequence[str]
    schema: StructType | str | None = None
    names: Sequence[str] = ()
    sep: str | None = None
    header: bool | None = None
    mode: str | None = None
    infer: bool = False
    rejects: bool = False
    recursive: bool = False
    name_pattern: str | None = None
    merge_schema: bool = False
    multiline: bool = False
    options: Mapping[str, str] = field(default_factory=dict)



def lines_below_headers(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of text files without the first of each file, whatever it says.

    A line further down that equals the header stays.  Spark knows which task
    holds the start of a file, so files are still split and nothing moves.
    Blank lines go, as they do in any delimited file, and a header is the first
    line that is not blank; lines hold no character 1.
    """
    whole = {"quote": "", "escape": "", "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    return load(spark, SourceSpec("csv", path, "value STRING", sep="\u0001", header=True, options=whole))


def load(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Read a source; lazy, apart from schema inference when asked for."""
    reader = spark.read.format(spec.format)
    schema = spec.schema
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if spec.rejects:
        if schema is None:
            raise ValueError("collecting rejects needs a declared schema")
        schema = StructType([*schema.fields, StructField(REJECT_COLUMN, StringType())])
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**_options(spec))
    paths = spec.path if isinstance(spec.path, str) else list(spec.path)
    df = reader.load(paths)
    if (spec.mode or "").upper() in ("DROPMALFORMED", "FAILFAST"):
        df = _judged_whole(df)
    return df.toDF(*spec.names) if spec.names else df


def _judged_whole(df: DataFrame) -> DataFrame:
    """Keep every column in the scan, so that a record is judged as a whole.

    Readers only parse the columns a query needs; a count or a narrow select
    would otherwise let through records that are malformed elsewhere.  The
    condition is always true, which the optimizer cannot tell.
    """
    return df.where(F.pmod(F.xxhash64(*hashable_columns(df)), F.lit(2)) < 2)


def _options(spec: SourceSpec) -> dict[str, str]:
    given: dict[str, object] = {
        "sep": spec.sep,
        "header": spec.header,
        "mode": spec.mode.upper() if spec.mode else None,
        "inferSchema": True if spec.infer else None,
        "columnNameOfCorruptRecord": REJECT_COLUMN if spec.rejects else None,
        "recursiveFileLookup": True if spec.recursive else None,
        "pathGlobFilter": spec.name_pattern,
        "mergeSchema": True if spec.merge_schema else None,
        "multiLine": True if spec.multiline else None,
    }
    options = {k: _text(v) for k, v in given.items() if v is not None}
    return {**options, **spec.options}


# Options that accept JSON written loosely.
LENIENT_JSON = {
    "allowUnquotedFieldNames": "true",
    "allowSingleQuotes": "true",
    "allowNumericLeadingZeros": "true",
    "dropFieldIfAllNull": "true",
}


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean rows and reject lines of a source loaded with ``rejects=True``.

    The input is parsed once, into a staged table that both results read.
    """
    parsed = stage(df, "parsed")
    clean = parsed.where(F.col(REJECT_COLUMN).isNull()).drop(REJECT_COLUMN)
    rejects = parsed.where(F.col(REJECT_COLUMN).isNotNull()).select(REJECT_COLUMN)
    return clean, rejects


def text_lines(spark: SparkSession, path: str | Sequence[str], whole: bool = False) -> DataFrame:
    """One row per line, or per file when ``whole`` is set."""
    return spark.read.text(path if isinstance(path, str) else list(path), wholetext=whole)


def query_files(spark: SparkSession, fmt: str, path: str, columns: str = "*") -> DataFrame:
    """SQL straight on files, no table needed."""
    return spark.sql(f"select {columns} from {fmt}.`{path}`")


def impose_schema(df: DataFrame, schema: StructType | str, required: Sequence[str] = ()) -> DataFrame:
    """Cast to a declared schema and fail on nulls in required columns."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    shaped = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in declared.fields])
    return require_not_null(shaped, required) if required else shaped


def _text(value: object) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)
