"""Functions callable from SQL text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from unicodedata import normalize

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loomwork.functions.text import AGE_EDGES, AGE_LABELS

# Combining marks that count as accents, characters a worker hands back at a time.
ACCENTS = re.compile("[\u0300-\u036f]")
PART_CHARS = 1 << 20


def register(spark: SparkSession) -> None:
    """Create session functions ``age_group`` and ``to_upper``.

    They are SQL functions, which Catalyst inlines into the plan, so no row
    leaves the JVM.
    """
    young, grown = AGE_EDGES
    low, middle, high = AGE_LABELS
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION age_group(age INT) RETURNS STRING
        RETURN CASE WHEN age IS NULL THEN NULL WHEN age < {young} THEN '{low}'
                    WHEN age <= {grown} THEN '{middle}' ELSE '{high}' END
    """)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION to_upper(value STRING) RETURNS STRING
        RETURN upper(value)
    """)


def unaccented() -> Callable[..., Column]:
    """Text without accents, which Spark has no expression for: Arrow batches, never single rows.

    A worker turns one text at a time into Python strings and hands results back in
    parts of about ``PART_CHARS``, so beside Spark's own batches its memory does not
    grow with rows a batch or their lengths; a single text is never cut. The inner
    function travels to the workers by value, so they need no copy of this package.
    """

    def plain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            part, size = [], 0
            for value in batch:
                text = value.as_py()
                if text is not None:
                    if not text.isascii():
                        text = normalize("NFC", ACCENTS.sub("", normalize("NFD", text)))
                    size += len(text)
                part.append(text)
                if size >= PART_CHARS:
                    yield pa.array(part, pa.string())
                    part, size = [], 0
            if part:
                yield pa.array(part, pa.string())

    return F.arrow_udf(plain, StringType())
