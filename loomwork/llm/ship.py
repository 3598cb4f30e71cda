"""Helpers shared by the operators: worker imports, batch functions, staged tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()

# Words are runs of bytes other than ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def importable(spark: SparkSession) -> None:
    """Make this package importable in Python workers.

    An installed package, or one on PYTHONPATH or in the working folder, already
    is; otherwise its sources are sent with the job.
    """
    root, context = PACKAGE.parent, spark.sparkContext
    known = [Path(p or ".").resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if root in known or Path.cwd() == root or "site-packages" in str(root):
        return
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="loomwork-sources-")) / "loomwork.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
    schema: str,
    max_bytes: int = 16 << 20,
) -> DataFrame:
    """``mapInArrow`` of a function of one batch, in slices of about ``max_bytes``.

    Slices bound the memory of a worker when some rows are very long; a single
    row is never cut.
    """
    importable(df.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, max_bytes):
                yield from function(part)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, max_bytes: int) -> Iterator[pa.RecordBatch]:
    if batch.num_rows <= 1 or batch.nbytes <= max_bytes:
        yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), max_bytes)
    yield from slices(batch.slice(half), max_bytes)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def words_of(text: Column) -> Column:
    """Words of a text as an array; null gives none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    none = F.array().cast("array<string>")
    return F.when(trimmed == "", none).otherwise(F.split(trimmed, WORD_GAP))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    An expression used inside a lambda is otherwise computed again for every
    element the lambda sees.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def piece(text: Column, most: int) -> Column:
    """A text, or of a longer one ``most`` characters from a place its hash decides."""
    long = F.char_length(text)
    start = F.pmod(F.xxhash64(text), F.greatest(long - most + 1, F.lit(1)).cast("bigint")) + 1
    return F.when(long <= most, text).otherwise(F.substr(text, start.cast("int"), F.lit(most)))


def bucket_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))
