"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes shuffles and splits skewed join partitions from run
# time statistics, so partition counts are not tuned by hand anywhere else.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_local_dirs: dict[str, str] = {}
_scopes: list[list[str]] = []


def build_session(
    app_name: str,
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or reuse) a session; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used, which is only right in
    local mode, where driver and executors are one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="loomwork-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path under the shared folder."""
    path = f"{shared_dir(spark)}/loomwork/{label}-{uuid.uuid4().hex}"
    for made in _scopes:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what the block stages below the shared folder when it ends.

    Frames built on staged data must be written or read inside the block.
    Tables whose files lie in that folder, or that are named after a path in it,
    are dropped.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in made:
            spark.sql(f"DROP TABLE IF EXISTS {table_of(path)}")
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(hadoop).delete(place, True)


def table_of(path: str) -> str:
    """Name of the scratch table that goes with a scratch path."""
    return "loomwork_" + path.rsplit("-", 1)[-1]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors, keeps the
    data columnar, and pins values such as row positions that a recomputation
    could assign differently.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
