"""A table of current rows by key, fed by changes.

Rows live in hash buckets of the key.  A commit adds files to the buckets its
changes fall in and appends one entry to a list of commits; nothing is
rewritten.  Readers see the files that the list names, so a write that failed
half way is invisible and a batch that is replayed is skipped.  Compaction
rewrites just the buckets that have grown a tail of changes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from loomwork.operators.windows import top_per_key
from loomwork.streaming.sinks import trigger
from loomwork.tables.files import Store

COMMITS = "_commits"
# Columns beside the table's own in its files.
VERSION, GONE = "_version", "_gone"


class ConflictError(RuntimeError):
    """Another writer has committed the same version first."""


@dataclass(frozen=True)
class Snapshot:
    """What the commit list says: files by bucket in commit order, and batches already taken."""

    version: int
    files: dict[int, list[str]]
    batches: frozenset[str]


class KeyedTable:
    """Insert, update and delete by key; read the current rows.

    ``order`` says which of several changes of a key wins (``-`` for
    descending, as ``top_per_key``); among equals the later commit does.
    Null keys are keys like any other.  ``buckets`` is fixed when the table is
    made: about the bytes of the table over 256 MB.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.store = Store(spark, path)
        told = json.loads(self.store.read("_table.json"))
        self.keys: list[str] = told["keys"]
        self.order: list[str] = told["order"]
        self.buckets: int = told["buckets"]
        self.schema = StructType.fromJson(told["schema"])

    @staticmethod
    def make(
        spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str], buckets: int
    ) -> "KeyedTable":
        """Make an empty table; one that is there already must have been made alike."""
        told = {"keys": list(keys), "order": list(order), "buckets": buckets, "schema": json.loads(schema.json())}
        taken = {VERSION, GONE, "_bucket"} & set(schema.names)
        if taken or not keys or buckets < 1:
            raise ValueError(f"a table needs keys and buckets, and may not name columns {sorted(taken)}")
        store = Store(spark, path)
        if not store.create("_table.json", json.dumps(told)) and json.loads(store.read("_table.json")) != told:
            raise ValueError(f"another keyed table is at {path}")
        return KeyedTable(spark, path)

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The table after commit ``version``, or now."""
        files: dict[int, list[str]] = {}
        batches, last = set(), 0
        for name in self.store.names(COMMITS):
            if name.startswith(".") or (version is not None and int(name.split(".")[0]) > version):
                continue
            entry = json.loads(self.store.read(f"{COMMITS}/{name}"))
            last = entry["version"]
            batches.update([entry["batch"]] if entry["batch"] is not None else [])
            for bucket, dropped in entry["removed"].items():
                left = [f for f in files[int(bucket)] if f not in set(dropped)]
                files[int(bucket)] = left
            for bucket, added in entry["added"].items():
                # A compacted file holds what is older than changes that came meanwhile.
                present = files.get(int(bucket), [])
                files[int(bucket)] = [*added, *present] if entry["removed"] else [*present, *added]
        return Snapshot(last, {b: f for b, f in files.items() if f}, frozenset(batches))

    def commit(self, changes: DataFrame, batch: str | None = None, deleted: str | None = None) -> int:
        """Add changes; rows for which the column ``deleted`` is true remove their key.

        ``batch`` names the changes: a name that has been committed is skipped.
        Returns the table's version afterwards.  Several changes of a key are
        reduced to the winning one before they are shuffled.
        """
        now = self.snapshot()
        if batch is not None and batch in now.batches:
            return now.version
        gone = F.lit(False) if deleted is None else F.coalesce(F.col(deleted).cast("boolean"), F.lit(False))
        version = now.version + 1
        rows = changes.select(*[F.col(f"`{c}`") for c in self.schema.names], gone.alias(GONE))
        rows = top_per_key(rows, self.keys, [*self.order, GONE]).withColumn(VERSION, F.lit(version).cast("bigint"))
        return self._append(rows, version, batch, {})

    def _append(self, rows: DataFrame, version: int, batch: str | None, removed: dict[int, list[str]]) -> int:
        folder = f"data/{version:09d}-{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        # One task, and so one file, per bucket that has changes.
        dealt = rows.withColumn("_bucket", bucket).repartition(self.buckets, "_bucket")
        dealt.write.partitionBy("_bucket").parquet(f"{self.store.path}/{folder}")
        added: dict[str, list[str]] = {}
        for file in self._files(folder):
            part = next(p for p in file.split("/") if p.startswith("_bucket="))
            added.setdefault(part.removeprefix("_bucket="), []).append(file)
        entry = {
            "version": version,
            "batch": batch,
            "added": added,
            "removed": {str(b): f for b, f in removed.items()},
        }
        if not self.store.create(f"{COMMITS}/{version:09d}.json", json.dumps(entry)):
            self.store.delete(folder)
            raise ConflictError(f"version {version} of {self.store.path} was committed by another writer")
        return version

    def _files(self, folder: str) -> list[str]:
        """Files of a commit, relative to the table."""
        found = []
        for bucket in self.store.names(folder):
            if bucket.startswith("_bucket="):
                names = [n for n in self.store.names(f"{folder}/{bucket}") if n.endswith(".parquet")]
                found += [f"{folder}/{bucket}/{n}" for n in names if not n.startswith(("_", "."))]
        return found

    def _rows(self, files: Sequence[str]) -> DataFrame:
        own = [StructField(GONE, BooleanType()), StructField(VERSION, LongType())]
        schema = StructType([*self.schema.fields, *own])
        paths = [f"{self.store.path}/{f}" for f in files]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _current(self, files: Sequence[str]) -> DataFrame:
        return top_per_key(self._rows(files), self.keys, [*self.order, f"-{VERSION}"])

    def read(self, version: int | None = None) -> DataFrame:
        """Current rows, or those of an earlier version that compaction has not removed.

        A bucket of one file holds each key once and is read as it is; only
        buckets with a tail of changes are ranked.
        """
        found = self.snapshot(version).files.values()
        single = [f for files in found if len(files) == 1 for f in files]
        several = [f for files in found if len(files) > 1 for f in files]
        rows = self._rows(single)
        if several:
            rows = rows.unionByName(self._current(several)) if single else self._current(several)
        return rows.where(~F.col(GONE)).select(*[F.col(f"`{c}`") for c in self.schema.names])

    def compact(self, tail: int = 1) -> int:
        """Rewrite buckets of more than ``tail`` files into one file each; delete markers go.

        Other buckets are not touched.  The files replaced stay on disk for
        readers that still use them, until ``expire``.
        """
        now = self.snapshot()
        touched = {b: f for b, f in now.files.items() if len(f) > tail}
        if not touched:
            return now.version
        rows = self._current([f for files in touched.values() for f in files]).where(~F.col(GONE))
        return self._append(rows, now.version + 1, None, touched)

    def expire(self) -> list[str]:
        """Delete files that the current version does not name; only while nobody writes."""
        named = {f for files in self.snapshot().files.values() for f in files}
        gone = []
        for folder in self.store.names("data"):
            files = self._files(f"data/{folder}")
            gone += [f for f in files if f not in named]
        for file in gone:
            self.store.delete(file)
        return gone


def to_keyed_table(
    df: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    stream: str,
    deleted: str | None = None,
    every: str | None = None,
    tail: int = 8,
) -> StreamingQuery:
    """Feed a keyed table from a stream of changes, exactly once per batch.

    ``stream`` names the feed in the commit list, so that a batch replayed after
    a failure is skipped.  Buckets are compacted once more than ``tail`` files
    have gathered.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.commit(batch, f"{stream}/{batch_id}", deleted)
        table.compact(tail)

    writer = df.writeStream.foreachBatch(write).queryName(stream).trigger(**trigger(every))
    return writer.option("checkpointLocation", checkpoint).start()
