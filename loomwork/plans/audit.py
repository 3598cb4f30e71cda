"""Run audit: one row per stage, on success and on failure."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "run_id STRING, stage STRING, status STRING, started TIMESTAMP, ended TIMESTAMP, error STRING, "
    "rows_in BIGINT, rows_out BIGINT, rows_rejected BIGINT"
)


class Counts:
    """Row counts of a stage, taken while its frames are written and by no other pass.

    A frame that is watched must be written, or otherwise run, inside the stage.
    """

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def watch(
        self, df: DataFrame, rows: str | None = None, rejected: Column | None = None
    ) -> DataFrame:
        """The same frame; counts its rows as ``rows`` (``rows_in`` or ``rows_out``), and its rejected ones.

        Several frames of a stage may be watched under one name; they add up.
        """
        measures = []
        if rows is not None:
            if rows not in ("rows_in", "rows_out"):
                raise ValueError("rows are rows_in or rows_out")
            measures.append(F.count(F.lit(1)).alias(rows))
        if rejected is not None:
            measures.append(F.count_if(rejected).alias("rows_rejected"))
        seen = Observation()
        self._seen.append(seen)
        return df.observe(seen, *measures)

    def totals(self) -> dict[str, int]:
        found: dict[str, int] = {}
        for seen in self._seen:
            for name, n in seen.get.items():
                found[name] = found.get(name, 0) + n
        return found


class Audit:
    """Appends audit rows to a folder that later runs add to."""

    def __init__(self, spark: SparkSession, path: str, run_id: str | None = None):
        self.spark = spark
        self.path = path
        self.run_id = run_id or uuid.uuid4().hex

    @contextmanager
    def stage(self, name: str) -> Iterator[Counts]:
        """An entry for what the block does; the counts it yields watch frames for it.

        A stage that fails has no counts: its frames may not have run.
        """
        started, counts = datetime.now(timezone.utc), Counts()
        try:
            yield counts
        except Exception as error:
            self._write(name, "failed", started, f"{type(error).__name__}: {error}")
            raise
        self._write(name, "succeeded", started, None, counts.totals())

    def entries(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).json(self.path)

    def _write(
        self, name: str, status: str, started: datetime, error: str | None, counts: dict[str, int] | None = None
    ) -> None:
        numbers = [(counts or {}).get(c) for c in ("rows_in", "rows_out", "rows_rejected")]
        row = (self.run_id, name, status, started, datetime.now(timezone.utc), error, *numbers)
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").json(self.path)
