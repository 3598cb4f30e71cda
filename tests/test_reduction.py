"""Semi-join reduction, observed counts, timed streams."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from loomwork.operators.bloom import BITS_PER_KEY, bloom_of, matched_reduced, reduced
from loomwork.plans.audit import Audit
from loomwork.streaming.progress import ProgressLog, run_until_idle
from loomwork.streaming.sinks import to_files


def test_filter_drops_most_rows_and_never_a_match(spark):
    fact = spark.range(50_000).selectExpr("id % 20000 AS k", "CAST(id % 7 AS STRING) AS s", "id AS v")
    few = spark.range(0, 20_000, 40).selectExpr("id AS k", "CAST(id % 7 AS STRING) AS s")
    left = reduced(fact, few, ["k"])
    exact = fact.join(few.select("k"), "k", "left_semi")
    kept, true = left.count(), exact.count()
    assert true <= kept <= 1.1 * true + 0.02 * 50_000
    pairs = matched_reduced(fact, few, ["k", "s"])
    assert sorted(map(tuple, pairs.collect())) == sorted(map(tuple, fact.join(few, ["k", "s"], "left_semi").select("k", "s", "v").collect()))


def test_filter_works_before_the_shuffle(spark, tmp_path):
    spark.range(1000).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = matched_reduced(fact, spark.range(10).toDF("k"), ["k"])
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.index("LeftSemi") < plan.index("Exchange hashpartitioning(k") < plan.index("getbit") < plan.index("Scan")


def test_null_keys_bounds_and_empty_lookups(spark):
    fact = spark.createDataFrame([(None,), (1,), (2,)], "k bigint")
    lookup = spark.createDataFrame([(None,), (2,)], "k bigint")
    found = bloom_of(lookup, ["k"])
    assert {r.k for r in fact.where(found.may_hold(F.col("k"))).collect()} >= {None, 2}
    assert [r.k for r in matched_reduced(fact, lookup, ["k"]).collect()] == [2]
    assert matched_reduced(fact, lookup.limit(0), ["k"]).collect() == []
    assert bloom_of(lookup, ["k"], expected=10**9) is None
    assert bloom_of(lookup, ["k"], expected=64_000).size == 64_000 * BITS_PER_KEY // 64
    # Too many keys for the bound: no filter, the same result.
    assert matched_reduced(fact, lookup, ["k"], max_bytes=8).count() == 1
    with pytest.raises(ValueError):
        reduced(fact, lookup.select(F.col("k").cast("int").alias("k")), ["k"])


def test_counts_come_from_the_write_itself(spark, tmp_path):
    audit = Audit(spark, str(tmp_path / "audit"), "r1")
    context = spark.sparkContext
    context.setJobGroup("counted", "counted")
    bad = F.col("id") % 10 == 0
    with audit.stage("s") as counts:
        rows = counts.watch(spark.range(0, 1000, 1, 4), "rows_in", rejected=bad)
        counts.watch(rows.where(~bad), "rows_out").write.parquet(str(tmp_path / "out"))
        jobs = len(context.statusTracker().getJobIdsForGroup("counted"))
    context.setJobGroup("plain", "plain")
    spark.range(0, 1000, 1, 4).where(~bad).write.parquet(str(tmp_path / "plain"))
    assert jobs == len(context.statusTracker().getJobIdsForGroup("plain")) == 1
    context.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(AnalysisException):
        with audit.stage("broken") as counts:
            counts.watch(spark.range(5), "rows_in").select("nothing").write.parquet(str(tmp_path / "no"))
    found = {r.stage: (r.status, r.rows_in, r.rows_out, r.rows_rejected) for r in audit.entries().collect()}
    assert found == {"s": ("succeeded", 1000, 900, 100), "broken": ("failed", None, None, None)}


def test_entries_of_older_runs_have_no_counts(spark, tmp_path):
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "a.json").write_text('{"run_id": "r", "stage": "s", "status": "succeeded"}\n')
    row = Audit(spark, str(tmp_path / "old")).entries().first()
    assert row.stage == "s" and row.rows_in is None


def _source(spark, folder, parts):
    for k in range(parts):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").json(folder)
    return spark.readStream.schema("id BIGINT").option("maxFilesPerTrigger", 1).json(folder)


def test_timed_stream_stops_when_idle(spark, tmp_path):
    stream = _source(spark, str(tmp_path / "in"), 3)
    log = ProgressLog(spark, str(tmp_path / "log"), ["timed"])
    spark.streams.addListener(log)
    try:
        query = to_files(stream, "parquet", str(tmp_path / "out"), str(tmp_path / "ck"), "100 milliseconds", name="timed")
        run_until_idle(query, log, 2.0, most_seconds=90)
    finally:
        spark.streams.removeListener(log)
    assert not query.isActive
    entries = log.entries().collect()
    assert sum(r.input_rows for r in entries) == 30
    assert sorted(r.batch_id for r in entries if r.input_rows) == [0, 1, 2]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 30


def test_timed_stream_that_fails_raises(spark, tmp_path):
    stream = _source(spark, str(tmp_path / "in"), 1).select(F.raise_error(F.lit("bad row")).cast("string").alias("x"))
    log = ProgressLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    try:
        query = to_files(stream, "parquet", str(tmp_path / "out"), str(tmp_path / "ck"), "100 milliseconds", name="failing")
        with pytest.raises(Exception, match="bad row"):
            run_until_idle(query, log, 30.0, most_seconds=90)
    finally:
        spark.streams.removeListener(log)
