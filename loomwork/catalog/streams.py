"""Streams run to completion over the tables, compared with the batch result.

Each table is written below the shared scratch folder as the files a stream
would find, consumed with an available-now trigger, and the sink is read back.
"""

from pyspark.sql import functions as F

from loomwork.catalog.registry import portable, query
from loomwork.operators.text import split_columns
from loomwork.session import scratch_path
from loomwork.sources.files import SourceSpec, load
from loomwork.sources.sinks import SinkSpec, save
from loomwork.streaming.readers import read_files, read_lines
from loomwork.streaming.progress import ProgressLog, run_until_idle
from loomwork.streaming.sinks import latest, to_files, to_keyed
from loomwork.streaming.transforms import decode_json, sql_over, with_load_date, with_total

_RUN_DATE = "2024-06-01"


def _arrivals(t, df, fmt, label, **options):
    path = scratch_path(t.spark, label)
    save(df.repartition(t.spark.sparkContext.defaultParallelism), SinkSpec(fmt, path, options=options))
    return path


def _some(t):
    """Files per batch that make a few batches, whatever the size of the cluster."""
    return max(1, t.spark.sparkContext.defaultParallelism // 2)


def _landed(t, stream, schema, fmt="parquet"):
    out, checkpoint = scratch_path(t.spark, "stream-out"), scratch_path(t.spark, "stream-ck")
    to_files(stream, fmt, out, checkpoint).awaitTermination()
    return load(t.spark, SourceSpec(fmt, out, schema))


@query(f"""
    SELECT event_id, user_id, value, event_id + user_id AS total, '{_RUN_DATE}' AS current_dt
    FROM events
""")
def stream_enrich(t):
    source = _arrivals(t, t.events.select("event_id", "user_id", "value"), "csv", "stream-csv", sep="|")
    stream = read_files(
        t.spark, "csv", source, "event_id BIGINT, user_id BIGINT, value DOUBLE", max_files=_some(t), sep="|"
    )
    made = with_load_date(with_total(stream, ["event_id", "user_id"]), run_date=_RUN_DATE)
    schema = "event_id BIGINT, user_id BIGINT, value DOUBLE, total BIGINT, current_dt DATE"
    return portable(_landed(t, made, schema))


@query("SELECT event_id, upper(event_type) AS kind FROM events WHERE value > 10")
def stream_filter(t):
    source = _arrivals(t, t.events.select("event_id", "event_type", "value"), "json", "stream-json")
    stream = read_files(
        t.spark, "json", source, "event_id BIGINT, event_type STRING, value DOUBLE", max_files=_some(t)
    )
    made = sql_over(
        stream,
        "loomwork_stream",
        "SELECT event_id, upper(event_type) AS kind FROM loomwork_stream WHERE value > 10",
    )
    return _landed(t, made, "event_id BIGINT, kind STRING")


@query("""
    SELECT event_id, user_id, CAST(CASE WHEN event_type <> 'error' THEN event_id % 100 END AS DOUBLE) AS mark
    FROM events
""")
def stream_lines(t):
    """Delimited lines split and typed in flight; a bad number gives null."""
    mark = F.when(F.col("event_type") == "error", "bad").otherwise((F.col("event_id") % 100).cast("string"))
    line = F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"), mark)
    source = _arrivals(t, t.events.select(line.alias("value")), "text", "stream-text")
    names = [("event_id", "bigint"), ("user_id", "bigint"), ("mark", "bigint")]
    made = split_columns(read_lines(t.spark, source, max_files=_some(t)), "value", ",", names)
    return portable(_landed(t, made, "event_id BIGINT, user_id BIGINT, mark BIGINT"), "mark")


@query("SELECT event_id, upper(event_type) AS event_type, value FROM events")
def stream_envelope(t):
    """Message records with a binary JSON body; fields outside the schema are ignored."""
    body = F.to_json(F.struct("event_id", "event_type", "value", F.col("props").alias("browser")))
    records = t.events.select(body.cast("binary").alias("value"))
    source = _arrivals(t, records, "parquet", "stream-envelope")
    stream = read_files(t.spark, "parquet", source, "value BINARY", max_files=_some(t))
    schema = "event_id BIGINT, event_type STRING, value DOUBLE"
    made = decode_json(stream, schema, ["event_id", "event_type", "value"])
    return _landed(t, made.withColumn("event_type", F.upper("event_type")), schema)


@query("SELECT event_id, user_id, event_id * 2 AS total FROM events")
def stream_restarted(t):
    """A stream stopped and started again takes up only what arrived meanwhile."""
    columns = "event_id BIGINT, user_id BIGINT"
    out, checkpoint = scratch_path(t.spark, "restart-out"), scratch_path(t.spark, "restart-ck")
    source = scratch_path(t.spark, "restart-in")
    rows = t.events.select("event_id", "user_id")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        save(rows.where(part), SinkSpec("json", source, mode="append"))
        stream = read_files(t.spark, "json", source, columns)
        to_files(stream.withColumn("total", F.col("event_id") * 2), "parquet", out, checkpoint).awaitTermination()
    return load(t.spark, SourceSpec("parquet", out, f"{columns}, total BIGINT"))


@query("SELECT event_id, user_id, event_id + user_id AS total FROM events")
def stream_csv_to_json(t):
    source = _arrivals(t, t.events.select("event_id", "user_id"), "csv", "stream-convert")
    stream = read_files(t.spark, "csv", source, "event_id BIGINT, user_id BIGINT", max_files=_some(t))
    made = with_total(stream, ["event_id", "user_id"])
    return _landed(t, made, "event_id BIGINT, user_id BIGINT, total BIGINT", fmt="json")


@query("""
    SELECT user_id, event_id, event_type, ts FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
    WHERE n = 1
""")
def stream_latest_by_key(t):
    """A change feed landed as one current row per key."""
    schema = "user_id BIGINT, event_id BIGINT, event_type STRING, ts TIMESTAMP_NTZ"
    changes = t.events.select("user_id", "event_id", "event_type", "ts")
    source = _arrivals(t, changes, "parquet", "stream-changes")
    stream = read_files(t.spark, "parquet", source, schema, max_files=_some(t))
    out, checkpoint = scratch_path(t.spark, "keyed"), scratch_path(t.spark, "keyed-ck")
    order = ["-ts", "-event_id"]
    to_keyed(stream, out, ["user_id"], order, checkpoint).awaitTermination()
    return latest(t.spark, out, ["user_id"], order)


@query("""
    SELECT event_type AS kind, count(*) AS n, (SELECT count(*) FROM events) AS input_rows FROM events GROUP BY 1
""")
def stream_timed(t):
    """On a clock until idle; the recorded progress accounts for every row taken in."""
    source = _arrivals(t, t.events.select("event_id", "event_type"), "json", "timed-in")
    out, checkpoint, told = (scratch_path(t.spark, f"timed-{x}") for x in ("out", "ck", "log"))
    stream = read_files(t.spark, "json", source, "event_id BIGINT, event_type STRING", max_files=_some(t))
    name = "timed_" + out.rsplit("-", 1)[-1]
    log = ProgressLog(t.spark, told, [name])
    t.spark.streams.addListener(log)
    try:
        run_until_idle(to_files(stream, "parquet", out, checkpoint, every="100 milliseconds", name=name), log, 3.0)
    finally:
        t.spark.streams.removeListener(log)
    taken = log.entries().agg(F.sum("input_rows").alias("input_rows"))
    rows = load(t.spark, SourceSpec("parquet", out, "event_id BIGINT, event_type STRING"))
    return rows.groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("n")).withColumn(
        "input_rows", taken.scalar()
    )
