"""Streams over small files: decoding, sinks, restarts and replays."""

import json

import pytest
from pyspark.sql import functions as F

from loomwork.operators.text import split_columns
from loomwork.sources.schemas import BOOKS, CLICKS, MARKS
from loomwork.streaming.readers import kafka_options, read_files, read_lines
from loomwork.streaming.sinks import (
    compact,
    index_options,
    latest,
    to_console,
    to_files,
    to_keyed,
    trigger,
)
from loomwork.streaming.transforms import decode_json, sql_over, with_load_date, with_total

CLICK_FIELDS = ["id", "custid", "visit_secs", "http_verb", "short_url", "upddt", "updts"]


def to_memory(df, name):
    """A sink on the driver, for tests only."""
    return df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()


def click(key, **more):
    row = {
        "id": key, "custid": 31, "ip": "203.0.113.9", "updts": "2031-04-02 11:22:33.0", "year": 2031,
        "visit_secs": 12, "http_verb": "put", "short_url": "/looms", "long_url": "/looms/9",
        "browser": "unknown to the schema", "status_cd": 204, "upddt": "2031-04-02",
    }
    return json.dumps({**row, **more})


def write_marks(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_options():
    assert kafka_options("b1:1,b2:1", "clicks", "g") == {
        "kafka.bootstrap.servers": "b1:1,b2:1", "subscribe": "clicks", "kafka.group.id": "g",
    }
    assert index_options("idx/doc", "id", {"es.nodes": "n"}) == {
        "es.resource": "idx/doc", "es.mapping.id": "id", "es.nodes": "n",
    }
    assert trigger("30 seconds") == {"processingTime": "30 seconds"}
    assert trigger(None) == {"availableNow": True}


def test_envelope_decoding(spark):
    without_time = json.loads(click(2))
    without_time.pop("updts")
    without_time["moment"] = "Thursday noon"
    bodies = [click(1), json.dumps(without_time), "not json"]
    df = spark.createDataFrame([(b.encode(),) for b in bodies], "value BINARY")
    rows = decode_json(df, CLICKS, CLICK_FIELDS).collect()
    assert [r.id for r in rows] == [1, 2, None]
    assert rows[0].updts is not None and rows[1].updts is None
    shaped = sql_over(
        decode_json(df, CLICKS, CLICK_FIELDS), "clicks_view",
        "SELECT id, upper(short_url) AS url, upper(http_verb) AS verb FROM clicks_view WHERE id = 1",
    )
    assert tuple(shaped.first()) == (1, "/LOOMS", "PUT")


def test_csv_stream_to_json_files_and_restart(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/ck"
    write_marks(source, "a.csv", ["1|Ida|31|45|52", "2|Kai|64|17|8"])
    write_marks(source, "b.csv", ["3|Ute|12|none|40"])

    def run():
        stream = read_files(spark, "csv", str(source), MARKS, max_files=1, sep="|")
        made = with_load_date(with_total(stream, ["m1", "m2", "m3"], "total"), run_date="2024-01-01")
        to_files(made, "json", out, checkpoint, files=1).awaitTermination()
        return {r.studid: r.total for r in spark.read.json(out).collect()}

    assert run() == {1: 128, 2: 89, 3: None}
    assert run() == {1: 128, 2: 89, 3: None}
    write_marks(source, "c.csv", ["4|Bo|1|2|3"])
    assert run() == {1: 128, 2: 89, 3: None, 4: 6}
    assert spark.read.json(out).count() == 4


def test_lines_and_memory_sink(spark, tmp_path):
    write_marks(tmp_path / "lines", "a.txt", ["1,Ida,31,45,52", "5,Leo,80,x"])
    names = [("id", "int"), ("name", "string"), ("m1", "int"), ("m2", "int"), ("m3", "int")]
    made = with_total(split_columns(read_lines(spark, f"{tmp_path}/lines"), "value", ",", names), ["m1", "m2", "m3"])
    to_memory(made, "marks_seen").awaitTermination()
    assert {r.id: r.total for r in spark.table("marks_seen").collect()} == {1: 128, 5: None}


def test_json_stream_filter_matches_batch(spark, tmp_path):
    books = tmp_path / "books"
    books.mkdir()
    for i, year in enumerate([2010, 2015, 2016, 2020]):
        (books / f"{i}.json").write_text(json.dumps({"title": f"t{i}", "year_written": year, "price": "1"}))
    text = "SELECT title FROM books_view WHERE year_written > 2015"
    stream = sql_over(read_files(spark, "json", str(books), BOOKS, max_files=2), "books_view", text)
    to_memory(stream, "books_seen").awaitTermination()
    batch = sql_over(spark.read.schema(BOOKS).json(str(books)), "books_view", text)
    assert sorted(spark.table("books_seen").collect()) == sorted(batch.collect())
    assert spark.table("books_seen").count() == 2


def test_console_sink_runs(spark, tmp_path):
    write_marks(tmp_path / "console", "a.txt", ["one"])
    query = to_console(read_lines(spark, f"{tmp_path}/console"))
    query.awaitTermination()
    assert query.exception() is None


@pytest.fixture()
def feed(spark, tmp_path):
    source = tmp_path / "feed"
    source.mkdir()
    (source / "a.json").write_text("\n".join([click(1), click(2), click(1, visit_secs=50, updts="2031-04-03 00:00:00")]))
    (source / "b.json").write_text("\n".join([click(2, visit_secs=1, updts="2031-01-01 00:00:00"), click(3)]))
    return source


def test_keyed_sink_keeps_the_latest_row(spark, tmp_path, feed):
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/ck"

    def run():
        changes = read_files(spark, "json", str(feed), CLICKS, max_files=1)
        to_keyed(changes.select(*CLICK_FIELDS), out, ["id"], ["-updts"], checkpoint).awaitTermination()
        return {r.id: r.visit_secs for r in latest(spark, out, ["id"], ["-updts"]).collect()}

    assert run() == {1: 50, 2: 12, 3: 12}
    (feed / "c.json").write_text(click(3, visit_secs=7, updts="2032-01-01 00:00:00"))
    assert run() == {1: 50, 2: 12, 3: 7}
    compact(spark, out, ["id"], ["-updts"], f"{tmp_path}/compacted")
    again = latest(spark, f"{tmp_path}/compacted", ["id"], ["-updts"])
    assert {r.id: r.visit_secs for r in again.collect()} == {1: 50, 2: 12, 3: 7}
    assert spark.read.parquet(f"{tmp_path}/compacted").count() == 3


def test_keyed_sink_replays_without_duplicates(spark, tmp_path, feed):
    """A batch whose commit was lost is written again over itself."""
    out, checkpoint = f"{tmp_path}/out", tmp_path / "ck"

    def run():
        changes = read_files(spark, "json", str(feed), CLICKS)
        to_keyed(changes.select(*CLICK_FIELDS), out, ["id"], ["-updts"], str(checkpoint)).awaitTermination()
        return spark.read.parquet(out).groupBy("id").count().where(F.col("count") > 1).count()

    assert run() == 0
    (checkpoint / "commits" / "0").unlink()
    for crc in (checkpoint / "commits").glob(".0.crc"):
        crc.unlink()
    assert run() == 0
    assert latest(spark, out, ["id"], ["-updts"]).count() == 3
