"""Readers and writers on small dirty files."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from loomwork.operators.cleanse import require_not_null
from loomwork.operators.evolve import combine, union_by_name, union_padded
from loomwork.operators.quality import schema_diff, tried
from loomwork.sources.files import (
    LENIENT_JSON,
    SourceSpec,
    impose_schema,
    lines_below_headers,
    load,
    query_files,
    split_rejects,
    text_lines,
)
from loomwork.sources.jdbc import (
    Connection,
    Slices,
    connection_from_file,
    read_options,
    write_options,
)
from loomwork.sources.schemas import CUSTOMERS
from loomwork.sources.sinks import SinkSpec, append_by_position, migrate, rebuild_external, save

DIRTY = "\n".join(
    [
        "1,Ann,Lee,30,Pilot",
        "1,Ann,Lee,41,Pilot",
        "2,Bob,,12,Therapist",
        "two,Cy,Ray,50,Writer",
        "3,Dee",
        ",Eve,Fox,20,Pilot",
        "trailer record",
    ]
)


@pytest.fixture()
def dirty(tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(DIRTY + "\n")
    return str(path)


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_untyped_columns_are_text(spark, dirty):
    df = load(spark, SourceSpec("csv", dirty))
    assert df.columns == ["_c0", "_c1", "_c2", "_c3", "_c4"]
    assert {t for _, t in df.dtypes} == {"string"}


def test_inference_degrades_to_text_on_one_bad_value(spark, dirty):
    df = load(spark, SourceSpec("csv", dirty, infer=True))
    assert dict(df.dtypes)["_c0"] == "string"


def test_malformed_records_are_dropped_whatever_is_selected(spark, dirty):
    df = load(spark, SourceSpec("csv", dirty, CUSTOMERS, mode="dropmalformed"))
    assert df.count() == 4
    assert len(df.collect()) == 4
    assert df.select("custfname").count() == 4
    assert sorted(r[0] for r in df.select("custfname").collect()) == ["Ann", "Ann", "Bob", "Eve"]


def test_failfast_fails_even_on_a_count(spark, dirty):
    df = load(spark, SourceSpec("csv", dirty, CUSTOMERS, mode="failfast"))
    with pytest.raises(Exception, match="MALFORMED"):
        df.select("custfname").count()


def test_rejects_are_kept_as_lines(spark, dirty, tmp_path):
    clean, rejects = split_rejects(load(spark, SourceSpec("csv", dirty, CUSTOMERS, rejects=True)))
    assert clean.count() == 4
    assert rejects.count() == 3
    assert sorted(r[0] for r in rejects.collect()) == ["3,Dee", "trailer record", "two,Cy,Ray,50,Writer"]
    save(rejects, SinkSpec("text", f"{tmp_path}/rejects", files=1))
    assert text_lines(spark, f"{tmp_path}/rejects").count() == 3


def test_rejects_need_a_schema(spark, dirty):
    with pytest.raises(ValueError, match="schema"):
        load(spark, SourceSpec("csv", dirty, rejects=True))


def test_declared_not_null_is_enforced_by_a_check(spark, dirty):
    df = load(spark, SourceSpec("csv", dirty, CUSTOMERS, mode="dropmalformed"))
    with pytest.raises(Exception, match="null in required column id"):
        impose_schema(df, "id INT, custfname STRING", required=["id"]).collect()
    assert impose_schema(df.where("id is not null"), "id INT", required=["id"]).count() == 3


def test_separator_header_and_names(spark, tmp_path):
    path = tmp_path / "quotes"
    path.write_text("market~share~closing_rate\nLOOM~WFT~7.25\nLOOM~WRP~none\n")
    df = load(spark, SourceSpec("csv", str(path), sep="~", header=True))
    assert df.columns == ["market", "share", "closing_rate"]
    named = load(spark, SourceSpec("csv", str(path), sep="~", names=["e", "s", "r"]))
    assert named.columns == ["e", "s", "r"] and named.count() == 3
    typed = df.select(F.col("closing_rate").try_cast("float").alias("rate"))
    assert [r.rate is None for r in typed.collect()] == [False, True]


def test_folder_levels(spark, tmp_path):
    for name in ("a/north1", "a/north2", "a/b/south1", "a/b/c/south2", "d/north3", "a/other"):
        file = tmp_path / f"{name}.csv"
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(f"{name}\n")
    base = str(tmp_path)
    count = lambda **kw: load(spark, SourceSpec("csv", **kw)).count()
    assert count(path=f"{base}/a") == 3
    assert count(path=f"{base}/a/*/*") == 2  # a folder's files and a file one level down
    assert count(path=base, recursive=True) == 6
    assert count(path=base, recursive=True, name_pattern="north[1-3]*") == 3
    assert count(path=[f"{base}/a", f"{base}/d"]) == 4
    assert count(path=[f"{base}/a/north*", f"{base}/d"], name_pattern="*.csv") == 3


def test_lenient_and_broken_json(spark, tmp_path):
    path = tmp_path / "auctions.json"
    path.write_text('{auctionid: "a1", \'bid\': 0175.0, "gone": null}\n{"auctionid":"a2","bid":"x"}\n{bad\n')
    schema = "auctionid STRING, bid DOUBLE"
    lenient = load(spark, SourceSpec("json", str(path), schema, options=LENIENT_JSON, rejects=True))
    clean, rejects = split_rejects(lenient)
    assert values(clean) == [("a1", 175.0)]
    assert rejects.count() == 2
    dropped = load(spark, SourceSpec("json", str(path), schema, options=LENIENT_JSON, mode="dropmalformed"))
    assert dropped.count() == 1 and dropped.select("auctionid").count() == 1
    with pytest.raises(Exception):
        load(spark, SourceSpec("json", str(path), schema, mode="failfast")).collect()


def test_multiline_json(spark, tmp_path):
    path = tmp_path / "doc.json"
    path.write_text('[{\n "id": 1,\n "tags": ["a", "b"]},\n {"id": 2, "tags": []}]')
    df = load(spark, SourceSpec("json", str(path), "id INT, tags ARRAY<STRING>", multiline=True))
    assert values(df.select("id", F.size("tags"))) == [(1, 2), (2, 0)]


@pytest.mark.parametrize("fmt", ["csv", "json", "orc", "parquet"])
def test_save_modes(spark, tmp_path, fmt):
    path = f"{tmp_path}/out"
    df = spark.range(3).select("id", F.lit("x").alias("v"))
    save(df, SinkSpec(fmt, path))
    with pytest.raises(AnalysisException):
        save(df, SinkSpec(fmt, path))
    save(df, SinkSpec(fmt, path, mode="append"))
    read = SourceSpec(fmt, path, "id LONG, v STRING")
    assert load(spark, read).count() == 6
    save(df, SinkSpec(fmt, path, mode="overwrite"))
    assert load(spark, read).count() == 3


def test_migration_and_sql_on_files(spark, tmp_path, dirty):
    source = SourceSpec("csv", dirty, CUSTOMERS, mode="dropmalformed")
    for fmt in ("json", "orc", "parquet"):
        migrate(spark, source, SinkSpec(fmt, f"{tmp_path}/{fmt}"))
        assert query_files(spark, fmt, f"{tmp_path}/{fmt}", "id").count() == 4


def test_rows_per_file_and_file_count(spark, tmp_path):
    save(spark.range(0, 100, 1, 4), SinkSpec("parquet", f"{tmp_path}/few", files=1))
    assert len(list((tmp_path / "few").glob("*.parquet"))) == 1
    save(spark.range(0, 100, 1, 1), SinkSpec("parquet", f"{tmp_path}/many", rows_per_file=30))
    assert len(list((tmp_path / "many").glob("*.parquet"))) == 4


def test_null_partition_value_is_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id INT, city STRING")
    save(df, SinkSpec("parquet", f"{tmp_path}/p", partition_by=["city"]))
    assert (tmp_path / "p" / "city=__HIVE_DEFAULT_PARTITION__").exists()
    assert values(load(spark, SourceSpec("parquet", f"{tmp_path}/p")).where("city is null")) == [(2, None)]


def test_managed_bucketed_and_external_tables(spark, tmp_path):
    df = spark.range(20).select("id", (F.col("id") % 3).alias("g"))
    save(df, SinkSpec("parquet", table="managed_t", mode="overwrite"))
    save(df, SinkSpec("parquet", table="managed_t", mode="append"))
    assert spark.table("managed_t").count() == 40
    append_by_position(df.select(F.col("g").alias("id"), F.col("id").alias("g")), "managed_t")
    assert spark.table("managed_t").where("id < 3").count() == 26

    save(df, SinkSpec("parquet", table="bucketed_t", bucket_by=(3, ["id"]), mode="overwrite"))
    joined = spark.table("bucketed_t").alias("a").join(spark.table("bucketed_t").alias("b"), "id")
    plan = joined.hint("merge")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan

    save(df, SinkSpec("orc", f"{tmp_path}/ext", "external_t", mode="overwrite", partition_by=["g"]))
    kind = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED external_t").collect()}
    assert kind["Type"] == "EXTERNAL"
    with pytest.raises(ValueError):
        save(df, SinkSpec("parquet"))


def test_external_table_follows_its_files(spark, tmp_path):
    path = f"{tmp_path}/grow"
    save(spark.range(2), SinkSpec("orc", path))
    assert rebuild_external(spark, "grow_t", path).columns == ["id"]
    save(spark.range(2).withColumn("extra", F.lit("e")), SinkSpec("orc", path, mode="append"))
    again = rebuild_external(spark, "grow_t", path)
    assert sorted(again.columns) == ["extra", "id"]
    assert again.where("extra is null").count() == 2


def test_overwrite_touches_only_its_partitions(spark, tmp_path):
    path = f"{tmp_path}/parts"
    df = spark.range(6).select("id", (F.col("id") % 3).alias("day"))
    save(df, SinkSpec("parquet", path, partition_by=["day"]))
    new = spark.createDataFrame([(100, 1)], "id LONG, day LONG")
    save(
        new,
        SinkSpec("parquet", path, mode="overwrite", partition_by=["day"], touched_partitions_only=True),
    )
    rows = values(load(spark, SourceSpec("parquet", path)).select("id", "day"))
    assert rows == [(0, 0), (2, 2), (3, 0), (5, 2), (100, 1)]


def test_evolution(spark, tmp_path):
    a = spark.createDataFrame([("s1", 1, "5%")], "stock STRING, value INT, incr STRING")
    b = spark.createDataFrame([("s2", 7, 2.5)], "stock STRING, incr INT, maxrate DOUBLE")
    assert union_by_name([a, a]).count() == 2
    merged = combine([a, b])
    assert dict(merged.dtypes) == {"stock": "string", "value": "int", "incr": "string", "maxrate": "double"}
    assert values(merged.select("stock", "incr")) == [("s1", "5%"), ("s2", "7")]
    padded = union_padded(a, b.drop("incr"), {"value": -1, "incr": "", "maxrate": -1.0})
    assert values(padded) == [("s1", 1, "5%", -1.0), ("s2", -1, "", 2.5)]
    with pytest.raises(ValueError, match="padding"):
        union_padded(a, b, {})
    a.write.parquet(f"{tmp_path}/d1")
    b.write.parquet(f"{tmp_path}/d2")
    with pytest.raises(Exception):
        load(spark, SourceSpec("parquet", [f"{tmp_path}/d1", f"{tmp_path}/d2"], merge_schema=True)).collect()


def test_reading_two_layouts_without_names_mixes_columns(spark, tmp_path):
    """Why drops are merged by name: one positional read puts values in wrong columns."""
    (tmp_path / "a.csv").write_text("stock,value,incr\ns1,10,1\n")
    (tmp_path / "b.csv").write_text("stock,incr,value\ns2,2,20\n")
    paths = [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"]
    naive = load(spark, SourceSpec("csv", paths, header=True))
    assert naive.where("stock = 's2'").first().asDict() != {"stock": "s2", "incr": "2", "value": "20"}
    parts = [load(spark, SourceSpec("csv", p, header=True)) for p in paths]
    right = union_by_name(parts).where("stock = 's2'").first().asDict()
    assert right == {"stock": "s2", "incr": "2", "value": "20"}


def test_schema_diff(spark):
    a = spark.createDataFrame([(1, "x")], "id INT, v STRING")
    b = spark.createDataFrame([("x", 1)], "v STRING, id INT")
    assert schema_diff(a, b) == []
    c = spark.createDataFrame([("1", 2.0)], "id STRING, w DOUBLE")
    assert schema_diff(a, c) == ["missing: v", "extra: w", "type of id: int != string"]
    assert schema_diff(a, c.withColumnRenamed("w", "v"), types=False) == []


def test_jdbc_options_keep_secrets_out_of_the_url(tmp_path):
    file = tmp_path / "connection.prop"
    file.write_text("[DBCRED]\ndriver=org.example.Driver\nhost=jdbc:db://h\nport=1\nuser=u\npass=p%1\n")
    connection = connection_from_file(str(file), "custdb")
    assert connection == Connection("jdbc:db://h:1/custdb", "org.example.Driver", "u", "p%1")
    assert "p%1" not in connection.url
    whole = read_options(connection, table="t")
    assert whole["dbtable"] == "t" and whole["password"] == "p%1"
    pushed = read_options(connection, query="select city, sum(amt) s from t group by city")
    assert pushed["query"].startswith("select") and "dbtable" not in pushed
    sliced = read_options(
        connection, query="select * from t", slices=Slices("id", "0", "100", 4), schema="id INT"
    )
    assert sliced["dbtable"] == "(select * from t) pushed"
    assert (sliced["partitionColumn"], sliced["numPartitions"]) == ("id", "4")
    assert sliced["customSchema"] == "id INT"
    assert write_options(connection, "t")["batchsize"] == "10000"
    with pytest.raises(ValueError):
        read_options(connection)
    with pytest.raises(FileNotFoundError):
        connection_from_file(str(tmp_path / "none"), "d")


def test_first_line_of_each_file_goes(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.txt").write_text('head,"x\nbody\nhead,"x\n\n last \\ ,\n')
    (folder / "b.txt").write_text("other\n" + "head\n" * 3)
    (folder / "c.txt").write_text("alone")
    (folder / "d.txt").write_text("")
    found = sorted(r[0] for r in lines_below_headers(spark, str(folder)).collect())
    assert found == sorted(["body", 'head,"x', " last \\ ,", "head", "head", "head"])
    # Only the task that holds the start of a file drops a line.
    (folder / "e.txt").write_text("first\n" + "row\n" * 50_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = lines_below_headers(spark, str(folder / "e.txt"))
        assert lines.rdd.getNumPartitions() > 5 and values(lines.groupBy("value").count()) == [("row", 50_000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tried_reports_only_what_it_expects(spark):
    df = spark.range(10).select(F.when(F.col("id") != 3, F.col("id")).alias("k"), F.lit("x").alias("v"))
    assert tried(df) == (10, None)
    assert tried(require_not_null(df, ["v"]), "null in") == (10, None)
    assert tried(require_not_null(df, ["k"]), "other", "null in") == (None, "null in")
    with pytest.raises(Exception, match="null in required"):
        tried(require_not_null(df, ["k"]), "MALFORMED")
    assert tried(df.limit(0)) == (0, None)
