"""Drifting types over files, and partitions found beside a table."""

import pytest
from pyspark.sql.types import StructType

from loomwork.sources.sinks import SinkSpec, discover_partitions, save
from loomwork.tables.census import file_schemas, load_drifted, type_census, widened


def _type(ddl):
    return StructType.fromDDL(ddl)


@pytest.mark.parametrize(
    "one, two, both",
    [
        ("int", "bigint", "bigint"),
        ("smallint", "double", "double"),
        ("float", "int", "double"),
        ("float", "smallint", "float"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("decimal(38,2)", "decimal(38,9)", "double"),
        ("decimal(10,2)", "int", "double"),
        ("date", "timestamp", "timestamp"),
        ("string", "int", "string"),
        ("boolean", "int", "string"),
        ("array<int>", "array<int>", "array<int>"),
    ],
)
def test_types_meet_either_way_round(spark, one, two, both):
    for a, b in ((one, two), (two, one)):
        assert widened([_type(f"x {a}"), _type(f"x {b}, y int")]) == _type(f"x {both}, y int")


def test_files_of_several_schemas(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 5).selectExpr("CAST(id AS INT) AS id", "'a' AS v").coalesce(1).write.parquet(f"{path}/one")
    spark.range(5, 8).selectExpr("id", "2.5D AS v", "array(id) AS more").repartition(2).write.parquet(f"{path}/two")
    spark.range(8, 9).selectExpr("CAST(id AS INT) AS id", "CAST(NULL AS STRING) AS v").coalesce(1).write.parquet(f"{path}/three")
    schemas = file_schemas(spark, path, files_per_task=1)
    assert sum(r.rows for r in schemas.collect()) == 9
    census = {(r.column_name, r.type): (r.files, r.rows) for r in type_census(schemas).collect() if r.column_name != "more"}
    assert census[("id", "integer")] == (2, 6) and census[("id", "long")][1] == 3 and census[("v", "double")][1] == 3
    found = load_drifted(spark, path)
    assert found.schema.simpleString() == "struct<id:bigint,v:string,more:array<bigint>>"
    rows = {r.id: (r.v, r.more) for r in found.collect()}
    assert rows[0] == ("a", None) and rows[6] == ("2.5", [6]) and rows[8] == (None, None) and len(rows) == 9
    with pytest.raises(ValueError):
        load_drifted(spark, str(tmp_path / "none"))


def test_partitions_come_and_go(spark, tmp_path):
    path, table = str(tmp_path / "t"), "found_partitions"
    rows = spark.range(30).selectExpr("id", "CAST(id % 3 AS STRING) AS part")
    save(rows.where("part <> '2'"), SinkSpec("parquet", path, table, partition_by=["part"]))
    rows.where("part = '2'").drop("part").write.parquet(f"{path}/part=2")
    assert spark.table(table).count() == 20
    discover_partitions(spark, table)
    assert spark.table(table).count() == 30
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert "30 rows" in told["Statistics"]
    column = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {table} id").collect()}
    assert column["max"] == "29" and column["num_nulls"] == "0"
    spark.sql(f"DROP TABLE {table}")
