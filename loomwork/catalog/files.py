"""Sources and sinks: the tables written out in a format and read back.

Every query writes a whole table below the shared scratch folder, in the shape
a source would deliver it, and returns what the reader under test makes of it.
"""

from pyspark.sql import functions as F

from loomwork.catalog.registry import portable, query
from loomwork.operators.cleanse import require_not_null
from loomwork.operators.evolve import combine
from loomwork.operators.layout import parts_for
from loomwork.operators.quality import tried
from loomwork.operators.sets import rows_only_in
from loomwork.operators.skew import skew_join
from loomwork.session import scratch_path, table_of
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
from loomwork.sources.sinks import SinkSpec, append_by_position, migrate, rebuild_external, save

_ORDER_SCHEMA = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderpriority STRING"
_ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def _written(t, df, fmt, label, **options):
    path = scratch_path(t.spark, label)
    save(df, SinkSpec(fmt, path, options=options))
    return path


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS _c0, CAST(o_custkey AS VARCHAR) AS _c1, o_orderstatus AS _c2,
           o_orderpriority AS _c3
    FROM orders
""")
def csv_untyped(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return load(t.spark, SourceSpec("csv", _written(t, rows, "csv", "untyped")))


@query(_ORDER_SQL)
def csv_declared(t):
    path = _written(t, _orders(t), "csv", "declared")
    return load(t.spark, SourceSpec("csv", path, _ORDER_SCHEMA))


@query(_ORDER_SQL)
def csv_inferred_with_header(t):
    path = _written(t, _orders(t), "csv", "inferred", header="true")
    inferred = load(t.spark, SourceSpec("csv", path, header=True, infer=True))
    return inferred.withColumns(
        {"o_orderkey": F.col("o_orderkey").cast("long"), "o_custkey": F.col("o_custkey").cast("long")}
    )


@query("SELECT o_orderkey AS id, o_custkey AS cust, o_orderstatus AS st, o_totalprice AS amt, o_orderpriority AS pri FROM orders")
def csv_delimited_named(t):
    path = _written(t, _orders(t), "csv", "delimited", sep="~")
    text = load(t.spark, SourceSpec("csv", path, sep="~", names=["id", "cust", "st", "amt", "pri"]))
    return impose_schema(
        text, "id BIGINT, cust BIGINT, st STRING, amt DOUBLE, pri STRING", required=["id"]
    )


def _broken_lines(t):
    """Order lines where pending orders carry a word for their amount."""
    amount = F.when(F.col("o_orderstatus") == "P", "open").otherwise(F.col("o_totalprice").cast("string"))
    line = F.concat_ws(
        ",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus", amount
    )
    return t.orders.select(line.alias("value"))


_BROKEN_SCHEMA = "id BIGINT, cust BIGINT, st STRING, amt DOUBLE"
_GOOD_SQL = "SELECT o_orderkey AS id, o_custkey AS cust, o_orderstatus AS st, o_totalprice AS amt FROM orders WHERE o_orderstatus <> 'P'"


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) || ',P,open' AS reject_data
    FROM orders WHERE o_orderstatus = 'P'
""")
def csv_rejects(t):
    path = _written(t, _broken_lines(t), "text", "rejects")
    _, rejects = split_rejects(load(t.spark, SourceSpec("csv", path, _BROKEN_SCHEMA, rejects=True)))
    return rejects


@query(_GOOD_SQL)
def csv_clean(t):
    path = _written(t, _broken_lines(t), "text", "clean")
    clean, _ = split_rejects(load(t.spark, SourceSpec("csv", path, _BROKEN_SCHEMA, rejects=True)))
    return clean


@query(_GOOD_SQL)
def csv_drop_malformed(t):
    path = _written(t, _broken_lines(t), "text", "malformed")
    return load(t.spark, SourceSpec("csv", path, _BROKEN_SCHEMA, mode="dropmalformed"))


@query("SELECT count(*) AS n FROM orders WHERE o_orderstatus <> 'P'")
def csv_drop_malformed_count(t):
    path = _written(t, _broken_lines(t), "text", "malformed-count")
    rows = load(t.spark, SourceSpec("csv", path, _BROKEN_SCHEMA, mode="dropmalformed"))
    return rows.agg(F.count("*").alias("n"))


@query(f"""
    SELECT 'permissive' AS mode, CAST(count(*) AS DOUBLE) AS n, CAST(NULL AS VARCHAR) AS failed FROM orders
    UNION ALL SELECT 'dropmalformed', count(*), NULL FROM ({_GOOD_SQL})
    UNION ALL SELECT 'failfast', CASE WHEN count(*) = 0 THEN 0 END,
                     CASE WHEN count(*) > 0 THEN 'MALFORMED_RECORD_IN_PARSING' END
              FROM orders WHERE o_orderstatus = 'P'
    UNION ALL SELECT 'failfast, clean lines', count(*), NULL FROM ({_GOOD_SQL})
""")
def csv_modes(t):
    """What each reading mode makes of the same broken lines: rows, or a failed job."""
    path = _written(t, _broken_lines(t), "text", "modes")
    good = _written(t, _broken_lines(t).where("value not like '%,open'"), "text", "modes-good")
    rows = []
    for mode, files in (("permissive", path), ("dropmalformed", path), ("failfast", path), ("failfast", good)):
        read = load(t.spark, SourceSpec("csv", files, _BROKEN_SCHEMA, mode=mode))
        n, failed = tried(read, "MALFORMED_RECORD_IN_PARSING")
        rows.append((f"{mode}, clean lines" if files == good else mode, None if n is None else float(n), failed))
    return t.spark.createDataFrame(rows, "mode string, n double, failed string")


@query("""
    SELECT 'id' AS key, CAST(count(*) AS DOUBLE) AS n, CAST(NULL AS VARCHAR) AS failed FROM orders
    UNION ALL SELECT 'amt', CASE WHEN count_if(o_orderstatus = 'P') = 0 THEN count(*) END,
                     CASE WHEN count_if(o_orderstatus = 'P') > 0 THEN 'null in required column amt' END
              FROM orders
""")
def csv_required_keys(t):
    """A read fails on a null in a required column, and passes on whole ones."""
    path = _written(t, _broken_lines(t), "text", "required")
    rows = []
    for key in ("id", "amt"):
        read = load(t.spark, SourceSpec("csv", path, _BROKEN_SCHEMA))
        n, failed = tried(require_not_null(read, [key]), f"null in required column {key}")
        rows.append((key, None if n is None else float(n), failed))
    return t.spark.createDataFrame(rows, "key string, n double, failed string")


@query("""
    SELECT CAST(c_custkey AS VARCHAR) || ',' || c_name AS line FROM customer
    UNION ALL SELECT 'id,name' FROM region
""")
def header_removed_by_position(t):
    """The first line of every file goes; data lines that equal it stay."""
    files = parts_for(t.customer, 1_000_000, least=4)
    named = t.customer.select(
        F.pmod(F.xxhash64("c_custkey"), F.lit(files)).alias("file"),
        F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("value"),
    )
    alike = t.region.select(F.pmod(F.xxhash64("r_regionkey"), F.lit(files)).alias("file"), F.lit("id,name").alias("value"))
    data = named.union(alike)
    header = data.select("file").distinct().select("file", F.lit("id,name").alias("value"), F.lit(0).alias("place"))
    lines = data.withColumn("place", F.lit(1)).union(header).repartition(files, "file")
    path = scratch_path(t.spark, "headers")
    lines.sortWithinPartitions("file", "place").select("file", "value").write.partitionBy("file").text(path)
    return lines_below_headers(t.spark, path).select(F.col("value").alias("line"))


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) || ',P,open' AS value
    FROM orders WHERE o_orderstatus = 'P'
""")
def rejects_by_difference(t):
    """Rejects found by subtracting the rebuilt clean lines from the raw ones."""
    path = _written(t, _broken_lines(t), "text", "difference")
    good = load(t.spark, SourceSpec("csv", path, _BROKEN_SCHEMA, mode="dropmalformed"))
    rebuilt = good.select(
        F.concat_ws(
            ",", F.col("id").cast("string"), F.col("cust").cast("string"), "st", F.col("amt").cast("string")
        ).alias("value")
    )
    return rows_only_in(text_lines(t.spark, path), rebuilt)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def csv_nested_folders(t):
    """Files on several folder levels, found by recursion and a name pattern."""
    base = scratch_path(t.spark, "levels")
    people = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    save(people.where("c_mktsegment = 'BUILDING'"), SinkSpec("csv", f"{base}/src1"))
    save(people.where("c_mktsegment = 'MACHINERY'"), SinkSpec("csv", f"{base}/src1/src2"))
    save(
        people.where("c_mktsegment not in ('BUILDING', 'MACHINERY')"), SinkSpec("csv", f"{base}/src3/a/b")
    )
    return load(
        t.spark,
        SourceSpec(
            "csv", base, "c_custkey BIGINT, c_name STRING, c_mktsegment STRING",
            recursive=True, name_pattern="*.csv",
        ),
    )


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'")
def csv_wildcards_and_lists(t):
    """One scan over a list of paths with wildcards; the level above stays out."""
    base = scratch_path(t.spark, "globs")
    people = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    save(people.where("c_mktsegment = 'BUILDING'"), SinkSpec("csv", f"{base}/top"))
    save(people.where("c_mktsegment = 'MACHINERY'"), SinkSpec("csv", f"{base}/top/src2"))
    rest = people.where("c_mktsegment not in ('BUILDING', 'MACHINERY')")
    save(rest, SinkSpec("csv", f"{base}/other"))
    paths = [f"{base}/top/src*", f"{base}/oth*"]
    return load(
        t.spark, SourceSpec("csv", paths, "c_custkey BIGINT, c_name STRING, c_mktsegment STRING")
    )


@query(_ORDER_SQL)
def json_lines(t):
    path = _written(t, _orders(t), "json", "json")
    return load(t.spark, SourceSpec("json", path, _ORDER_SCHEMA))


@query("SELECT event_id AS id, event_type AS kind FROM events")
def json_lenient(t):
    """JSON with bare names, single quotes and leading zeros."""
    line = F.concat(
        F.lit("{id: 00"), F.col("event_id").cast("string"), F.lit(", 'kind': '"), "event_type", F.lit("'}")
    )
    path = _written(t, t.events.select(line.alias("value")), "text", "lenient")
    return load(t.spark, SourceSpec("json", path, "id BIGINT, kind STRING", options=LENIENT_JSON))


@query("SELECT user_id, count(*) AS n FROM events GROUP BY user_id")
def json_multiline(t):
    """Files that each hold one JSON array spread over many lines.

    Such a file is read by one task, so its rows are bounded and their number
    grows with the table.
    """
    files = parts_for(t.events, 200_000, least=8)
    counts = t.events.groupBy("user_id").agg(F.count("*").alias("n"))
    objects = counts.select(
        F.pmod(F.xxhash64("user_id"), F.lit(files)).alias("file"),
        F.lit(1).alias("place"),
        F.concat(
            F.lit(',{\n "user": '), F.col("user_id").cast("string"),
            F.lit(',\n "n": '), F.col("n").cast("string"), F.lit("\n}"),
        ).alias("value"),
    )
    used = objects.select("file").distinct()
    first = used.select("file", F.lit(0).alias("place"), F.lit("[{}").alias("value"))
    last = used.select("file", F.lit(2).alias("place"), F.lit("]").alias("value"))
    path = scratch_path(t.spark, "multiline")
    lines = objects.union(first).union(last).repartition(files, "file")
    ordered = lines.sortWithinPartitions("file", "place").select("file", "value")
    ordered.write.partitionBy("file").text(path)
    read = load(t.spark, SourceSpec("json", path, "user BIGINT, n BIGINT", multiline=True))
    return read.where("user is not null").select(F.col("user").alias("user_id"), "n")


@query(_ORDER_SQL)
def json_compressed_partitioned(t):
    path = scratch_path(t.spark, "json-parts")
    save(
        _orders(t),
        SinkSpec(
            "json",
            path,
            partition_by=["o_orderstatus"],
            rows_per_file=1_000_000,  # a gzip file is read by one task
            options={"compression": "gzip", "ignoreNullFields": "false"},
        ),
    )
    return load(t.spark, SourceSpec("json", path, _ORDER_SCHEMA))


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def orc_scan(t):
    path = _written(t, t.orders, "orc", "orc")
    return load(t.spark, SourceSpec("orc", path)).select("o_orderkey", "o_totalprice", "o_orderdate")


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def parquet_scan(t):
    return t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def sql_on_files(t):
    path = _written(t, t.orders, "orc", "sql-orc")
    return query_files(t.spark, "orc", path, "o_orderkey, o_orderstatus")


@query(_ORDER_SQL)
def csv_to_orc(t):
    source = SourceSpec("csv", _written(t, _orders(t), "csv", "from"), _ORDER_SCHEMA)
    target = scratch_path(t.spark, "to")
    migrate(t.spark, source, SinkSpec("orc", target))
    return load(t.spark, SourceSpec("orc", target))


@query("SELECT CAST(c_custkey AS VARCHAR) || ' ' || c_name AS value FROM customer")
def text_round_trip(t):
    lines = t.customer.select(F.concat_ws(" ", F.col("c_custkey").cast("string"), "c_name").alias("value"))
    return text_lines(t.spark, _written(t, lines, "text", "text"))


@query("SELECT count(*) AS n FROM customer")
def whole_text_files(t):
    """Line breaks counted in whole files add up to the rows written."""
    path = scratch_path(t.spark, "whole")
    save(t.customer.select(F.col("c_name").alias("value")), SinkSpec("text", path, rows_per_file=100_000))
    whole = text_lines(t.spark, path, whole=True)
    breaks = F.length("value") - F.length(F.replace(F.col("value"), F.lit("\n"), F.lit("")))
    return whole.agg(F.sum(breaks).cast("long").alias("n"))


def _drops(t, fmt, label):
    """Three deliveries: a column is missing from the second and added in the third."""
    base = scratch_path(t.spark, label)
    orders = t.orders
    first = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    second = orders.where("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice")
    third = orders.where("o_orderstatus = 'P'").select("o_orderpriority", "o_totalprice", "o_orderkey", "o_custkey")
    for day, df in (("day1", first), ("day2", second), ("day3", third)):
        save(df, SinkSpec(fmt, f"{base}/{day}"))
    return [f"{base}/day{i}" for i in (1, 2, 3)]


_DROPS_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_custkey::DOUBLE END AS o_custkey, o_totalprice,
           CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS o_orderpriority
    FROM orders
"""
_DROP_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]


@query(_DROPS_SQL)
def merge_schema_parquet(t):
    paths = _drops(t, "parquet", "merge-parquet")
    merged = load(t.spark, SourceSpec("parquet", paths, merge_schema=True))
    return portable(merged.select(*_DROP_COLUMNS), "o_custkey")


@query(_DROPS_SQL)
def merge_schema_orc(t):
    paths = _drops(t, "orc", "merge-orc")
    merged = load(t.spark, SourceSpec("orc", paths, merge_schema=True))
    return portable(merged.select(*_DROP_COLUMNS), "o_custkey")


@query(_DROPS_SQL)
def merge_schema_json(t):
    paths = _drops(t, "json", "merge-json")
    merged = load(t.spark, SourceSpec("json", paths))
    return portable(merged.select(*_DROP_COLUMNS), "o_custkey")


@query(_DROPS_SQL)
def external_table_rebuilt(t):
    """An external table is pointed at files whose schema has grown."""
    paths = _drops(t, "orc", "rebuild")
    base = paths[0].rsplit("/", 1)[0]
    flat = scratch_path(t.spark, "rebuilt")
    for path in paths:
        save(load(t.spark, SourceSpec("orc", path)), SinkSpec("orc", flat, mode="append"))
    rebuilt = rebuild_external(t.spark, table_of(base), flat)
    return portable(rebuilt.select(*_DROP_COLUMNS), "o_custkey")


_DRIFT_SQL = """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS incr
    FROM orders
"""


def _drift(t):
    numeric = t.orders.where("o_orderstatus <> 'P'").selectExpr("o_orderkey", "o_custkey as incr")
    textual = t.orders.where("o_orderstatus = 'P'").selectExpr("o_orderkey", "'n/a' as incr")
    return numeric, textual


@query(_DRIFT_SQL)
def type_drift_json(t):
    """A column turns from number to text between drops; JSON reading settles on text."""
    base = scratch_path(t.spark, "drift-json")
    for day, df in zip(("day1", "day2"), _drift(t)):
        save(df, SinkSpec("json", f"{base}/{day}"))
    return load(t.spark, SourceSpec("json", [f"{base}/day1", f"{base}/day2"])).select("o_orderkey", "incr")


@query(_DRIFT_SQL)
def type_drift_columnar(t):
    """The same from Parquet, where each drop is read alone and then combined."""
    drops = [_written(t, df, "parquet", "drift") for df in _drift(t)]
    return combine([load(t.spark, SourceSpec("parquet", p)) for p in drops])


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice,
           o_orderstatus FROM orders
""")
def partitions_overwritten(t):
    """An overwrite replaces only the partition it brings."""
    path = scratch_path(t.spark, "parts")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    save(rows, SinkSpec("parquet", path, partition_by=["o_orderstatus"]))
    again = rows.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.lit(0.0))
    save(
        again,
        SinkSpec("parquet", path, mode="overwrite", partition_by=["o_orderstatus"], touched_partitions_only=True),
    )
    return load(t.spark, SourceSpec("parquet", path))


@query("SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer")
def table_append(t):
    path = scratch_path(t.spark, "append")
    table = table_of(path)
    people = t.customer.select("c_custkey", "c_name")
    save(people, SinkSpec("parquet", path, table, mode="overwrite"))
    save(people, SinkSpec("parquet", path, table, mode="append"))
    return t.spark.table(table)


@query("SELECT c_custkey, c_name FROM customer")
def table_full_refresh(t):
    path = scratch_path(t.spark, "refresh")
    table = table_of(path)
    people = t.customer.select("c_custkey", "c_name")
    save(people.limit(0), SinkSpec("parquet", path, table, mode="overwrite"))
    save(people, SinkSpec("parquet", path, table, mode="overwrite"))
    return t.spark.table(table)


@query("SELECT c_custkey AS a, c_nationkey AS b FROM customer UNION ALL SELECT s_suppkey, s_nationkey FROM supplier")
def insert_by_position(t):
    path = scratch_path(t.spark, "insert")
    table = table_of(path)
    save(t.customer.selectExpr("c_custkey as a", "c_nationkey as b"), SinkSpec("parquet", path, table))
    append_by_position(t.supplier.select("s_suppkey", "s_nationkey"), table)
    return t.spark.table(table)


@query("SELECT l_orderkey, l_linenumber, l_partkey, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def bucketed_join(t):
    """Two tables bucketed alike join without a shuffle, unless a key is heavy.

    A bucket is read by one task, so their number grows with the larger table.
    """
    left, right = scratch_path(t.spark, "bucket-l"), scratch_path(t.spark, "bucket-r")
    buckets = parts_for(t.lineitem, 1_000_000, least=8)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    save(lines, SinkSpec("parquet", left, table_of(left), bucket_by=(buckets, ["l_orderkey"])))
    orders = t.orders.select("o_orderkey", "o_totalprice")
    save(orders, SinkSpec("parquet", right, table_of(right), bucket_by=(buckets, ["o_orderkey"])))
    joined = skew_join(
        t.spark.table(table_of(left)),
        t.spark.table(table_of(right)),
        [("l_orderkey", "o_orderkey")],
        "inner",
        hot="left",
    )
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'O'")
def sql_create_and_overwrite(t):
    """CREATE TABLE AS SELECT, then INSERT OVERWRITE."""
    path = scratch_path(t.spark, "ctas")
    table = table_of(path)
    t.orders.createOrReplaceTempView("loomwork_orders")
    columns = "o_orderkey, o_totalprice, o_orderpriority"
    t.spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}' AS SELECT {columns} FROM loomwork_orders WHERE o_orderstatus = 'F'")
    t.spark.sql(f"INSERT OVERWRITE TABLE {table} SELECT {columns} FROM loomwork_orders WHERE o_orderstatus = 'O'")
    return t.spark.table(table)


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def external_partitioned_table(t):
    """External ORC table with a partition column, filled by SQL."""
    path = scratch_path(t.spark, "external")
    table = table_of(path)
    t.orders.createOrReplaceTempView("loomwork_orders")
    t.spark.sql(
        f"CREATE TABLE {table} (o_orderkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING) "
        f"USING orc PARTITIONED BY (o_orderpriority) LOCATION '{path}'"
    )
    t.spark.sql(
        f"INSERT INTO {table} SELECT /*+ REBALANCE(o_orderpriority) */ o_orderkey, o_totalprice, o_orderpriority FROM loomwork_orders"
    )
    return t.spark.table(table)


@query("SELECT DISTINCT c_custkey, c_name, c_mktsegment FROM customer")
def curated_handover(t):
    """One job publishes a partitioned table, the next reads it."""
    path = scratch_path(t.spark, "handover")
    table = table_of(path)
    people = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    save(people, SinkSpec("parquet", path, table, partition_by=["c_mktsegment"]))
    return t.spark.table(table).select("c_custkey", "c_name", "c_mktsegment").na.drop("any").distinct()


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0.0 ELSE o_totalprice END AS o_totalprice, o_orderstatus
    FROM orders
""")
def table_partitions_overwritten(t):
    """A managed table keeps the partitions that an overwrite has no rows for."""
    table = table_of(scratch_path(t.spark, "managed"))
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    spec = SinkSpec("parquet", table=table, mode="overwrite", partition_by=["o_orderstatus"], touched_partitions_only=True)
    save(rows, spec)
    # Columns in another order: they are matched by name.
    again = rows.where("o_orderstatus = 'F'").select("o_orderstatus", F.lit(0.0).alias("o_totalprice"), "o_orderkey")
    save(again, spec)
    return t.spark.table(table)


@query("""
    SELECT c_custkey, c_name, 'MANAGED' AS kind FROM customer
    UNION ALL SELECT s_suppkey, s_name, 'MANAGED' FROM supplier
""")
def managed_table_refresh(t):
    """A managed table refreshed in full, then appended to."""
    table = table_of(scratch_path(t.spark, "managed"))
    people = t.customer.select("c_custkey", "c_name")
    save(people.limit(1), SinkSpec("parquet", table=table))
    save(people, SinkSpec("parquet", table=table, mode="overwrite"))
    firms = t.supplier.selectExpr("s_suppkey as c_custkey", "s_name as c_name")
    save(firms, SinkSpec("parquet", table=table, mode="append"))
    kind = t.spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Type'").select("data_type")
    return t.spark.table(table).withColumn("kind", kind.scalar())
