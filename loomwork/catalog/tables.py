"""Tables kept over many deliveries: keyed feeds, merges, stored sketches."""

from pyspark.sql import functions as F

from loomwork.catalog.registry import query
from loomwork.operators.bloom import matched_reduced
from loomwork.operators.distinct import distinct_from_states, distinct_states, relative_error
from loomwork.operators.frequent import frequent_from_states, frequent_state
from loomwork.operators.quality import quality_report
from loomwork.operators.quantiles import exact_quantiles
from loomwork.session import scratch_path, table_of
from loomwork.sources.sinks import SinkSpec, discover_partitions, save
from loomwork.tables.census import file_schemas, load_drifted, type_census
from loomwork.tables.compact import compact_files
from loomwork.tables.files import Store
from loomwork.tables.keyed import KeyedTable
from loomwork.tables.merge import merge_partitions


@query("""
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND event_type <> 'error'
""")
def keyed_feed(t):
    """Updates and deletes in three batches, one of them replayed, compacted in between."""
    rows = t.events.select("user_id", "event_id", "event_type", "value")
    table = KeyedTable.make(t.spark, scratch_path(t.spark, "keyed"), rows.schema, ["user_id"], ["-event_id"], 4)
    last = rows.agg(F.max("event_id")).first()[0]
    third = F.floor(F.col("event_id") * 3 / (last + 1))
    changes = rows.withColumns({"third": third, "gone": F.col("event_type") == "error"})
    table.commit(changes.where("third = 0"), "0", "gone")
    table.commit(changes.where("third = 1"), "1", "gone")
    table.commit(changes.where("third = 1"), "1", "gone")
    table.compact()
    table.commit(changes.where("third = 2"), "2", "gone")
    return table.read()


@query("""
    SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    WHERE c_acctbal >= 0 OR c_mktsegment <> 'BUILDING'
    UNION ALL
    SELECT c_custkey, 0.0, 'RESET' FROM customer WHERE c_acctbal < 0 AND c_mktsegment = 'BUILDING' AND c_custkey % 5 > 0
    UNION ALL
    SELECT s_suppkey + 1000000000, s_acctbal, 'SUPPLIER' FROM supplier
""")
def merge_by_partition(t):
    """Customers by segment: some of one segment move or go, suppliers come; other segments stay as they are."""
    path = scratch_path(t.spark, "merged")
    base = t.customer.selectExpr("c_custkey as id", "c_acctbal as balance", "c_mktsegment as segment")
    base.write.partitionBy("segment").parquet(path)
    moved = base.where("balance < 0 AND segment = 'BUILDING'").selectExpr(
        "id", "0.0d as balance", "'RESET' as segment", "id % 5 = 0 as gone"
    )
    new = t.supplier.selectExpr(
        "s_suppkey + 1000000000 as id", "s_acctbal as balance", "'SUPPLIER' as segment", "false as gone"
    )
    merge_partitions(t.spark, path, moved.unionByName(new), ["id"], ["segment"], "gone")
    return t.spark.read.parquet(path)


_SHARES = (0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0)


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {p}::DOUBLE AS share, round(quantile_cont({c}, {p}), 6) AS value FROM lineitem"
        for c in ("l_extendedprice", "l_quantity")
        for p in _SHARES
    )
)
def quantiles_bracketed(t):
    """Quantiles whose brackets are narrowed until few values are sorted."""
    found = exact_quantiles(t.lineitem, ["l_extendedprice", "l_quantity"], _SHARES, accuracy=200, most_values=1000)
    return found.withColumn("value", F.round("value", 6))


_COUNTED = ("l_orderkey", "l_partkey", "l_shipdate", "l_returnflag")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, count({c}) AS present_rows, "
        f"count(DISTINCT {c}) AS distinct_values, true AS close FROM lineitem"
        for c in _COUNTED
    )
)
def distinct_over_deliveries(t):
    """Stored sketches of three deliveries, one stored twice, merged: within the stated error of the exact counts."""
    path = scratch_path(t.spark, "distinct")
    for k in (0, 1, 2, 1):
        part = t.lineitem.where(F.col("l_orderkey") % 3 == k)
        distinct_states(part, _COUNTED, f"day-{k}").write.mode("append").parquet(path)
    merged = distinct_from_states(t.spark.read.parquet(path))
    exact = quality_report(t.lineitem, _COUNTED).select("column_name", "distinct_values")
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_values"))
    close = off <= relative_error() * F.col("distinct_values")
    return merged.join(exact, "column_name").select(
        "column_name", "total_rows", "present_rows", "distinct_values", close.alias("close")
    )


@query("""
    SELECT l_shipdate.year() AS value, count(*) AS n FROM lineitem GROUP BY 1
    HAVING count(*) >= 0.1 * (SELECT count(*) FROM lineitem)
""")
def frequent_over_deliveries(t):
    """Years that hold a tenth of the lines, from the states of four deliveries; what a state lacks is counted again."""
    path = scratch_path(t.spark, "frequent")
    years = t.lineitem.select(F.year("l_shipdate").cast("bigint").alias("value"), (F.col("l_orderkey") % 4).alias("part"))
    for k in range(4):
        frequent_state(years.where(F.col("part") == k), "value", str(k), 0.1).write.mode("append").parquet(path)
    return frequent_from_states(t.spark.read.parquet(path), 0.1, lambda d: years.where(F.col("part") == int(d)))


@query("""
    SELECT o_orderkey, o_totalprice, o_orderpriority, true AS few_files FROM orders
""")
def files_compacted(t):
    """Many small files per partition, rewritten to a stated size: the same rows in files within the range."""
    path = scratch_path(t.spark, "compacted")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    spread = rows.repartition(2 * t.spark.sparkContext.defaultParallelism, "o_orderkey")
    spread.write.partitionBy("o_orderpriority").parquet(path)
    before = Store(t.spark, path).files()
    target = max(sum(f.size for f in before) // 4, 1)
    compact_files(t.spark, path, target)
    after = Store(t.spark, path).files()
    few = len(after) < len(before) and max(f.size for f in after) <= max(target, *(f.size for f in before))
    return t.spark.read.parquet(path).select(*rows.columns, F.lit(few).alias("few_files"))


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 400000)
""")
def join_semi_reduced(t):
    """Lines of a few orders: a filter of bounded size drops most lines before their shuffle."""
    few = t.orders.where("o_totalprice > 400000").select("o_orderkey")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return matched_reduced(lines, few, [("l_orderkey", "o_orderkey")])


def _drops(t):
    """Three deliveries of orders: one more column, one column less, and types that differ."""
    path = scratch_path(t.spark, "drops")
    first = t.orders.selectExpr("CAST(o_orderkey AS INT) AS id", "o_orderstatus AS status", "1 AS drop_no")
    second = t.orders.selectExpr("o_orderkey AS id", "o_orderstatus AS status", "o_totalprice AS price", "2 AS drop_no")
    third = t.orders.selectExpr("o_orderkey AS id", "CAST(o_totalprice AS INT) AS status", "o_totalprice AS price", "3L AS drop_no")
    for k, rows in enumerate((first, second, third)):
        rows.coalesce(1).write.parquet(f"{path}/drop={k}")
    return path


@query("""
    SELECT o_orderkey AS id, o_orderstatus AS status, NULL::DOUBLE AS price, 1::BIGINT AS drop_no FROM orders
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 2 FROM orders
    UNION ALL SELECT o_orderkey, CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR), o_totalprice, 3 FROM orders
""")
def types_drifted(t):
    """Read under one widened schema: whole numbers widen, a clash becomes text, lacking columns are null."""
    return load_drifted(t.spark, _drops(t))


@query("""
    SELECT column_name, type, files::BIGINT AS files, files * (SELECT count(*) FROM orders) AS rows
    FROM (VALUES ('id', 'integer', 1), ('id', 'long', 2), ('status', 'string', 2), ('status', 'integer', 1),
                 ('price', 'double', 2), ('drop_no', 'integer', 2), ('drop_no', 'long', 1)) v(column_name, type, files)
""")
def types_counted(t):
    """Which types each column has in how many files and rows, from the footers alone."""
    census = type_census(file_schemas(t.spark, _drops(t)))
    return census.select("column_name", "type", "files", F.col("rows").cast("decimal(38,0)").cast("bigint").alias("rows"))


@query("""
    SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1
""")
def partitions_discovered(t):
    """A partition that another writer put beside a table's own is read through the table."""
    path = scratch_path(t.spark, "found")
    table = table_of(path)
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    save(rows.where("status <> 'F'"), SinkSpec("parquet", path, table, partition_by=["status"]))
    rows.where("status = 'F'").drop("status").write.parquet(f"{path}/status=F")
    discover_partitions(t.spark, table)
    return t.spark.table(table).groupBy("status").agg(F.count("*").alias("n"))
