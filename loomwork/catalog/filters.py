"""Predicates."""

from pyspark.sql import functions as F

from loomwork.catalog.registry import portable, query
from loomwork.functions.dates import in_month, is_month_end, is_month_start
from loomwork.operators.cleanse import is_not_numeric
from loomwork.operators.metrics import dim_metrics, money_avg


@query("""
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
    WHERE (o_totalprice >= 100000 AND o_orderstatus <> 'P') OR o_orderpriority IS NULL
""")
def filters_combo(t):
    keep = ((F.col("o_totalprice") >= 100000) & (F.col("o_orderstatus") != "P")) | F.col(
        "o_orderpriority"
    ).isNull()
    return t.orders.where(keep).select("o_orderkey", "o_totalprice", "o_orderstatus")


@query("""
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_custkey IS NOT NULL
""")
def in_list(t):
    keep = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & F.col("o_custkey").isNotNull()
    return t.orders.where(keep).select("o_orderkey", "o_orderpriority")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment LIKE '%N%R%'")
def like_pattern(t):
    return t.customer.where(F.col("c_mktsegment").like("%N%R%")).select("c_custkey", "c_mktsegment")


@query("""
    SELECT o_orderkey, 'x' || CAST(o_orderkey AS VARCHAR) AS code
    FROM orders WHERE o_orderpriority = '5-LOW'
""")
def non_numeric_detector(t):
    code = F.when(
        F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))
    ).otherwise(F.col("o_orderkey").cast("string"))
    coded = t.orders.select("o_orderkey", code.alias("code"))
    return coded.where(is_not_numeric(F.col("code")))


@query("""
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE month(o_orderdate) = 12 AND year(o_orderdate) = 1998
""")
def month_and_year(t):
    return t.orders.where(in_month("o_orderdate", 1998, 12)).select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )


@query("""
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
           CASE WHEN day(o_orderdate) = 1 THEN 'start' ELSE 'end' END AS edge
    FROM orders
    WHERE CAST(o_orderdate AS DATE) = last_day(o_orderdate) OR day(o_orderdate) = 1
""")
def month_edges(t):
    edges = t.orders.where(is_month_end("o_orderdate") | is_month_start("o_orderdate"))
    labelled = edges.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        F.when(is_month_start("o_orderdate"), "start").otherwise("end").alias("edge"),
    )
    return portable(labelled)


@query("""
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE upper(c_mktsegment) = 'BUILDING' OR c_mktsegment = 'MACHINERY'
""")
def function_in_predicate(t):
    keep = (F.upper("c_mktsegment") == "BUILDING") | (F.col("c_mktsegment") == "MACHINERY")
    return t.customer.where(keep).select("c_custkey", "c_mktsegment")


@query("""
    SELECT c_custkey, c_acctbal FROM customer
    WHERE c_acctbal < 0 AND c_mktsegment NOT IN ('BUILDING')
""")
def sql_text_filter(t):
    return t.customer.where("c_acctbal < 0 and c_mktsegment not in ('BUILDING')").select(
        "c_custkey", "c_acctbal"
    )


_HAVING = """
    SELECT c_nationkey, count(*) AS cnt,
           CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS avgbal
    FROM customer GROUP BY c_nationkey HAVING avgbal > 4500
"""


@query(_HAVING)
def having_threshold(t):
    return dim_metrics(
        t.customer,
        ["c_nationkey"],
        {"cnt": F.count("*"), "avgbal": money_avg("c_acctbal", 2)},
        having="avgbal > 4500",
    )


@query(_HAVING)
def having_by_outer_query(t):
    t.customer.createOrReplaceTempView("loomwork_customer")
    return t.spark.sql("""
        SELECT * FROM (
          SELECT c_nationkey, count(*) AS cnt,
                 CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS avgbal
          FROM loomwork_customer GROUP BY c_nationkey) grouped
        WHERE avgbal > 4500
    """)
