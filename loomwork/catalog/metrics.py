"""Grouped measures."""

from pyspark.sql import functions as F

from loomwork.catalog.registry import portable, query
from loomwork.functions.text import age_group
from loomwork.operators.joins import lookup
from loomwork.operators.metrics import change_over_periods, dim_metrics, money_avg, money_sum


@query("""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, c_mktsegment AS segment, count(*) AS cnt,
           count(DISTINCT o_custkey) AS customers, min(o_totalprice) AS minamt,
           max(o_totalprice) AS maxamt,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avgamt
    FROM orders JOIN customer ON o_custkey = c_custkey
    GROUP BY ALL HAVING avgamt > 200000
    ORDER BY yr DESC, segment
""")
def segment_metrics(t):
    """Orders are reduced to one row per customer and year before the join."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    per_customer = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(
        F.count("*").alias("n"),
        F.sum(amount).alias("total"),
        F.min("o_totalprice").alias("low"),
        F.max("o_totalprice").alias("high"),
    )
    segments = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return dim_metrics(
        lookup(per_customer, segments, [("o_custkey", "c_custkey")]),
        ["yr", "segment"],
        {
            "cnt": F.sum("n"),
            "customers": F.count("*"),
            "minamt": F.min("low"),
            "maxamt": F.max("high"),
            "avgamt": F.sum("total").cast("double") / F.sum("n"),
        },
        having="avgamt > 200000",
        order=["-yr", "segment"],
    )


@query("""
    SELECT o_orderstatus, o_orderpriority, count(o_totalprice) AS cnt,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           min(o_totalprice) AS low, max(o_totalprice) AS high,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS mean
    FROM orders GROUP BY ALL
""")
def grouped_stats(t):
    return dim_metrics(
        t.orders,
        ["o_orderstatus", "o_orderpriority"],
        {
            "cnt": F.count("o_totalprice"),
            "total": money_sum("o_totalprice", 2),
            "low": F.min("o_totalprice"),
            "high": F.max("o_totalprice"),
            "mean": money_avg("o_totalprice", 2),
        },
    )


@query("""
    SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts
    FROM lineitem GROUP BY l_returnflag
""")
def count_distinct_by_key(t):
    return dim_metrics(
        t.lineitem,
        ["l_returnflag"],
        {"suppliers": F.count_distinct("l_suppkey"), "parts": F.count_distinct("l_partkey")},
    )


@query("""
    SELECT CASE WHEN p_size < 13 THEN 'Children' WHEN p_size <= 18 THEN 'Teen' ELSE 'Adults' END
             AS agegroup, p_type, count(p_size) AS cnt, min(p_size) AS minage, max(p_size) AS maxage,
           count(DISTINCT p_size) AS distcnt, avg(p_size) AS avgage
    FROM part WHERE p_brand <> 'Brand#1' GROUP BY ALL HAVING avg(p_size) <= 34
    ORDER BY agegroup, p_type DESC
""")
def dimensional_metrics(t):
    size = "p_size"
    return dim_metrics(
        t.part,
        [age_group(size).alias("agegroup"), "p_type"],
        {
            "cnt": F.count(size),
            "minage": F.min(size),
            "maxage": F.max(size),
            "distcnt": F.count_distinct(size),
            "avgage": F.avg(size),
        },
        where="p_brand <> 'Brand#1'",
        having="avgage <= 34",
        order=["agegroup", "-p_type"],
    )


@query("""
    SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS cnt
    FROM orders GROUP BY 1
""")
def monthly_amounts(t):
    monthly = dim_metrics(
        t.orders,
        [F.trunc("o_orderdate", "month").alias("month")],
        {"total": money_sum("o_totalprice", 2), "cnt": F.count("*")},
    )
    return portable(monthly)


@query("""
    SELECT o_custkey, mth, sumamt,
           lag(sumamt, 1, -1) OVER (PARTITION BY o_custkey ORDER BY mth) AS priormthamt
    FROM (SELECT o_custkey, CAST(month(o_orderdate) AS INTEGER) AS mth,
                 CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS sumamt
          FROM orders GROUP BY ALL)
""")
def month_over_month(t):
    return change_over_periods(
        t.orders,
        ["o_custkey"],
        {"mth": F.month("o_orderdate")},
        {"sumamt": money_sum("o_totalprice", 2)},
        "priormthamt",
        default=-1.0,
    )


@query("""
    SELECT c_mktsegment,
           CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS avgbal
    FROM customer WHERE upper(c_mktsegment) IN ('BUILDING', 'FURNITURE', 'MACHINERY')
    GROUP BY 1 HAVING avgbal > 4000 ORDER BY 1
""")
def avg_having_ordered(t):
    return dim_metrics(
        t.customer,
        ["c_mktsegment"],
        {"avgbal": money_avg("c_acctbal", 2)},
        where=F.upper("c_mktsegment").isin("BUILDING", "FURNITURE", "MACHINERY"),
        having="avgbal > 4000",
        order=["c_mktsegment"],
    )


_TOTALS = """
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS samt
    FROM {orders} GROUP BY o_custkey
"""


@query(f"SELECT max(samt) AS max_total FROM ({_TOTALS.format(orders='orders')})")
def max_of_grouped_sums(t):
    sums = t.orders.groupBy("o_custkey").agg(money_sum("o_totalprice", 2).alias("samt"))
    return sums.agg(F.max("samt").alias("max_total"))


_CTE = """
    WITH per_customer AS (
      SELECT o_custkey,
             CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS aamt,
             max(o_totalprice) AS mamt
      FROM {orders} GROUP BY o_custkey)
    SELECT o_custkey, aamt AS commonamt, CASE WHEN aamt > 0 THEN 'avgamt' ELSE '' END AS amttype
    FROM per_customer
    UNION
    SELECT o_custkey, mamt AS commonamt, CASE WHEN mamt > 0 THEN 'maxamt' ELSE '' END AS amttype
    FROM per_customer
"""


@query(_CTE.format(orders="orders"))
def cte_union(t):
    t.orders.createOrReplaceTempView("loomwork_orders")
    return t.spark.sql(_CTE.format(orders="loomwork_orders"))


_UNION_ALL = f"""
    SELECT * FROM ({_TOTALS}) a
    UNION ALL
    SELECT * FROM ({_TOTALS}) b WHERE samt > 2000000
"""


@query(_UNION_ALL.format(orders="orders"))
def union_all_views(t):
    t.orders.createOrReplaceTempView("loomwork_orders")
    return t.spark.sql(_UNION_ALL.format(orders="loomwork_orders"))
