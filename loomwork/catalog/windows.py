"""Row numbers, ranks, neighbours and top rows."""

from pyspark.sql import functions as F

from loomwork.catalog.registry import query
from loomwork.operators.windows import (
    first_rows,
    last_rows,
    nth_per_key,
    nth_value_rows,
    number_all,
    number_rows,
    rank_rows,
    shift_rows,
    sort_columns,
    top_per_key,
)

_ORDERS = "o_orderkey, o_custkey, o_totalprice, o_orderdate"


def _orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def _numbered(order, predicate, by="o_custkey"):
    return f"""
        SELECT {_ORDERS} FROM (
          SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS n FROM orders)
        WHERE {predicate}
    """


@query(f"SELECT {_ORDERS}, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS sno FROM orders")
def row_key_global(t):
    return number_all(_orders(t), ["o_orderdate", "o_orderkey"], "sno")


@query(f"""
    SELECT {_ORDERS},
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS transorder
    FROM orders
""")
def row_key_per_customer(t):
    return number_rows(_orders(t), ["o_custkey"], ["o_orderdate", "o_orderkey"], "transorder")


@query(_numbered("o_orderdate, o_orderkey", "n <= 3"))
def first_three(t):
    return top_per_key(_orders(t), ["o_custkey"], ["o_orderdate", "o_orderkey"], 3)


@query(_numbered("o_orderdate, o_orderkey", "n = 3"))
def third_only(t):
    return nth_per_key(_orders(t), ["o_custkey"], ["o_orderdate", "o_orderkey"], 3)


@query(_numbered("o_orderdate DESC, o_orderkey DESC", "n <= 3"))
def last_three(t):
    return top_per_key(_orders(t), ["o_custkey"], ["-o_orderdate", "-o_orderkey"], 3)


@query(_numbered("o_orderdate DESC, o_orderkey DESC", "n = 2"))
def penultimate(t):
    return nth_per_key(_orders(t), ["o_custkey"], ["-o_orderdate", "-o_orderkey"], 2)


@query(f"SELECT {_ORDERS} FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3")
def top_three_global(t):
    return first_rows(_orders(t), ["-o_totalprice", "o_orderkey"], 3)


@query(f"SELECT {_ORDERS} FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 3")
def bottom_three_global(t):
    return first_rows(_orders(t), ["o_totalprice", "o_orderkey"], 3)


@query(f"SELECT {_ORDERS} FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10")
def last_ten(t):
    return last_rows(_orders(t), ["o_orderdate", "o_orderkey"], 10)


@query(_numbered("o_totalprice DESC, o_orderkey", "n <= 3"))
def top_three_per_customer(t):
    return top_per_key(_orders(t), ["o_custkey"], ["-o_totalprice", "o_orderkey"], 3)


@query("""
    SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity,
           row_number() OVER (PARTITION BY l_suppkey
             ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey) AS row_no,
           rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS rank_no,
           dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS dense_no
    FROM lineitem
""")
def rank_compare(t):
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return rank_rows(
        lines, ["l_suppkey"], ["-l_quantity"], ["l_orderkey", "l_linenumber", "l_partkey"]
    )


def _by_dense_rank(n):
    return f"""
        SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM (
          SELECT *, dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS n
          FROM lineitem) WHERE n = {n}
    """


@query(_by_dense_rank(1))
def highest_with_ties(t):
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    return nth_value_rows(lines, ["l_suppkey"], "l_quantity", 1)


@query(_by_dense_rank(2))
def second_highest(t):
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity")
    return nth_value_rows(lines, ["l_suppkey"], "l_quantity", 2)


@query("""
    SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) AS n
      FROM orders) WHERE n = 1
""")
def newest_per_category(t):
    rows = t.orders.select("o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate")
    return top_per_key(rows, ["o_custkey", "o_orderpriority"], ["-o_orderdate", "-o_orderkey"])


_WINDOW = "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"


@query(f"""
    SELECT {_ORDERS}, lag(o_totalprice, 1, 0) OVER {_WINDOW} AS prioramt,
           lead(o_totalprice, 1, 0) OVER {_WINDOW} AS nextamt
    FROM orders
""")
def lag_lead(t):
    return shift_rows(
        _orders(t),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        {"prioramt": ("o_totalprice", 1, 0.0), "nextamt": ("o_totalprice", -1, 0.0)},
    )


# The three labels, prioramt, masked_custid and custcnt are names of the result.
_PATTERN = f"""
    SELECT o_orderkey, o_custkey, o_totalprice, prioramt,
           CASE WHEN prioramt = 0 THEN 'very first trans'
                WHEN prioramt < o_totalprice THEN 'purchase increased'
                ELSE 'purchase decreased' END AS purchase_pattern
    FROM (SELECT *, lag(o_totalprice, 1, 0) OVER {_WINDOW} AS prioramt FROM orders)
"""


def _patterns(t):
    shifted = shift_rows(
        _orders(t),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        {"prioramt": ("o_totalprice", 1, 0.0)},
    )
    prior = F.col("prioramt")
    label = (
        F.when(prior == 0, "very first trans")
        .when(prior < F.col("o_totalprice"), "purchase increased")
        .otherwise("purchase decreased")
    )
    return shifted.select(
        "o_orderkey", "o_custkey", "o_totalprice", "prioramt", label.alias("purchase_pattern")
    )


@query(_PATTERN)
def purchase_pattern(t):
    return _patterns(t)


@query(f"""
    SELECT o_custkey, purchase_pattern, count(*) AS custcnt FROM ({_PATTERN}) GROUP BY ALL
""")
def pattern_counts(t):
    return _patterns(t).groupBy("o_custkey", "purchase_pattern").agg(F.count("*").alias("custcnt"))


@query(f"""
    SELECT purchase_pattern, md5(CAST(o_custkey AS VARCHAR)) AS masked_custid, count(*) AS custcnt
    FROM ({_PATTERN}) GROUP BY o_custkey, purchase_pattern
""")
def masked_pattern_counts(t):
    counts = _patterns(t).groupBy("o_custkey", "purchase_pattern").agg(F.count("*").alias("custcnt"))
    return counts.select(
        "purchase_pattern", F.md5(F.col("o_custkey").cast("string")).alias("masked_custid"), "custcnt"
    )


@query("""
    SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer
    GROUP BY ALL ORDER BY c_mktsegment, n DESC, c_nationkey
""")
def sort_mixed(t):
    counts = t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))
    return counts.orderBy(*sort_columns(["c_mktsegment", "-n", "c_nationkey"]))
