"""The paths for heavy keys over whole tables.

No key of the test tables reaches the usual bound, so these queries lower it:
a key counts as heavy from ``SPLIT_ROWS`` rows on.  Each gives what its plain
counterpart gives.
"""

from loomwork.catalog.registry import REGISTRY, portable, query
from loomwork.operators.skew import skew_join
from loomwork.operators.windows import number_rows, rank_rows, shift_rows
import loomwork.catalog.joins  # noqa: F401  (their SQL is used below)
import loomwork.catalog.windows  # noqa: F401

SPLIT_ROWS = 12


@query(REGISTRY["join_inner"].sql)
def join_inner_split(t):
    joined = skew_join(t.orders, t.customer, [("o_custkey", "c_custkey")], "inner", hot="left", group_rows=SPLIT_ROWS)
    return joined.select("o_orderkey", "o_totalprice", "c_custkey", "c_name")


@query("""
    SELECT c_custkey, c_name, CAST(o_orderkey AS DOUBLE) AS o_orderkey
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey
""")
def join_left_split(t):
    sold = t.orders.select("o_custkey", "o_orderkey")
    joined = skew_join(t.customer, sold, [("c_custkey", "o_custkey")], "left", hot="right", group_rows=SPLIT_ROWS)
    return portable(joined.select("c_custkey", "c_name", "o_orderkey"), "o_orderkey")


@query("""
    SELECT CAST(c_custkey AS DOUBLE) AS c_custkey, CAST(event_id AS DOUBLE) AS event_id
    FROM customer FULL JOIN events ON c_custkey = user_id
""")
def join_full_split(t):
    seen = t.events.select("user_id", "event_id")
    people = t.customer.select("c_custkey")
    joined = skew_join(people, seen, [("c_custkey", "user_id")], "full", hot="right", group_rows=SPLIT_ROWS)
    return portable(joined.select("c_custkey", "event_id"), "c_custkey", "event_id")


@query("""
    SELECT o_custkey, o_orderkey,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n
    FROM orders
""")
def numbers_split(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    numbered = number_rows(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], "n", group_rows=SPLIT_ROWS)
    return numbered.select("o_custkey", "o_orderkey", "n")


@query("""
    SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS row_no,
           rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS rank_no,
           dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS dense_no
    FROM orders
""")
def ranks_split(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority")
    ranked = rank_rows(rows, ["o_custkey"], ["o_orderpriority"], ["o_orderkey"], group_rows=SPLIT_ROWS)
    return ranked.select("o_orderkey", "row_no", "rank_no", "dense_no")


@query("""
    SELECT o_orderkey, lag(o_totalprice, 1, 0.0::DOUBLE) OVER w AS earlier, lead(o_totalprice, 2, 0.0::DOUBLE) OVER w AS later
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def lag_lead_split(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    wanted = {"earlier": ("o_totalprice", 1, 0.0), "later": ("o_totalprice", -2, 0.0)}
    shifted = shift_rows(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], wanted, group_rows=SPLIT_ROWS)
    return shifted.select("o_orderkey", "earlier", "later")
