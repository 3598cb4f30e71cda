"""Set operations, evolution and upserts."""

from pyspark.sql import functions as F

from loomwork.catalog.registry import portable, query
from loomwork.operators.columns import shared_columns
from loomwork.operators.evolve import combine, union_by_name, union_padded
from loomwork.operators.joins import upsert
from loomwork.operators import sets


def _keys(t):
    return (
        t.orders.select(F.col("o_orderkey").alias("k")),
        t.lineitem.select(F.col("l_orderkey").alias("k")),
    )


def _ids(t):
    return (
        t.embeddings.select(F.col("vec_id").alias("k")),
        t.labels.select(F.col("doc_id").alias("k")),
    )


@query("SELECT o_orderkey AS k FROM orders UNION ALL SELECT l_orderkey FROM lineitem")
def union_all(t):
    a, b = _keys(t)
    return a.union(b)


@query("SELECT o_custkey AS k FROM orders UNION SELECT l_orderkey FROM lineitem")
def union_distinct(t):
    _, b = _keys(t)
    return sets.union_distinct(t.orders.select(F.col("o_custkey").alias("k")), b)


@query("SELECT vec_id AS k FROM embeddings INTERSECT SELECT doc_id FROM labels")
def intersect(t):
    return sets.common_rows(*_ids(t))


@query("SELECT o_orderkey AS k FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def subtract(t):
    return sets.rows_only_in(*_keys(t))


@query("""
    (SELECT vec_id AS k FROM embeddings EXCEPT SELECT doc_id FROM labels) UNION ALL
    (SELECT doc_id AS k FROM labels EXCEPT SELECT vec_id FROM embeddings)
""")
def symmetric_difference(t):
    return sets.rows_in_one(*_ids(t))


@query("""
    SELECT bool_and(k IN (SELECT o_orderkey FROM orders)) AS subset,
           (SELECT bool_and(o_orderkey IN (SELECT l_orderkey FROM lineitem)) FROM orders) AS superset,
           NOT bool_or(k IN (SELECT o_orderkey FROM orders)) AS disjoint
    FROM (SELECT l_orderkey AS k FROM lineitem)
""")
def subset_and_disjoint(t):
    orders, lines = _keys(t)
    return sets.relation(lines, orders)


@query("""
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS nation
    FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, NULL, s_nationkey::DOUBLE FROM supplier
""")
def union_by_name_missing(t):
    people = t.customer.selectExpr("c_custkey as id", "c_name as name", "c_mktsegment as segment")
    firms = t.supplier.selectExpr("s_nationkey as nation", "s_name as name", "s_suppkey as id")
    return portable(union_by_name([people, firms]), "nation")


@query("""
    SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier
""")
def union_shared_columns(t):
    """Two layouts cut to the columns both have, in the order of the first."""
    people = t.customer.selectExpr("c_custkey as id", "c_name as name", "c_mktsegment as segment", "c_nationkey as nation")
    firms = t.supplier.selectExpr("s_nationkey as nation", "s_name as name", "s_suppkey as id")
    both = shared_columns(people, firms)
    return people.select(*both).union(firms.select(*both))


@query("""
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, -1 AS nation FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, '', s_nationkey FROM supplier
""")
def union_padded_columns(t):
    people = t.customer.selectExpr("c_custkey as id", "c_name as name", "c_mktsegment as segment")
    firms = t.supplier.selectExpr("s_nationkey as nation", "s_name as name", "s_suppkey as id")
    return union_padded(people, firms, {"segment": "", "nation": -1})


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS amt, o_orderstatus AS kind FROM orders
    UNION ALL
    SELECT event_type || '-' || CAST(event_id AS VARCHAR), value, NULL FROM events
""")
def evolve_type_clash(t):
    numeric = t.orders.selectExpr("o_orderkey as id", "o_totalprice as amt", "o_orderstatus as kind")
    textual = t.events.selectExpr("concat(event_type, '-', event_id) as id", "value as amt")
    return combine([numeric, textual])


@query("""
    SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment
    FROM customer WHERE c_acctbal >= 0
    UNION ALL
    SELECT c_custkey, 0.0, 'RESET' FROM customer WHERE c_acctbal < 0
    UNION ALL
    SELECT s_suppkey + 1000000000, s_acctbal, 'SUPPLIER' FROM supplier
""")
def upsert_by_key(t):
    base = t.customer.selectExpr("c_custkey as id", "c_acctbal as balance", "c_mktsegment as segment")
    reset = t.customer.where("c_acctbal < 0").selectExpr(
        "c_custkey as id", "0.0d as balance", "'RESET' as segment"
    )
    new = t.supplier.selectExpr(
        "s_suppkey + 1000000000 as id", "s_acctbal as balance", "'SUPPLIER' as segment"
    )
    return upsert(base, reset.unionByName(new), ["id"])
