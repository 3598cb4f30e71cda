"""Joins, lookups and membership."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.catalog.registry import portable, query
from loomwork.functions.dates import in_month
from loomwork.operators.joins import (
    grid,
    lookup,
    matched,
    not_in,
    rules_lookup,
    totals_per_key,
    unmatched,
)
from loomwork.operators.metrics import money_sum
from loomwork.operators.skew import skew_join


_COUNTED = "(SELECT DISTINCT o_custkey AS a FROM orders WHERE o_orderpriority <> '1-URGENT')"
_RICH = "(SELECT c_custkey AS b FROM customer WHERE c_acctbal > 0)"


@query(
    " UNION ALL ".join(
        f"SELECT '{how}' AS how, count(*) AS n FROM {_COUNTED} l {how} JOIN {_RICH} r ON a = b"
        for how in ("inner", "left", "right", "full")
    )
)
def join_row_counts(t):
    """Rows by join type over unique keys: full is left plus right less inner."""
    left = t.orders.where("o_orderpriority <> '1-URGENT'").select(F.col("o_custkey").alias("a")).distinct()
    right = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("b"))
    counts = [
        skew_join(left, right, [("a", "b")], how).agg(F.count(F.lit(1)).alias("n")).select(F.lit(how).alias("how"), "n")
        for how in ("inner", "left", "right", "full")
    ]
    return reduce(DataFrame.union, counts)


@query("""
    SELECT o_orderkey, o_totalprice, c_custkey, c_name
    FROM orders JOIN customer ON o_custkey = c_custkey
""")
def join_inner(t):
    return lookup(t.orders, t.customer, [("o_custkey", "c_custkey")], "inner").select(
        "o_orderkey", "o_totalprice", "c_custkey", "c_name"
    )


@query("""
    SELECT doc_id, lang, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)
""")
def join_shared_name(t):
    documents = t.documents.select("doc_id", "lang", "n_chars")
    return skew_join(documents, t.labels, ["doc_id"], "inner", hot="right")


@query("""
    SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, f.first_ship
    FROM lineitem l JOIN (
      SELECT l_orderkey, l_linenumber, min(l_shipdate) AS first_ship
      FROM lineitem GROUP BY ALL) f
    ON l.l_orderkey = f.l_orderkey AND l.l_linenumber = f.l_linenumber
""")
def join_multi_key(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    first = lines.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_shipdate").alias("first_ship"))
    joined = skew_join(lines, first, ["l_orderkey", "l_linenumber"], "inner", hot="left")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "first_ship")


@query("""
    SELECT o_orderkey, o_totalprice, CAST(l_partkey AS DOUBLE) AS l_partkey, l_quantity
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
""")
def join_left(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    joined = skew_join(t.orders, lines, [("o_orderkey", "l_orderkey")], "left", hot="right")
    return portable(
        joined.select("o_orderkey", "o_totalprice", "l_partkey", "l_quantity"), "l_partkey"
    )


@query("""
    SELECT CAST(l_partkey AS DOUBLE) AS l_partkey, l_quantity, o_orderkey, o_orderdate
    FROM lineitem RIGHT JOIN orders ON o_orderkey = l_orderkey
""")
def join_right(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    joined = skew_join(lines, t.orders, [("l_orderkey", "o_orderkey")], "right", hot="left")
    return portable(
        joined.select("l_partkey", "l_quantity", "o_orderkey", "o_orderdate"), "l_partkey"
    )


@query("""
    SELECT vec_id::DOUBLE AS vec_id, label::DOUBLE AS label, doc_id::DOUBLE AS doc_id,
           quality::DOUBLE AS quality
    FROM embeddings FULL JOIN labels ON vec_id = doc_id
""")
def join_full(t):
    joined = skew_join(
        t.embeddings.select("vec_id", "label"),
        t.labels.select("doc_id", "quality"),
        [("vec_id", "doc_id")],
        "full",
        hot="right",
    )
    return portable(joined, "vec_id", "label", "doc_id", "quality")


@query("""
    SELECT g.c_mktsegment, g.r_name, count(c_custkey) AS n
    FROM (SELECT * FROM (SELECT DISTINCT c_mktsegment FROM customer)
          CROSS JOIN (SELECT r_name, r_regionkey FROM region)) g
    LEFT JOIN (SELECT c_custkey, c_mktsegment, n_regionkey
               FROM customer JOIN nation ON c_nationkey = n_nationkey) c
    ON g.c_mktsegment = c.c_mktsegment AND g.r_regionkey = c.n_regionkey
    GROUP BY ALL
""")
def segment_region_grid(t):
    """Cross join of two short lists, as a scaffold that shows empty cells."""
    cells = grid(t.customer.select("c_mktsegment").distinct(), t.region)
    placed = lookup(t.customer, t.nation, [("c_nationkey", "n_nationkey")])
    counts = placed.groupBy("c_mktsegment", F.col("n_regionkey").alias("r_regionkey")).agg(
        F.count("*").alias("n")
    )
    return cells.join(counts, ["c_mktsegment", "r_regionkey"], "left").select(
        "c_mktsegment", "r_name", F.coalesce("n", F.lit(0)).alias("n")
    )


@query("""
    SELECT child.c_custkey, child.c_name, parent.c_name AS referrer
    FROM customer child JOIN customer parent ON child.c_custkey // 10 = parent.c_custkey
""")
def join_self(t):
    child = t.customer.select(
        "c_custkey", "c_name", F.expr("c_custkey div 10").alias("referrer_key")
    )
    parent = t.customer.select(
        F.col("c_custkey").alias("parent_key"), F.col("c_name").alias("referrer")
    )
    return skew_join(child, parent, [("referrer_key", "parent_key")], "inner", hot="left").select(
        "c_custkey", "c_name", "referrer"
    )


_SEMI = "SELECT * FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"


@query(_SEMI)
def join_semi(t):
    return matched(t.orders, t.lineitem, [("o_orderkey", "l_orderkey")])


@query("SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def join_anti(t):
    return unmatched(t.orders, t.lineitem, [("o_orderkey", "l_orderkey")])


@query(_SEMI)
def lookup_left_dedup(t):
    """The semi join written as left join, filter and dedup."""
    keys = t.lineitem.select("l_orderkey").distinct()
    joined = skew_join(t.orders, keys, [("o_orderkey", "l_orderkey")], "left", hot="left")
    return joined.where("l_orderkey is not null").drop("l_orderkey").dropDuplicates()


@query(_SEMI)
def lookup_inner_distinct(t):
    """The semi join written as inner join and distinct."""
    keys = t.lineitem.select("l_orderkey").distinct()
    joined = skew_join(t.orders, keys, [("o_orderkey", "l_orderkey")], "inner", hot="left")
    return joined.drop("l_orderkey").distinct()


@query(_SEMI)
def semi_join_by_sql(t):
    t.orders.createOrReplaceTempView("loomwork_orders")
    t.lineitem.select("l_orderkey").distinct().createOrReplaceTempView("loomwork_line_keys")
    return t.spark.sql(
        "SELECT o.* FROM loomwork_orders o SEMI JOIN loomwork_line_keys k ON o.o_orderkey = k.l_orderkey"
    )


@query("""
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
""")
def in_subquery(t):
    indebted = t.customer.where("c_acctbal < 0")
    return matched(t.orders, indebted, [("o_custkey", "c_custkey")]).select("o_orderkey", "o_custkey")


_LISTED = "SELECT CASE WHEN o_totalprice < {0} THEN NULL ELSE o_orderkey END FROM orders"


@query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_orderkey NOT IN ({_LISTED.format(2000)})
    UNION ALL SELECT -1, -1, (SELECT count(*) FROM lineitem)
""")
def not_in_with_null(t):
    """A null in the list leaves no row; a marker row tells that from a failed read."""
    listed = t.orders.select(
        F.when(F.col("o_totalprice") < 2000, None).otherwise(F.col("o_orderkey")).alias("k")
    )
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    marker = lines.agg(F.count("*").alias("l_partkey")).select(
        F.lit(-1).cast("long").alias("l_orderkey"), F.lit(-1).alias("l_linenumber"), "l_partkey"
    )
    return not_in(lines, "l_orderkey", listed, "k").unionByName(marker)


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
""")
def not_in_without_null(t):
    listed = t.orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"))
    return not_in(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey", listed, "k")


@query("""
    SELECT c_custkey, c_name, n_name, r_name
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
""")
def lookup_enrich(t):
    places = lookup(t.nation, t.region, [("n_regionkey", "r_regionkey")], "left")
    return lookup(t.customer, places, [("c_nationkey", "n_nationkey")], "left").select(
        "c_custkey", "c_name", "n_name", "r_name"
    )


_DECEMBER = "SELECT o_custkey FROM orders WHERE month(o_orderdate) = 12 AND year(o_orderdate) = 1998"


@query(f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN ({_DECEMBER})")
def active_customers(t):
    month = t.orders.where(in_month("o_orderdate", 1998, 12))
    return matched(t.customer, month, [("c_custkey", "o_custkey")]).select("c_custkey", "c_name")


@query(f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN ({_DECEMBER})")
def dormant_customers(t):
    month = t.orders.where(in_month("o_orderdate", 1998, 12))
    return unmatched(t.customer, month, [("c_custkey", "o_custkey")]).select("c_custkey", "c_name")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, o_orderdate, o_totalprice,
           c_name, c_mktsegment, n_name
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
""")
def denormalised(t):
    people = lookup(t.customer, t.nation, [("c_nationkey", "n_nationkey")]).select(
        "c_custkey", "c_name", "c_mktsegment", "n_name"
    )
    placed = lookup(t.orders, people, [("o_custkey", "c_custkey")])
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return skew_join(lines, placed, [("l_orderkey", "o_orderkey")], "inner", hot="left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "o_orderdate", "o_totalprice",
        "c_name", "c_mktsegment", "n_name",
    )


@query("""
    SELECT c_custkey, count(c_custkey) AS txn_cnt,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS txn_total
    FROM customer LEFT JOIN events ON c_custkey = user_id GROUP BY c_custkey
""")
def customer_totals_left(t):
    """Counting the left key gives 1, not 0, for customers without a match."""
    totals = totals_per_key(
        t.customer.select("c_custkey"),
        t.events,
        ("c_custkey", "user_id"),
        [F.count("*").alias("n"), money_sum("value", 2).alias("txn_total")],
        how="left",
    )
    return totals.select("c_custkey", F.coalesce("n", F.lit(1)).alias("txn_cnt"), "txn_total")


@query("""
    SELECT c_custkey, c_name, count(*) AS txn_cnt,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS txn_total
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name
""")
def customer_totals_inner(t):
    return totals_per_key(
        t.customer.select("c_custkey", "c_name"),
        t.orders,
        ("c_custkey", "o_custkey"),
        [F.count("*").alias("txn_cnt"), money_sum("o_totalprice", 2).alias("txn_total")],
        how="inner",
    )


# The most specific matching rule wins, null means any.
_RULES = [
    ("ASIA", "NATION_2", "BUILDING", 2),
    ("ASIA", "NATION_2", None, 4),
    ("ASIA", None, None, 17),
    ("EUROPE", "NATION_3", None, 5),
    ("EUROPE", None, None, 16),
    (None, None, None, 9),
]


@query("""
    SELECT c_custkey,
           CASE WHEN r_name = 'ASIA' AND n_name = 'NATION_2' AND c_mktsegment = 'BUILDING' THEN 2
                WHEN r_name = 'ASIA' AND n_name = 'NATION_2' THEN 4
                WHEN r_name = 'ASIA' THEN 17
                WHEN r_name = 'EUROPE' AND n_name = 'NATION_3' THEN 5
                WHEN r_name = 'EUROPE' THEN 16 ELSE 9 END AS rate
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def rules_by_place(t):
    rules = t.spark.createDataFrame(_RULES, "r_name STRING, n_name STRING, c_mktsegment STRING, rate INT")
    places = lookup(t.nation, t.region, [("n_regionkey", "r_regionkey")])
    people = lookup(t.customer, places, [("c_nationkey", "n_nationkey")])
    rated = rules_lookup(people, rules, ["r_name", "n_name", "c_mktsegment"], "rate", default=0)
    return rated.select("c_custkey", "rate")
