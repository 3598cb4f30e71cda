"""Scalar expressions."""

from pyspark.sql import functions as F

from loomwork.catalog.registry import portable, query
from loomwork.functions import sql as sql_functions
from loomwork.functions.dates import date_parts as calendar
from loomwork.functions.dates import parse_date
from loomwork.functions.money import (
    compound_interest,
    coupon_percent,
    offer_price,
    simple_interest,
)
from loomwork.functions.nested import one_per_element, parse_json
from loomwork.functions.text import age_group, described, mail_address, mask, part_of, yes_no
from loomwork.operators.metrics import money_sum


@query("""
    SELECT event_id, upper(event_type) AS up, lower(upper(event_type)) AS low FROM events
""")
def case_functions(t):
    return t.events.select(
        "event_id", F.upper("event_type").alias("up"), F.lower(F.upper("event_type")).alias("low")
    )


@query("""
    SELECT c_custkey, c_name || ' is a ' || c_mktsegment AS nameprof,
           split_part(c_name || ' is a ' || c_mktsegment, ' ', 1) AS first_word,
           split_part(c_name, '#', 1) AS before_hash,
           CASE WHEN c_name || ' is a ' || c_mktsegment LIKE '%ING' THEN 'yes' ELSE 'no' END AS ends_ing,
           NULLIF(split_part(c_name, '#', 3), '') AS third
    FROM customer
""")
def name_split_concat(t):
    named = t.customer.withColumn("nameprof", described("c_name", "c_mktsegment"))
    return named.select(
        "c_custkey",
        "nameprof",
        part_of("nameprof", " ", 0).alias("first_word"),
        F.substring_index("c_name", "#", 1).alias("before_hash"),
        yes_no(F.col("nameprof").like("%ING")).alias("ends_ing"),
        part_of("c_name", "#", 2).alias("third"),
    )


@query("""
    SELECT o_orderkey, strftime(o_orderdate, '%m/%d') AS monthday,
           strftime(o_orderdate, '%Y/%m/%d %H:%M:%S') AS dtfmt,
           substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 4) AS yearstr,
           date_trunc('day', o_orderdate) AS tsfmt
    FROM orders
""")
def substr_format(t):
    day = F.to_date("o_orderdate").cast("string")
    return t.orders.select(
        "o_orderkey",
        F.concat(F.substring(day, 6, 2), F.lit("/"), F.substring(day, 9, 2)).alias("monthday"),
        F.date_format("o_orderdate", "yyyy/MM/dd HH:mm:ss").alias("dtfmt"),
        F.substring(day, 1, 4).alias("yearstr"),
        F.to_timestamp_ntz(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("yyyy-MM-dd")).alias(
            "tsfmt"
        ),
    )


@query("""
    SELECT c_custkey, coalesce(CASE WHEN c_acctbal >= 0 THEN c_name END, 'na') AS name,
           CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS grade
    FROM customer
""")
def coalesce_case(t):
    balance = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey",
        F.coalesce(F.when(balance >= 0, F.col("c_name")), F.lit("na")).alias("name"),
        F.when(balance < 0, "debt").when(balance < 5000, "low").otherwise("high").alias("grade"),
    )


@query("""
    SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS key_text, CAST(p_size AS SMALLINT) AS size16,
           CAST(TRY_CAST(p_name AS INTEGER) AS DOUBLE) AS not_a_number,
           CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) AS price_text
    FROM part
""")
def casts(t):
    typed = t.part.select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("key_text"),
        F.col("p_size").cast("smallint").alias("size16"),
        F.col("p_name").try_cast("int").alias("not_a_number"),
        F.col("p_retailprice").cast("decimal(10,2)").cast("string").alias("price_text"),
    )
    return portable(typed, "not_a_number")


@query("""
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr,
           CAST(month(o_orderdate) AS INTEGER) AS mth,
           CAST(last_day(o_orderdate) AS VARCHAR) AS lastday,
           CAST(CAST(o_orderdate AS DATE) + CAST(7 - dayofweek(o_orderdate) AS INTEGER) AS VARCHAR) AS nextsunday,
           CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dayofwk,
           CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS daytrunc
    FROM orders
""")
def date_parts(t):
    parts = [c.alias(n) for n, c in calendar("o_orderdate").items()]
    return portable(t.orders.select("o_orderkey", *parts))


@query("""
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 3 AS VARCHAR) AS threedays,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INTEGER) AS days_to
    FROM orders
""")
def date_shifts(t):
    run_date = F.lit("2002-01-01").cast("date")
    shifted = t.orders.select(
        "o_orderkey",
        F.date_add("o_orderdate", 3).alias("threedays"),
        F.datediff(run_date, "o_orderdate").alias("days_to"),
    )
    return portable(shifted)


@query("""
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE strftime(o_orderdate, '%m-%d-%Y') END AS dt,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS parsed
    FROM orders
""")
def text_date_parse(t):
    text = F.when(F.col("o_orderstatus") == "P", "pending").otherwise(
        F.date_format("o_orderdate", "MM-dd-yyyy")
    )
    dated = t.orders.select("o_orderkey", text.alias("dt"))
    return portable(dated.withColumn("parsed", parse_date("dt")))


@query("""
    SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k,
           CAST(NULL AS VARCHAR) AS absent
    FROM events
""")
def json_fields(t):
    parsed = t.events.select("event_id", parse_json("props", "k INT, absent STRING").alias("body"))
    return parsed.select("event_id", "body.k", "body.absent")


@query("""
    SELECT md5(CAST(c_custkey AS VARCHAR)) AS c_custkey, md5(c_name) AS c_name, c_mktsegment
    FROM customer
""")
def mask_md5(t):
    return mask(
        t.customer.select("c_custkey", "c_name", "c_mktsegment"),
        {"c_custkey": "md5", "c_name": "md5"},
    )


@query("SELECT c_custkey, sha256(c_name) AS c_name FROM customer")
def mask_sha2(t):
    return mask(t.customer.select("c_custkey", "c_name"), {"c_name": ("sha2", 256)})


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey,
           l_quantity + l_discount + l_tax AS total, l_partkey % 7 AS rest, l_quantity / 2 AS half
    FROM lineitem
""")
def arithmetic_columns(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_quantity") + F.col("l_discount") + F.col("l_tax")).alias("total"),
        (F.col("l_partkey") % 7).alias("rest"),
        (F.col("l_quantity") / 2).alias("half"),
    )


@query("SELECT count(*) AS n, count(*) AS ids FROM customer")
def surrogate_ids(t):
    """Ids whose values depend on the partitioning, but which never repeat."""
    keyed = t.customer.select(F.monotonically_increasing_id().alias("custsk"), "c_custkey")
    return keyed.agg(F.count("*").alias("n"), F.count_distinct("custsk").alias("ids"))


_BAND = "CASE WHEN p_size < 13 THEN 'Children' WHEN p_size <= 18 THEN 'Teen' ELSE 'Adults' END"


@query(f"SELECT p_partkey, p_size, {_BAND} AS agegroup FROM part")
def age_band(t):
    return t.part.select("p_partkey", "p_size", age_group("p_size").alias("agegroup"))


@query(f"SELECT {_BAND} AS agegroup, count(*) AS cnt FROM part GROUP BY 1")
def age_band_counts(t):
    return t.part.groupBy(age_group("p_size").alias("agegroup")).agg(F.count("*").alias("cnt"))


@query(f"SELECT p_partkey, {_BAND} AS agegroup, upper(p_name) AS name FROM part")
def sql_registered_function(t):
    sql_functions.register(t.spark)
    t.part.createOrReplaceTempView("loomwork_part")
    return t.spark.sql(
        "SELECT p_partkey, age_group(p_size) AS agegroup, to_upper(p_name) AS name FROM loomwork_part"
    )


@query("SELECT doc_id, strip_accents(text) AS text FROM documents")
def arrow_function(t):
    """Accents stripped in Arrow batches: Spark has no such expression."""
    return t.documents.select("doc_id", sql_functions.unaccented()("text").alias("text"))


@query("""
    SELECT o_orderkey, o_totalprice - least(o_totalprice * 10 / 100, 15000.0::DOUBLE) AS to_pay
    FROM orders
""")
def promo_capped(t):
    return t.orders.select(
        "o_orderkey", offer_price("o_totalprice", 10, cap=15000).alias("to_pay")
    )


@query("""
    SELECT o_orderkey, CAST(pct AS INTEGER) AS pct,
           o_totalprice - least(o_totalprice * pct / 100, 50.0::DOUBLE) AS to_pay
    FROM (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN 10 ELSE 5 END AS pct FROM orders)
""")
def coupon_discount(t):
    coupon = F.when(F.col("o_orderpriority") == "1-URGENT", "summer10").otherwise("none")
    coded = t.orders.withColumn("coupon", coupon).withColumn("pct", coupon_percent("coupon"))
    return coded.select(
        "o_orderkey", "pct", offer_price("o_totalprice", F.col("pct")).alias("to_pay")
    )


@query("""
    SELECT c_custkey, round(c_acctbal * pow(1.1, 12), 2) AS compounded,
           c_acctbal * 1.3 AS simple
    FROM customer
""")
def interest(t):
    return t.customer.select(
        "c_custkey",
        F.round(compound_interest("c_acctbal", 12), 2).alias("compounded"),
        simple_interest("c_acctbal", 3, 10).alias("simple"),
    )


@query("""
    SELECT c_custkey, lower(c_mktsegment) || split_part(c_name, '#', 2) || '@example.com' AS mail
    FROM customer
""")
def mail_addresses(t):
    parts = t.customer.select(
        "c_custkey",
        F.lower("c_mktsegment").alias("first"),
        part_of("c_name", "#", 1).alias("last"),
    )
    return parts.select("c_custkey", mail_address("first", "last").alias("mail"))


@query("""
    SELECT CAST(sum(CAST(o_totalprice + 1000 AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders WHERE o_totalprice > 100000
""")
def bonus_sum(t):
    raised = t.orders.where("o_totalprice > 100000").select(
        (F.col("o_totalprice") + 1000).alias("raised")
    )
    return raised.agg(money_sum("raised", 2).alias("total"))


@query("""
    SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, string_split(text, chr(10))[i] AS line
    FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
          FROM documents)
""")
def nested_explode(t):
    lines = t.documents.select("doc_id", F.split("text", "\n").alias("lines"))
    return one_per_element(lines, "lines", "line", position="line_no")


@query("SELECT c_custkey, c_custkey AS item FROM customer UNION ALL SELECT c_custkey, c_nationkey FROM customer")
def map_and_array_access(t):
    nested = t.customer.select(
        "c_custkey",
        F.create_map(F.lit("nation"), F.col("c_nationkey").cast("long")).alias("info"),
    )
    listed = nested.select("c_custkey", F.array("c_custkey", F.col("info")["nation"]).alias("items"))
    return one_per_element(listed, "items", "item")
