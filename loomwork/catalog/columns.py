"""Projection and column standardisation."""

from pyspark.sql import functions as F

from loomwork.catalog.registry import portable, query
from loomwork.functions.nested import pick
from loomwork.operators.columns import (
    ColumnPlan,
    cast_columns,
    rename_columns,
    replace_column,
    reshape,
)


@query("SELECT c_mktsegment, c_custkey, c_name FROM customer")
def select_reorder(t):
    return t.customer.select("c_mktsegment", "c_custkey", "c_name")


@query("SELECT c_custkey AS custid, c_name AS custname, 'Retail' AS srcsystem FROM customer")
def literal_and_alias(t):
    return t.customer.select(
        F.col("c_custkey").alias("custid"),
        F.col("c_name").alias("custname"),
        F.lit("Retail").alias("srcsystem"),
    )


@query("""
    SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal, c_mktsegment AS profession
    FROM customer
""")
def rename_in_place(t):
    return rename_columns(
        t.customer, {"c_custkey": "id", "c_name": "name", "c_mktsegment": "profession"}
    )


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def drop_columns(t):
    return t.customer.drop("c_acctbal", "c_nationkey")


@query("SELECT c_custkey, c_mktsegment AS c_name, c_nationkey, c_acctbal FROM customer")
def replaced_column(t):
    return replace_column(t.customer, "c_name", "c_mktsegment")


@query("""
    SELECT c_custkey AS id, c_nationkey, c_mktsegment AS custname, 'Retail' AS srcsystem
    FROM customer
""")
def standardised_layout(t):
    return reshape(
        t.customer,
        ColumnPlan(
            keep=["c_custkey", "c_nationkey", "c_name", "c_mktsegment", "c_acctbal"],
            constants={"srcsystem": "Retail"},
            replace={"c_name": "c_mktsegment"},
            rename={"c_custkey": "id", "c_name": "custname"},
            drop=["c_acctbal"],
        ),
    )


@query("""
    SELECT c_custkey, c_mktsegment,
           CASE WHEN c_mktsegment LIKE '%MOBILE' THEN 'yes' ELSE 'no' END AS is_mobile,
           CAST(c_nationkey AS VARCHAR) AS nation_text
    FROM customer
""")
def expr_flags(t):
    return t.customer.selectExpr(
        "c_custkey",
        "c_mktsegment",
        "case when c_mktsegment like '%MOBILE' then 'yes' else 'no' end as is_mobile",
        "cast(c_nationkey as string) as nation_text",
    )


@query("SELECT *, '2002-01-01' AS loaddt, c_acctbal * 2 AS doubled FROM customer")
def all_plus_extras(t):
    extended = t.customer.select(
        "*",
        F.lit("2002-01-01").cast("date").alias("loaddt"),
        (F.col("c_acctbal") * 2).alias("doubled"),
    )
    return portable(extended)


@query("""
    SELECT p_brand AS brand, max(p_retailprice) AS max_rate, min(p_retailprice) AS min_rate
    FROM part GROUP BY p_brand
""")
def aggregate_renamed(t):
    rates = t.part.groupBy("p_brand").agg(
        F.max("p_retailprice").alias("max_rate"), F.min("p_retailprice").alias("min_rate")
    )
    return rates.withColumnRenamed("p_brand", "brand")


@query("SELECT c_custkey AS id, c_name AS full_name, c_mktsegment AS segment FROM customer")
def nested_fields(t):
    nested = t.customer.select(
        "c_custkey",
        F.struct(
            F.col("c_name").alias("name"), F.struct(F.col("c_mktsegment").alias("segment")).alias("job")
        ).alias("info"),
    )
    return pick(nested, {"id": "c_custkey", "full_name": "info.name", "segment": "info.job.segment"})


@query("SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nation, s_acctbal AS balance FROM supplier")
def named_columns(t):
    return t.supplier.toDF("id", "name", "nation", "balance")


@query("""
    SELECT o_orderkey, CAST(TRY_CAST(o_orderpriority AS INTEGER) AS DOUBLE) AS whole,
           TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS digit,
           CAST(o_totalprice AS FLOAT) AS price
    FROM orders
""")
def selective_cast(t):
    text = t.orders.select(
        "o_orderkey",
        F.col("o_orderpriority").alias("whole"),
        F.substring("o_orderpriority", 1, 1).alias("digit"),
        F.col("o_totalprice").alias("price"),
    )
    return portable(cast_columns(text, {"whole": "int", "digit": "int", "price": "float"}), "whole")
