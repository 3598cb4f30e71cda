"""Whole jobs: the batch job, configured activities and one query over many sources."""

import json

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from loomwork.catalog.registry import portable, query
from loomwork.plans.audit import Audit
from loomwork.plans.batch import BatchSpec, csv_inputs, publish, run
from loomwork.plans.configured import query_sources, run_activities
from loomwork.session import scratch_path
from loomwork.sources.sinks import SinkSpec, save

_RUN_TS = "2024-03-05 10:20:30"
_AGE = "CAST(10 + c_nationkey * 2 AS SMALLINT)"
_PROFESSION = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'Therapist' WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END"


def _inputs(t, sales):
    """Customers, and orders on request, as the delimited files the batch job expects."""
    people = t.customer.selectExpr(
        "c_custkey as id",
        "substring_index(c_name, '#', 1) as custfname",
        "substring_index(c_name, '#', -1) as custlname",
        "cast(10 + c_nationkey * 2 as smallint) as custage",
        "case when c_mktsegment = 'BUILDING' then 'Therapist' when c_acctbal < 0 then null "
        "else c_mktsegment end as custprofession",
    )
    again = people.withColumn("custage", F.lit(5).cast("smallint"))
    sold = t.orders.selectExpr(
        "o_orderkey as txnid",
        "date_format(o_orderdate, 'MM-dd-yyyy') as dt",
        "o_custkey as custid",
        "o_totalprice as amt",
        "o_orderpriority as category",
        "o_orderstatus as product",
        "'c' as city",
        "'s' as state",
        "'card' as spendby",
    )
    left, right = scratch_path(t.spark, "batch-cust"), scratch_path(t.spark, "batch-txns")
    save(people.unionByName(again), SinkSpec("csv", left))
    if sales:
        save(sold, SinkSpec("csv", right))
    return csv_inputs(left, right)


def _run(t, sales=False):
    customers, transactions = _inputs(t, sales)
    return run(t.spark, BatchSpec(customers, transactions, _RUN_TS, min_profession_age=30, min_group_age=30))


# The duplicate of each customer is younger, so the original survives.
_CURATED = f"""
    SELECT id, prof AS custprofession, custage, 'Retail' AS src, '2024-03-05' AS curdt,
           lname || ' is a ' || prof AS nameprof, lname AS custfname, 2024 AS "year", '24/03' AS curdtstr,
           '2024/03/05 00:00:00' AS dtfmt,
           CASE WHEN custage < 13 THEN 'Children' WHEN custage <= 18 THEN 'Teen' ELSE 'Adults' END AS agegroup
    FROM (SELECT c_custkey AS id, split_part(c_name, '#', 2) AS lname, {_AGE} AS custage,
                 CASE coalesce({_PROFESSION}, 'na') WHEN 'Therapist' THEN 'Physician'
                   WHEN 'na' THEN 'prof not defined' ELSE coalesce({_PROFESSION}, 'na') END AS prof
          FROM customer)
"""


@query(_CURATED)
def batch_curated(t):
    rows = _run(t)["curated"].drop("loadts")
    return portable(rows.withColumn("id", F.col("id").cast("long")))


@query(f"""
    SELECT custprofession, avg(custage) AS avgage FROM ({_CURATED})
    GROUP BY 1 HAVING avg(custage) > 30 ORDER BY 1
""")
def batch_age_by_profession(t):
    return _run(t)["age_by_profession"]


@query(f"""
    SELECT "year", agegroup, custprofession, max(curdt) AS max_curdt, min(curdt) AS min_curdt,
           avg(custage) AS avg_custage, avg(custage) AS mean_age, count(DISTINCT custage) AS distinct_cnt_age
    FROM ({_CURATED}) WHERE agegroup <> 'Children' GROUP BY ALL HAVING avg(custage) > 30
""")
def batch_age_metrics(t):
    """Published to Parquet with an audit entry, then read back."""
    frames = _run(t)
    out = scratch_path(t.spark, "batch-out")
    audit = Audit(t.spark, f"{out}/audit")
    publish(frames, {"age_metrics": SinkSpec("parquet", f"{out}/age_metrics")}, audit)
    return portable(t.spark.read.parquet(f"{out}/age_metrics"))


@query("SELECT unnest(['age_metrics', 'no_such_column']) AS stage, unnest(['succeeded', 'failed']) AS status, unnest([false, true]) AS has_error")
def batch_audit(t):
    """Audit rows of a stage that was published and of one that failed."""
    frames = _run(t)
    out = scratch_path(t.spark, "batch-audit")
    audit = Audit(t.spark, f"{out}/audit")
    publish(frames, {"age_metrics": SinkSpec("parquet", f"{out}/age_metrics")}, audit)
    try:
        with audit.stage("no_such_column"):
            save(frames["curated"], SinkSpec("parquet", f"{out}/none", partition_by=["no_such_column"]))
    except AnalysisException:
        pass
    return audit.entries().select("stage", "status", F.col("error").isNotNull().alias("has_error"))


@query("""
    SELECT 'orders' AS stage, count(*) AS rows_in, count(*) FILTER (o_totalprice >= 1000) AS rows_out,
           count(*) FILTER (o_totalprice < 1000) AS rows_rejected FROM orders
""")
def batch_audit_counts(t):
    """Rows in, out and rejected of a stage, counted while it writes."""
    out = scratch_path(t.spark, "audit-counts")
    audit = Audit(t.spark, f"{out}/audit")
    poor = F.col("o_totalprice") < 1000
    with audit.stage("orders") as counts:
        rows = counts.watch(t.orders, "rows_in", rejected=poor)
        save(counts.watch(rows.where(~poor), "rows_out"), SinkSpec("parquet", f"{out}/orders"))
    return audit.entries().select("stage", "rows_in", "rows_out", "rows_rejected")


_JOINED = f"""
    SELECT o_orderkey AS txnid, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dt, c_custkey AS id, age AS custage,
           row_number() OVER (ORDER BY o_orderdate, o_orderkey, c_custkey, age) AS sno
    FROM orders JOIN (SELECT c_custkey, unnest([{_AGE}, 5::SMALLINT]) AS age FROM customer)
      ON o_custkey = c_custkey
"""


@query(_JOINED)
def batch_denormalised(t):
    """Raw customers joined with transactions, numbered by date."""
    rows = _run(t, sales=True)["numbered"].select("txnid", "dt", "id", "custage", "sno")
    return portable(rows.withColumns({c: F.col(c).cast("long") for c in ("txnid", "id")}))


@query("""
    SELECT md5(CAST(c_custkey AS VARCHAR)) AS id, c_name AS name, c_acctbal AS balance,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction' ELSE c_mktsegment END AS segment
    FROM customer WHERE c_acctbal > 0
""")
def configured_activities(t):
    source, target = scratch_path(t.spark, "act-in"), scratch_path(t.spark, "act-out")
    save(t.customer, SinkSpec("orc", source))
    steps = [
        {"activity": "read", "format": "orc", "path": source},
        {"activity": "where", "condition": "c_acctbal > 0"},
        {
            "activity": "select",
            "columns": ["c_custkey as id", "c_name as name", "c_acctbal as balance", "c_mktsegment as segment"],
        },
        {"activity": "keep_best", "keys": ["id"], "order": ["-balance"]},
        {"activity": "tidy", "rules": {"replace": {"segment": {"BUILDING": "Construction"}}}},
        {"activity": "mask", "columns": {"id": "md5"}},
        {"activity": "write", "format": "parquet", "path": target},
    ]
    run_activities(t.spark, json.dumps(steps))
    return t.spark.read.parquet(target)


@query("""
    SELECT c_custkey AS id, c_acctbal AS balance, 'people' AS source_name FROM customer WHERE c_acctbal > 1000
    UNION ALL
    SELECT s_suppkey, s_acctbal, 'firms' FROM supplier WHERE s_acctbal > 1000
""")
def query_many_sources(t):
    people, firms = scratch_path(t.spark, "src-people"), scratch_path(t.spark, "src-firms")
    save(t.customer.selectExpr("c_custkey as id", "c_acctbal as bal"), SinkSpec("orc", people))
    save(t.supplier.selectExpr("s_suppkey as id", "s_acctbal as bal"), SinkSpec("parquet", firms))
    spec = {
        "select": ["id", "bal as balance"],
        "where": "bal > 1000",
        "sources": {
            "people": {"format": "orc", "path": people},
            "firms": {"format": "parquet", "path": firms},
        },
    }
    return query_sources(t.spark, json.dumps(spec))
