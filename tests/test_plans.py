"""Jobs, audit, and the shape of physical plans."""

import json

import pytest
from pyspark.sql import functions as F

from loomwork.catalog import REGISTRY
from loomwork.functions.dates import in_month
from loomwork.operators.windows import number_all
from loomwork.plans.audit import Audit
from loomwork.plans.batch import BatchSpec, csv_inputs, publish, run
from loomwork.plans.configured import query_sources, run_activities
from loomwork.session import scratch_path, shared_dir, stage
from loomwork.sources.files import SourceSpec, load
from loomwork.sources.sinks import SinkSpec

CUSTOMERS = """\
71,Oda,Quill,61,Shepherd
71,Oda,Quill,29,Shepherd
72,Bram,Vole,82,Therapist
73,Ines,,9,
seven,Tove,Marsh,50,Glazier
75,Ulf
,Nameless,None,44,Shepherd
"""
TXNS = """\
1,03-19-2022,71,75.20,Garden,Spades,Northwick,Westmark,card
1,02-19-2022,71,12.00,Garden,Spades,Northwick,Westmark,card
2,01-08-2022,72,310.15,Garden,Hoses,Eastbay,Westmark,card
3,04-30-2022,71,8.45,Kitchen,Ladles,Millford,Southmark,cash
4,soon,98,6.0,Toys,Kites,Millford,Southmark,cash
"""


@pytest.fixture()
def spec(tmp_path):
    (tmp_path / "cust.csv").write_text(CUSTOMERS)
    (tmp_path / "txns.csv").write_text(TXNS)
    inputs = csv_inputs(f"{tmp_path}/cust.csv", f"{tmp_path}/txns.csv")
    return BatchSpec(*inputs, run_ts="2024-01-02 03:04:05")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_batch_frames(spark, spec):
    frames = run(spark, spec)
    assert frames["customers"].count() == 5
    curated = {r.id: r for r in frames["curated"].collect()}
    assert set(curated) == {71, 72, 73}
    assert curated[71].custage == 61
    assert curated[72].nameprof == "Vole is a Physician"
    assert curated[72].custfname == "Vole"
    assert curated[73].custprofession == "prof not defined"
    assert curated[73].agegroup == "Children"
    assert (curated[71].curdtstr, curated[71].dtfmt) == ("24/01", "2024/01/02 00:00:00")
    assert [tuple(r) for r in frames["age_by_profession"].collect()] == [("Physician", 82.0), ("Shepherd", 61.0)]
    assert {r.id for r in frames["not_excluded"].collect()} == {71, 72}
    metrics = frames["age_metrics"].collect()
    assert [(r.custprofession, r.distinct_cnt_age) for r in metrics] == [("Shepherd", 1), ("Physician", 1)]
    assert {r.txnid: str(r.dt) for r in frames["transactions"].collect()} == {
        1: "2022-03-19", 2: "2022-01-08", 3: "2022-04-30", 4: "None",
    }
    numbered = sorted(frames["numbered"].collect(), key=lambda r: r.sno)
    assert [(r.sno, r.txnid, r.custage) for r in numbered] == [
        (1, 2, 82), (2, 1, 29), (3, 1, 61), (4, 3, 29), (5, 3, 61),
    ]
    assert len(frames["masked"].first().custlname) == 32
    assert frames["profile_summary"].count() == 8
    assert len(frames) == 13 and "age_metrics" in frames


def test_publish_with_audit(spark, spec, tmp_path):
    frames = run(spark, spec)
    audit = Audit(spark, f"{tmp_path}/audit", run_id="r1")
    sinks = {
        "customers": SinkSpec("parquet", f"{tmp_path}/c", partition_by=["custprofession"]),
        "masked": SinkSpec("csv", f"{tmp_path}/m"),
    }
    publish(frames, sinks, audit)
    assert spark.read.parquet(f"{tmp_path}/c").count() == 5
    with pytest.raises(Exception):
        publish(frames, {"masked": sinks["masked"]}, audit)
    rows = [(r.stage, r.status, r.error is None) for r in audit.entries().orderBy("started").collect()]
    assert rows == [("customers", "succeeded", True), ("masked", "succeeded", True), ("masked", "failed", False)]
    with pytest.raises(KeyError):
        publish(frames, {"nothing": sinks["masked"]})


def test_command_line(spark, tmp_path):
    from loomwork.plans.app import main

    (tmp_path / "cust.csv").write_text(CUSTOMERS)
    (tmp_path / "txns.csv").write_text(TXNS)
    out = f"{tmp_path}/out"
    assert main([f"{tmp_path}/cust.csv", f"{tmp_path}/txns.csv", out, "--run-ts", "2024-01-02 00:00:00"]) == 0
    assert spark.read.json(f"{out}/denormalised").count() == 5
    assert spark.read.parquet(f"{out}/age_metrics").count() == 2
    assert spark.read.json(f"{out}/audit").where("status = 'succeeded'").count() == 5
    with pytest.raises(SystemExit):
        main([])


def test_configured_jobs(spark, tmp_path):
    spark.range(5).withColumn("v", F.lit("a")).write.json(f"{tmp_path}/a")
    spark.range(5, 8).withColumn("v", F.lit("b")).write.orc(f"{tmp_path}/b")
    spec = {
        "select": ["id", "upper(v) as v"],
        "where": "id % 2 = 1",
        "sources": {
            "one": {"format": "json", "path": f"{tmp_path}/a", "schema": "id LONG, v STRING"},
            "two": {"format": "orc", "path": f"{tmp_path}/b"},
        },
    }
    rows = sorted(tuple(r) for r in query_sources(spark, json.dumps(spec)).collect())
    assert rows == [(1, "A", "one"), (3, "A", "one"), (5, "B", "two"), (7, "B", "two")]
    with pytest.raises(ValueError, match="read"):
        run_activities(spark, '[{"activity": "where", "condition": "true"}]')
    with pytest.raises(ValueError, match="unknown"):
        run_activities(
            spark, json.dumps([{"activity": "read", "format": "orc", "path": f"{tmp_path}/b"}, {"activity": "fly"}])
        )


def test_scratch_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == base
    assert scratch_path(spark, "x").startswith(base)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert stage(spark.range(3), "t").count() == 3


def test_filters_and_columns_reach_the_scan(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    plan = plan_of(orders.where(in_month("o_orderdate", 1998, 12)).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_partition_filter_prunes(spark, tmp_path):
    df = spark.range(9).select("id", (F.col("id") % 3).alias("day"))
    df.write.partitionBy("day").parquet(f"{tmp_path}/p")
    plan = plan_of(load(spark, SourceSpec("parquet", f"{tmp_path}/p")).where("day = 1"))
    assert "PartitionFilters: [isnotnull(day" in plan


@pytest.mark.parametrize(
    "name",
    ["segment_metrics", "join_left", "join_full", "join_semi", "denormalised", "customer_totals_left",
     "not_in_with_null", "intersect", "subtract", "second_highest", "upsert_by_key"],
)
def test_no_cartesian_products(spark, data, name):
    plan = plan_of(REGISTRY[name](spark, data))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_top_rows_are_reduced_before_the_shuffle(spark, data):
    plan = plan_of(REGISTRY["top_three_per_customer"](spark, data))
    assert plan.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan_of(REGISTRY["top_three_global"](spark, data))


def test_whole_table_numbering_has_no_single_task_sort(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet")
    plan = plan_of(number_all(orders, ["o_orderdate", "o_orderkey"]))
    single = plan.index("Exchange SinglePartition")
    # Only the one-row-per-segment summary passes through a single partition.
    assert "HashAggregate(keys=[_seg" in plan[single:]
    assert plan.count("Exchange SinglePartition") == 1


def test_set_operations_shuffle_once(spark, data):
    plan = plan_of(REGISTRY["subtract"](spark, data))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_bucketed_tables_join_without_a_shuffle(spark, data):
    plan = plan_of(REGISTRY["bucketed_join"](spark, data).hint("merge"))
    assert "Exchange hashpartitioning" not in plan


def test_catalogue_stays_out_of_python_workers(spark, data):
    """Python runs in the one query that shows an Arrow function, and nowhere else."""
    for name in ("age_band", "sql_registered_function", "word_count", "mask_md5", "batch_curated"):
        assert "Python" not in plan_of(REGISTRY[name](spark, data)), name
    assert "ArrowEvalPython" in plan_of(REGISTRY["arrow_function"](spark, data))
