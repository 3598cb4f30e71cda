"""Heavy-key paths give what the plain operators give, and spread the work."""

import itertools

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from compare import rows_of_spark
from loomwork.operators.joins import is_small, lookup, matched, not_in, unmatched
from loomwork.operators.skew import heavy_keys, skew_join
from loomwork.operators.windows import (
    nth_value_rows,
    number_all,
    number_rows,
    rank_rows,
    shift_rows,
    sort_columns,
)


def same(a, b):
    assert rows_of_spark(a.select(sorted(a.columns))) == rows_of_spark(b.select(sorted(b.columns)))


@pytest.fixture(scope="module")
def fact(spark):
    """One key, and the null key, hold a third of the rows each."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7).cast("long"))
        .when(F.col("id") % 3 == 1, F.lit(None).cast("long"))
        .otherwise(F.col("id") % 50)
    )
    rows = spark.range(0, 3000, 1, 6).select(
        "id", key.alias("k"), (F.col("id") % 11).alias("amt"), F.lit("same").alias("note")
    )
    return rows.repartition(6)


@pytest.fixture(scope="module")
def dim(spark):
    rows = [(i, f"n{i}") for i in range(0, 60) if i != 9] + [(None, "nobody"), (1000, "unused")]
    return spark.createDataFrame(rows, "dk LONG, name STRING")


def test_heavy_keys_are_found_and_bounded(fact):
    found = {r.k: r._slices for r in heavy_keys(fact, ["k"], group_rows=200).collect()}
    assert set(found) == {7, None}
    assert found[7] >= 5
    assert heavy_keys(fact, ["k"], group_rows=10_000) is None


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
@pytest.mark.parametrize("order", ["fact-left", "fact-right"])
def test_split_join_equals_plain_join(fact, dim, how, order):
    if order == "fact-left":
        split = skew_join(fact, dim, [("k", "dk")], how, hot="left", group_rows=100)
        plain = fact.join(dim, F.col("k") == F.col("dk"), how)
    else:
        split = skew_join(dim, fact, [("dk", "k")], how, hot="right", group_rows=100)
        plain = dim.join(fact, F.col("k") == F.col("dk"), how)
    same(split, plain)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
def test_split_join_on_a_shared_name(fact, dim, how):
    other = dim.withColumnRenamed("dk", "k")
    split = skew_join(fact, other, ["k"], how, group_rows=100)
    same(split, fact.join(other, ["k"], how))


def test_split_join_spreads_a_heavy_key_of_identical_rows(spark, dim, tmp_path):
    spark.range(0, 4000, 1, 8).select(F.lit(7).cast("long").alias("k")).write.parquet(f"{tmp_path}/c")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        copies = spark.read.parquet(f"{tmp_path}/c")
        joined = skew_join(copies, dim, [("k", "dk")], "inner", group_rows=500)
        tasks = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for name in ("files.openCostInBytes", "files.maxPartitionBytes", "autoBroadcastJoinThreshold"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in tasks) == 4000
    assert len(tasks) > 2
    assert max(r["count"] for r in tasks) <= 2500


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_semi", "left_anti"])
@pytest.mark.parametrize("on", ["shared", "apart", "mixed"])
def test_column_order_is_that_of_the_plain_join(spark, fact, dim, how, on):
    left = fact.select("id", "k", F.col("id").alias("m"), "amt")
    right = dim.select("name", F.col("dk").alias("k") if on != "apart" else "dk", F.lit(1).alias("m2"))
    pairs = {"shared": ["k"], "apart": [("k", "dk")], "mixed": ["k", ("m", "m2")]}[on]
    by_way = [skew_join(left, right, pairs, how, hot=hot, group_rows=n).columns for hot in ("left", "right") for n in (None, 0, 100, 10**9)]
    assert all(c == by_way[0] for c in by_way)
    if on == "shared":
        assert by_way[0] == left.join(right, ["k"], how).columns or how in ("left_semi", "left_anti")
    small = lookup(left, right, pairs, "inner", small_rows=10**6).columns
    assert small == lookup(left, right, pairs, "inner", small_rows=1).columns == skew_join(left, right, pairs).columns


@pytest.mark.parametrize("small_rows", [None, 1, 10**6])
def test_lookup_refuses_clashing_names_at_any_size(fact, small_rows):
    with pytest.raises(ValueError, match="rename"):
        lookup(fact, fact.select("k", "note"), ["k"], small_rows=small_rows)


def _jobs(spark, work):
    """Jobs and tasks that ``work`` starts, by Spark's own counts."""
    tracker, group = spark.sparkContext.statusTracker(), f"probe-{id(work)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = tracker.getJobIdsForGroup(group)
    stages = {s for j in jobs for s in tracker.getJobInfo(j).stageIds}
    return len(jobs), [tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)]


def test_smallness_is_found_without_reading_all(spark):
    wide = spark.range(0, 1_000_000, 1, 64)
    jobs, tasks = _jobs(spark, lambda: is_small(wide, 1000))
    assert not is_small(wide, 1000) and is_small(wide.limit(10), 1000)
    assert jobs == 1 and tasks == [1]


def test_joins_declare_without_jobs(spark, data, fact, dim):
    from loomwork.catalog import REGISTRY

    build = lambda: REGISTRY["segment_metrics"](spark, data)
    build()
    # Reading a Parquet footer is a job of its own; there are two tables.
    assert _jobs(spark, build)[0] <= 2
    assert _jobs(spark, lambda: skew_join(fact, dim, [("k", "dk")], "left"))[0] == 0
    assert _jobs(spark, lambda: lookup(fact, dim, [("k", "dk")]))[0] == 0


def test_names_on_both_sides_are_refused(fact):
    with pytest.raises(ValueError, match="rename"):
        skew_join(fact, fact, ["k"], "inner")


@pytest.mark.parametrize("order,ties", [(["amt"], ["id"]), (["-amt"], ["id"]), (["note"], ["id"])])
def test_split_ranks_equal_window_ranks(fact, order, ties):
    split = rank_rows(fact, ["k"], order, ties, group_rows=100)
    same(split, rank_rows(fact, ["k"], order, ties, group_rows=10**9))


def test_split_ranks_over_many_segments(spark, fact):
    """Tie groups longer than a segment, and segments with several tie groups."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for order in (["amt"], ["-amt"], ["note"]):
            split = rank_rows(fact, ["k"], order, ["id"], group_rows=100)
            same(split, rank_rows(fact, ["k"], order, ["id"], group_rows=10**9))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_split_numbers_and_shifts_equal_windows(spark, fact, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        numbered = number_rows(fact, ["k"], ["-amt", "id"], "n", group_rows=100)
        same(numbered, number_rows(fact, ["k"], ["-amt", "id"], "n", group_rows=10**9))
        columns = {"before": ("amt", 1, -5), "after": ("amt", -2, None), "who": ("note", 1, "none")}
        shifted = shift_rows(fact, ["k"], ["amt", "id"], columns, group_rows=100)
        same(shifted, shift_rows(fact, ["k"], ["amt", "id"], columns, group_rows=10**9))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_whole_table_numbers(spark, fact, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        numbered = number_all(fact, ["-amt", "id"], "n")
        window = Window.orderBy(*sort_columns(["-amt", "id"]))
        same(numbered, fact.withColumn("n", F.row_number().over(window).cast("long")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_copies_do_not_pile_up_in_one_segment(spark):
    """Rows equal in the whole sort order are still laid out over several tasks."""
    from loomwork.operators.windows import _segments

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        copies = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
        sizes = [r["count"] for r in _segments(copies, ["k"], ["v"]).groupBy("_seg").count().collect()]
        assert sum(sizes) == 4000 and max(sizes) <= 1000
        numbers = number_all(copies, ["k"], "n").select("n").distinct()
        assert numbers.count() == 4000
        ranks = rank_rows(copies, ["k"], ["v"], [], group_rows=100)
        assert ranks.select("rank_no", "dense_no").distinct().collect() == [(1, 1)]
        assert ranks.agg(F.max("row_no"), F.count_distinct("row_no")).first()[:] == (4000, 4000)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_large_n_per_key(fact):
    from loomwork.operators.windows import top_per_key

    window = Window.partitionBy("k").orderBy(*sort_columns(["-amt", "id"]))
    plain = fact.withColumn("n", F.row_number().over(window)).where("n <= 1500").drop("n")
    same(top_per_key(fact, ["k"], ["-amt", "id"], 1500), plain)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_rows_with_the_nth_value(fact, n):
    window = Window.partitionBy("k").orderBy(F.desc("amt"))
    plain = fact.withColumn("d", F.dense_rank().over(window)).where(F.col("d") == n).drop("d")
    same(nth_value_rows(fact, ["k"], "amt", n, group_rows=100), plain)


def test_lookup_without_a_small_side(fact, dim):
    for how in ("inner", "left"):
        plain = fact.join(dim, F.col("k") == F.col("dk"), how)
        same(lookup(fact, dim, [("k", "dk")], how, small_rows=3, group_rows=100), plain)
        same(lookup(fact, dim, [("k", "dk")], how), plain)
    assert is_small(dim, 61) and not is_small(dim, 60)


def test_membership(fact, dim):
    same(matched(dim, fact, [("dk", "k")]), dim.join(fact, F.col("k") == F.col("dk"), "left_semi"))
    same(unmatched(dim, fact, [("dk", "k")]), dim.join(fact, F.col("k") == F.col("dk"), "left_anti"))


@pytest.mark.parametrize("listed", [[], [None], [1, 2], [1, None]])
def test_not_in_follows_sql(spark, dim, listed):
    other = spark.createDataFrame([(v,) for v in listed], "v LONG")
    other.createOrReplaceTempView("listed")
    dim.createOrReplaceTempView("dim")
    plain = spark.sql("SELECT * FROM dim WHERE dk NOT IN (SELECT v FROM listed)")
    same(not_in(dim, "dk", other, "v"), plain)


def test_outer_joins_keep_the_row_count_rule(spark):
    """Unique keys: full = left + right - inner; 14 / 13 / 11 expected by join type."""
    left = spark.createDataFrame([(i,) for i in range(14)], "a LONG")
    right = spark.createDataFrame([(i,) for i in range(3, 16)], "b LONG")
    count = {
        how: skew_join(left, right, [("a", "b")], how).count()
        for how in ("inner", "left", "right", "full")
    }
    assert (count["left"], count["right"], count["inner"]) == (14, 13, 11)
    assert count["full"] == count["left"] + count["right"] - count["inner"]


def test_slices_do_not_depend_on_row_order(fact):
    """A retried task sees the same rows in any order and must place them alike."""
    from loomwork.operators.skew import _sliced, _renamed

    marks = _renamed(heavy_keys(fact, ["k"], 100), ["k"])
    once = {r.id: r._slice for r in _sliced(fact, ["k"], marks).collect()}
    by_amount = fact.sortWithinPartitions("amt", F.desc("id"))
    again = {r.id: r._slice for r in _sliced(by_amount, ["k"], marks).collect()}
    assert once == again
    assert len(set(itertools.chain(once.values()))) > 1
