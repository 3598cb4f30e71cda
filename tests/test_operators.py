"""Cleansing, columns, expressions, sets and text on hand-made rows."""

import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomwork.functions import sql as sql_functions
from loomwork.functions.dates import date_parts, in_month, is_month_end, is_month_start, parse_date
from loomwork.functions.money import compound_interest, coupon_percent, offer_price, simple_interest
from loomwork.functions.nested import one_per_element, pick
from loomwork.functions.text import age_group, band, described, mail_address, mask, part_of
from loomwork.operators import quality, sets
from loomwork.operators.cleanse import (
    TidyRules,
    distinct_complete,
    is_not_numeric,
    keep_best,
    replace_from,
    require_not_null,
    tidy,
    wide_enough,
)
from loomwork.operators.columns import (
    ColumnPlan,
    rename_columns,
    replace_column,
    reshape,
    shared_columns,
)
from loomwork.operators.joins import grid, rules_lookup, upsert
from loomwork.operators.layout import broadcast_small, cached, cut_lineage, layout, partition_sizes
from loomwork.operators.profile import frequent_exact, frequent_values, profile, sample_by_hash
from loomwork.operators.text import (
    LINE_ORDER,
    line_order,
    split_columns,
    tokens,
    without_header,
    word_count,
    zip_rows,
)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def people(spark):
    rows = [
        (4, "Ann", "Lee", 30, "Pilot"),
        (4, "Ann", "Lee", 41, "Pilot"),
        (4, "Ann", "Lee", 41, "Pilot"),
        (2, "Bob", None, 12, "Therapist"),
        (None, "Eve", "Fox", 20, None),
        (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, "id INT, fname STRING, lname STRING, age INT, prof STRING")


def test_keep_best_is_deterministic_and_idempotent(people):
    order = ["-age", "fname", "lname", "prof"]
    once = keep_best(people, ["id"], order)
    assert values(once.where("id = 4")) == [(4, "Ann", "Lee", 41, "Pilot")]
    assert values(keep_best(once, ["id"], order)) == values(once)
    assert people.distinct().count() == 5


def test_tidy_stays_in_one_stage(people):
    rules = TidyRules(
        drop_any=["id"],
        fill={"lname": "na", "prof": "na"},
        replace={"prof": {"Therapist": "Physician", "na": "prof not defined"}},
    )
    done = tidy(people, rules)
    assert values(done.distinct()) == [
        (2, "Bob", "na", 12, "Physician"),
        (4, "Ann", "Lee", 30, "Pilot"),
        (4, "Ann", "Lee", 41, "Pilot"),
    ]
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()


def test_null_rules(people):
    assert people.na.drop("all").count() == 5
    assert people.na.drop("any").count() == 3
    assert people.na.drop(thresh=3).count() == 5
    assert distinct_complete(people).count() == 2
    assert tidy(people, TidyRules(drop_all=["lname", "prof"])).count() == 5


def test_require_not_null(people):
    with pytest.raises(Exception, match="null in required column id"):
        require_not_null(people, ["id"]).collect()
    assert require_not_null(people.where("id is not null"), ["id"]).count() == 4


def test_not_numeric(spark):
    df = spark.createDataFrame([("12",), ("ten",), ("4x",), (None,)], "v STRING")
    assert values(df.where(is_not_numeric(F.col("v")))) == [("4x",), ("ten",)]


def test_replace_from_table(spark, people):
    mapping = spark.createDataFrame([("Pilot", "Captain")], "old STRING, new STRING")
    assert {r.prof for r in replace_from(people, "prof", mapping, "old", "new").collect()} == {
        "Captain", "Therapist", None,
    }


def test_column_layout(people):
    assert replace_column(people, "fname", "lname").columns == ["id", "fname", "age", "prof"]
    with pytest.raises(ValueError, match="taken"):
        rename_columns(people, {"lname": "fname"})
    plan = ColumnPlan(keep=["id", "lname", "fname"], constants={"src": "Retail"}, replace={"fname": "lname"})
    assert reshape(people, plan).columns == ["id", "fname", "src"]
    assert shared_columns(people, people.select("age", "id")) == ["id", "age"]


def test_quality_in_one_pass(spark, people):
    report = {r.column_name: r for r in quality.quality_report(people, ["id", "prof"]).collect()}
    assert report["id"].present_rows == 4 and report["id"].distinct_values == 2
    assert report["prof"].completeness_pct == pytest.approx(4 / 6 * 100)
    assert quality.uniqueness_pct(people, ["id", "prof"]).first()[0] == pytest.approx(50.0)
    assert quality.completeness_pct(people, ["id", "prof"]).first()[0] == pytest.approx(200 / 3)
    assert quality.quality_report(people.limit(0), ["id"]).first().completeness_pct is None
    text = spark.createDataFrame([("1",), ("1",), ("x",), (None,)], "k STRING")
    assert tuple(quality.key_checks(text, "k", "int").first()) == (4, 2, 1, 1)
    approx = quality.quality_report(people, ["id"], approx=True).first()
    assert approx.distinct_values == 2


def test_bands(spark):
    ages = spark.createDataFrame([(5,), (12,), (13,), (18,), (19,), (None,)], "age INT")
    groups = {r.age: r.g for r in ages.select("age", age_group("age").alias("g")).collect()}
    assert groups == {5: "Children", 12: "Children", 13: "Teen", 18: "Teen", 19: "Adults", None: None}
    with pytest.raises(ValueError):
        band("age", [1], ["only"])


def test_sql_functions_are_inlined(spark):
    sql_functions.register(spark)
    df = spark.sql("SELECT age_group(CAST(id AS INT)) AS g, to_upper('a') AS u FROM range(12, 20)")
    assert {r.g for r in df.collect()} == {"Children", "Teen", "Adults"}
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    arrow = spark.sql("SELECT 'áb̂ ñ' AS v").select(sql_functions.unaccented()("v").alias("v"))
    assert arrow.first().v == "ab n"


def test_accents_are_stripped_in_bounded_parts(spark):
    """A worker holds a part of a batch as Python strings, not the batch; rows stay whole and in order."""
    rest = "plain words " * 8_000
    texts = [None, "", "é" + "x" * 3_000_000, *(f"{i} àé ñ b\u0302 {rest}" for i in range(200)), None]
    plain = [None, "", "e" + "x" * 3_000_000, *(f"{i} ae n b {rest}" for i in range(200)), None]
    batch, longest = pa.array(texts[3:], pa.string()), 0
    strip, done = sql_functions.unaccented().func, []
    tracemalloc.start()
    for part in strip(iter([batch, batch])):
        longest = max(longest, part.nbytes)
        done.append(part)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert pa.concat_arrays(done).to_pylist() == 2 * plain[3:]
    assert batch.nbytes > 16e6
    assert longest < 4e6
    assert most < 8e6

    rows = spark.createDataFrame([*enumerate(texts)], "id INT, v STRING").coalesce(1)
    arrow = rows.select("id", sql_functions.unaccented()("v").alias("v")).collect()
    assert [r.v for r in sorted(arrow)] == plain


def test_offers_and_interest(spark):
    df = spark.createDataFrame([(800.0, "summer10"), (400.0, "summer10"), (800.0, "none")], "a DOUBLE, c STRING")
    paid = df.select(offer_price("a", coupon_percent("c")).alias("p"))
    assert sorted(r.p for r in paid.collect()) == [360.0, 750.0, 760.0]
    grown = spark.createDataFrame([(1000.0,)], "a DOUBLE").select(
        compound_interest("a", 3), simple_interest("a", 3, 10)
    )
    assert tuple(grown.first()) == (pytest.approx(1331.0), pytest.approx(1300.0))


def test_dates(spark):
    df = spark.createDataFrame([("06-26-2011",), ("2011-06-26",), ("13-40-2011",), (None,)], "d STRING")
    assert [str(r.p) for r in df.select(parse_date("d").alias("p")).collect()] == ["2011-06-26", "None", "None", "None"]
    day = df.limit(1).select(parse_date("d").alias("d"))
    parts = day.select(*[c.alias(n) for n, c in date_parts("d").items()]).first()
    assert (parts.yr, parts.mth, parts.dayofwk) == (2011, 6, 1)
    assert (str(parts.lastday), str(parts.nextsunday), str(parts.daytrunc)) == (
        "2011-06-30", "2011-07-03", "2011-06-01",
    )
    edges = spark.sql("SELECT explode(array(date'2011-12-01', date'2011-12-31', date'2012-01-01')) AS d")
    assert edges.where(in_month("d", 2011, 12)).count() == 2
    assert edges.where(is_month_start("d")).count() == 2
    assert edges.where(is_month_end("d")).count() == 1


def test_text_expressions(spark, people):
    made = people.where("id = 2").select(
        described("fname", "prof").alias("d"), mail_address("fname", "prof", "@x").alias("m")
    )
    assert tuple(made.first()) == ("Bob is a Therapist", "BobTherapist@x")
    assert people.where("id is null").select(described("fname", "prof")).distinct().count() == 1
    assert made.select(part_of("d", " ", 0), part_of("d", " ", 9)).first()[:] == ("Bob", None)


def test_masked_keys_still_join(people):
    ids = people.where("id is not null").select("id")
    hidden = mask(ids, {"id": "md5"})
    assert hidden.join(hidden.distinct(), "id").count() == ids.count()
    assert len(mask(ids, {"id": ("sha2", 512)}).first().id) == 128
    with pytest.raises(ValueError):
        mask(ids, {"id": "rot13"})


def test_nested_rows(spark, tmp_path):
    (tmp_path / "family.json").write_text(
        '{"id":1,"name":"Madison","members":[{"gender":"male","relation":"self","info":{"title":"Ms"}},'
        '{"gender":"female","relation":"spouse","info":{"title":"Mrs","hobby":"reading"}}]}'
    )
    schema = "id INT, name STRING, members ARRAY<STRUCT<gender STRING, relation STRING, info STRUCT<title STRING, hobby STRING>>>"
    df = spark.read.schema(schema).json(str(tmp_path))
    assert df.select(F.col("members")[0]["info"]["title"]).first()[0] == "Ms"
    members = one_per_element(df, "members", "m", position="i")
    flat = pick(members, {"id": "id", "i": "i", "relation": "m.relation", "hobby": "m.info.hobby"})
    assert values(flat) == [(1, 0, "self", None), (1, 1, "spouse", "reading")]


def test_sets(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k INT, v STRING")
    b = spark.createDataFrame([(1, None), (3, "y"), (3, "y"), (9, "z")], "k INT, v STRING")
    assert values(sets.common_rows(a, b)) == values(a.intersect(b))
    assert values(sets.rows_only_in(a, b)) == values(a.subtract(b))
    assert values(sets.union_distinct(a, b)) == values(a.union(b).distinct())
    assert values(sets.rows_in_one(a, b)) == [(2, "x"), (9, "z")]
    assert sets.relation(a.where("k = 1"), b).first().asDict() == {
        "subset": True, "superset": False, "disjoint": False,
    }
    assert sets.relation(a.where("k = 2"), b).first().disjoint
    assert sets.relation(a.limit(0), b).first().subset


def test_upsert_and_rules(spark):
    base = spark.createDataFrame([("cara", 10), ("abel", 20)], "name STRING, pay INT")
    changes = spark.createDataFrame([("paul", 25), ("cara", 12)], "name STRING, pay INT")
    once = upsert(base, changes, ["name"])
    assert values(once) == [("abel", 20), ("cara", 12), ("paul", 25)]
    assert values(upsert(once, changes, ["name"])) == values(once)
    rules = spark.createDataFrame(
        [("north", "Ulm", "dock", 3), ("north", "Ulm", None, 6), ("north", None, None, 11)],
        "zone STRING, town STRING, quarter STRING, rate INT",
    )
    places = spark.createDataFrame(
        [("north", "Ulm", "dock"), ("north", "Ulm", "hill"), ("north", "Kiel", "x"), ("west", "y", "z"), (None, None, None)],
        "zone STRING, town STRING, quarter STRING",
    )
    levels = ["zone", "town", "quarter"]
    rated = rules_lookup(places, rules, levels, "rate", default=0)
    assert rated.columns == [*levels, "rate"]
    assert sorted(r.rate for r in rated.collect()) == [0, 0, 3, 6, 11]
    everywhere = rules.unionByName(spark.createDataFrame([(None, None, None, 8)], rules.schema))
    assert sorted(r.rate for r in rules_lookup(places, everywhere, levels, "rate", default=0).collect()) == [3, 6, 8, 8, 11]
    for bad in ((None, "Ulm", None, 1), ("north", "Ulm", None, 7)):
        with pytest.raises(ValueError):
            rules_lookup(places, rules.unionByName(spark.createDataFrame([bad], rules.schema)), levels, "rate")


def test_rules_of_any_length(spark):
    rules = spark.range(30_000).select(F.col("id").cast("string").alias("zone"), F.col("id").alias("rate"))
    places = spark.createDataFrame([("7",), ("29999",), ("none",)], "zone STRING")
    assert sorted(r.rate for r in rules_lookup(places, rules, ["zone"], "rate", default=-1).collect()) == [-1, 7, 29999]


def test_grid_bounds_its_cells(spark):
    assert grid(spark.range(2), spark.range(3).toDF("b")).count() == 6
    assert grid(spark.range(0), spark.range(3).toDF("b")).count() == 0
    assert grid(spark.range(10), spark.range(10).toDF("b"), max_cells=100).count() == 100
    with pytest.raises(ValueError):
        grid(spark.range(10), spark.range(11).toDF("b"), max_cells=100)


def test_tokens_and_counts(spark, tmp_path):
    (tmp_path / "words").write_text("loom weft loom\nweft warp\n")
    lines = spark.read.text(str(tmp_path / "words"))
    assert tokens(lines, "value").count() == 5
    assert values(word_count(lines, "value")) == [("loom", 2), ("warp", 1), ("weft", 2)]


def test_ragged_lines(spark):
    lines = spark.createDataFrame([("Ida,Turin,52,2031-02-14,640",), ("Kai,29,2031-02-15,8",)], "value STRING")
    assert wide_enough(lines, "value", ",", 5).count() == 1
    typed = split_columns(lines, "value", ",", [("name", "string"), ("city", "string"), ("age", "int"), ("day", "date"), ("amt", "int")])
    assert [r.amt for r in typed.orderBy("name").collect()] == [640, None]
    assert without_header(lines, "value", "Kai,29,2031-02-15,8").count() == 1


def test_separators_are_literal(spark):
    df = spark.createDataFrame([("a|b.c||d",)], "v STRING")
    assert df.select(part_of("v", "|", 1), part_of("v", ".", 1), part_of("v", "||", 1)).first()[:] == (
        "b.c", "c||d", "d",
    )
    assert tokens(df, "v", "|").count() == 4


def test_keyless_files_zip_by_line(spark, tmp_path):
    (tmp_path / "names").write_text("".join(f"{i},n{i}\n" for i in range(500)))
    (tmp_path / "cities").write_text("".join(f"city{i}\n" for i in range(499)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        names = line_order(spark.read.text(str(tmp_path / "names"))).withColumnRenamed("value", "name")
        cities = line_order(spark.read.text(str(tmp_path / "cities"))).withColumnRenamed("value", "city")
        zipped = zip_rows(
            names, cities.withColumnsRenamed({c: f"c{c}" for c in LINE_ORDER}),
            LINE_ORDER, [f"c{c}" for c in LINE_ORDER],
        ).select("row_no", "name", "city").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rows = sorted(zipped, key=lambda r: r.row_no)
    assert len(rows) == 500
    assert all(r.name == f"{i},n{i}" and r.city == f"city{i}" for i, r in enumerate(rows[:-1]))
    assert rows[-1].city is None


def test_profile_and_samples(spark):
    df = spark.range(0, 1000, 1, 4).select("id", (F.col("id") * 2).alias("d"), F.lit("x").alias("c"))
    found = profile(df, [("id", "d")], ["c"])
    pair = found["pairs"].first()
    assert pair.correlation == pytest.approx(1.0) and pair.covariance == pytest.approx(df.cov("id", "d"))
    assert found["summary"].count() == 8
    assert "x" in frequent_values(df, ["c"], 0.4).first()[0]
    assert sample_by_hash(df, "id", 1).count() == 1000 and sample_by_hash(df, "id", 0).count() == 0
    assert sample_by_hash(spark.range(200_000), "id", 1e-4).count() in range(5, 60)
    assert sample_by_hash(df.withColumn("none", F.lit(None)), "none", 1).count() == 1000
    with pytest.raises(ValueError):
        sample_by_hash(df, "id", 1.5)
    nulls = df.select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"))
    assert values(frequent_exact(nulls, "v", 0.4)) == [(None, 500)]
    sampled = sample_by_hash(df, "id", 0.2)
    assert 120 < sampled.count() < 280
    assert values(sample_by_hash(df.repartition(7), "id", 0.2)) == values(sampled)


def test_layout(spark):
    df = spark.range(0, 1000, 1, 8)
    assert layout(df, 3).rdd.getNumPartitions() == 3
    assert layout(df, 2, shrink=True).rdd.getNumPartitions() == 2
    assert layout(df).count() == 1000
    with pytest.raises(ValueError):
        layout(df, shrink=True)
    assert partition_sizes(df).agg(F.sum("n")).first()[0] == 1000
    with cached(df) as kept:
        assert kept.is_cached
    assert not df.is_cached
    assert cut_lineage(df.where("id > 5")).count() == 994
    assert broadcast_small(df, 10) is df
    assert broadcast_small(df, 1000) is not df
