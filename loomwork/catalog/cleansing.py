"""Cleansing, de-duplication, quality and profiling."""

from pyspark.sql import functions as F

from loomwork.catalog.registry import query
from loomwork.operators.cleanse import (
    TidyRules,
    distinct_complete,
    keep_best,
    replace_from,
    tidy,
)
from loomwork.operators.profile import (
    frequent_exact,
    frequent_values,
    pair_statistics,
    profile,
    sample_by_hash,
    sample_rows,
)
from loomwork.operators.quantiles import summary_table
from loomwork.operators import quality

# The tables hold no nulls, so these queries make some by rule.
_GAPS = """
    (SELECT c_custkey AS id, CASE WHEN c_acctbal >= 0 THEN c_name END AS name,
            CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment,
            CASE WHEN c_acctbal < 9000 THEN c_acctbal END AS balance
     FROM customer)
"""


def _gaps(t):
    return t.customer.selectExpr(
        "c_custkey as id",
        "case when c_acctbal >= 0 then c_name end as name",
        "case when c_mktsegment <> 'BUILDING' then c_mktsegment end as segment",
        "case when c_acctbal < 9000 then c_acctbal end as balance",
    )


@query("SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def dedup_rows(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag").distinct()


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_arbitrary(t):
    """One row per key, whichever comes first, so only the keys can be compared."""
    survivors = t.lineitem.dropDuplicates(["l_orderkey", "l_linenumber"])
    return survivors.select("l_orderkey", "l_linenumber")


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_partkey, l_suppkey FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_quantity DESC, l_extendedprice DESC, l_partkey, l_suppkey) AS n
      FROM lineitem) WHERE n = 1
""")
def dedup_best(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_partkey", "l_suppkey"
    )
    order = ["-l_quantity", "-l_extendedprice", "l_partkey", "l_suppkey"]
    return keep_best(lines, ["l_orderkey", "l_linenumber"], order)


@query(f"SELECT * FROM {_GAPS} WHERE id IS NOT NULL AND name IS NOT NULL AND segment IS NOT NULL AND balance IS NOT NULL")
def na_drop_any(t):
    return _gaps(t).na.drop("any")


@query(f"SELECT name, segment FROM {_GAPS} WHERE name IS NOT NULL OR segment IS NOT NULL")
def na_drop_all(t):
    return _gaps(t).select("name", "segment").na.drop("all")


@query(f"SELECT * FROM {_GAPS} WHERE name IS NOT NULL AND segment IS NOT NULL")
def na_drop_subset(t):
    return _gaps(t).na.drop("any", subset=["name", "segment"])


@query(f"""
    SELECT * FROM {_GAPS}
    WHERE (name IS NOT NULL)::INT + (segment IS NOT NULL)::INT + (balance IS NOT NULL)::INT >= 2
""")
def na_drop_thresh(t):
    return _gaps(t).na.drop(thresh=2, subset=["name", "segment", "balance"])


@query(f"""
    SELECT id, coalesce(name, 'na') AS name, coalesce(segment, 'none') AS segment,
           coalesce(balance, -1) AS balance FROM {_GAPS}
""")
def fill_nulls(t):
    return _gaps(t).na.fill({"name": "na", "segment": "none", "balance": -1.0})


@query("""
    SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Construction'
             WHEN 'MACHINERY' THEN 'Tools' ELSE c_mktsegment END AS c_mktsegment
    FROM customer
""")
def replace_values(t):
    return t.customer.select("c_custkey", "c_mktsegment").na.replace(
        {"BUILDING": "Construction", "MACHINERY": "Tools"}, subset=["c_mktsegment"]
    )


@query("""
    SELECT o_orderkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS cust
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0
""")
def replace_from_table(t):
    coded = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("cust"))
    names = t.customer.where("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("code"), "c_name"
    )
    return replace_from(coded, "cust", names, "code", "c_name")


@query(f"""
    SELECT id, name,
           CASE coalesce(segment, 'na') WHEN 'na' THEN 'not defined'
             WHEN 'MACHINERY' THEN 'Tools' ELSE coalesce(segment, 'na') END AS segment,
           balance
    FROM {_GAPS} WHERE name IS NOT NULL
""")
def fill_replace_chain(t):
    rules = TidyRules(
        drop_any=["id", "name"],
        fill={"segment": "na"},
        replace={"segment": {"na": "not defined", "MACHINERY": "Tools"}},
    )
    return tidy(_gaps(t), rules)


@query(f"SELECT DISTINCT segment, CAST(balance > 4000 AS BOOLEAN) AS rich FROM {_GAPS} WHERE segment IS NOT NULL AND balance IS NOT NULL")
def distinct_null_free(t):
    return distinct_complete(_gaps(t).selectExpr("segment", "balance > 4000 as rich"))


def _pct(part, whole):
    return f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100"


@query(f"""
    SELECT round(({_pct('count(DISTINCT id)', 'count(id)')} + {_pct('count(DISTINCT segment)', 'count(segment)')}) / 2, 6)
      AS uniqueness_pct FROM {_GAPS}
""")
def uniqueness_pct(t):
    score = quality.uniqueness_pct(_gaps(t), ["id", "segment"])
    return score.select(F.round("uniqueness_pct", 6).alias("uniqueness_pct"))


@query(f"""
    SELECT round(({_pct('count(name)', 'count(*)')} + {_pct('count(segment)', 'count(*)')}) / 2, 6)
      AS completeness_pct FROM {_GAPS}
""")
def completeness_pct(t):
    score = quality.completeness_pct(_gaps(t), ["name", "segment"])
    return score.select(F.round("completeness_pct", 6).alias("completeness_pct"))


def _report_row(name):
    return f"""
        SELECT '{name}' AS column_name, count(*) AS total_rows, count({name}) AS present_rows,
               count(DISTINCT {name}) AS distinct_values,
               {_pct(f'count(DISTINCT {name})', f'count({name})')} AS uniqueness_pct,
               {_pct(f'count({name})', 'count(*)')} AS completeness_pct
        FROM {_GAPS}
    """


@query(" UNION ALL ".join(_report_row(n) for n in ("id", "name", "segment", "balance")))
def quality_report(t):
    return quality.quality_report(_gaps(t), ["id", "name", "segment", "balance"])


@query("""
    SELECT count(*) AS total_rows, count(DISTINCT code) AS distinct_keys,
           count(*) - count(code) AS null_keys,
           count(*) FILTER (WHERE code IS NOT NULL AND TRY_CAST(code AS BIGINT) IS NULL) AS wrong_type_keys
    FROM (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'x' || CAST(o_custkey AS VARCHAR)
                      WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS code
          FROM orders)
""")
def key_checks(t):
    code = (
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("x"), F.col("o_custkey").cast("string")))
        .when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string"))
    )
    return quality.key_checks(t.orders.select(code.alias("code")), "code", "bigint")


@query("""
    SELECT 'l_quantity' AS x, 'l_extendedprice' AS y,
           round(corr(l_extendedprice, l_quantity), 6) AS correlation,
           round(covar_samp(l_extendedprice, l_quantity), 4) AS covariance
    FROM lineitem
    UNION ALL
    SELECT 'l_quantity', 'l_discount', round(corr(l_discount, l_quantity), 6),
           round(covar_samp(l_discount, l_quantity), 4)
    FROM lineitem
""")
def correlation_covariance(t):
    pairs = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount")]
    return pair_statistics(t.lineitem, pairs).select(
        "x",
        "y",
        F.round("correlation", 6).alias("correlation"),
        F.round("covariance", 4).alias("covariance"),
    )


@query("""
    SELECT unnest(['missing: c_comment', 'extra: segment', 'type of c_acctbal: double != string']) AS difference
""")
def schema_validity(t):
    """What a delivered table lacks, adds or types differently, against what is expected."""
    expected = t.customer.withColumn("c_comment", F.lit("")).select("c_custkey", "c_acctbal", "c_comment")
    delivered = t.customer.select("c_custkey", F.col("c_acctbal").cast("string"), F.col("c_mktsegment").alias("segment"))
    return t.spark.createDataFrame([(d,) for d in quality.schema_diff(expected, delivered)], "difference STRING")


def _summary_row(name, measure):
    each = ", ".join(f"round(({measure.format(c)})::DOUBLE, 3) AS {c}" for c in ("o_orderkey", "o_totalprice"))
    return f"SELECT '{name}' AS summary, {each} FROM orders"


@query(
    " UNION ALL ".join(
        _summary_row(*p)
        for p in (
            ("count", "count({})"),
            ("mean", "avg({})"),
            ("stddev", "stddev_samp({})"),
            ("min", "min({})"),
            ("25%", "quantile_cont({}, 0.25)"),
            ("50%", "quantile_cont({}, 0.5)"),
            ("75%", "quantile_cont({}, 0.75)"),
            ("max", "max({})"),
        )
    )
)
def summary_stats(t):
    """A whole summary, quartiles included, all measures exact."""
    names = ("o_orderkey", "o_totalprice")
    found = summary_table(t.orders, names)
    return found.select("summary", *[F.round(n, 3).alias(n) for n in names])


@query("""
    SELECT 'pairs' AS part, 'l_quantity, l_extendedprice' AS item,
           round(corr(l_quantity, l_extendedprice), 6) AS value FROM lineitem
    UNION ALL SELECT 'summary', 'count l_quantity', count(l_quantity) FROM lineitem
    UNION ALL SELECT 'summary', 'min l_quantity', min(l_quantity) FROM lineitem
    UNION ALL SELECT 'summary', 'max l_quantity', max(l_quantity) FROM lineitem
    UNION ALL SELECT 'sample', 'rows within bounds', 1
""")
def profile_bundle(t):
    """The exploratory set of one table, its parts brought under each other."""
    lines = t.lineitem.select("l_quantity", "l_extendedprice", "l_returnflag")
    found = profile(lines, [("l_quantity", "l_extendedprice")], ["l_returnflag"], fraction=0.5)
    pairs = found["pairs"].select(
        F.lit("pairs").alias("part"), F.concat_ws(", ", "x", "y").alias("item"), F.round("correlation", 6).alias("value")
    )
    summary = found["summary"].where("summary in ('count', 'min', 'max')").select(
        F.lit("summary"), F.concat(F.col("summary"), F.lit(" l_quantity")), F.col("l_quantity").cast("double")
    )
    taken = found["sample"].agg(F.count(F.lit(1)).alias("k"), F.lit(0).alias("n"))
    share = taken.union(lines.agg(F.lit(0), F.count(F.lit(1)))).agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    sample = share.select(F.lit("sample"), F.lit("rows within bounds"), (F.abs(F.col("k") / F.col("n") - 0.5) < 0.1).cast("double"))
    return pairs.union(summary).union(sample)


@query("""
    SELECT 'count' AS summary, CAST(count(p_size) AS VARCHAR) AS p_size FROM part
    UNION ALL SELECT 'min', CAST(min(p_size) AS VARCHAR) FROM part
    UNION ALL SELECT 'max', CAST(max(p_size) AS VARCHAR) FROM part
""")
def describe_bounds(t):
    return t.part.select("p_size").describe().where("summary in ('count', 'min', 'max')")


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS summary, round({f}(p_size)::DOUBLE, 6) AS p_size, "
        f"round({f}(p_retailprice)::DOUBLE, 6) AS p_retailprice FROM part"
        for name, f in (("count", "count"), ("mean", "avg"), ("stddev", "stddev_samp"), ("min", "min"), ("max", "max"))
    )
)
def describe_all(t):
    """Every row of a description, as numbers."""
    found = t.part.select("p_size", "p_retailprice").describe()
    return found.select("summary", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in found.columns[1:]])


def _true_items(name):
    return f"""SELECT '{name}' AS column_name, {name} AS value, true AS found FROM orders GROUP BY {name}
    HAVING count(*) >= 0.15 * (SELECT count(*) FROM orders)"""


@query(f"{_true_items('o_orderstatus')} UNION ALL {_true_items('o_orderpriority')}")
def frequent_items(t):
    """The sketch names every item that is frequent; what else it names is not fixed."""
    names = ["o_orderstatus", "o_orderpriority"]
    sketch = frequent_values(t.orders, names, 0.15)
    total = t.orders.agg(F.count("*")).scalar()
    parts = []
    for name in names:
        counts = t.orders.groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
        named = F.array_contains(sketch.select(f"{name}_freqItems").scalar(), F.col("value"))
        true_items = counts.where(F.col("n") >= 0.15 * total)
        parts.append(true_items.select(F.lit(name).alias("column_name"), "value", named.alias("found")))
    return parts[0].unionByName(parts[1])


@query("""
    SELECT CASE WHEN lang <> 'en' THEN lang END AS value, count(*) AS n FROM documents GROUP BY 1
    HAVING count(*) >= 0.12 * (SELECT count(*) FROM documents)
""")
def frequent_items_exact(t):
    """A null that holds most of the rows is an item like any other."""
    made = t.documents.select(F.when(F.col("lang") != "en", F.col("lang")).alias("lang"))
    return frequent_exact(made, "lang", 0.12)


@query("SELECT 0::BIGINT AS strangers, true AS fair_share")
def sample_seeded(t):
    """A random sample holds rows of the table, about the share asked for."""
    keys = ["o_orderkey", "o_custkey"]
    drawn = sample_rows(t.orders.select(*keys), 0.2, 10)
    tagged = drawn.withColumn("drawn", F.lit(1)).unionByName(t.orders.select(*keys, F.lit(0).alias("drawn")))
    per_key = tagged.groupBy(*keys).agg(F.sum("drawn").alias("drawn"), F.count_if(F.col("drawn") == 0).alias("rows"))
    share = F.sum("drawn") / F.sum("rows")
    return per_key.agg(
        F.count_if(F.col("drawn") > F.col("rows")).alias("strangers"),
        share.between(0.15, 0.25).alias("fair_share"),
    )


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE CAST('0x' || substr(md5('7:' || CAST(o_orderkey AS VARCHAR)), 1, 12) AS BIGINT) < 56294995342131
""")
def sample_repeatable(t):
    return sample_by_hash(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 0.2, seed=7)
