"""Lines, tokens and positions."""

from pyspark.sql import functions as F

from loomwork.catalog.registry import portable, query
from loomwork.operators.cleanse import wide_enough
from loomwork.operators.layout import cached, cut_lineage, layout, partition_sizes
from loomwork.operators.metrics import money_sum
from loomwork.operators.text import level_counts, tokens, without_header, zip_rows
from loomwork.operators.text import word_count as count_words
from loomwork.operators.windows import first_rows

_WORDS = "(SELECT unnest(string_split(text, ' ')) AS word FROM documents)"


@query(f"SELECT word, count(*) AS n FROM {_WORDS} GROUP BY word")
def word_count(t):
    return count_words(t.documents, "text")


@query(f"SELECT DISTINCT word FROM {_WORDS}")
def distinct_tokens(t):
    return tokens(t.documents.select("text"), "text").select("word").distinct()


@query("SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations")
def token_rows(t):
    return tokens(t.conversations.select("conv_id", "turn", "text"), "text").drop("text")


@query(f"SELECT word, count(*) AS n FROM {_WORDS} GROUP BY word ORDER BY n DESC, word LIMIT 3")
def top_words(t):
    return first_rows(count_words(t.documents, "text"), ["-n", "word"], 3)


@query("""
    SELECT doc_id, len(string_split(text, ' ')) AS fields FROM documents
    WHERE len(string_split(text, ' ')) >= 100
""")
def ragged_guard(t):
    kept = wide_enough(t.documents, "text", " ", 100)
    return kept.select("doc_id", F.size(F.split("text", " ")).cast("long").alias("fields"))


def _log(t):
    short = F.date_format("ts", "yyyy-MM-dd")
    full = F.concat_ws(
        " ", short, F.date_format("ts", "HH:mm:ss"), F.upper("event_type"), F.col("event_id").cast("string")
    )
    return t.events.select(F.when(F.col("event_type") == "view", short).otherwise(full).alias("line"))


@query("""
    SELECT upper(event_type) AS level, count(*) AS n FROM events
    WHERE event_type <> 'view' GROUP BY 1
""")
def log_level_counts(t):
    return level_counts(_log(t), "line")


@query("SELECT CAST(c_custkey AS VARCHAR) || ',' || c_name AS line FROM customer")
def header_removed(t):
    rows = t.customer.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("line"))
    header = t.region.select(F.lit("id,name").alias("line"))
    return without_header(header.union(rows), "line", "id,name")


@query("SELECT min(o_totalprice) AS low FROM orders WHERE o_orderpriority = '2-HIGH'")
def key_lookup_min(t):
    return t.orders.where("o_orderpriority = '2-HIGH'").agg(F.min("o_totalprice").alias("low"))


@query("SELECT o_orderstatus AS value, count(*) AS n FROM orders GROUP BY 1")
def value_counts(t):
    return t.orders.groupBy(F.col("o_orderstatus").alias("value")).agg(F.count("*").alias("n"))


@query("""
    SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
           max(o_totalprice) AS high
    FROM orders
""")
def whole_table_totals(t):
    return t.orders.agg(
        F.count("*").alias("n"),
        money_sum("o_totalprice", 2).alias("total"),
        F.max("o_totalprice").alias("high"),
    )


@query("""
    SELECT i AS row_no, CAST(c_custkey AS DOUBLE) AS c_custkey, c_name, o_orderkey, o_orderdate
    FROM (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS i FROM customer) a
    FULL JOIN (SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS i
               FROM orders) b USING (i)
""")
def positional_zip(t):
    """Tables without a common key, joined by position; the longer one keeps its tail."""
    zipped = zip_rows(
        t.customer.select("c_custkey", "c_name"),
        t.orders.select("o_orderkey", "o_orderdate"),
        ["c_custkey"],
        ["o_orderdate", "o_orderkey"],
    )
    return portable(zipped, "c_custkey")


@query("SELECT count(*) AS n FROM lineitem")
def partition_row_counts(t):
    """Rows per partition depend on how the input is split, their sum does not."""
    return partition_sizes(t.lineitem).agg(F.sum("n").alias("n"))


@query("""
    SELECT 'laid out' AS step, count(*) AS n, count(DISTINCT o_custkey) AS keys FROM orders
    UNION ALL SELECT 'cached', count(*), count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'checkpointed', count(*), count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus <> 'O'
""")
def layout_steps(t):
    """One table laid out by key once, two readers of the kept copy, lineage cut after each."""

    def counts(df, step):
        keys = F.count_distinct("o_custkey").alias("keys")
        return df.agg(F.count(F.lit(1)).alias("n"), keys).select(F.lit(step).alias("step"), "n", "keys")

    with cached(layout(t.orders.select("o_custkey", "o_orderstatus"), by=["o_custkey"])) as kept:
        whole = cut_lineage(counts(kept, "laid out"))
        opened = cut_lineage(counts(kept.where("o_orderstatus = 'O'"), "cached"))
        rest = cut_lineage(kept.where("o_orderstatus <> 'O'"))
    return whole.union(opened).union(counts(rest, "checkpointed"))


@query(f"SELECT upper(word) AS word, count(*) AS n FROM {_WORDS} WHERE word IN ('the', 'and', 'der') GROUP BY 1")
def words_by_sql(t):
    tokens(t.documents.select("text"), "text").select("word").createOrReplaceTempView("loomwork_words")
    return t.spark.sql(
        "SELECT upper(word) AS word, count(*) AS n FROM loomwork_words WHERE word IN ('the', 'and', 'der') GROUP BY 1"
    )
