"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm.ship import words_of
from loomwork.session import stage

# Rows of one key range of one source that a task sorts.
RANGE_ROWS = 5_000
# Weights that count as one for cutting ranges: steps of an eighth of a power of two.
WEIGHT_STEPS = 8


def source_targets(
    sizes: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: float = 2.0,
) -> DataFrame:
    """Token targets per source: ``source, source_size, target``.

    Sources in code point order, null last, take ``weights`` in turn, repeating.
    Together they get ``share`` of all tokens by weight, none more than
    ``max_epochs`` of its own size; what a source cannot take is shared again
    among the others.  The fixed point is min(cap, weight * level) with one
    level for all, found by ordering sources by cap / weight.  Sources of size
    0 get 0.  The table has one row per source, so its windows are small.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    turn = F.pmod(place, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    capped = by_source.withColumn("_w", weight).withColumn("_cap", max_epochs * F.col("source_size"))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source")
    everyone = Window.partitionBy()
    ranked = (
        capped.withColumn("_rank", F.row_number().over(order))
        .withColumn("_cap_before", F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_w_rest", F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("_total", F.sum("source_size").over(everyone))
    )
    level = (share * F.col("_total") - F.coalesce("_cap_before", F.lit(0.0))) / F.col("_w_rest")
    levelled = ranked.withColumn("_level", level).withColumn(
        "_fits", F.col("_cap") <= F.col("_w") * F.col("_level")
    )
    # Sources whose cap is under the level form a prefix of that order; the
    # level of the first other source holds for all others.
    found = levelled.withColumn(
        "_common", F.min_by("_level", F.when(~F.col("_fits"), F.col("_rank"))).over(everyone)
    )
    target = F.when(F.col("_fits"), F.col("_cap")).otherwise(F.col("_w") * F.col("_common"))
    return found.select("source", "source_size", "source_rows", target.alias("target"))


def exponential_key(doc_id: Column, text: Column, weight: Column, seed: str = "mix-1") -> Column:
    """-ln(u) / weight with u in (0, 1) from a hash of id and text, so reruns agree."""
    digest = F.md5(
        F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    )
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    return -F.ln((number + 0.5) / F.lit(float(1 << 52))) / weight


def weight_class(weight: Column) -> Column:
    """Step of a weight on a scale of eighths of powers of two, from -512 to 512; null counts as 1."""
    step = F.round(WEIGHT_STEPS * F.log2(weight))
    return F.greatest(F.lit(-512.0), F.least(F.lit(512.0), F.coalesce(step, F.lit(0.0)))).cast("int")


def key_range(key: Column, classes: Column, range_rows: int) -> Column:
    """Number of the range of about ``range_rows`` rows of its source that a key falls in.

    ``classes`` holds how many rows of the source have each class of weight, in a
    fixed order.  Rows of weight w have a smaller key with the chance
    1 - exp(-w key); the sum over the classes is the expected place of the key,
    which never falls as the key grows.
    """
    earlier = F.aggregate(
        classes,
        F.lit(0.0),
        lambda n, c: n + c["n"] * (1 - F.exp(-key * F.pow(F.lit(2.0), c["class"] / F.lit(WEIGHT_STEPS)))),
    )
    return F.floor(earlier / F.lit(range_rows))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    max_epochs: float = 2.0,
    quality: DataFrame | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """How often each document enters the mix.

    A source with target t and size s is taken whole floor(t / s) times; the
    rest of its target is filled by Efraimidis-Spirakis sampling: documents get
    exponential keys divided by their quality weight, are ordered by key, and
    are taken until the running sum of sizes reaches the rest.  The document
    that crosses it is taken when at least half of it fits.

    ``quality`` has ``doc_id, weight``: one positive weight per document; others
    and null ids weigh 1.  Keys come from a hash of id and text, so reruns
    agree; rows equal in both are interchangeable.  Size is the number of
    words, 0 for null texts; documents of size 0 are never taken beyond whole
    epochs.  A null source is a source.  Empty tables give no rows.

    A source is cut into ranges of its key of about ``range_rows`` rows, whatever
    the weights: see ``key_range``.  Sums of ranges give each range its start, so no task orders a whole source.

    Returns ``doc_id, text_hash, source, size, source_size, target, copies, taken``.
    """
    sized = docs.select(
        "doc_id",
        "source",
        F.size(words_of(F.col("text"))).cast("bigint").alias("size"),
        F.xxhash64("text").alias("text_hash"),
        exponential_key(F.col("doc_id"), F.col("text"), F.lit(1.0)).alias("_key"),
    )
    sized = sized.withColumn("_class", F.lit(0))
    if quality is not None:
        weight = quality.select("doc_id", F.col("weight").alias("_weight"))
        sized = sized.join(weight, "doc_id", "left").withColumns(
            {"_key": F.col("_key") / F.coalesce("_weight", F.lit(1.0)), "_class": weight_class(F.col("_weight"))}
        )
    # Sources, ranges and rows are all derived from this table; it holds no text.
    sized = stage(
        sized.select("doc_id", "source", "size", "text_hash", "_key", "_class"), "mix-sizes"
    )
    counts = sized.groupBy("source", F.col("_class").alias("class")).agg(F.count(F.lit(1)).alias("n"))
    classes = counts.groupBy(F.col("source").alias("_source")).agg(
        F.sort_array(F.collect_list(F.struct("class", "n"))).alias("_classes")
    )
    targets = source_targets(sized, weights, share, max_epochs)
    targets = targets.join(classes, F.col("source").eqNullSafe(F.col("_source"))).drop("source")
    placed = (
        sized.join(F.broadcast(targets) if _few(counts) else targets, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_range", key_range(F.col("_key"), F.col("_classes"), range_rows))
        .drop("_classes")
        .withColumn("_epochs", F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)))
        .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
    )
    sums = placed.groupBy("_source", "_range").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("_source").alias("_s"),
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
    )
    inside = (
        Window.partitionBy("_source", "_range")
        .orderBy("_key", "doc_id", "text_hash")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    running = placed.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        starts, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r"))
    )
    before = F.col("_start") + F.col("_before")
    extra = (F.col("size") > 0) & (before + F.col("size") / 2 <= F.col("_rest"))
    copies = F.col("_epochs") + F.when(extra, 1).otherwise(0)
    return running.select(
        "doc_id",
        "text_hash",
        "source",
        "size",
        "source_size",
        "target",
        copies.cast("bigint").alias("copies"),
        (copies * F.col("size")).cast("bigint").alias("taken"),
    )


def _few(counts: DataFrame) -> bool:
    """Whether there are at most 10,000 sources and classes of weight, so that their table can be broadcast."""
    return counts.limit(10_001).count() <= 10_000


def quality_weights(labels: DataFrame, good: float = 2.0, poor: float = 0.5) -> DataFrame:
    """``doc_id, weight`` from quality labels; the best label of an id counts."""
    best = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.max("quality").alias("_q")
    )
    return best.select("doc_id", F.when(F.col("_q") >= 1, good).otherwise(poor).alias("weight"))


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Documents repeated as the mix says, with the columns of ``docs``.

    Decisions are matched by id and text, so rows equal in both share one.
    """
    decided = mixed.groupBy("doc_id", "text_hash").agg(F.max("copies").alias("_copies")).where("_copies > 0")
    decided = decided.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    # All columns travel in one, so that no name can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("_row.text") == F.col("_hash"))
    repeated = rows.join(decided, same).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    )
    return repeated.select("_row.*")
