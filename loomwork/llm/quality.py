"""Quality rules: base counts and a hashed n-gram log-likelihood ratio."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.ship import let, words_of
from loomwork.session import stage

WINDOW = 5


@dataclass(frozen=True)
class Rules:
    """Parameters of the verdict.

    ``buckets`` hashed n-grams; ``prior`` raw-corpus pseudo counts mixed into the
    target counts, which pulls rare n-grams to a ratio of 1; ``neutral`` n-grams
    of ratio 1 added to every document, so that a few words alone reject none;
    ``threshold`` the least mean log ratio of a document that stays.
    """

    buckets: int = 1 << 14
    prior: float = 1 << 14
    neutral: int = 20
    threshold: float = -0.08
    min_words: int = 10
    max_repeat_pct: int = 20


def grams(words: Column, buckets: int) -> Column:
    """Buckets of the single words and word pairs of a word array."""

    def bucket(*w: Column) -> Column:
        return F.pmod(F.xxhash64(*w), F.lit(buckets)).cast("int")

    def of(w: Column) -> Column:
        single = F.transform(w, lambda x: bucket(x))
        # The hash of a pair goes on from the hash of its first word, without a copy of both.
        pair = F.transform(F.slice(w, 2, F.size(w)), lambda x, i: bucket(F.get(w, i), x))
        return F.concat(single, pair)

    return let(words, of)


def gram_counts(docs: DataFrame, trusted: DataFrame, rules: Rules) -> DataFrame:
    """``bucket, raw, target``: n-gram counts of all documents and of trusted ones.

    ``trusted`` has ``doc_id``.  Documents are marked by a join that moves ids
    and texts once, and counted in one pass.  Counts are combined before their
    shuffle, which carries at most one row per bucket and task.
    """
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("_good", F.lit(1))
    # Without a sort of the texts, and the same way at any size.
    marked = docs.select("doc_id", "text").join(ids.hint("shuffle_hash"), "doc_id", "left")
    # The outer form keeps Spark from computing the array once more to filter on it.
    listed = marked.select("_good", F.explode_outer(grams(words_of(F.col("text")), rules.buckets)).alias("bucket"))
    sums = listed.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("_good").alias("target"))
    return sums.where("bucket IS NOT NULL")


def gram_weights(counts: DataFrame, rules: Rules) -> DataFrame:
    """One row with the log ratio of every bucket as an array of ``rules.buckets`` numbers.

    Without trusted documents every ratio is 0.
    """
    b = rules.buckets
    whole = counts.sparkSession.range(b).withColumnRenamed("id", "bucket").join(counts, "bucket", "left")
    whole = whole.select("bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("raw", "target")])
    sums = counts.agg(F.sum("raw").alias("_raw"), F.sum("target").alias("_target"))
    # One row of sums beside the buckets of a fixed number.
    totals = whole.withColumns({"_r": sums.select("_raw").scalar(), "_t": sums.select("_target").scalar()})
    p_raw = (F.col("raw") + 1) / (F.coalesce("_r", F.lit(0)) + b)
    p_target = (F.col("target") + rules.prior * p_raw) / (F.coalesce("_t", F.lit(0)) + rules.prior)
    ratio = F.when(F.coalesce("_t", F.lit(0)) > 0, F.ln(p_target / p_raw)).otherwise(0.0)
    rows = totals.select("bucket", ratio.alias("ratio"))
    listed = F.array_sort(F.collect_list(F.struct("bucket", "ratio")))
    return rows.agg(F.transform(listed, lambda x: x["ratio"]).alias("ratios"))


def quality_counts(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Base counts of every row beside its columns ``doc_id, text``.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (of
    ``#*$%&|<>``), ``n_dup_lines`` (lines with a word that equal an earlier
    line) and ``n_repeat_words`` (words in windows of five words that occur
    twice or more).  Windows are compared by 64-bit hashes.  A null text counts
    0 everywhere.  ``_words`` stays for later steps, and so do the columns to
    ``carry``, as fields of ``_carried``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    repeated_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    symbols = F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))
    carried = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_carried")] * bool(carry)
    rows = docs.select(
        "doc_id",
        words_of(F.col("text")).alias("_words"),
        symbols.cast("bigint").alias("n_symbols"),
        repeated_lines.cast("bigint").alias("n_dup_lines"),
        *carried,
    )
    return rows.select(
        "doc_id",
        "_words",
        F.size("_words").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        repeat_words(F.col("_words")).cast("bigint").alias("n_repeat_words"),
        *[F.col("_carried")] * bool(carry),
    )


def repeat_words(words: Column) -> Column:
    """Words in windows of ``WINDOW`` words that occur twice or more."""

    def hashes(h: Column) -> Column:
        first = F.slice(h, 1, F.size(h) - (WINDOW - 1))
        return F.transform(first, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))

    def places(placed: Column) -> Column:
        # Ordered by hash, equal windows are neighbours.
        def twin(x: Column, i: Column, step: int) -> Column:
            inside = i >= 1 if step < 0 else i < F.size(placed) - 1
            return F.when(inside, F.get(placed, i + step)["h"] == x["h"]).otherwise(False)

        twins = F.filter(placed, lambda x, i: twin(x, i, -1) | twin(x, i, 1))
        return F.sort_array(F.transform(twins, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        # Each repeated window adds the words up to the next one, WINDOW at most.
        return F.aggregate(
            F.sequence(F.lit(1), F.size(at) - 1),
            F.lit(WINDOW),
            lambda acc, k: acc + F.least(F.lit(WINDOW), F.get(at, k) - F.get(at, k - 1)),
        )

    def of(hashed: Column) -> Column:
        placed = F.sort_array(F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        found = let(let(placed, places), covered)
        return F.when(F.size(F.array_distinct(hashed)) < F.size(hashed), found).otherwise(0)

    # Every word is hashed once; windows are made of these numbers.
    counted = let(let(F.transform(words, lambda x: F.xxhash64(x)), hashes), of)
    return F.when(F.size(words) > WINDOW, counted).otherwise(0)


def quality(docs: DataFrame, trusted: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Judge every document: base rules, then the mean log ratio of its n-grams.

    Hashed single words and word pairs form two multinomials, of trusted
    documents and of all.  ``score`` is the mean log ratio over the n-grams of a
    document, so length does not matter; documents under ``rules.threshold``
    are rejected.  A document fails the base rules with fewer than
    ``min_words`` words or more than ``max_repeat_pct`` percent of its words in
    repeated windows.

    Null texts have no words and fail; a null ``doc_id`` is never trusted;
    repeated rows are judged alike; other columns are ignored; empty tables
    give no rows, and without trusted documents only the base rules reject.
    """
    return judged(quality_counts(docs), _ratios(docs, trusted, rules), rules).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "score",
    )


def keep_good(docs: DataFrame, trusted: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns."""
    rows = quality_counts(docs, carry=docs.columns)
    kept = judged(rows, _ratios(docs, trusted, rules), rules).where("kept")
    return kept.select(*[F.col(f"_carried.`{c}`").alias(c) for c in docs.columns])


def _ratios(docs: DataFrame, trusted: DataFrame, rules: Rules) -> DataFrame:
    counts = stage(gram_counts(docs, trusted, rules), "gram-counts")
    return gram_weights(counts, rules)


def judged(rows: DataFrame, weights: DataFrame, rules: Rules) -> DataFrame:
    """Rows of ``quality_counts`` with ``score``, ``base_failed`` and ``kept``."""
    rows = rows.withColumn("_grams", grams(F.col("_words"), rules.buckets))
    rows = rows.withColumn("_ratios", weights.scalar())
    ratios = F.col("_ratios")
    mean = let(
        F.col("_grams"),
        lambda g: F.aggregate(g, F.lit(0.0), lambda acc, b: acc + F.get(ratios, b))
        / (F.size(g) + rules.neutral),
    )
    score = F.when(F.col("n_words") > 0, mean)
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words")
    )
    scored = rows.withColumns({"score": score, "base_failed": failed})
    good = ~F.col("base_failed") & F.coalesce(F.col("score") >= rules.threshold, F.lit(False))
    return scored.withColumn("kept", good)


def trusted_documents(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled as good."""
    return labels.where("quality >= 1").select("doc_id")
