"""Exact de-duplication of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.ship import lower_ascii


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One row per row of ``docs``: the copy that stays and the size of its group.

    Texts are equal when identical after lower-casing A-Z; a null text counts
    as empty.  Rows are grouped by a 128-bit content hash together with the
    text itself, so bytes are compared inside a hash group and a collision
    cannot merge two texts.  Equal texts collapse before the shuffle, so a text
    that fills a third of the table costs one row per task.  Each row then finds
    its group by hash and digest; that join carries no text, and Spark splits a
    hot key of it.

    ``keep`` is ``smallest`` or ``largest``: which id of a group stays.  A null
    id never stays before another; in a group of null ids all rows stay.  Rows
    that repeat the id that stays all stay.  An empty table gives no rows, and
    other columns of ``docs`` are ignored.

    Returns ``<id_col>, keep_id, group_size, kept, text_sha256``.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be 'smallest' or 'largest'")
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        norm.alias("_norm"),
        F.unhex(F.md5(norm)).alias("_hash"),
    )
    best = (F.min if keep == "smallest" else F.max)("_id")
    groups = (
        rows.groupBy("_hash", "_norm")
        .agg(best.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("_hash", F.sha2("_norm", 256).alias("_sha"), "keep_id", "group_size")
    )
    digests = rows.select("_id", "_hash", F.sha2("_norm", 256).alias("_sha"))
    return digests.join(groups, ["_hash", "_sha"]).select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """``documents`` rows without exact copies, all columns of ``docs``.

    Of equal texts the row with the chosen id stays.  Rows equal in id and
    text, which no id tells apart, become one, and so do equal texts whose ids
    are all null.
    """
    norm = lower_ascii(F.coalesce(F.col("text"), F.lit("")))
    carried = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # min_by orders by id; the hash of the row settles repeated ids alike in every run.
    order = F.struct(
        F.col("doc_id").isNull(),
        F.col("doc_id") if keep == "smallest" else -F.col("doc_id"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if c != "doc_id"]),
    )
    kept = docs.groupBy(F.unhex(F.md5(norm)).alias("_hash"), norm.alias("_norm")).agg(
        F.min_by(carried, order).alias("_row")
    )
    return kept.select("_row.*")
