"""One query per operator over its whole table, with DuckDB SQL where that can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@_query()
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from loomwork.llm.quality import quality, trusted_documents

    labels = _table(spark, folder, "labels")
    return quality(_table(spark, folder, "documents"), trusted_documents(labels))


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

# Sources by cap / weight: the level is the one at which the first uncapped
# source takes its share of what the capped ones leave.
SQL_MIX = rf"""
WITH sized AS (
  SELECT d.doc_id, d.source, {_WORDS} AS size, coalesce(d.text, '') AS text,
         CASE WHEN q.quality IS NULL THEN 1.0::DOUBLE WHEN q.quality >= 1 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS weight
  FROM documents d LEFT JOIN (
    SELECT doc_id, max(quality) AS quality FROM labels
    WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id) q ON d.doc_id = q.doc_id
), keyed AS (
  SELECT doc_id, source, size, -ln(
    (CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || text), 1, 13) AS BIGINT) + 0.5::DOUBLE)
    / 4503599627370496.0::DOUBLE) / weight AS key
  FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3) + 1] AS w
  FROM sized GROUP BY source
), levels AS (
  SELECT s.source, s.source_size, s.w, 2.0::DOUBLE * s.source_size AS cap,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM sources)
          - coalesce((SELECT sum(2.0::DOUBLE * o.source_size) FROM sources o
                      WHERE 2.0::DOUBLE * o.source_size / o.w < 2.0::DOUBLE * s.source_size / s.w), 0))
         / (SELECT sum(o.w) FROM sources o
            WHERE 2.0::DOUBLE * o.source_size / o.w >= 2.0::DOUBLE * s.source_size / s.w) AS level
  FROM sources s
), targets AS (
  SELECT source, source_size, CASE WHEN cap <= w * level THEN cap
         ELSE w * (SELECT arg_min(level, cap / w) FROM levels WHERE cap > w * level) END AS target
  FROM levels
), placed AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       ((epochs + CASE WHEN size > 0 AND before + size / 2.0::DOUBLE <= target - epochs * source_size
                  THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM placed
"""


@_query(SQL_MIX)
def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    from loomwork.llm.mixing import mix, quality_weights

    quality = quality_weights(_table(spark, folder, "labels"))
    mixed = mix(_table(spark, folder, "documents"), quality=quality)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


SQL_EXACT = """
WITH normed AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
), groups AS (
  SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM normed GROUP BY norm
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM normed n JOIN groups g ON n.norm = g.norm
"""


@_query(SQL_EXACT)
def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from loomwork.llm.exact import exact_duplicates

    return exact_duplicates(_table(spark, folder, "documents"), keep="largest")


@_query()
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from loomwork.llm.bpe import token_counts

    return token_counts(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query()
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from loomwork.llm.ship import bucket_of
    from loomwork.llm.toxicity import toxicity, train

    docs = _table(spark, folder, "documents")
    weights, bias = train(docs, _table(spark, folder, "labels"))
    held_out = bucket_of(F.col("doc_id"), 4) == 2
    return toxicity(docs, weights, bias).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", "sentences"
    )


@_query()
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from loomwork.llm.langid import held_out, identify, learned_samples

    docs = _table(spark, folder, "documents")
    samples = learned_samples(docs.where(~held_out(docs)))
    return identify(docs, samples).select("doc_id", held_out(docs).alias("held_out"), "lang_pred", "score")


# All pairs with a shared shingle, counted; then components by walking links.
SQL_NEAR = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i+3], ' ') for i in range(1, len(w) - 2)] END) AS s
  FROM worded
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_n
  FROM shingled x JOIN shingled y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * both_n >= 80 * (p.n + q.n - both_n)
), reach AS (
  SELECT doc_id, doc_id AS seen FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.seen = l.a
), named AS (
  SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM named d LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""


@_query(SQL_NEAR)
def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    from loomwork.llm.minhash import near_duplicates

    return near_duplicates(_table(spark, folder, "documents"))


@_query()
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from loomwork.llm.packing import packed_documents

    return packed_documents(_table(spark, folder, "documents"))


# Base 32 of the digest, five bits at a time: 40 hex digits are 32 groups.
SQL_WARC = """
WITH hashed AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), kept AS (
  SELECT hex, max(page_id) AS largest FROM hashed GROUP BY hex
), coded AS (
  SELECT h.page_id, h.hex, k.largest, strlen(h.html) AS n FROM hashed h JOIN kept k ON h.hex = k.hex
)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string([
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
      ((CAST('0x' || substr(hex, 5 * (g // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (g % 4))) & 31)::INT + 1]
    for g in range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM coded
"""


@_query(SQL_WARC)
def op9_warc_chunks(spark: SparkSession, folder: str) -> DataFrame:
    from loomwork.llm.warc import chunk_table, record_table, write_archives
    from loomwork.session import stage

    archives = write_archives(_table(spark, folder, "pages"))
    return record_table(stage(chunk_table(archives), "warc-chunks")).drop("intact")


@_query()
def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    from loomwork.llm.html import extract

    return extract(_table(spark, folder, "pages"))


# The digest's first digits decide; code points are DuckDB's characters.
SQL_INFILL = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
           OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
         WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed
), cut AS (
  SELECT *, substring(t, 1, least(c1, c2)) AS p, substring(t, least(c1, c2) + 1, greatest(c1, c2) - least(c1, c2)) AS m,
         substring(t, greatest(c1, c2) + 1) AS s
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(c1, c2) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN greatest(c1, c2) - least(c1, c2) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM cut
"""


@_query(SQL_INFILL)
def op13_infill(spark: SparkSession, folder: str) -> DataFrame:
    from loomwork.llm.infill import infill, restored

    cut = infill(_table(spark, folder, "documents"))
    again = restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(again, 256).alias("restored_sha256"),
    )


def _sql_repair() -> str:
    """Edits by states, row after row: the cheapest way to each state, then the ASCII-least one.

    A way is a struct of cost, audit and text, which compares in this order.
    """
    none = "{'c': 1000000000::BIGINT, 't': '', 'o': ''}"

    def way(state: str, cost: int | str, edit: str, line: str | None = None) -> str:
        text = f"{state}.o" if line is None else f"{state}.o || {line} || chr(10)"
        return f"{{'c': {state}.c + {cost}, 't': {state}.t || '{edit}', 'o': {text}}}"

    def best(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    def said(state: str, role: str) -> list[str]:
        extra = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
        free = "fault NOT IN ('blank', 'duplicate')"
        kept = way(state, extra, "K", "role || ':' || text")
        told = way(state, f"1 + {extra}", "R", f"'{role}:' || text")
        return [
            f"CASE WHEN {free} AND role[1:1] = '{role[0]}' THEN {kept} ELSE {none} END",
            f"CASE WHEN {free} THEN {told} ELSE {none} END",
        ]

    # A user turn may be inserted before the row, then an assistant turn.
    more = best("u", way("e", 5, "I", "'user:'"), way("s", 5, "I", "'user:'"), way("a", 5, "I", "'user:'"))
    first = "CASE WHEN fault NOT IN ('blank', 'duplicate') AND role[1:1] = 's' THEN " + way(
        "e", "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END", "K", "role || ':' || text"
    ) + f" ELSE {none} END"
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), coded AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 1, 2, 3, 4, 5, 6, 7, 8],
      lambda c, i: xor(c >> 1, (c & 1) * 3988292384))), 4294967295) % 20 AS code
  FROM keyed
), spoilt AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN code = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM coded WHERE code <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
    lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h, copy) || role[1:1] AS pair,
    trim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT *, sha256(length(role)::VARCHAR || ':' || role || text) AS h FROM spoilt)
), faulty AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate'
    WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed
), ways AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 't': '', 'o': ''}} AS e, {none} AS s, {none} AS u, {none} AS a
  FROM faulty WHERE i = 1
  UNION ALL
  SELECT conv_id, i, {way("e", 2, "D")}, {best(way("s", 2, "D"), first)},
    {best(way("u1", 2, "D"), *said("e", "user"), *said("s", "user"), *said("a1", "user"))},
    {best(way("a1", 2, "D"), *said("u1", "assistant"))}
  FROM (SELECT *, {best("a", way("u1", 5, "I", "'assistant:'"))} AS a1
    FROM (SELECT f.conv_id, f.i, f.role, f.text, f.fault, w.e, w.s, w.u, w.a, {more} AS u1
      FROM ways w JOIN faulty f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = w.i + 1))
), ended AS (
  SELECT conv_id, {best("e", "a", way("u1", 5, "I", "'assistant:'"))} AS w
  FROM (SELECT *, {more} AS u1 FROM ways)
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.c, 0)::BIGINT AS cost, coalesce(w.t, '') AS audit,
  sha256(CASE WHEN coalesce(w.o, '') = '' THEN '' ELSE left(w.o, -1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended n ON o.conv_id IS NOT DISTINCT FROM n.conv_id
"""


@_query(_sql_repair())
def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    from loomwork.llm.turns import damaged, repair

    conversations = _table(spark, folder, "conversations")
    found = repair(damaged(conversations), original=conversations)
    return found.withColumn("repaired_sha256", F.sha2("repaired", 256)).drop("repaired")


@_query()
def op12_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    from loomwork.llm.neighbours import nearest

    return nearest(_table(spark, folder, "embeddings"))
