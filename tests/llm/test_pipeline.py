"""The corpus pipeline against its stages done the plain way."""

import random
from collections import Counter

import corpus_pipeline
from cases import prose
from loomwork.llm.mixing import mix, quality_weights
from loomwork.llm.packing import Lengths
from loomwork.llm.quality import Rules
from test_text_models import _brute_quality, _words

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _documents():
    draw = random.Random(21)
    rows = []
    for k in range(90):
        words = prose(k, draw.randint(15, 120), 400)
        rows.append((k, words))
    for k in range(20):
        # Exact copies, with other letter case; near copies that lack the last word.
        rows.append((200 + k, [w.upper() if j % 3 == 0 else w for j, w in enumerate(rows[k][1])]))
        rows.append((300 + k, rows[30 + k][1][:-1]))
    rows += [(400, ["short"]), (401, []), (402, "same five words all over".split() * 20)]
    docs = [(i, " ".join(w), "en", draw.choice(["a", "a", "b", None]), 1) for i, w in rows]
    return [*docs, (403, None, None, "b", None)]


def _shingles(text):
    words = _words("".join(c.lower() if c.isascii() else c for c in text))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def _plain_survivors(docs, labels):
    """Ids after the rules, exact and near de-duplication."""
    trusted = {i for i, quality, _ in labels if quality >= 1}
    judged = _brute_quality(docs, trusted, Rules())
    kept = {row[0] for row in judged if row[7]}
    first = {}
    for doc_id, text, *_ in sorted((d for d in docs if d[0] in kept)):
        first.setdefault("".join(c.lower() if c.isascii() else c for c in text), doc_id)
    texts = {i: t for i, t, *_ in docs}
    alive = sorted(first.values())
    sets = {i: _shingles(texts[i]) for i in alive}
    group = {i: i for i in alive}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for x, i in enumerate(alive):
        for j in alive[x + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    return {i for i in alive if root(i) == i}


def test_pipeline_equals_plain_stages(spark, tmp_path):
    docs = _documents()
    labels = [(k, int(k % 4 != 0), 0) for k in range(0, 90, 2)]
    frame = spark.createDataFrame(docs, COLUMNS)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    frame.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    marks.write.parquet(str(tmp_path / "labels.parquet"))
    placed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    alive = _plain_survivors(docs, labels)
    assert {200, 210, 300, 310, 400, 401, 402, 403}.isdisjoint(alive) and 20 <= len(alive) < 90
    # The mixture has its own plain version in test_mixing; here it mixes what plainly survives.
    left = frame.where(frame.doc_id.isin(sorted(alive)))
    taken = {r.doc_id: r.taken // r.size for r in mix(left, quality=quality_weights(marks)).collect() if r["size"]}
    words = {i: len(_words(t)) for i, t, *_ in docs}
    expected = Counter({i: n * words[i] for i, n in taken.items() if n})
    found = Counter()
    for r in placed:
        found[r.doc_id] += r.length
    assert found == expected
    # Every sequence is filled as it says, within a permitted length, without overlap.
    bins = {}
    for r in placed:
        bins.setdefault((r.bin_id, r.bin_capacity, r.bin_fill), []).append((r.offset, r.length))
    assert len({b for b, *_ in bins}) == len(bins)
    for (_, capacity, fill), parts in bins.items():
        assert capacity in Lengths().capacities and sum(n for _, n in parts) == fill <= capacity
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n


def test_stages_keep_columns_and_are_named():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules",
        "exact_dedup",
        "near_dedup",
        "mix_sources",
        "best_fit_packing",
    ]


def test_pipeline_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
