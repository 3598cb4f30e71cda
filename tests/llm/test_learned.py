"""Learned models against plain versions, and what they learn from."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from cases import AWKWARD, docs_frame, prose
from loomwork.llm import langid, toxicity
from loomwork.llm.hashing import Texts


def _plain_phrases(word, sample):
    at = count = 0
    while at < len(word):
        end = at + 1
        while end <= len(word) and word[at:end] in sample:
            end += 1
        at, count = max(at + 1, end - 1), count + 1
    return count


def _plain_language(text, samples):
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not words or not samples:
        return langid.UNDETERMINED, 0.0
    bits = [
        sum(_plain_phrases(f" {w} ", sample) for w in words) * math.log2(max(2, len(sample))) for _, sample in samples
    ]
    best = bits.index(min(bits))
    return samples[best][0], 1 / sum(2 ** -min(b - bits[best], 1000.0) for b in bits)


def test_languages_equal_plain_parsing(spark):
    samples = (
        ("en", " the cat sat on the mat and then the other cats came "),
        ("es", " el gato se sento en la alfombra y luego vinieron los otros gatos "),
        ("xx", " zz "),
    )
    draw = random.Random(3)
    words = "the cat el gato mat luego zz qq other otros é über".split()
    rows = [(100 + k, " ".join(draw.choices(words, k=draw.randint(0, 8)))) for k in range(150)]
    rows += [r for r in AWKWARD if len(r[1] or "") < 1000]
    found = langid.identify(docs_frame(spark, rows), samples).collect()
    shown = sorted((str(r.doc_id), r.lang_pred, round(r.score, 9)) for r in found)
    plain = [(str(r[0]), *_plain_language(r[1], samples)) for r in rows]
    assert shown == sorted((i, lang, round(score, 9)) for i, lang, score in plain)


def _tongue(seed):
    draw = random.Random(seed)
    letters = draw.sample("abcdefghijklmnopqrstuvwxyz", 9)
    return ["".join(draw.choices(letters, k=draw.randint(2, 5))) for _ in range(60)]


def test_languages_learned_from_unequal_lengths(spark):
    draw = random.Random(2)
    much, little = _tongue(1), _tongue(2)
    samples = (
        ("little", " " + " ".join(draw.choices(little, k=60)) + " "),
        ("much", " " + " ".join(draw.choices(much, k=9000)) + " "),
    )
    rows = [(k, " ".join(draw.choices((little, much)[k % 2], k=30))) for k in range(100)]
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs_frame(spark, rows), samples).collect()}
    right = sum(found[k] == ("little", "much")[k % 2] for k in range(100))
    assert right >= 95


def test_language_of_long_documents_only_is_learned(spark):
    draw = random.Random(5)
    long = " ".join(draw.choices(_tongue(7), k=20_000))
    short = [(k, " ".join(draw.choices(_tongue(8), k=40)), "s") for k in range(30)]
    assert len(long) > 5 * langid.Fit().doc_chars
    samples = langid.learned_samples(docs_frame(spark, [(99, long, "l"), *short]))
    assert [lang for lang, _ in samples] == ["l", "s"]
    assert 5000 < len(samples[0][1]) <= langid.Fit().doc_chars + 2


def _plain_score(text, weights, bias, fit):
    data = (text or "").encode()
    clean, spans = 1.0, []
    for found in re.finditer(rb"[^.!?\n]+", data):
        bag = toxicity.bags(Texts.of(pa.array([found.group().decode("utf-8", "ignore")], pa.large_string())), fit)
        if not len(bag.features):
            continue
        q = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(weights[bag.features].sum()) + bias))))
        clean *= 1 - min(q, 1 - 1e-12)
        if q >= 0.3:
            spans.append((found.start() + int(bag.spans[0][0]), found.start() + int(bag.spans[0][1])))
    return 1 - clean, spans


def test_toxicity_equals_plain_noisy_or(spark):
    fit = toxicity.Fit(bits=12)
    weights = np.random.default_rng(1).normal(0, 2, 1 << 12).astype(np.float32).astype(float)
    draw = random.Random(8)
    rows = [r for r in AWKWARD if len(r[1] or "") < 1000]
    for k in range(80):
        parts = [" ".join(prose(k * 9 + s, draw.randint(0, 6))) for s in range(draw.randint(0, 6))]
        rows.append((100 + k, "".join(p + draw.choice([". ", "!", "?\n", "\n", " é. "]) for p in parts)))
    found = {}
    for r in toxicity.toxicity(docs_frame(spark, rows), weights, -3.0, fit).collect():
        spans = [(s["first"], s["last"]) for s in r.sentences]
        found.setdefault(r.doc_id, []).append((r.score, spans, r.predicted))
    assert sum(map(len, found.values())) == len(rows)
    for doc_id, text, *_ in rows:
        score, spans = _plain_score(text, weights, -3.0, fit)
        for seen in found[doc_id]:
            # Weights are summed in single precision.
            assert abs(seen[0] - score) < 1e-5 and seen[1:] == (spans, int(score >= 0.3))


def test_long_documents_are_learned_from_within_a_budget(spark):
    rows = [(k, f"word{k} " * (30_000 if k % 2 else 20)) for k in range(40)]
    marks = spark.createDataFrame([(k, k % 4 == 1) for k in range(40)], "doc_id bigint, toxic boolean")
    labels = marks.selectExpr("doc_id", "CAST(toxic AS INT) AS toxic")
    usable = [k for k in range(40) if zlib.crc32(str(k).encode()) % 4 != 2]
    fit = toxicity.Fit(sample_chars=500, total_chars=10**9)
    found = toxicity.labelled_sample(docs_frame(spark, rows), labels, fit).collect()
    assert sorted(r.doc_id for r in found) == usable
    assert {len(r.text) for r in found if r.doc_id % 2} == {500}
    few = toxicity.labelled_sample(docs_frame(spark, rows), labels, toxicity.Fit(sample_chars=500, total_chars=3000))
    kept = few.collect()
    assert 0 < sum(len(r.text) for r in kept) <= 3000 and {r.doc_id for r in kept} < set(usable)
