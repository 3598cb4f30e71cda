"""Token counts, toxicity, language, quality."""

import json
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cases import AWKWARD, docs_frame, prose
from loomwork.llm import bpe, langid, quality, toxicity
from loomwork.llm.ship import bucket_of

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _library(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [len(t.ids) for t in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_token_counts_equal_the_library():
    draw = random.Random(1)
    parts = list("ab  \n\t'sé.,!?12²Ⅷ中文🙂 　\x0b\x1c\x85_$") + ["<|endoftext|>", "the ", " of", "'ll", "'Re"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 30))) for _ in range(5000)]
    texts += ["x" * 20_000, " " * 3000, "a\n" * 2000, "ab" * 5000, "<|endoftext|>" * 3]
    assert bpe.count_tokens(texts, open(VOCABULARY, encoding="utf-8").read()) == _library(texts)


def test_token_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 10)
    monkeypatch.setattr(bpe, "CHUNKS", 10)
    merger = bpe.Merger(open(VOCABULARY, encoding="utf-8").read())
    text = " ".join(prose(3, 500))
    assert merger.count(text) == _library([text])[0]
    assert len(merger.pieces) <= 10 and len(merger.chunks) <= 10


def test_token_rows(spark):
    found = bpe.token_counts(docs_frame(spark, AWKWARD), VOCABULARY, limit=1024).collect()
    expected = []
    for doc_id, text, *_ in AWKWARD:
        n = _library([text])[0] if text else 0
        expected.append((doc_id, len((text or "").encode()), n, n > 1024))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert bpe.token_counts(docs_frame(spark, []), VOCABULARY).collect() == []


def test_unsupported_vocabulary_is_refused():
    source = json.load(open(VOCABULARY, encoding="utf-8"))
    source["normalizer"] = {"type": "Lowercase"}
    with pytest.raises(ValueError, match="normalizers"):
        bpe.Merger(json.dumps(source))


def test_suffix_automaton_parses_greedily():
    sample, draw = "abracadabra abba", random.Random(4)
    automaton = langid.Automaton(sample)
    for _ in range(2000):
        text = "".join(draw.choice("abrcd xz") for _ in range(draw.randint(0, 12)))
        count = at = 0
        while at < len(text):
            end = at + 1
            while end <= len(text) and text[at:end] in sample:
                end += 1
            at, count = max(at + 1, end - 1), count + 1
        assert automaton.phrases(text) == count, text


def test_language_rows(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    samples = langid.learned_samples(docs.where(~langid.held_out(docs)))
    assert [lang for lang, _ in samples] == ["de", "en", "es", "fr"]
    found = {r["doc_id"]: r for r in langid.identify(docs, samples).collect()}
    held = [r for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    right = sum(found[r["doc_id"]]["lang_pred"] == r["lang"] for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_of_awkward_rows(spark):
    docs = docs_frame(spark, AWKWARD)
    found = langid.identify(docs, (("en", " word one two "), ("fr", " un deux trois "))).collect()
    by_id = {r["doc_id"]: r["lang_pred"] for r in found}
    assert len(found) == len(AWKWARD)
    assert {by_id[i] for i in (1, 2, 3, -7)} == {langid.UNDETERMINED}
    assert by_id[5] == "en"
    assert {r["lang_pred"] for r in langid.identify(docs, ()).collect()} == {langid.UNDETERMINED}
    assert langid.learned_samples(docs_frame(spark, [])) == ()
    assert langid.identify(docs_frame(spark, []), ()).collect() == []


def test_toxicity_on_held_out_rows(spark, data):
    data = data.replace("sf0.01", "sf0.1")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    weights, bias = toxicity.train(docs, labels)
    scored = toxicity.toxicity(docs, weights, bias, locate=False)
    held = scored.join(labels, "doc_id").where(bucket_of(F.col("doc_id"), 4) == 2).collect()
    toxic = [r["score"] for r in held if r["toxic"] == 1]
    clean = [r["score"] for r in held if r["toxic"] == 0]
    wins = np.mean([[t > c for c in clean] for t in toxic])
    assert wins > 0.97
    assert np.mean(np.array(toxic) >= 0.3) > 0.85 and np.mean(np.array(clean) >= 0.3) < 0.02


def test_offending_sentences_are_found(spark):
    draw = random.Random(6)
    texts, labels = [], []
    for k in range(600):
        sentences = [" ".join(prose(k * 7 + s, draw.randint(3, 9))) for s in range(draw.randint(1, 8))]
        labels.append(k % 4 == 0)
        if k % 4 == 0:
            at = draw.randrange(len(sentences))
            sentences[at] += " vilest"
        texts.append(". ".join(sentences) + ".")
    fit = toxicity.Fit(epochs=200)
    weights, bias = toxicity.learn(texts, np.array(labels), fit)
    docs = docs_frame(spark, list(enumerate(texts)) + [(9000, None), (9001, ""), (9002, "?!. ..\n")])
    found = {r["doc_id"]: r for r in toxicity.toxicity(docs, weights, bias, fit).collect()}
    for k, text in enumerate(texts):
        spans = found[k]["sentences"]
        assert bool(spans) == labels[k] == bool(found[k]["predicted"])
        for s in spans:
            assert b"vilest" in text.encode()[s["first"] : s["last"]]
    assert all(found[k]["score"] == 0 for k in (9000, 9001, 9002))


def test_toxicity_without_both_labels(spark):
    weights, bias = toxicity.learn(["a b", "c d"], np.array([0, 0]))
    assert not weights.any() and toxicity.learn([], np.array([]))[1] == bias
    found = toxicity.toxicity(docs_frame(spark, AWKWARD), weights, bias).collect()
    assert len(found) == len(AWKWARD) and all(r["predicted"] == 0 for r in found)
    assert toxicity.toxicity(docs_frame(spark, []), weights, bias).collect() == []


def _hash(parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode(), seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def _grams(words, buckets):
    return [_hash(words[i : i + n]) % buckets for n in (1, 2) for i in range(len(words) - n + 1)]


def _brute_quality(rows, trusted, rules):
    split = [[w for w in _words(t)] for _, t, *_ in rows]
    raw, target = np.zeros(rules.buckets), np.zeros(rules.buckets)
    for (doc_id, *_), words in zip(rows, split):
        for g in _grams(words, rules.buckets):
            raw[g] += 1
            target[g] += doc_id in trusted
    p_raw = (raw + 1) / (raw.sum() + rules.buckets)
    p_target = (target + rules.prior * p_raw) / (target.sum() + rules.prior)
    ratio = np.log(p_target / p_raw) if target.sum() else np.zeros(rules.buckets)
    out = []
    for (doc_id, text, *_), words in zip(rows, split):
        seen, covered = {}, set()
        for i in range(len(words) - 4):
            seen.setdefault(tuple(words[i : i + 5]), []).append(i)
        for places in seen.values():
            if len(places) > 1:
                covered.update(p + k for p in places for k in range(5))
        lines = [x for x in (text or "").split("\n") if _words(x)]
        found = _grams(words, rules.buckets)
        score = sum(ratio[g] for g in found) / (len(found) + rules.neutral) if words else None
        failed = len(words) < rules.min_words or 100 * len(covered) > rules.max_repeat_pct * len(words)
        out.append(
            (
                doc_id,
                len(words),
                sum(map(len, words)),
                sum(c in "#*$%&|<>" for c in text or ""),
                len(lines) - len(set(lines)),
                len(covered),
                failed,
                not failed and score >= rules.threshold,
                None if score is None else round(score, 9),
            )
        )
    return sorted(out, key=str)


def _words(text):
    import re

    return re.findall("[^\x20\x09-\x0d]+", text or "")


def test_quality_equals_brute_force(spark):
    draw = random.Random(8)
    rows = list(AWKWARD)
    for k in range(60):
        words = prose(k % 3, draw.randint(0, 60), 40)
        if k % 5 == 0:
            words = [w + "***" for w in words]
        if k % 4 == 0:
            words = words + words[: len(words) // 2]
        text = "".join(w + draw.choice([" ", " ", "\n", "  ", "\t"]) for w in words)
        rows.append((100 + k, text))
    rows += [(200, "a b c d e a b c d e"), (201, "a a a a a a a"), (202, "x y\nx y\n\n \nz\nx y"), (203, "one two three four five")]
    trusted = {100 + k for k in range(60) if k % 5}
    rules = quality.Rules(buckets=64, prior=16)
    labels = spark.createDataFrame([(i, 1, 0) for i in trusted] + [(101, 1, 0), (None, 1, 0), (105, 0, 0)], "doc_id bigint, quality int, toxic int")
    frame = docs_frame(spark, rows)
    found = quality.quality(frame, quality.trusted_documents(labels), rules).collect()
    shown = [(*r[:8], None if r["score"] is None else round(r["score"], 9)) for r in found]
    assert sorted(shown, key=str) == _brute_quality(rows, trusted, rules)
    kept = quality.keep_good(frame, quality.trusted_documents(labels), rules)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((r["doc_id"] for r in found if r["kept"]), key=str)


def test_target_counts_every_trusted_document(spark):
    docs = spark.range(20_500).selectExpr("id AS doc_id", "concat('w', id % 7, ' x') AS text")
    trusted = docs.where("doc_id >= 100").select("doc_id")
    counts = quality.gram_counts(docs, trusted.unionByName(trusted), quality.Rules()).collect()
    assert (sum(r["raw"] for r in counts), sum(r["target"] for r in counts)) == (3 * 20_500, 3 * 20_400)


def test_quality_without_trusted_rows(spark):
    nothing = spark.createDataFrame([], "doc_id bigint")
    rows = [(1, " ".join(prose(1, 30))), (2, "short"), (3, None)]
    found = {r["doc_id"]: r for r in quality.quality(docs_frame(spark, rows), nothing).collect()}
    assert found[1]["kept"] and found[1]["score"] == 0 and not found[2]["kept"] and not found[3]["kept"]
    assert quality.quality(docs_frame(spark, []), nothing).collect() == []


def test_quality_keeps_clean_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    judged = quality.quality(docs, quality.trusted_documents(labels)).join(labels, "doc_id").collect()
    good = [r for r in judged if r["quality"] == 1 and not r["base_failed"]]
    poor = [r for r in judged if r["quality"] == 0]
    assert all(r["kept"] for r in good)
    assert sum(r["kept"] for r in poor) <= 0.1 * len(poor)
    assert not math.isnan(sum(r["score"] for r in good))
