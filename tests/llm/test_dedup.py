"""Exact and near duplicates."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cases import AWKWARD, docs_frame, prose
from loomwork.llm.exact import drop_exact_duplicates, exact_duplicates
from loomwork.llm.graph import components
from loomwork.llm import minhash
from loomwork.llm.minhash import BINS, Near, drop_near_duplicates, near_duplicates, shingle_sets, signature

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_groups(spark, keep):
    rows = AWKWARD + [(20, "Same"), (21, "sAME"), (22, "same "), (None, "SAME"), (30, "É"), (31, "é")]
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    expected = []
    for norm, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        digest = hashlib.sha256(norm.encode()).hexdigest()
        expected += [(i, best, len(ids), i == best, digest) for i in ids]
    found = [tuple(r) for r in exact_duplicates(docs_frame(spark, rows), keep=keep).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_exact_drop_keeps_all_columns(spark):
    rows = docs_frame(spark, [(3, "b"), (2, "B"), (2, "B"), (None, "c"), (None, "C"), (5, None), (6, "")])
    left = drop_exact_duplicates(rows)
    assert left.columns == rows.columns
    assert sorted(((r["doc_id"], (r["text"] or "").lower()) for r in left.collect()), key=str) == sorted(
        [(2, "b"), (None, "c"), (5, "")], key=str
    )


def test_exact_empty(spark):
    assert exact_duplicates(docs_frame(spark, [])).collect() == []
    assert drop_exact_duplicates(docs_frame(spark, [])).collect() == []


def _brute(rows, size, percent=80):
    sets = []
    for _, text, *_ in rows:
        words = (text or "").translate(LOWER).split()
        if not words:
            sets.append(set())
        elif len(words) < size:
            sets.append({tuple(words)})
        else:
            sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)})
    place = list(range(len(rows)))

    def root(i):
        while place[i] != i:
            i = place[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                place[root(i)] = root(j)
    smallest = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            r = root(i)
            smallest[r] = min(smallest.get(r, doc_id), doc_id)
    return sorted(
        [(doc_id, len(sets[i]), smallest.get(root(i))) for i, (doc_id, *_) in enumerate(rows)], key=str
    )


def _near_rows():
    """Copies at all similarities around the threshold, chains, a common passage, short texts."""
    draw = random.Random(5)
    rows, doc_id = [], 100
    passage = prose(1, 60)
    for group in range(12):
        base = prose(group + 10, draw.choice([6, 12, 40, 200]))
        chain = base
        for step in range(12):
            text = list(chain if group % 3 == 0 else base)
            for _ in range(draw.randint(0, max(1, len(text) // 25))):
                text[draw.randrange(len(text))] = f"new{draw.random()}"
            chain = text
            rows.append((doc_id, " ".join(text)))
            doc_id += 1
    rows += [(doc_id + k, " ".join(passage + prose(1000 + k, 30))) for k in range(25)]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [4, 5])
def test_near_classes_equal_brute_force(spark, size):
    rows = _near_rows() + [(9000, "a b c"), (9001, "A b C"), (9002, "a b c d"), (9003, ""), (9004, None), (9005, " ")]
    near = Near(shingle=size)
    found = near_duplicates(docs_frame(spark, rows), near).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == _brute(rows, size)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


@pytest.mark.parametrize("bands", [1, 32])
def test_near_finds_every_pair_of_short_texts(spark, bands):
    rows = []
    for k in range(400):
        text = prose(k, 8)
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(text[:-1]))]
    found = near_duplicates(docs_frame(spark, rows), Near(bands=bands)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i - i % 2 for i, _ in rows}


@pytest.mark.parametrize("n", [500, 2000])
def test_near_large_component_meets_outsiders_only(spark, n):
    """What is compared under a key grows with a large component, not with its square."""
    rows = [(k, 1, 0) for k in range(n)] + [(n + k, 1, n + k) for k in range(5)]
    rows += [(k, 2, 0) for k in range(n)]
    met = minhash._across(spark.createDataFrame(rows, "rep bigint, key bigint, component bigint"))
    per_key = met.groupBy("key").agg(F.count_if(F.expr("component <> hub")).alias("outside"), F.count("*").alias("n"))
    assert [tuple(r) for r in per_key.collect()] == [(1, 5, n + 5)]


@pytest.mark.parametrize("ordered", [0, 40, 1 << 20])
def test_near_classes_hold_in_any_order_of_shingles(spark, monkeypatch, ordered):
    monkeypatch.setattr(minhash, "ORDERED", ordered)
    monkeypatch.setattr(minhash, "SMALL", 1000)
    rows = _near_rows()
    found = near_duplicates(docs_frame(spark, rows), Near(bands=1)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == _brute(rows, 4)


def test_rare_shingles_leave_out_what_texts_share(spark):
    passage = prose(1, 40)
    rows = [(k, " ".join(prose(50 + k, 30) + passage)) for k in range(30)]
    rare = minhash._rare_shingles(docs_frame(spark, rows), Near()).collect()
    assert {r["rep"] for r in rare} == set(range(30))
    assert len({r["key"] for r in rare}) == len(rare)


def test_near_awkward_rows(spark):
    found = near_duplicates(docs_frame(spark, AWKWARD)).collect()
    assert len(found) == len(AWKWARD)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["n_shingles"] == by_id[2]["n_shingles"] == by_id[3]["n_shingles"] == 0
    assert by_id[1]["kept"] and by_id[2]["kept"] and by_id[3]["kept"]
    # Four of them are the same sequence of words, one without an id.
    assert by_id[None]["component_id"] == 4 and not by_id[None]["kept"]
    left = drop_near_duplicates(docs_frame(spark, AWKWARD))
    assert left.columns == docs_frame(spark, []).columns
    assert sorted(r["doc_id"] for r in left.collect()) == [-7, 1, 2, 3, 4, 4, 5, 6, 8]
    assert near_duplicates(docs_frame(spark, [])).collect() == []


def test_signatures_agree_as_often_as_sets():
    draw = np.random.default_rng(3)
    for n, shared in ((5, 4), (50, 40), (1000, 800)):
        rates = []
        for _ in range(60):
            both = draw.integers(0, 1 << 63, shared, dtype=np.uint64) * np.uint64(2)
            extra = draw.integers(0, 1 << 63, n - shared, dtype=np.uint64) * np.uint64(2)
            a, b = np.sort(both), np.sort(np.concatenate([both, extra]))
            rates.append((signature(a) == signature(b)).mean())
        assert abs(np.mean(rates) - shared / n) < 0.05
    assert len(set(signature(np.array([5], np.uint64)).tolist())) == 2  # own bin and what others borrow
    assert len(signature(np.array([5], np.uint64))) == BINS


def test_shingles_of_long_and_short_texts():
    texts = pa.array([None, "", "a", "A b", "a b c d e", "x" * 100_000, "word " * 5])
    assert [len(s) for s in shingle_sets(texts, 4)] == [0, 0, 1, 1, 2, 1, 1]


@pytest.mark.parametrize("shape", ["chain", "star", "mixed"])
def test_components(spark, shape):
    draw = random.Random(2)
    if shape == "chain":
        links = [(i, i + 1) for i in range(200)]
    elif shape == "star":
        links = [(0, i) for i in range(1, 300)]
    else:
        links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(7, 7)]
    place = {}

    def root(i):
        place.setdefault(i, i)
        while place[i] != i:
            i = place[i]
        return i

    for a, b in links:
        if a != b:
            x, y = sorted((root(a), root(b)))
            place[y] = x
    expected = sorted((i, root(i)) for i in place)
    frame = spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint")
    assert sorted(map(tuple, components(frame).collect())) == expected
    assert components(frame.limit(0)).collect() == []
