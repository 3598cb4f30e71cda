"""Mixing, packing, and the pipeline."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cases import AWKWARD, docs_frame, prose
from loomwork.llm.mixing import apply_mix, exponential_key, key_range, mix, quality_weights, weight_class
from loomwork.llm.packing import Lengths, pack, packed, packed_documents


def _sizes():
    draw = random.Random(3)
    rows = list(AWKWARD)
    for k in range(300):
        source = draw.choice(["a", "a", "a", "b", "c", "é", "Z", None])
        rows.append((1000 + k, " ".join(prose(k, draw.randint(0, 80))), "en", source))
    return rows


def _targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by resharing the excess until nothing is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, share * sum(sizes.values()), set(names)
    while True:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = cap * sizes[s]
            free.discard(s)
            left -= target[s]


@pytest.mark.parametrize("range_rows", [7, 100_000])
def test_mix_equals_brute_force(spark, range_rows):
    rows = _sizes()
    quality = {1000 + k: 2.0 for k in range(0, 300, 3)}
    weights = spark.createDataFrame(list(quality.items()), "doc_id bigint, weight double")
    found = mix(docs_frame(spark, rows), quality=weights, range_rows=range_rows).collect()
    size = [len((t or "").split()) if (t or "").isascii() else len([w for w in (t or "").split(" ") if w]) for _, t, *_ in rows]
    sources: dict = {}
    for (_, _, _, source), n in zip(rows, size):
        sources[source] = sources.get(source, 0) + n
    targets = _targets(sources)
    order: dict = {}
    for (doc_id, text, _, source), n in zip(rows, size):
        seed = f"mix-1|{'' if doc_id is None else doc_id}|{text or ''}"
        u = (int(hashlib.md5(seed.encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        order.setdefault(source, []).append((-math.log(u) / quality.get(doc_id, 1.0), doc_id, n))
    expected = []
    for source, items in order.items():
        whole = math.floor(targets[source] / sources[source]) if sources[source] else 0
        rest, before = targets[source] - whole * sources[source], 0
        for key, doc_id, n in sorted(items, key=lambda x: (x[0], -1 if x[1] is None else x[1])):
            taken = whole * n + (n if n and before + n / 2 <= rest else 0)
            expected.append((doc_id, n, sources[source], round(targets[source], 6), taken))
            before += n
    shown = [(r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in found]
    assert sorted(shown, key=str) == sorted(expected, key=str)
    assert all(r["taken"] <= 2 * r["size"] for r in found)


def test_mix_repeats_documents(spark):
    frame = docs_frame(spark, _sizes())
    decided = mix(frame)
    taken = Counter()
    for r in decided.collect():
        taken[r["doc_id"]] += r["copies"]
    left = apply_mix(frame, decided)
    assert left.columns == frame.columns
    assert Counter(r["doc_id"] for r in left.collect()) == +taken
    assert mix(docs_frame(spark, [])).collect() == []
    assert {r["taken"] for r in mix(docs_frame(spark, [(1, None, "en", None), (2, "", "en", "a")])).collect()} == {0}


def test_quality_weights(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (None, 1), (3, None)], "doc_id bigint, quality int")
    assert sorted(map(tuple, quality_weights(labels).collect())) == [(1, 2.0), (2, 0.5)]


def _best_fit(sizes, lengths):
    """The same rules by plain search; opening is checked by its outcome only."""
    bins, offsets, capacities = pack(sizes, lengths)
    held: dict = {}
    for i, b in enumerate(bins):
        held.setdefault(b, []).append((offsets[i], sizes[i]))
    for b, items in held.items():
        at = 0
        for offset, size in sorted(items):
            assert offset == at
            at += size
        assert capacities[b] == min(c for c in lengths.capacities if c >= at)
    return held, capacities


@pytest.mark.parametrize("seed", range(8))
def test_pack_is_sound_and_tight(seed):
    draw = random.Random(seed)
    lengths = Lengths(capacities=(8, 16, 32), per_bin=2.0, attention=1 / 64)
    sizes = [draw.randint(1, 32) if seed % 2 else min(32, 1 + int(draw.expovariate(0.2))) for _ in range(400)]
    held, capacities = _best_fit(sizes, lengths)
    assert sorted(s for items in held.values() for _, s in items) == sorted(sizes)
    assert sum(sizes) / sum(capacities) > 0.9
    cost = sum(lengths.cost(c) for c in capacities)
    single = min(
        sum(lengths.cost(c) for c in pack(sizes, Lengths((c, 32) if c < 32 else (32,), 2.0, 1 / 64))[2]) for c in (8, 16, 32)
    )
    assert cost <= 1.1 * single


def test_pack_edges():
    lengths = Lengths(capacities=(4, 8), costs={4: 4.0, 8: 7.0})
    assert pack([], lengths) == ([], [], [])
    assert pack([8, 4, 4], lengths)[2] in ([8, 8], [8, 4, 4])
    assert pack([1], lengths)[2] == [4]
    with pytest.raises(ValueError):
        pack([9], lengths)


def test_packed_rows(spark):
    lengths = Lengths(capacities=(64, 256))
    rows = [(k, n) for k, n in enumerate([0, 1, 63, 64, 65, 255, 256, 257, 5000])] + [(3, 64), (None, 7), (90, None), (91, -4)]
    rows += [(200 + k, 30) for k in range(400)]
    frame = spark.createDataFrame([(*r, "x", "x") for r in rows], "doc_id bigint, size int, piece string, length string")
    found = packed(frame, "doc_id", "size", lengths, shard_rows=50).collect()
    tokens = Counter()
    spans: dict = {}
    for r in found:
        tokens[r["doc_id"]] += r["length"]
        if r["bin_id"] is None:
            assert r["length"] == 0
            continue
        spans.setdefault(r["bin_id"], []).append((r["offset"], r["length"], r["bin_capacity"], r["bin_fill"]))
    expected = Counter()
    for doc_id, n in rows:
        expected[doc_id] += max(n or 0, 0)
    assert tokens == expected and len({r["doc_id"] for r in found}) == len({r[0] for r in rows})
    for items in spans.values():
        at = 0
        for offset, length, capacity, fill in sorted(items):
            assert offset == at
            at += length
        assert at == fill and capacity == (64 if fill <= 64 else 256)
    assert packed(frame.limit(0), "doc_id", "size").collect() == []
    assert len({r["doc_id"] for r in packed_documents(docs_frame(spark, AWKWARD)).collect()}) == len({r[0] for r in AWKWARD})


def test_packing_is_the_same_in_every_run(spark):
    draw = random.Random(12)
    rows = [(draw.choice([None, *range(200)]), draw.choice([0, 3, 7, 40, 300, 9000])) for _ in range(900)]
    frame = spark.createDataFrame(rows, "k bigint, size bigint")
    one, two = (packed(frame.repartition(n), "k", "size", shard_rows=100).collect() for n in (2, 7))
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, two), key=str)


def _plain_pack(sizes, lengths):
    """Variable-capacity best fit by looking at every bin and every capacity."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bins = []
    for n, i in enumerate(order):
        size = sizes[i]
        fitting = [b for b in bins if b["room"] >= size]
        if not fitting:
            best = None
            for capacity in sorted(lengths.capacities, reverse=True):
                if capacity < size:
                    continue
                room = capacity - size
                for k in order[n + 1 :]:
                    room -= sizes[k] if sizes[k] <= room else 0
                rate = lengths.cost(capacity) / (capacity - room)
                if best is None or rate < best[0]:
                    best = (rate, capacity)
            bins.append({"room": best[1], "items": []})
            fitting = [bins[-1]]
        chosen = min(fitting, key=lambda b: b["room"])
        chosen["room"] -= size
        chosen["items"].append(size)
    final = [min(c for c in lengths.capacities if c >= sum(b["items"])) for b in bins]
    return sorted((c, sorted(b["items"])) for c, b in zip(final, bins))


@pytest.mark.parametrize("seed", range(12))
def test_packing_equals_plain_best_fit(seed):
    draw = random.Random(seed)
    lengths = Lengths(capacities=(8, 16, 40), per_bin=draw.choice([0.0, 2.0, 30.0]), attention=draw.choice([0.0, 0.05]))
    # Distinct amounts of room, so that no two bins tie.
    sizes = [draw.randint(1, 40) for _ in range(draw.randint(1, 40))]
    bins, _, capacities = pack(sizes, lengths)
    shown = [[] for _ in capacities]
    for size, b in zip(sizes, bins):
        shown[b].append(size)
    found = sorted((c, sorted(items)) for c, items in zip(capacities, shown))
    plain = _plain_pack(sizes, lengths)
    cost = lambda rows: sum(lengths.cost(c) for c, _ in rows)
    assert cost(found) == pytest.approx(cost(plain)) and [c for c, _ in found] == [c for c, _ in plain]


@pytest.mark.parametrize("weights", [[0.5], [3.0], [0.5, 1.0, 2.0], [0.7, 0.05, 40.0]])
def test_ranges_are_even_whatever_the_weights(spark, weights):
    n, size = 20_000, 100
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("id") % len(weights) + 1).cast("int"))
    rows = spark.range(n).select(
        exponential_key(F.col("id"), F.lit("x"), weight).alias("key"), weight_class(weight).alias("class")
    )
    classes = rows.groupBy("class").agg(F.count("*").alias("n"))
    listed = classes.agg(F.sort_array(F.collect_list(F.struct("class", "n"))).alias("classes"))
    placed = rows.crossJoin(F.broadcast(listed)).select("key", key_range(F.col("key"), F.col("classes"), size).alias("r"))
    ranges = placed.groupBy("r").agg(F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("b"))
    found = ranges.orderBy("r").collect()
    assert max(r["n"] for r in found) < 2 * size
    assert all(one["b"] < other["a"] for one, other in zip(found, found[1:]))
