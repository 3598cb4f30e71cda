"""Exact quantiles, and states of deliveries that merge."""

import random
import statistics

import numpy as np
import pytest

from loomwork.operators.distinct import distinct_from_states, distinct_states, relative_error
from loomwork.operators.frequent import frequent_from_states, frequent_state
from loomwork.operators.quantiles import _narrow, _Wanted, exact_quantiles, summary_table

SHARES = (0.0, 0.01, 0.25, 1 / 3, 0.5, 0.9, 1.0)


def _columns():
    draw = random.Random(5)
    n = 3000
    return {
        "smooth": [draw.gauss(0, 100) for _ in range(n)],
        "lumpy": [float(draw.choice([1, 1, 1, 1, 2, 9])) for _ in range(n)],
        "holes": [None if k % 3 else draw.choice([float("nan"), draw.random()]) for k in range(n)],
        "empty": [None] * n,
        "one": [7.0 if k == 0 else None for k in range(n)],
    }


@pytest.mark.parametrize("most_values", [50, 1 << 20])
def test_quantiles_equal_sorting(spark, most_values):
    data = _columns()
    rows = list(zip(*data.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).repartition(4)
    found = exact_quantiles(df, list(data), SHARES, accuracy=100, most_values=most_values).collect()
    assert len(found) == len(data) * len(SHARES)
    for row in found:
        values = [v for v in data[row.column_name] if v is not None and v == v]
        if values:
            assert row.value == pytest.approx(float(np.quantile(values, row.share)), rel=1e-12)
        else:
            assert row.value is None


def test_brackets_hold_few_values(spark):
    df = spark.range(20_000).selectExpr("CAST(id * 7919 % 20000 AS DOUBLE) AS x").repartition(5)
    wanted = _Wanted("x", 0.3, 20_000, inside=20_000)
    assert _narrow(df, [wanted], 1000)
    assert wanted.inside <= 4 * 20_000 / 1000 + 2 and wanted.below <= wanted.ranks[0] < wanted.below + wanted.inside


def test_summary_table(spark):
    values = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, None]
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)], "`a b` double, k int")
    found = {r["summary"]: (r["a b"], r["k"]) for r in summary_table(df, ["a b", "k"], (0.25, 0.5, 0.999)).collect()}
    clean = [v for v in values if v is not None]
    assert found["count"] == (7, 8) and found["mean"][0] == pytest.approx(statistics.mean(clean))
    assert found["stddev"][0] == pytest.approx(statistics.stdev(clean)) and found["max"] == (9, 7)
    assert found["25%"] == (1.5, 1.75) and found["50%"][0] == 3.0 and "99.9%" in found
    none = summary_table(df.limit(0), ["k"]).collect()
    assert {r["summary"]: r["k"] for r in none}["50%"] is None


def test_distinct_states_merge(spark, tmp_path):
    path = str(tmp_path / "states")
    for k in range(4):
        # Every delivery repeats half of the one before.
        df = spark.range(k * 5000, k * 5000 + 10_000).selectExpr("id", "id % 7 AS few", "IF(id % 4 = 0, NULL, 'x') AS gaps")
        distinct_states(df, ["id", "few", "gaps"], str(k)).write.mode("append").parquet(path)
    distinct_states(spark.range(10).selectExpr("id", "id AS few", "'x' AS gaps").limit(0), ["id"], "none").write.mode("append").parquet(path)
    found = {r.column_name: r for r in distinct_from_states(spark.read.parquet(path)).collect()}
    assert found["id"].total_rows == 40_000 and abs(found["id"].distinct_estimate - 25_000) <= 25_000 * relative_error()
    assert found["few"].distinct_estimate == 7 and found["gaps"].distinct_estimate == 1
    assert found["gaps"].completeness_pct == 75.0
    sizes = [len(r.sketch) for r in spark.read.parquet(path).collect()]
    assert max(sizes) <= (1 << 14) + 64


def _deliveries(spark):
    draw = random.Random(4)
    parts = {}
    for k in range(3):
        heavy = ["a"] * 50 + [None] * 40 + (["b"] * 60 if k == 0 else ["b"] * 4)
        parts[str(k)] = heavy + [f"{k}-{draw.randint(0, 60)}" for _ in range(90)]
    frames = {k: spark.createDataFrame([(v,) for v in rows], "value string").repartition(3) for k, rows in parts.items()}
    return parts, frames


@pytest.mark.parametrize("support", [0.05, 0.1, 0.2, 0.5])
def test_frequent_values_over_deliveries(spark, support):
    parts, frames = _deliveries(spark)
    states = [frequent_state(f, "value", k, 0.05) for k, f in frames.items()]
    # A state stored twice counts once.
    whole = states[0].unionByName(states[1]).unionByName(states[2]).unionByName(states[1])
    assert whole.count() <= 4 * 21
    asked = []

    def again(delivery):
        asked.append(delivery)
        return frames[delivery]

    found = {r.value: r.n for r in frequent_from_states(whole, support, again).collect()}
    rows = [v for part in parts.values() for v in part]
    assert found == {v: rows.count(v) for v in set(rows) if rows.count(v) >= support * len(rows)}
    # Delivery 0 stored every candidate.
    assert "0" not in asked


def test_undecided_values_need_a_recount(spark):
    _, frames = _deliveries(spark)
    states = frequent_state(frames["0"], "value", "0", 0.05).unionByName(frequent_state(frames["1"], "value", "1", 0.05))
    with pytest.raises(ValueError):
        frequent_from_states(states, 0.1)
    # Values that every state holds need none.
    found = frequent_from_states(states.where("whole OR value IN ('a') OR value IS NULL"), 0.15).collect()
    assert {r.value for r in found} == {"a", None}
