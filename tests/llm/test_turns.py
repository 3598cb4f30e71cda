"""Conversation repair against a plain search over edits."""

import hashlib
import random
import re
import zlib

import pytest

from loomwork.llm import turns
from loomwork.llm.turns import CLOSE, GONE, START, damaged, edits, edits_of, repair, runs_of

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, content string, part int, cost string, edits string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "x", "x") for r in rows], SCHEMA).repartition(3)


def _spoil(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def _search(rows):
    """Cheapest (cost, audit, turns) by trying every edit of every row, best first by cost, then audit."""
    best = {}

    def solve(i, state):
        # state: initials so far that matter: '', 's', 'u', 'a'.
        if (i, state) in best:
            return best[i, state]
        follow = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
        names = {"u": "user", "a": "assistant"}
        ways = []
        if i == len(rows):
            if state in ("", "a"):
                ways.append((0, "", ()))
        else:
            role, text, fault = rows[i]
            extra = 5 * (fault == "truncated")
            rest = solve(i + 1, state)
            ways.append((2 + rest[0], "D" + rest[1], rest[2]))
            if fault not in ("blank", "duplicate"):
                initial = role[:1]
                if initial == follow or (initial == "s" and state == ""):
                    rest = solve(i + 1, initial)
                    ways.append((extra + rest[0], "K" + rest[1], ((role, text), *rest[2])))
                rest = solve(i + 1, follow)
                ways.append((1 + extra + rest[0], "R" + rest[1], ((names[follow], text), *rest[2])))
        depth = len([k for k in inserting if k == i])
        if depth < 3:
            inserting.append(i)
            kept = dict(best)
            rest = solve(i, follow)
            best.clear()
            best.update(kept)
            inserting.pop()
            ways.append((5 + rest[0], "I" + rest[1], ((names[follow], ""), *rest[2])))
        found = min(ways, key=lambda w: w[:2]) if ways else (1 << 40, "", ())
        if not depth:
            best[i, state] = found
        return found

    inserting = []
    return solve(0, "")


def _plain(rows):
    """One conversation the plain way."""
    order = lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest())
    rows = sorted(rows, key=order)
    seen, marked = set(), []
    for _, _, role, text in rows:
        bare = text.strip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, fault))
    cost, audit, said = _search(marked)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
    numbers = [t for _, t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    count = lambda f: sum(m[2] == f for m in marked)
    illegal = sum(p not in ("su", "ua", "au") for p in pairs)
    whole = "\n".join(f"{r}:{t}" for r, t in said)
    return (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, whole)


def _rows(seed, conversations=60, longest=9):
    draw = random.Random(seed)
    texts = ["Hi.", "Hi.", "no end", "What?", "", " \t", None, "same same.", "end!\n ", "é中"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "usher", "user"]
    rows = []
    for conv in [*range(conversations), None]:
        for _ in range(draw.randint(1, longest)):
            turn = draw.choice([None, *range(12)])
            rows.append((conv, turn, draw.choice(roles), draw.choice(texts)))
        if draw.random() < 0.3:
            rows += rows[-2:]
    return rows


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"]


@pytest.mark.parametrize("spoilt", [False, True])
@pytest.mark.parametrize("segment_rows", [7, 20_000])
def test_repair_equals_search(spark, segment_rows, spoilt):
    rows = _rows(segment_rows)
    table = frame(spark, rows)
    found = repair(damaged(table) if spoilt else table, original=table, segment_rows=segment_rows)
    found = {r.conv_id: tuple(r[n] for n in NAMES) for r in found.collect()}
    given = _spoil(rows) if spoilt else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    groups = {c: [] for c, *_ in rows}
    for row in given:
        groups[row[0]].append(row)
    assert found == {c: _plain(g) for c, g in groups.items()}


def test_conversation_over_many_segments(spark):
    draw = random.Random(1)
    rows = [(5, k, draw.choice(["user", "assistant", "tool"]), f"text {k}{draw.choice(['.', ''])}") for k in range(400)]
    rows += [(5, 400 + k, "user", "again.") for k in range(300)] + [(4, 0, "user", "a."), (6, 0, "user", "a.")]
    one = repair(frame(spark, rows)).collect()
    many = repair(frame(spark, rows), segment_rows=11).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))
    long = next(r for r in one if r.conv_id == 5)
    symbols = []
    seen = set()
    for _, _, role, text in rows[:700]:
        fault = (role, text) in seen
        seen.add((role, text))
        symbols.append(GONE if fault else 2 * {"user": 1, "assistant": 2, "tool": 3}[role] + (text[-1] != "."))
    # The plain way over all rows, one row at a time.
    costs = [CLOSE]
    for s in reversed(symbols):
        costs.append(turns.advance(turns.power(s, 0), costs[-1]))
    assert long.cost == costs[-1][START] and long.duplicate == 299


def test_runs_unroll_like_single_rows():
    draw = random.Random(2)
    for _ in range(300):
        runs = runs_of([draw.randint(0, 8) for _ in range(draw.randint(1, 8))], [draw.randint(1, 40) for _ in range(8)])
        singles = [(s, 1) for s, n in runs for _ in range(n)]
        assert edits_of(runs) == edits_of(singles)
        matrix = turns.matrix_of(runs)
        after = [draw.randint(0, 9) for _ in range(4)]
        assert turns.advance(matrix, after) == turns.advance(turns.matrix_of(singles), after)


def test_long_run_of_copies(spark):
    found = repair(frame(spark, [(1, 3, "user", "copy.")] * 5000)).collect()[0]
    assert (found.duplicate, found.illegal, found.audit) == (4999, 4999, "D" * 5000)
    assert found.repaired == "" and found.cost == 10_000 and found.gaps == 0


def test_edits_have_one_row_per_content_and_ignore_other_columns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", "x" * 300_000 + ".")]
    found = edits(frame(spark, rows)).orderBy("turn").collect()
    assert [(r.copies, r.edits, r.new_role) for r in found] == [(2, "KD", ""), (1, "K", "")]


def test_empty_table_and_lost_conversations(spark):
    none = frame(spark, [(1, 0, "user", "a.")]).limit(0)
    assert repair(none).collect() == []
    lost = repair(none, original=frame(spark, [(8, 0, "user", "a.")])).collect()
    assert [tuple(r) for r in lost] == [(8, 0, 0, 0, 0, 0, 0, "", "")]
