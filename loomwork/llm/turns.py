"""Repair of the turn structure of conversations.

A conversation should read ``(s?(ua)+)?`` by the initials of its roles.  Its
rows are symbols, made of a role and a fault; what a row costs in each state of
that pattern is a 4 x 4 matrix under minimum and plus.  Equal neighbours form
runs, a run is a power of its symbol's matrix, and powers are kept in binary.
The matrices of stretches of one conversation compose, so a conversation may
span any number of tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.ship import importable
from loomwork.session import stage

# Rows, without their texts, that one task repairs together.
SEGMENT_ROWS = 20_000

DELETE, INSERT, RELABEL, CUT_OFF = 2, 5, 1, 5
WHITE = " \t\n\x0b\x0c\r"
NEVER = 1 << 50

# States: nothing yet, after the system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
# Where an inserted or relabelled turn leads; it is the user's unless the user spoke last.
NEXT = (USER, USER, ASSISTANT, USER)
# Symbols: 2 * role + truncated for roles s, u, a and any other; then rows that must go.
GONE = 8
S, U, A, OTHER = range(4)
LEGAL = {(S, U), (U, A), (A, U)}


def _kept(state: int, role: int) -> int | None:
    """The state after a turn of this role, or None where it may not stand."""
    if role == S:
        return SYSTEM if state == START else None
    if role in (U, A):
        return NEXT[state] if NEXT[state] == (USER if role == U else ASSISTANT) else None
    return None


def _row_costs(symbol: int) -> list[list[int]]:
    """Cheapest cost of a row from state to state, turns inserted before it included."""
    direct = [[NEVER] * 4 for _ in range(4)]
    for state in range(4):
        direct[state][state] = DELETE
        if symbol != GONE:
            extra = CUT_OFF * (symbol % 2)
            kept = _kept(state, symbol // 2)
            if kept is not None:
                direct[state][kept] = min(direct[state][kept], extra)
            to = NEXT[state]
            direct[state][to] = min(direct[state][to], RELABEL + extra)
    whole = [row[:] for row in direct]
    for state in range(4):
        at, paid = state, 0
        for _ in range(4):
            at, paid = NEXT[at], paid + INSERT
            whole[state] = [min(x, paid + y) for x, y in zip(whole[state], direct[at])]
    return whole


def product(left: Sequence[Sequence[int]], right: Sequence[Sequence[int]]) -> list[list[int]]:
    """Matrix product under minimum and plus."""
    columns = list(zip(*right))
    return [[min(min(x + y for x, y in zip(row, column)), NEVER) for column in columns] for row in left]


def advance(matrix: Sequence[Sequence[int]], after: Sequence[int]) -> tuple[int, ...]:
    """Cost to the end before a stretch, from the cost after it."""
    return tuple(min(min(x + y for x, y in zip(row, after)), NEVER) for row in matrix)


@lru_cache(maxsize=None)
def power(symbol: int, exponent: int) -> list[list[int]]:
    """The matrix of 2 ** exponent equal rows."""
    if exponent == 0:
        return _row_costs(symbol)
    half = power(symbol, exponent - 1)
    return product(half, half)


def _bits(length: int) -> list[int]:
    return [k for k in range(length.bit_length()) if length >> k & 1]


def advance_run(symbol: int, length: int, after: Sequence[int]) -> tuple[int, ...]:
    for k in _bits(length):
        after = advance(power(symbol, k), after)
    return tuple(after)


def matrix_of(runs: Sequence[tuple[int, int]]) -> list[list[int]]:
    """The matrix of a whole stretch of runs."""
    whole = [[0 if i == j else NEVER for j in range(4)] for i in range(4)]
    for symbol, length in runs:
        for k in _bits(length):
            whole = product(whole, power(symbol, k))
    return whole


# Cost to close the pattern from each state when no row is left.
CLOSE = tuple(0 if s in ENDS else INSERT if NEXT[s] in ENDS else 2 * INSERT for s in range(4))


@lru_cache(maxsize=1 << 16)
def _choice(symbol: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """The ASCII-least cheapest edits of one row, and the state they lead to."""
    before = advance(power(symbol, 0), after)
    edits = ""
    while True:
        best = before[state]
        if DELETE + after[state] == best:
            return edits + "D", state
        if INSERT + before[NEXT[state]] == best:
            edits += "I"
            state = NEXT[state]
            continue
        kept = _kept(state, symbol // 2)
        if kept is not None and CUT_OFF * (symbol % 2) + after[kept] == best:
            return edits + "K", kept
        return edits + "R", NEXT[state]


def _unroll(symbol: int, length: int, state: int, after: tuple[int, ...], out: list[str]) -> int:
    """Edits of a run, halved until single rows; the cached powers give the costs in the middle."""
    if length == 1:
        # Only differences matter, so that costs recur.
        least = min(after)
        edits, state = _choice(symbol, state, tuple(min(a - least, NEVER) for a in after))
        out.append(edits)
        return state
    rest = length - (1 << ((length - 1).bit_length() - 1))
    state = _unroll(symbol, length - rest, state, advance_run(symbol, rest, after), out)
    return _unroll(symbol, rest, state, after, out)


def runs_of(symbols: Sequence[int], lengths: Sequence[int]) -> list[tuple[int, int]]:
    """Equal neighbours collapsed."""
    runs: list[tuple[int, int]] = []
    for symbol, length in zip(symbols, lengths):
        if runs and runs[-1][0] == symbol:
            runs[-1] = (symbol, runs[-1][1] + length)
        else:
            runs.append((symbol, length))
    return runs


def edits_of(
    runs: Sequence[tuple[int, int]], state: int = START, after: Sequence[int] = CLOSE
) -> tuple[list[str], int]:
    """Cheapest edits of each row of a stretch, ASCII-least among equals, and the state at its end."""
    ends = [tuple(after)]
    for symbol, length in reversed(runs[1:]):
        ends.append(advance_run(symbol, length, ends[-1]))
    out: list[str] = []
    for (symbol, length), end in zip(runs, reversed(ends)):
        state = _unroll(symbol, length, state, end, out)
    return out, state


def closing(state: int) -> str:
    """Turns to insert at the very end."""
    return "I" * (CLOSE[state] // INSERT)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows spoilt on purpose, as decided by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4
    makes it the user's.  A null counts as one space, in the key as in role and text.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    code = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("_r"), F.coalesce("text", space).alias("_t"), code.alias("_c")
    ).where("_c <> 0")
    rows = rows.withColumn("_", F.explode(F.array_repeat(F.lit(0), F.when(F.col("_c") == 3, 2).otherwise(1))))
    text = F.when(F.col("_c") == 1, "").when(F.col("_c") == 2, F.translate("_t", ".!?", "")).otherwise(F.col("_t"))
    role = F.when(F.col("_c") == 4, "user").otherwise(F.col("_r"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def _contents(conversations: DataFrame) -> DataFrame:
    """Rows with a digest of role and text, and their symbol without regard to other rows; 9 for blank."""
    rows = conversations.select(
        "conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
    bare = F.btrim("text", F.lit(WHITE))
    cut_off = ~F.substring(bare, -1, 1).isin(".", "!", "?")
    named = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.withColumns(
        {
            "content": F.unhex(F.sha2(named, 256)),
            "role_no": role,
            "blank": bare == "",
            "cut_off": (bare != "") & cut_off,
        }
    )


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    one = F.lit(True)
    for name in names:
        one = one & left[name].eqNullSafe(right[f"_{name}"])
    return one


def _keyed(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumnsRenamed({n: f"_{n}" for n in names})


def _faults(conversations: DataFrame) -> DataFrame:
    """One row per conversation, turn and content: how often, and the faults of its copies."""
    slim = (
        _contents(conversations)
        .groupBy("conv_id", "turn", "content", "role_no", "blank", "cut_off")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    # Contents of several turns: all but the first are duplicates, copies of one turn too.
    shared = slim.where("NOT blank").groupBy("conv_id", "content").agg(
        F.count(F.lit(1)).alias("turns"),
        F.max(F.col("turn").isNull()).alias("untimed"),
        F.min("turn").alias("first"),
    )
    shared = _keyed(shared.where("turns > 1").drop("turns"), "conv_id", "content")
    rows = slim.join(shared, _same(slim, shared, "conv_id", "content"), "left")
    first = F.when(F.col("untimed"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first"))
    rows = rows.withColumn("again", F.col("untimed").isNotNull() & ~first)
    fault = F.col("blank") | F.col("again")
    symbol = F.when(fault, GONE).otherwise(2 * F.col("role_no") + F.col("cut_off").cast("int"))
    return rows.select("conv_id", "turn", "content", "role_no", "blank", "again", "copies", symbol.alias("symbol"))


def _runs(table: pa.Table) -> list[tuple[int, int]]:
    symbols, copies = table["symbol"].to_pylist(), table["copies"].to_pylist()
    marks, lengths = [], []
    for symbol, n in zip(symbols, copies):
        marks.append(symbol)
        lengths.append(1)
        if n > 1:
            marks.append(GONE)
            lengths.append(n - 1)
    return runs_of(marks, lengths)


def _spanning(laid: DataFrame) -> DataFrame:
    """What the stretches of conversations in several segments need to know of the others.

    ``_conv_id, _part``, the state at the start, the costs after the end, the
    role before and whether it is the last: from one matrix a stretch, composed
    from the end, and one pass more to find the states from the start.
    """
    kind = laid.schema["conv_id"].dataType.simpleString()
    # At most one conversation per border between two segments.
    wide = laid.groupBy("conv_id").agg(F.min("part").alias("_a"), F.max("part").alias("_b")).where("_a < _b")
    wide = _keyed(wide.select("conv_id"), "conv_id")
    rows = stage(laid.join(wide, _same(laid, wide, "conv_id")).drop("_conv_id"), "spanning")
    cells = "array<bigint>"

    def summarise(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        flat = [x for row in matrix_of(_runs(table)) for x in row]
        return pa.table(
            {
                "conv_id": table["conv_id"][:1],
                "part": table["part"][:1],
                "matrix": pa.array([flat], pa.list_(pa.int64())),
                "last_role": table["role_no"][-1:],
            }
        )

    def close(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        after, afters = CLOSE, []
        for flat in reversed(table["matrix"].to_pylist()):
            afters.append(list(after))
            after = advance([flat[4 * i : 4 * i + 4] for i in range(4)], after)
        n = table.num_rows
        before = [-1, *table["last_role"].to_pylist()[:-1]]
        return pa.table(
            {
                "_conv_id": table["conv_id"],
                "_part": table["part"],
                "after": pa.array(afters[::-1], pa.list_(pa.int64())),
                "role_before": pa.array(before, pa.int32()),
                "last": pa.array([k == n - 1 for k in range(n)]),
            }
        )

    def walk(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        runs, after = _runs(table), table["after"][0].as_py()
        exits = [edits_of(runs, state, after)[1] for state in range(4)]
        names = ("conv_id", "part", "after", "role_before", "last")
        return pa.table({**{c: table[c][:1] for c in names}, "exits": pa.array([exits], pa.list_(pa.int64()))})

    def chain(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        state, starts = START, []
        for exits in table["exits"].to_pylist():
            starts.append(state)
            state = exits[state]
        columns = {c: table[c] for c in ("after", "role_before", "last")}
        return pa.table(
            {"_conv_id": table["conv_id"], "_part": table["part"], "start": pa.array(starts, pa.int32()), **columns}
        )

    sums = rows.groupBy("conv_id", "part").applyInArrow(
        summarise, f"conv_id {kind}, part int, matrix {cells}, last_role int"
    )
    known = f"after {cells}, role_before int, last boolean"
    closed = sums.groupBy("conv_id").applyInArrow(close, f"_conv_id {kind}, _part int, {known}")
    told = rows.join(closed, _same(rows, closed, "conv_id", "part")).drop("_conv_id", "_part")
    walked = told.groupBy("conv_id", "part").applyInArrow(walk, f"conv_id {kind}, part int, {known}, exits {cells}")
    return walked.groupBy("conv_id").applyInArrow(chain, f"_conv_id {kind}, _part int, start int, {known}")


def edits(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The cheapest edits that give every conversation the pattern ``(s?(ua)+)?``.

    Rows are taken by turn, nulls first, then by a digest of role and text;
    rows equal in all of these are ``copies`` of one row.  The first fault of a
    row counts: blank, duplicate (role and text seen earlier in the
    conversation), truncated (its text does not end in ``.!?``).  Keeping a row
    is free, relabelling it as user or assistant costs 1, deleting it 2 (the
    only way for blank and duplicate rows), inserting an empty user or
    assistant turn 5, and a truncated row that stays adds 5.

    Null roles and texts count as one space; a null ``conv_id`` is a
    conversation too; other columns are ignored; an empty table gives no rows.
    Texts are left out of the layout by range, so a segment of about
    ``segment_rows`` rows is small whatever the texts, and no conversation is
    gathered in one task.

    Returns per conversation, turn and content: ``conv_id, turn, content``,
    ``copies, blank, duplicate, truncated`` (numbers of rows), ``illegal``
    (rows that may not follow the row before), ``cost``, ``edits`` (initials of
    D, I, K, R in order), ``before`` and ``after`` (initials of turns inserted
    around the row) and ``new_role`` (null if no copy stays, empty if kept).
    """
    importable(conversations.sparkSession)
    rows = stage(_faults(conversations), "turn-faults")
    parts = max(1, -(-rows.count() // segment_rows))
    order = [F.col("conv_id"), F.col("turn"), F.col("content")]
    laid = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    laid = laid.withColumns({"part": F.spark_partition_id(), "pos": F.monotonically_increasing_id()})
    laid = stage(laid, "turn-segments")
    more = stage(_spanning(laid), "turn-spans")
    told = laid.join(more, _same(laid, more, "conv_id", "part"), "left").drop("_conv_id", "_part")
    types = {c: laid.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}

    def repair(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        codes = table["conv_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices
        codes = codes.to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
        found: dict[str, list] = {c: [] for c in ("edits", "before", "after", "new_role", "cost", "illegal")}
        for a, b in zip(bounds, bounds[1:]):
            _repair_stretch(table.slice(a, b - a), found)
        kept = ["conv_id", "turn", "content", "copies"]
        numbers = {c: pa.array(found[c], pa.int64()) for c in ("cost", "illegal")}
        words = {c: pa.array(found[c], pa.string()) for c in ("edits", "before", "after", "new_role")}
        copies = table["copies"].to_numpy()
        blank = table["blank"].to_numpy(zero_copy_only=False)
        again = table["again"].to_numpy(zero_copy_only=False)
        cut_off = (table["symbol"].to_numpy() % 2).astype(np.int64)
        faults = {
            "blank": pa.array(np.where(blank, copies, 0)),
            "duplicate": pa.array(np.where(blank, 0, np.where(again, copies, copies - 1))),
            "truncated": pa.array(np.where(blank | again, 0, cut_off)),
        }
        return pa.table({**{c: table[c] for c in kept}, **faults, **numbers, **words})

    schema = (
        f"conv_id {types['conv_id']}, turn {types['turn']}, content binary, copies bigint, blank bigint, "
        "duplicate bigint, truncated bigint, cost bigint, illegal bigint, edits string, before string, "
        "after string, new_role string"
    )
    return told.groupBy("part").applyInArrow(repair, schema)


def _repair_stretch(table: pa.Table, found: dict[str, list]) -> None:
    """Append what becomes of each row of one conversation in one segment."""
    symbols, copies = table["symbol"].to_pylist(), table["copies"].to_pylist()
    roles = table["role_no"].to_pylist()
    start, after, role, last = START, CLOSE, -1, True
    if table["start"][0].is_valid:
        start, after = table["start"][0].as_py(), tuple(table["after"][0].as_py())
        role, last = table["role_before"][0].as_py(), table["last"][0].as_py()
    steps, end = edits_of(_runs(table), start, after)
    state, at = start, 0
    for i, (symbol, n, role_no) in enumerate(zip(symbols, copies, roles)):
        own = steps[at : at + n]
        at += n
        # Turns are inserted before rows that stay, never before rows that go.
        first = own[0]
        before = ""
        for _ in range(first.count("I")):
            state = NEXT[state]
            before += "ua"[state == ASSISTANT]
        cost = INSERT * len(before) + DELETE * sum(s[-1] == "D" for s in own)
        new_role = None
        if first[-1] != "D":
            cost += CUT_OFF * (symbol % 2)
            if first[-1] == "K":
                state, new_role = _kept(state, symbol // 2), ""
            else:
                state = NEXT[state]
                new_role = "assistant" if state == ASSISTANT else "user"
                cost += RELABEL
        words, behind = "".join(own), ""
        if last and i == len(symbols) - 1:
            for _ in closing(end):
                state = NEXT[state]
                behind += "ua"[state == ASSISTANT]
            words += "I" * len(behind)
            cost += INSERT * len(behind)
        found["edits"].append(words)
        found["before"].append(before)
        found["after"].append(behind)
        found["new_role"].append(new_role)
        found["cost"].append(cost)
        found["illegal"].append(n - 1 + (role >= 0 and (role, role_no) not in LEGAL))
        role = role_no


def repaired(conversations: DataFrame, changes: DataFrame) -> DataFrame:
    """The rows of ``edits`` with ``said``: the turns they leave, as an array of role and text.

    Texts move once, to the rows that hold them.
    """
    texts = _contents(conversations).groupBy("conv_id", "turn", "content")
    texts = _keyed(texts.agg(F.first("role").alias("role"), F.first("text").alias("text")), "conv_id", "turn", "content")
    rows = changes.join(texts, _same(changes, texts, "conv_id", "turn", "content"))

    def inserted(initials: str) -> Column:
        role = lambda c: F.when(c == "u", "user").otherwise("assistant")
        each = F.filter(F.split(initials, ""), lambda c: c != "")
        return F.transform(each, lambda c: F.struct(role(c).alias("role"), F.lit("").alias("text")))

    new_role = F.when(F.col("new_role") == "", F.col("role")).otherwise(F.col("new_role"))
    own = F.array(F.struct(new_role.alias("role"), F.col("text").alias("text")))
    own = F.when(F.col("new_role").isNotNull(), own).otherwise(F.slice(own, 1, 0))
    said = F.concat(inserted("before"), own, inserted("after"))
    return rows.withColumn("said", said).select(*changes.columns, "said")


def repair(conversations: DataFrame, original: DataFrame | None = None, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits, and the repaired text.

    ``original`` names conversations that appear even if none of their rows is
    left; such have zeros, an empty audit and an empty text.  ``audit`` and
    ``repaired`` are single values per conversation, so here a conversation
    must fit a value; ``edits`` and ``repaired`` as tables have no such bound.

    Returns ``conv_id, gaps`` (turn numbers missing between the least and the
    largest), ``blank, duplicate, truncated, illegal, cost, audit, repaired``.
    """
    rows = repaired(conversations, edits(conversations, segment_rows))
    lines = F.transform("said", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    place = F.struct(F.col("turn").isNotNull().alias("t"), F.col("turn").alias("turn"), F.col("content").alias("c"))
    rows = rows.select(
        "conv_id", "turn", *counts, F.struct(place.alias("place"), "edits", lines.alias("lines")).alias("_row")
    )
    named = (conversations if original is None else original).select("conv_id").distinct()
    rows = rows.unionByName(named, allowMissingColumns=True)
    all_rows = F.array_sort(F.collect_list("_row"))
    grouped = rows.groupBy("conv_id").agg(
        F.min("turn").alias("_first"),
        F.max("turn").alias("_last"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counts],
        all_rows.alias("_rows"),
    )
    turns = F.array_distinct(F.filter(F.transform("_rows", lambda x: x["place"]["turn"]), lambda t: t.isNotNull()))
    gaps = F.col("_last") - F.col("_first") + 1 - F.size(turns)
    return grouped.select(
        "conv_id",
        F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"),
        *counts,
        F.array_join(F.transform("_rows", lambda x: x["edits"]), "").alias("audit"),
        F.array_join(F.flatten(F.transform("_rows", lambda x: x["lines"])), "\n").alias("repaired"),
    )
