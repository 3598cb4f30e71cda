"""Token counts by byte-pair merging."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.ship import map_batches

# The split pattern of byte-level vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Pretokens, and chunks of them, remembered per worker; a full memory is emptied.
PIECES = 600_000
CHUNKS = 200_000
_PAIR_BITS = 20


class Merger:
    """Counts the tokens a byte-level vocabulary gives, without making them.

    ``source`` is the text of a tokenizer file: ranked merges, byte-level split,
    and special strings that are one token each wherever they occur.
    """

    def __init__(self, source: str):
        found = json.loads(source)
        split = found["pre_tokenizer"]
        if found["model"]["type"] != "BPE" or split["type"] != "ByteLevel" or not split.get("use_regex"):
            raise ValueError("a byte-level BPE vocabulary is needed")
        if found["normalizer"] is not None or split["add_prefix_space"] or found["model"]["ignore_merges"]:
            raise ValueError("normalizers, added prefix spaces and ignored merges are not supported")
        plain = ("single_word", "lstrip", "rstrip")
        if any(t[k] for t in found["added_tokens"] for k in plain):
            raise ValueError("special strings that take in their surroundings are not supported")
        merges = [m.split(" ") if isinstance(m, str) else m for m in found["model"]["merges"]]
        ids: dict[str, int] = {c: b for b, c in enumerate(_byte_letters())}
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (left, right) in enumerate(merges):
            made = ids.setdefault(left + right, len(ids))
            self.ranks.setdefault(ids[left] << _PAIR_BITS | ids[right], rank)
            self.made.append(made)
        specials = sorted((t["content"] for t in found["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.split = regex.compile(SPLIT).findall
        # A space beside more white space may belong to either side.
        self.loose = re.compile(r"\s \s?|[^\S ] | [^\S ]").search
        self.pieces = _Memory(self._piece, PIECES)
        self.chunks = _Memory(self._chunk, CHUNKS)

    def _piece(self, piece: str) -> int:
        """Tokens of one pretoken: initial symbols minus merges.

        A heap holds adjacent pairs by rank, then place; neighbours form a
        linked list.  A popped pair whose symbols have changed is stale.
        """
        symbols = list(piece.encode())
        n = len(symbols)
        if n == 1:
            return 1
        ranks, made = self.ranks, self.made
        heap = []
        for i in range(n - 1):
            rank = ranks.get(symbols[i] << _PAIR_BITS | symbols[i + 1])
            if rank is not None:
                heap.append((rank, i))
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        count = n
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if j >= n or symbols[i] < 0 or ranks.get(symbols[i] << _PAIR_BITS | symbols[j]) != rank:
                continue
            symbols[i] = made[rank]
            symbols[j] = -1
            count -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                new = ranks.get(symbols[i] << _PAIR_BITS | symbols[k])
                if new is not None:
                    heappush(heap, (new, i))
            h = before[i]
            if h >= 0:
                new = ranks.get(symbols[h] << _PAIR_BITS | symbols[i])
                if new is not None:
                    heappush(heap, (new, h))
        return count

    def _chunk(self, chunk: str) -> int:
        return sum(map(self.pieces.__getitem__, self.split(chunk)))

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        if not self.special:
            return self._plain(text)
        parts = self.special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1

    def _plain(self, text: str) -> int:
        if not text:
            return 0
        if self.loose(text):
            return self._chunk(text)
        # Single spaces between other characters open a pretoken, so the text
        # falls apart there; the parts recur and are remembered.
        first, *rest = text.split(" ")
        if rest and not rest[-1]:
            # A space at the end is a pretoken of its own.
            rest.pop()
            return self.chunks[first] * bool(first) + sum(map(self.chunks.__getitem__, [" " + r for r in rest])) + 1
        start = self.chunks[first] if first else 0
        return start + sum(map(self.chunks.__getitem__, [" " + r for r in rest]))


class _Memory(dict):
    """Remembers what a function gave; emptied when full, so memory is bounded."""

    def __init__(self, function, room: int):
        self.function = function
        self.room = room

    def __missing__(self, key):
        value = self.function(key)
        if len(self) >= self.room:
            self.clear()
        # Long strings hardly recur.
        if len(key) <= 64:
            self[key] = value
        return value


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 itself, others from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


_mergers: dict[int, Merger] = {}


def merger(source: str) -> Merger:
    """One merger per worker and vocabulary, so that its memory serves all tasks."""
    key = hash(source)
    if key not in _mergers:
        _mergers.clear()
        _mergers[key] = Merger(source)
    return _mergers[key]


def count_tokens(texts: Iterable[str | None], source: str) -> list[int]:
    counting = merger(source)
    return [counting.count(t) if t else 0 for t in texts]


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Tokens of every whole text under a byte-level BPE vocabulary file.

    The driver reads the file and broadcasts its text, whose size does not
    depend on the data.  A text falls into pretokens; in each, the adjacent pair
    of lowest rank is merged again and again, and its count is its bytes minus
    its merges.  Special strings inside a text count as one token.

    A null text counts as empty: 0 bytes, 0 tokens.  Null or repeated ids are
    kept, other columns ignored, an empty table gives no rows.

    Returns ``<id_col>, n_bytes, n_tokens, over_limit``.
    """
    with open(vocabulary, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batch: pa.RecordBatch):
        texts = batch.column(1).to_pylist()
        tokens = np.array(count_tokens(texts, shared.value), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens)], names=["_id", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.struct(
            F.col(id_col).alias("i"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint").alias("b")
        ).alias("_id"),
        F.col(text_col).alias("_text"),
    )
    counted = map_batches(rows, run, f"_id struct<i:{kind},b:bigint>, n_tokens bigint")
    return counted.select(
        F.col("_id.i").alias(id_col),
        F.col("_id.b").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
