"""Language identification by cross-parsing with suffix automata."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomwork.llm.ship import bucket_of, map_batches, piece

# Runs of letters.
_LETTERS = re.compile(r"[^\W\d_]+").findall
UNDETERMINED = "und"
# Words remembered per worker; a full memory is emptied.
MEMORY = 300_000
# Bits per language of a sum of phrases.
_ROOM = 48


@dataclass(frozen=True)
class Fit:
    """Parameters of learning: per language at most ``sample_docs`` documents, in
    order of a hash of id and text, of longer ones a piece of ``doc_chars`` characters,
    and of their words at most ``sample_chars`` characters."""

    sample_docs: int = 100
    doc_chars: int = 10_000
    sample_chars: int = 60_000


class Automaton:
    """Suffix automaton: recognises every substring of a text, in linear space."""

    def __init__(self, text: str):
        length, link, steps = [0], [-1], [{}]
        last = 0
        for c in text:
            new = len(length)
            length.append(length[last] + 1)
            link.append(0)
            steps.append({})
            at = last
            while at >= 0 and c not in steps[at]:
                steps[at][c] = new
                at = link[at]
            if at >= 0:
                after = steps[at][c]
                if length[after] == length[at] + 1:
                    link[new] = after
                else:
                    twin = len(length)
                    length.append(length[at] + 1)
                    link.append(link[after])
                    steps.append(dict(steps[after]))
                    while at >= 0 and steps[at].get(c) == after:
                        steps[at][c] = twin
                        at = link[at]
                    link[after] = link[new] = twin
            last = new
        self.steps = steps

    def phrases(self, text: str) -> int:
        """Longest matches, one after another, that make up the text; an unknown letter is one."""
        steps = self.steps
        start, count, at = steps[0], 1, steps[0]
        for c in text:
            to = at.get(c)
            if to is None:
                # A new phrase begins with this letter.
                count += at is not start
                to = start.get(c)
                if to is None:
                    count += 1
                    at = start
                    continue
            at = steps[to]
        return count - (at is start)


class Parser:
    """Phrases that words need under each language.

    A word is parsed with a space on both sides, so that beginnings and endings
    count; phrases end with the word.  What a word needs is then the same in
    every document and is remembered.
    """

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.langs = [lang for lang, _ in samples]
        self.automata = [Automaton(text) for _, text in samples]
        self.bits = np.array([math.log2(max(2, len(text))) for _, text in samples])
        self.seen: dict[str, int] = {}

    def _need(self, word: str) -> int:
        framed = f" {word} "
        packed = sum(a.phrases(framed) << (_ROOM * k) for k, a in enumerate(self.automata))
        if len(self.seen) >= MEMORY:
            self.seen.clear()
        if len(word) <= 64:
            self.seen[word] = packed
        return packed

    def phrases(self, text: str) -> tuple[list[int], int] | None:
        """Phrases per language and number of letters; ``None`` without a letter."""
        words = _LETTERS(text.lower())
        if not words:
            return None
        seen, need = self.seen, self._need
        total = sum([seen[w] if w in seen else need(w) for w in words])
        mask = (1 << _ROOM) - 1
        return [total >> (_ROOM * k) & mask for k in range(len(self.automata))], sum(map(len, words))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language of fewest normalised phrases per letter, and its share of the evidence.

        Parsing with a text of n letters spends log2(n) bits a phrase, so phrases
        count by these: a language learned from little text has short matches,
        but names each in fewer bits.  Shares are in proportion to 2 to the
        minus bits.
        """
        counted = self.phrases(text) if text and self.langs else None
        if counted is None:
            return UNDETERMINED, 0.0
        spent = np.array(counted[0]) * self.bits
        best = int(spent.argmin())
        behind = np.minimum(spent - spent[best], 1000.0)
        return self.langs[best], float(1 / np.exp2(-behind).sum())


def learned_samples(docs: DataFrame, fit: Fit = Fit()) -> tuple[tuple[str, str], ...]:
    """Sample text per language, languages in order, from documents with a language.

    Each task drops all but its first ``sample_docs`` rows of a language before
    the shuffle, so a language that fills the table moves no more than others.
    The number of languages is taken to be that of a catalogue of languages.
    """
    order = Window.partitionBy("lang").orderBy("_order", "doc_id")
    usable = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", "lang", piece(F.col("text"), fit.doc_chars).alias("text")
    )
    ranked = usable.withColumn("_order", F.xxhash64("doc_id", "text"))
    top = ranked.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= fit.sample_docs)
    found: dict[str, list[tuple[int, str]]] = {}
    for row in top.select("lang", "_n", "text").toLocalIterator():
        found.setdefault(row["lang"], []).append((row["_n"], row["text"]))
    samples = []
    for lang in sorted(found):
        words, used = [], 0
        for _, text in sorted(found[lang]):
            for word in _LETTERS(text.lower()):
                if used + len(word) + 1 > fit.sample_chars:
                    break
                words.append(word)
                used += len(word) + 1
        if words:
            samples.append((lang, f" {' '.join(words)} "))
    return tuple(samples)


_parsers: dict[int, Parser] = {}


def parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    """One parser per worker and samples, so that automata are built once."""
    key = hash(samples)
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(samples)
    return _parsers[key]


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...]) -> DataFrame:
    """Language of every whole text.

    ``und`` with score 0 for a null text, one without a letter, or if no
    language was learned.  Ties go to the first language in order.  Repeated
    rows are judged alike, null ids kept, other columns ignored; an empty table
    gives no rows.

    Returns ``doc_id, lang_pred, score``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(samples)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch):
        judge = parser(shared.value)
        found = [judge.predict(t) for t in batch.column(1).to_pylist()]
        columns = [
            batch.column(0),
            pa.array([lang for lang, _ in found], pa.string()),
            pa.array([score for _, score in found], pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double")


def held_out(docs: DataFrame):
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0."""
    return bucket_of(F.col("doc_id"), 5) == 0
