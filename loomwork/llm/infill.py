"""Fill-in-middle: texts cut in three, put in another order between marks.

A cut is a place counted in code points, a text is stored as bytes.  The index
from one to the other is learned: error-bounded straight segments over the byte
offsets of all boundaries predict a cut's offset, and the stored residual of
that boundary corrects it exactly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.hashing import Texts
from loomwork.llm.ship import map_batches

# Bytes whose boundaries are fitted at once; residuals fit a signed byte.
BLOCK = 1 << 20
MOST_ERROR = 126


@dataclass(frozen=True)
class Marks:
    """Strings in front of the parts; a text that holds one stays plain."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __iter__(self) -> Iterator[str]:
        return iter((self.prefix, self.suffix, self.middle))


@dataclass(frozen=True)
class Draw:
    """How cuts and forms are drawn from the id, in percent; ``seed`` changes all draws."""

    seed: str = "1"
    cut_pct: int = 90
    spm_pct: int = 20


class RankIndex:
    """Byte offset of the k-th code point boundary of UTF-8 data, for any k.

    Segments hold a first rank, an offset and a slope; every boundary lies
    within ``error`` bytes of its segment and has its residual stored.  Memory
    is one byte per boundary and 24 per segment.
    """

    def __init__(self, data: np.ndarray, error: int = 24):
        if not 1 <= error <= MOST_ERROR:
            raise ValueError(f"the error must be between 1 and {MOST_ERROR} bytes")
        self.error = error
        firsts: list[int] = []
        offsets: list[int] = []
        slopes: list[float] = []
        residuals = []
        rank = 0
        for start in range(0, len(data), BLOCK):
            part = data[start : start + BLOCK]
            places = np.flatnonzero((part & 0xC0) != 0x80) + start
            for k, end, slope in _segments(places, error):
                firsts.append(rank + k)
                offsets.append(int(places[k]))
                slopes.append(slope)
                guess = places[k] + np.floor(np.arange(end - k) * slope).astype(np.int64)
                residuals.append((places[k:end] - guess).astype(np.int8))
            rank += len(places)
        # The end of the data is a boundary too.
        firsts.append(rank)
        offsets.append(len(data))
        slopes.append(0.0)
        residuals.append(np.zeros(1, np.int8))
        self.firsts = np.asarray(firsts, np.int64)
        self.offsets = np.asarray(offsets, np.int64)
        self.slopes = np.asarray(slopes)
        self.residuals = np.concatenate(residuals)

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        """Offsets as the segments alone give them."""
        at = np.searchsorted(self.firsts, ranks, side="right") - 1
        return self.offsets[at] + np.floor((ranks - self.firsts[at]) * self.slopes[at]).astype(np.int64)

    def __getitem__(self, ranks: np.ndarray) -> np.ndarray:
        """Exact offsets."""
        return self.predict(ranks) + self.residuals[ranks]


def _segments(places: np.ndarray, error: int) -> Iterator[tuple[int, int, float]]:
    """First rank, end and slope of segments that stay within ``error`` of all places.

    From a segment's first point, every further point narrows the slopes that
    still pass within the error of all of them; the segment ends where none is
    left.  The points are looked at in steps that double.
    """
    n, k = len(places), 0
    while k < n:
        low, high, end, step = 0.0, np.inf, k + 1, 64
        while end < n:
            run = np.arange(end - k, min(end + step, n) - k)
            rise = (places[end : end + step] - places[k]).astype(np.float64)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            bad = np.flatnonzero(lows > highs)
            fine = int(bad[0]) if len(bad) else len(run)
            if fine:
                low, high = float(lows[fine - 1]), float(highs[fine - 1])
            end += fine
            if len(bad):
                break
            step *= 2
        yield k, end, (low + high) / 2 if end > k + 1 else 0.0
        k = end


def _number(digest: Column, group: int) -> Column:
    """A group of eight hex digits as an unsigned number."""
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("bigint")


def infill(
    docs: DataFrame,
    marks: Marks = Marks(),
    draw: Draw = Draw(),
    error: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every text in fill-in-middle form.

    Two cuts are drawn over the n + 1 code point boundaries of a text of n code
    points, from the SHA-256 of ``seed:id``.  ``form`` is ``plain`` (the text as
    it is: empty, holding a mark, or not drawn), ``psm`` (prefix, suffix,
    middle) or ``spm`` (suffix, prefix, middle), each part behind its mark.

    A null text counts as empty, a null id as empty text in the draw.  Repeated
    rows give equal rows, other columns are ignored, an empty table gives no
    rows.  Texts are cut whole; a task holds 4 MB of them, or one text.

    Returns ``<id_col>, n, form, prefix_chars, middle_chars, output``; the two
    lengths are null for plain texts.
    """
    _distinct(marks)
    heads = [m.encode() for m in marks]

    def run(batch: pa.RecordBatch):
        texts = Texts.of(batch.column(1))
        index = RankIndex(texts.data, error)
        # Ranks at which texts start, by counting boundaries between them.
        starts = np.searchsorted(index.offsets, texts.offsets, side="right") - 1
        starts = _ranks(index, starts, texts.offsets)
        n = np.diff(starts)
        draws = [batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4, 5)]
        one, two = draws[0] % (n + 1), draws[1] % (n + 1)
        first, second = np.minimum(one, two), np.maximum(one, two)
        cuts = [index[starts[:-1] + c] for c in (first, second)]
        data = texts.data.tobytes()
        forms, outputs = [], []
        for i, (a, d) in enumerate(zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist())):
            text = data[a:d]
            if not text or draws[2][i] % 100 >= draw.cut_pct or any(h in text for h in heads):
                forms.append("plain")
                outputs.append(text)
                continue
            b, c = int(cuts[0][i]), int(cuts[1][i])
            before, middle, after = heads[0] + data[a:b], heads[2] + data[b:c], heads[1] + data[c:d]
            spm = draws[3][i] % 100 < draw.spm_pct
            forms.append("spm" if spm else "psm")
            outputs.append((after + before if spm else before + after) + middle)
        plain = np.array([f == "plain" for f in forms], dtype=bool)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n),
                pa.array(forms, pa.string()),
                pa.array(first, mask=plain),
                pa.array(second - first, mask=plain),
                pa.array(outputs, pa.binary()).cast(pa.string()),
            ],
            names=["_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )

    digest = F.sha2(F.concat(F.lit(f"{draw.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), digest.alias("_digest"))
    rows = rows.select("_id", "_text", *[_number(F.col("_digest"), g).alias(f"_h{g}") for g in range(4)])
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return map_batches(rows, run, schema, max_bytes=4 << 20).withColumnRenamed("_id", id_col)


def _ranks(index: RankIndex, segments: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ranks of boundaries given by their offsets, found within their segments.

    The offset over the slope is near the rank; the exact offsets around it
    decide.
    """
    slopes = np.maximum(index.slopes[segments], 1.0)
    ranks = index.firsts[segments] + ((offsets - index.offsets[segments]) / slopes).astype(np.int64)
    last = len(index.residuals) - 1
    ranks = np.clip(ranks, 0, last)
    while True:
        off = offsets - index[ranks]
        if not off.any():
            return ranks
        # A boundary is one to four bytes after the one before it.
        step = np.where(off > 0, np.maximum(off // 4, 1), np.minimum(-(-off // 4), -1))
        ranks = np.clip(np.where(off == 0, ranks, ranks + step), 0, last)


def _distinct(marks: Sequence[str]) -> None:
    """Marks must be findable in any output: no mark may begin inside another."""
    found = list(marks)
    for i, one in enumerate(found):
        for j, other in enumerate(found):
            for k in range(len(one)):
                if (k or i != j) and (one[k:].startswith(other) or other.startswith(one[k:])):
                    raise ValueError("marks must not overlap")
    if not all(found):
        raise ValueError("marks must not be empty")


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text again, from output and form alone.

    The first mark after the leading one is the true one: a text in three parts
    holds no mark, and no mark can begin in a text and end in a mark.
    """
    any_mark = "|".join(f"\\Q{m}\\E" for m in marks)
    parts = F.split(output, any_mark, 4)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
