"""Fill-in-middle: the learned index, forms, and the way back."""

import hashlib
import random

import numpy as np
import pytest

from cases import AWKWARD, docs_frame
from loomwork.llm.infill import BLOCK, Draw, Marks, RankIndex, infill, restored

MARKED = [
    (20, "a <M> in a text stays plain " * 30),
    (21, "<P>"),
    (22, "<P" + "x" * 50 + ">S><"),
    (23, "<" * 400),
]


@pytest.mark.parametrize("error", [1, 7, 126])
@pytest.mark.parametrize("letters", ["a", "aé", "a中", "🙂é中a", "🙂"])
def test_index_is_exact_at_every_boundary(letters, error):
    draw = random.Random(error)
    # Stretches of one letter bend the line; a long one crosses blocks.
    text = "".join(draw.choice(letters) * draw.randint(1, 400) for _ in range(300))
    text += letters[0] * (BLOCK + 5)
    offsets = np.cumsum([0] + [len(c.encode()) for c in text])
    index = RankIndex(np.frombuffer(text.encode(), np.uint8), error)
    ranks = np.arange(len(offsets))
    assert (index[ranks] == offsets).all()
    assert np.abs(index.predict(ranks) - offsets).max() <= error
    assert len(index.firsts) < 3000


def test_index_of_one_letter_width_needs_no_correction():
    index = RankIndex(np.frombuffer(("é" * 10_000).encode(), np.uint8))
    assert len(index.firsts) == 2 and not index.residuals.any()


def test_index_refuses_errors_that_residuals_cannot_hold():
    with pytest.raises(ValueError):
        RankIndex(np.zeros(0, np.uint8), 127)


def _plain(doc_id, text, draw=Draw()):
    text = text or ""
    digest = hashlib.sha256(f"{draw.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= draw.cut_pct:
        return (doc_id, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    before, middle, after = text[:a], text[a:b], text[b:]
    if h[3] % 100 < draw.spm_pct:
        return (doc_id, n, "spm", a, b - a, f"<S>{after}<P>{before}<M>{middle}")
    return (doc_id, n, "psm", a, b - a, f"<P>{before}<S>{after}<M>{middle}")


@pytest.mark.parametrize("draw", [Draw(), Draw(seed="other", cut_pct=100, spm_pct=50), Draw(cut_pct=100, spm_pct=0)])
def test_infill_equals_slicing(spark, draw):
    letters = random.Random(9)
    rows = AWKWARD + MARKED
    rows += [(100 + k, "".join(letters.choices("ab é中🙂\n<>PSM", k=letters.randint(0, 300)))) for k in range(300)]
    rows.append((999, "🙂 long 中 " * 400_000))
    found = infill(docs_frame(spark, [(*r, None, None)[:4] for r in rows]), draw=draw)
    found = found.withColumn("again", restored(found["output"], found["form"])).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r)[:6] for r in found), key=key) == sorted((_plain(r[0], r[1], draw) for r in rows), key=key)
    texts = {r[0]: r[1] or "" for r in rows}
    assert all(r.again == texts[r.doc_id] for r in found)
    forms = {r.form for r in found}
    assert {"plain", "psm"} <= forms and ("spm" in forms) == (draw.spm_pct > 0)


def test_other_marks_and_clashing_names(spark):
    marks = Marks("[pre|", "[suf|", "[mid|")
    docs = spark.createDataFrame([(k, "x" * k, "c", 5) for k in range(50)], "doc_id int, body string, output string, n int")
    found = infill(docs, marks, text_col="body")
    rows = found.select("doc_id", "form", "output", restored(found["output"], found["form"], marks).alias("t")).collect()
    assert all(r.t == "x" * r.doc_id for r in rows)
    assert all(("[mid|" in r.output) == (r.form != "plain") for r in rows)


def test_overlapping_marks_are_refused(spark):
    with pytest.raises(ValueError):
        infill(docs_frame(spark, AWKWARD), Marks("<a", "<b", "a<"))
    with pytest.raises(ValueError):
        infill(docs_frame(spark, AWKWARD), Marks("<P>", "<P>", "<M>"))


def test_empty_table(spark):
    assert infill(docs_frame(spark, []).limit(0)).collect() == []
