"""Small tables of awkward rows."""

from __future__ import annotations

import random

DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # Names that operators use themselves.
    "kept boolean, size string, component_id string, _id string, _row string, score string"
)


def docs_frame(spark, rows):
    """``rows`` of (doc_id, text[, lang[, source]])."""
    full = [(*r, *(None,) * (4 - len(r)), None, False, "x", "x", "x", "x", "x") for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


AWKWARD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n\x0b ", "en", "b"),
    (None, "One two three four five six seven eight nine ten.", "en", None),
    (4, "one TWO three four five six seven eight nine ten.", "en", "a"),
    (4, "one TWO three four five six seven eight nine ten.", "en", "a"),
    (5, "word " * 30_000, "en", "a"),
    (6, "Ünïcode 中文 🙂 é́ 　 ß", "de", "c"),
    (-7, "!!! ??? ###", "de", "c"),
    (8, "x" * 200_000, "fr", "c"),
]


def prose(seed: int, n_words: int, vocabulary: int = 2000) -> list[str]:
    draw = random.Random(seed)
    words = [
        "".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(vocabulary)
    ]
    return [draw.choice(words) for _ in range(n_words)]
