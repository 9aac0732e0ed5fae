"""Small documents that every operator has to stand."""

from __future__ import annotations

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, component_id int, n int"
LONG = " ".join(f"word{n % 997}x" for n in range(40_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from all of them"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from all of them"),
    (2, "The quick brown fox jumps over the lazy dog and runs away from all of them"),
    (3, "Un texte tout autre, écrit en français, avec des accents"),
    (4, None),
    (5, ""),
    (6, " \n\t "),
    (None, "A text without an id that stands for itself alone here"),
    (7, LONG),
    (8, "1234 5678 ... !!"),
]


def documents(spark, texts=TEXTS):
    """Documents with columns whose names the operators use themselves."""
    rows = [(doc, text, "en", None, len(text or ""), "x", 1, 2) for doc, text in texts]
    return spark.createDataFrame(rows, SCHEMA)


def rows(frame, *columns):
    return sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=repr)
