"""Small tables with the cases that every operator and stage must take."""

import re

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def words(text):
    """The words of the contracts: runs of characters other than 20, 09-0D."""
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def edge_rows():
    long = " ".join(f"w{i * i % 9973}" for i in range(30_000))
    line = "same line again and again"
    clean = " ".join(f"c{i}" for i in range(60))
    rows = [
        (1, clean, "en", "a"), (1, clean, "en", "a"),  # a repeated row
        (2, clean + " tail", "en", "b"), (3, None, "en", "a"), (4, "", None, "b"), (5, " \t\n\r\x0b\x0c ", "en", None),
        (6, "\n".join([line] * 50), "en", "a"), (7, long, "en", "a"), (8, "one", "en", "b"), (9, "One", "en", "b"),
        (None, "no id but some words here and more of them than ten in all", "de", None),
        (10, None, None, None), (11, "a b 世界 \U0001f600 é " + clean, "zh", "世"),
        (12, "\x00\x1f " + clean.upper(), "en", "\U0001f600"), (13, "tie", "en", "c"), (14, "tie", "en", "c"),
    ]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns of clashing names."""
    rows = [(*r, i % 3, "x", [i]) for i, r in enumerate(edge_rows())]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, size int, __row string, ids array<int>"
    )
