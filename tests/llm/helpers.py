"""Rows that every operator must take, and word splitting as the contracts state it."""

import re

SCHEMA = "doc_id long, text string, id string, k long, t string, w string, kept string, n_words long, score double"


def odd_documents(spark, texts=()):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    base = [(1, None), (2, ""), (3, "   \n\t "), (4, "word"), (5, "alpha beta gamma delta epsilon"),
            (5, "alpha beta gamma delta epsilon"), (None, "alpha beta gamma delta epsilon"), (None, None),
            (6, "long " * 30_000 + "end"), (7, "émile Ünder straße 日本語 \U0001F600 " * 8), (8, "x" * 20_000),
            (9, "tail alpha beta gamma delta epsilon")]
    rows = base + [(100 + i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "id", 7, "t", "w", "kept", -1, 0.5) for i, t in rows], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return [] if text is None else [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
