"""Documents with awkward rows, and small helpers."""

from __future__ import annotations

import hashlib

LONG = " ".join(f"word{i} goes on" for i in range(20_000))
PROSE = "the quick brown fox jumps over the lazy dog while seven wizards make toxic brew for the evil queen and jack"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


AWKWARD = [(1, None), (2, ""), (3, "  \n\t "), (4, LONG), (5, PROSE), (6, PROSE), (6, PROSE), (None, PROSE), (7, "Ünïcödé ñ 日本 <|x|>"), (8, "!!! ???")]


def awkward(spark):
    return docs(spark, AWKWARD)


def empty(spark):
    return docs(spark, [])


def clashing(df, *names):
    """The same rows with more columns of the given names."""
    for name in names:
        df = df.selectExpr("*", f"'kept' as `{name}`")
    return df


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
