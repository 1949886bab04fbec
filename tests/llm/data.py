"""Small tables with the odd cases every operator must take."""

from __future__ import annotations

from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet " * 8000
# Columns whose names the operators use themselves.
CLASHING = ["row", "score", "fp", "hits", "spans", "base", "unit", "key", "n_tokens", "lang_pred", "root", "text_hash"]

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.IntegerType()),
        *[T.StructField(c, T.StringType()) for c in CLASHING],
    ]
)


def documents(spark, rows):
    """A table of (doc_id, text[, lang]) rows, with extra columns."""
    full = []
    for doc_id, text, *rest in rows:
        lang = rest[0] if rest else None
        full.append((doc_id, text, lang, "s", None if text is None else len(text), *CLASHING))
    return spark.createDataFrame(full, SCHEMA)


def odd(spark):
    """Null id, null text, empty text, blanks only, one word, equal rows, equal ids, a very long text."""
    return documents(
        spark,
        [
            (None, None),
            (None, "some words without an id"),
            (1, None, "en"),
            (2, "", "en"),
            (3, " \t\n ", None),
            (4, "word", "en"),
            (5, "the same row twice over", "en"),
            (5, "the same row twice over", "en"),
            (6, "the same id with one text", "fr"),
            (6, "and with another text too", "fr"),
            (7, LONG, "en"),
            (8, "ünï¢ödé ▁ 𝔘 é", "de"),
            (9, "12345 !!! ???", "en"),
        ],
    )


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
