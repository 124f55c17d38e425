"""Made documents with everything that may go wrong in them, and how results are compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars int"

ODD_TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "two words",
    "The quick brown fox jumps over the lazy dog. Naïve café, 東京 and 😀 emoji here.",
    "a" * 30_000,
    "word " * 9_000,
    "  leading and   inner\n\nspace\t\ttabs  ",
    "'s it's we'll I'd 123 4567 <|endoftext|> ​ \x1c \x85 é é",
]


def documents(spark: SparkSession, texts: list[str | None], first: int = 0) -> DataFrame:
    rows = [(first + i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


def odd_documents(spark: SparkSession) -> DataFrame:
    """Odd texts, repeated rows, null ids, null columns, and columns whose names may clash."""
    rows = [(i, t, None, None, None) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, "no id here at all", "de", "x", 3), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    clash = ["id", "ids", "print", "node", "root", "a", "b", "count", "k", "block", "value", "kind", "start",
             "_found", "_clean", "_print", "_stay_id", "_words", "row", "found", "clean", "words", "stay_id"]
    for name in clash:
        frame = frame.selectExpr("*", f"'{name}' as `{name}`")
    return frame


def empty_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
