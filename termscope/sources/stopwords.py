"""Stopword lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termscope.functions.text import normalize_stopword

# A list above this many words is joined, not inlined into the expression.
MAX_INLINE_WORDS = 10_000


def normalize_stopwords(lines: DataFrame, value: str = "value") -> DataFrame:
    """Distinct stopwords of a column of lines, as ``term``."""
    words = lines.select(normalize_stopword(value).alias("term"))
    return words.where("term IS NOT NULL").distinct()


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """A stopword file, one word per line, as distinct normalized terms."""
    return normalize_stopwords(spark.read.text(path))


def inline_stopwords(words: DataFrame) -> tuple[str, ...] | None:
    """The words as a tuple when there are few enough, else None.

    At most ``MAX_INLINE_WORDS + 1`` rows reach the driver. On None, give
    the table itself to the operators, which then join it.
    """
    rows = words.limit(MAX_INLINE_WORDS + 1).collect()
    if len(rows) > MAX_INLINE_WORDS:
        return None
    return tuple(sorted(r.term for r in rows))


def load_stopwords(spark: SparkSession, path: str) -> tuple[str, ...] | DataFrame:
    """A stopword file as words, or as a table if it is long."""
    table = read_stopwords(spark, path)
    words = inline_stopwords(table)
    return table if words is None else words
