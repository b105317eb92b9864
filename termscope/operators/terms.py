"""Long forms of tokenized documents."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.functions.text import is_term, words

#: Stopwords as words, or as a table with a column ``term`` for lists of any length.
StopWords = Iterable[str] | DataFrame


def kept_terms(terms: DataFrame, stopwords: StopWords = ()) -> DataFrame:
    """Rows whose ``term`` is long enough and no stopword; a NULL term is no word.

    Words are tested in the row, a table is anti joined.
    """
    if isinstance(stopwords, DataFrame):
        return drop_stopwords(terms.where(is_term("term")), stopwords)
    return terms.where(is_term("term", stopwords))


def kept_or_marked(terms: DataFrame, stopwords: StopWords = ()) -> DataFrame:
    """As :func:`kept_terms`, but rows with a NULL term, which mark documents, stay."""
    if isinstance(stopwords, DataFrame):
        return drop_stopwords(terms.where(F.col("term").isNull() | is_term("term")), stopwords)
    return terms.where(F.col("term").isNull() | is_term("term", stopwords))


def tokens(docs: DataFrame, keys: Sequence[str], text: str = "reviewText") -> DataFrame:
    """Every word of every document with its position: ``(keys, pos, token)``."""
    return docs.select(*keys, F.posexplode(words(text)).alias("pos", "token"))


def term_occurrences(
    docs: DataFrame,
    keys: Sequence[str],
    stopwords: StopWords = (),
    text: str = "reviewText",
) -> DataFrame:
    """Every kept term of every document, repeats included: ``(keys, term)``."""
    return kept_terms(docs.select(*keys, F.explode(words(text)).alias("term")), stopwords)


def document_terms(
    docs: DataFrame,
    keys: Sequence[str],
    stopwords: StopWords = (),
    text: str = "reviewText",
) -> DataFrame:
    """Each document's distinct terms: ``(keys, term)``.

    Repeats go inside the row, before the explode, so counting rows counts
    documents and no distinct aggregation is shuffled.
    """
    distinct = F.explode(F.array_distinct(words(text))).alias("term")
    return kept_terms(docs.select(*keys, distinct), stopwords)


def drop_stopwords(terms: DataFrame, stopwords: DataFrame, term: str = "term") -> DataFrame:
    """Anti join against a stopword table.

    No broadcast hint: Spark broadcasts the list when its measured size is below
    the threshold and otherwise joins by term, splitting skewed partitions.
    """
    return terms.join(stopwords.select(F.col("term").alias(term)), term, "left_anti")
