"""Term weights in long form: ``(doc_id, term, weight)``, any vocabulary size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termscope.functions.stats import idf as idf_value
from termscope.functions.text import words
from termscope.operators.numbering import global_rank
from termscope.operators.terms import StopWords, kept_or_marked, kept_terms
from termscope.sources.storage import MAX_BROADCAST_ROWS, join_by_size, stored


def term_frequency(
    docs: DataFrame, stopwords: StopWords = (), keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Occurrences per document and term: ``(keys, term, tf)``, no shuffle.

    A document is one row, so its words are sorted and run lengths read off
    inside the row: a run starts where a word differs from the one before it and
    ends where the next one starts.
    """
    sorted_words = docs.select(*keys, F.sort_array(words("reviewText")).alias("w"))
    w, s = F.col("w"), F.col("s")
    # No filter on the array here: it would be pushed to the scan and tokenize
    # there once more. An empty text has one run, of a NULL term, dropped below.
    starts = F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0))),
        lambda i: (i == 0) | (F.get(w, i) != F.get(w, i - 1)),
    )
    marked = sorted_words.select(*keys, "w", starts.alias("s"))
    # The runs' words are the distinct ones in their order: no loop over runs.
    ends = F.concat(F.slice(s, 2, F.size(s)), F.array(F.size(w)))
    runs = F.arrays_zip(F.array_distinct(w).alias("term"), s.alias("start"), ends.alias("stop"))
    length = (F.col("stop") - F.col("start")).cast("bigint")
    found = marked.select(*keys, F.inline(runs).alias("term", "start", "stop"))
    return kept_terms(found.select(*keys, "term", length.alias("tf")), stopwords)


def vocabulary(
    docs: DataFrame, stopwords: StopWords = (), size: int | None = None
) -> DataFrame:
    """Terms by corpus frequency: ``(idx, term, freq)``, most frequent first, ties
    by term; ``size`` keeps the first so many."""
    counted = (
        kept_terms(docs.select(F.explode(words("reviewText")).alias("term")), stopwords)
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("freq"))
    )
    ranked = global_rank(counted, [F.desc("freq"), F.asc("term")])
    if size is not None:
        ranked = ranked.where(F.col("rk") <= size)
    return ranked.select((F.col("rk") - 1).alias("idx"), "term", "freq")


def document_frequency(docs: DataFrame, stopwords: StopWords = ()) -> DataFrame:
    """Documents per term: ``(term, df)``."""
    distinct = F.explode(F.array_distinct(words("reviewText"))).alias("term")
    return (
        kept_terms(docs.select(distinct), stopwords)
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def idf(docs: DataFrame, stopwords: StopWords = (), min_doc_freq: int = 0) -> DataFrame:
    """``(term, df, idf)``; the weight is 0 below ``min_doc_freq`` documents.

    The document total comes from the same pass as the document frequencies, as
    the row with a NULL term.
    """
    marker = F.array(F.lit(None).cast("string"))
    terms = F.explode(F.concat(marker, F.array_distinct(words("reviewText")))).alias("term")
    counted = (
        kept_or_marked(docs.select(terms), stopwords)
        .groupBy("term")
        .agg(F.sum(F.when(F.col("term").isNull(), -1).otherwise(1)).alias("cnt"))
    )
    m = counted.where("cnt < 0").agg(F.coalesce(-F.sum("cnt"), F.lit(0)).alias("m")).scalar()
    df = F.col("cnt")
    weight = F.when(df >= min_doc_freq, idf_value(m, df)).otherwise(F.lit(0.0))
    return counted.where("cnt > 0").select("term", df.alias("df"), weight.alias("idf"))


def tfidf(
    docs: DataFrame,
    stopwords: StopWords = (),
    min_doc_freq: int = 0,
    max_terms: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """``(doc_id, term, weight)`` with weight tf * idf.

    The term weights are stored first. A vocabulary of proven size is broadcast
    and the documents stay where they are; a larger one is joined by term.
    """
    weights = idf(docs, stopwords, min_doc_freq).select("term", "idf")
    counted = term_frequency(docs, stopwords)
    return (
        join_by_size(counted, weights, "term", "idf", max_terms)
        .select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("weight"))
    )


def l2_normalize(weights: DataFrame) -> DataFrame:
    """Scale each document's weights to unit length; a zero vector stays zero.

    Lengths are a hash aggregate, stored, which a hash join brings back. Weights
    that are dealt by ``doc_id``, a struct, are neither shuffled nor sorted for that; other
    ids become such a struct, which is never null, so rows without an id are one document.
    """
    if not isinstance(weights.schema["doc_id"].dataType, StructType):
        weights = weights.withColumn("doc_id", F.struct("doc_id"))
    lengths = weights.groupBy(F.col("doc_id").alias("id")).agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length")
    )
    lengths = stored(lengths, "lengths").hint("shuffle_hash")
    unit = F.when(F.col("length") == 0, F.lit(0.0)).otherwise(F.col("weight") / F.col("length"))
    return weights.join(lengths, F.col("doc_id") == F.col("id")).select(
        F.col("doc_id.doc_id").alias("doc_id"), "term", unit.alias("weight")
    )


def unit_tfidf(docs: DataFrame, stopwords: StopWords = ()) -> DataFrame:
    """``(doc_id, term, weight)``, TF-IDF scaled to unit length per document.

    Texts are dealt by ``doc_id`` before they become terms: one compact row per document
    is shuffled, whatever the number of splits, and as a broadcast of the term weights
    leaves them in place, the lengths need no shuffle or sort of the long table. The texts
    are dealt and split once for the lengths and once for the weights.
    """
    dealt = docs.withColumn("doc_id", F.struct("doc_id")).repartition("doc_id")
    return l2_normalize(tfidf(dealt, stopwords))


def label_index(docs: DataFrame, label: str = "category") -> DataFrame:
    """Labels by frequency, ties by label: ``(label, idx, cnt)``; NULL skipped."""
    counted = (
        docs.where(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    ranked = global_rank(counted, [F.desc("cnt"), F.asc("label")])
    return ranked.select("label", (F.col("rk") - 1).alias("idx"), "cnt")
