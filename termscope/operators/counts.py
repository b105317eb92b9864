"""Document-presence counts.

The base is one *tally*: ``(category, term, tally)``, one row per pair and one
with a NULL term per category. It takes a single pass over the texts and a
single aggregation; N, Nc, Nt and Ntc all follow from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termscope.functions.text import words
from termscope.operators.terms import StopWords, kept_or_marked


def tally(docs: DataFrame, stopwords: StopWords = ()) -> DataFrame:
    """Count documents per (category, term) and per category in one pass.

    Each document contributes its distinct terms and one NULL term, so documents
    left without terms still count. Document rows are counted as -1: a reader
    splits the table by sign, on the aggregated value. A filter on the key would
    be pushed below the aggregation and give each reader a scan of its own; a
    filter on the value leaves one shuffle that all readers share. For the same
    reason NULL categories go here: a join on category would drop them below the
    aggregation of one reader only.
    """
    marker = F.array(F.lit(None).cast("string"))
    pairs = docs.where("category IS NOT NULL").select(
        "category",
        F.explode(F.concat(marker, F.array_distinct(words("reviewText")))).alias("term"),
    )
    pairs = kept_or_marked(pairs, stopwords)
    weight = F.when(F.col("term").isNull(), F.lit(-1)).otherwise(F.lit(1))
    return pairs.groupBy("category", "term").agg(F.sum(weight).alias("tally"))


def tally_of(tallied: DataFrame, terms: DataFrame) -> DataFrame:
    """The rows of some terms, and those of the categories, which have a NULL term.

    For lists that fit in each task, such as a selection. The scores of a term need no
    others. Both readers of the tally still share its shuffle: the test is the same for
    both, and no join by term follows that would add a filter for one of them.
    """
    marker = terms.sparkSession.createDataFrame([(None,)], "_kept string")
    kept = terms.select(F.col("term").alias("_kept")).unionAll(marker)
    return tallied.join(F.broadcast(kept), F.col("term").eqNullSafe(F.col("_kept")), "left_semi")


def category_term_rows(tallied: DataFrame) -> DataFrame:
    """Ntc: ``(category, term, ntc)``."""
    return tallied.where("tally > 0").select("category", "term", F.col("tally").alias("ntc"))


def category_rows(tallied: DataFrame) -> DataFrame:
    """Nc: ``(category, nc)``."""
    return tallied.where("tally < 0").select("category", (-F.col("tally")).alias("nc"))


def total_documents(tallied: DataFrame) -> DataFrame:
    """N: one row ``(n)``."""
    return category_rows(tallied).agg(F.coalesce(F.sum("nc"), F.lit(0)).alias("n"))


def term_rows(tallied: DataFrame) -> DataFrame:
    """Nt: ``(term, nt)``. A document has one category, so Nt is the sum of Ntc."""
    return category_term_rows(tallied).groupBy("term").agg(F.sum("ntc").alias("nt"))


def tagged_counts(tallied: DataFrame) -> DataFrame:
    """All four counters as one table ``(tag, category, term, cnt)``.

    The grouping sets run over the tally, not over the documents.
    """
    sets = tallied.groupingSets([["category", "term"], ["term"]], "category", "term")
    summed = sets.agg(
        F.abs(F.sum("tally")).alias("cnt"), F.grouping("category").alias("_all")
    )
    tag = (
        F.when((F.col("_all") == 1) & F.col("term").isNull(), "N")
        .when(F.col("_all") == 1, "NT")
        .when(F.col("term").isNull(), "NC")
        .otherwise("NTC")
    )
    return summed.select(tag.alias("tag"), "category", "term", "cnt")


def write_counts(counts: DataFrame, path: str) -> None:
    """Store tagged counts, one folder per tag, so a reader scans only its tags."""
    counts.write.mode("overwrite").partitionBy("tag").parquet(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema("category string, term string, cnt bigint, tag string")
        .parquet(path)
        .select("tag", "category", "term", "cnt")
    )


def with_tag(counts: DataFrame, tag: str) -> DataFrame:
    """The rows of one counter."""
    return counts.where(F.col("tag") == tag).drop("tag")


def corpus_meta(counts: DataFrame) -> DataFrame:
    """Corpus metadata as rows ``(category, n, nc)``."""
    n = with_tag(counts, "N").agg(F.sum("cnt").alias("n")).scalar()
    per_category = with_tag(counts, "NC").groupBy("category").agg(F.sum("cnt").alias("nc"))
    return per_category.select("category", n.alias("n"), "nc")


def corpus_meta_json(counts: DataFrame) -> DataFrame:
    """Corpus metadata as one JSON object ``{"N": n, "Nc": {category: count}}``."""
    entries = F.map_from_entries(F.collect_list(F.struct("category", "nc")))
    return corpus_meta(counts).agg(
        F.to_json(F.struct(F.max("n").alias("N"), entries.alias("Nc"))).alias("value")
    )


def known_categories(counts: DataFrame, meta: DataFrame) -> DataFrame:
    """Counts of categories the metadata knows."""
    return counts.join(meta.select("category"), "category", "left_semi")


def run_summary(scored: DataFrame, ranked: DataFrame) -> DataFrame:
    """One row: scored pairs, categories, terms of the merged dictionary."""
    pairs = scored.agg(F.count(F.lit(1)).alias("n")).scalar()
    return ranked.agg(
        F.count_distinct("category").alias("categories"),
        F.count_distinct("term").alias("merged_terms"),
    ).select(pairs.alias("scored_pairs"), "categories", "merged_terms")
