"""Top terms per category: review files in, report out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from termscope.operators import counts as c
from termscope.operators.report import category_lines, merged_dictionary
from termscope.operators.terms import StopWords
from termscope.operators.scores import (
    TOP_TERMS_PER_CATEGORY,
    contingency_from_counts,
    score_pairs,
    top_terms,
)
from termscope.sources.report import write_dictionary, write_report, write_text


def term_report(
    docs: DataFrame,
    output: str,
    stopwords: StopWords = (),
    k: int = TOP_TERMS_PER_CATEGORY,
) -> DataFrame:
    """Write counts, metadata, report and dictionary below ``output``.

    The texts are read once. The counts table is stored first; all that follows
    reads the table, and a later run can start from it: :func:`report_from_counts`.
    Returns the ranked terms.
    """
    c.write_counts(c.tagged_counts(c.tally(docs, stopwords)), f"{output}/counts")
    return report_from_counts(c.read_counts(docs.sparkSession, f"{output}/counts"), output, k)


def report_from_counts(
    counts: DataFrame, output: str, k: int = TOP_TERMS_PER_CATEGORY
) -> DataFrame:
    """The part of the run after counting."""
    spark = counts.sparkSession
    write_text(c.corpus_meta_json(counts), f"{output}/meta", "value")
    ranked = top_terms(score_pairs(contingency_from_counts(counts)), k)
    ranked.write.mode("overwrite").parquet(f"{output}/ranked")
    ranked = spark.read.schema(ranked.schema).parquet(f"{output}/ranked")
    write_report(category_lines(ranked), ranked, f"{output}/report")
    write_dictionary(merged_dictionary(ranked), f"{output}/dictionary")
    return ranked
