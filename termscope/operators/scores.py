"""Association scores over document counts, and the terms they select."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termscope.functions.stats import chi_square, chi_square_cell, chi_square_empty_cells
from termscope.operators.counts import (
    category_rows,
    category_term_rows,
    term_rows,
    total_documents,
    with_tag,
)
from termscope.operators.numbering import top_k_per_group, top_n

TOP_TERMS_PER_CATEGORY = 75
TOP_TERMS_GLOBAL = 2000

# Copies of each category row in the join with the pairs; a power of two.
CATEGORY_SALTS = 32


def join_term_totals(tallied: DataFrame) -> DataFrame:
    """Ntc joined with Nt: ``(category, term, ntc, nt)``."""
    return category_term_rows(tallied).join(term_rows(tallied), "term").select(
        "category", "term", "ntc", "nt"
    )


def with_term_totals(pairs: DataFrame) -> DataFrame:
    """Add Nt to ``(category, term, ntc)`` with one shuffle in place of a join.

    A term has at most one pair per category, so no window group is hot.
    """
    return pairs.withColumn("nt", F.sum("ntc").over(Window.partitionBy("term")))


def contingency(tallied: DataFrame) -> DataFrame:
    """All counts per pair: ``(category, term, n, nc, nt, ntc)``."""
    return _contingency(
        category_term_rows(tallied), category_rows(tallied), total_documents(tallied)
    )


def contingency_from_counts(counts: DataFrame) -> DataFrame:
    """The same from stored counts; each side scans the folder of its own tag."""
    return _contingency(
        with_tag(counts, "NTC").select("category", "term", F.col("cnt").alias("ntc")),
        with_tag(counts, "NC").select("category", F.col("cnt").alias("nc")),
        with_tag(counts, "N").agg(F.sum("cnt").alias("n")),
    )


def _contingency(pairs: DataFrame, categories: DataFrame, total: DataFrame) -> DataFrame:
    """N is a scalar subquery. The category table carries no broadcast hint: once
    its stage has run, adaptive execution broadcasts it if its real size is below
    the threshold. Beyond that the join shuffles, and the salt spreads the pairs
    of a hot category over many tasks.
    """
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(CATEGORY_SALTS - 1).cast("bigint"))
    categories = categories.select("category", "nc", F.explode(salts).alias("_salt"))
    # An expression that can be NULL would add a filter to this side of the join
    # only, and the sides would no longer share the tally's shuffle.
    salt = F.xxhash64("term").bitwiseAND(F.lit(CATEGORY_SALTS - 1))
    return (
        with_term_totals(pairs)
        .withColumn("_salt", salt)
        .join(categories, ["category", "_salt"])
        .select("category", "term", total.scalar().alias("n"), "nc", "nt", "ntc")
    )


def score_pairs(table: DataFrame) -> DataFrame:
    """Chi-square of every co-occurring pair of a contingency table:
    ``(category, term, chi2)``."""
    counts = [F.col(c) for c in ("n", "nc", "nt", "ntc")]
    return table.select("category", "term", chi_square(*counts).alias("chi2"))


def top_terms(scored: DataFrame, k: int = TOP_TERMS_PER_CATEGORY) -> DataFrame:
    """The best ``k`` terms per category: ``(category, rk, term, chi2)``.

    Order is chi2 descending, then term ascending.
    """
    ranked = top_k_per_group(scored, ["category"], [F.desc("chi2"), F.asc("term")], k)
    return ranked.select("category", "rk", "term", "chi2")


def global_scores(table: DataFrame) -> DataFrame:
    """Chi-square of presence x all categories per term of a contingency table:
    ``(term, nt, chi2)``.

    Rounded to six decimals so the order does not hang on summation order. With
    the category table broadcast, pairs are still partitioned by term from the
    window, and the aggregation shuffles nothing.
    """
    n, nc, nt, ntc = (F.col(c) for c in ("n", "nc", "nt", "ntc"))
    summed = table.groupBy("term").agg(
        F.max("n").alias("n"),
        F.max("nt").alias("nt"),
        F.sum(chi_square_cell(n, nc, nt, ntc)).alias("observed"),
        F.sum("nc").alias("docs_seen"),
    )
    empty = chi_square_empty_cells(n, nt, n - F.col("docs_seen"))
    return summed.select("term", "nt", F.round(F.col("observed") + empty, 6).alias("chi2"))


def top_terms_global(table: DataFrame, n: int = TOP_TERMS_GLOBAL) -> DataFrame:
    """The best ``n`` terms of the corpus: ``(term, nt, chi2)``."""
    return top_n(global_scores(table), [F.desc("chi2"), F.asc("term")], n)
