"""Terms ranked by the chi-square of their counts per document against the category.

The selection of the ML stages in long form: it holds for any number of terms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.functions.stats import log_chi_square_tail, log_chi_square_tail_bounds
from termscope.operators.numbering import global_rank
from termscope.operators.terms import StopWords
from termscope.operators.vectors import term_frequency
from termscope.sources.storage import scratch, stored

#: More than the difference of two logarithms that are equal to six decimals.
ROUNDED_OFF = 2e-6


def term_statistics(docs: DataFrame, stopwords: StopWords = ()) -> DataFrame:
    """``(term, dof, statistic)`` of every term of the corpus.

    A term's table has a row for each count it has in some document, zero included,
    and a column for each category. Per count, the squared cells over their margins add
    up from one aggregate; the row of zeros follows from totals, so no grid of terms
    and categories is built. A term of every document has weight 0 throughout, and so
    degree and statistic 0. Documents without a category are left out.
    """
    known = docs.where("category IS NOT NULL").select("category", "reviewText")
    totals = known.groupBy("category").agg(F.count(F.lit(1)).alias("nc"))
    whole = totals.agg(
        F.coalesce(F.sum("nc"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("categories")
    )
    n = whole.select("n").scalar()
    categories = whole.select("categories").scalar()
    cells = (
        term_frequency(known, stopwords, keys=("category",))
        .groupBy("term", "tf", "category")
        .agg(F.count(F.lit(1)).alias("o"))
        .join(totals, "category")
    )
    o, nc = F.col("o").cast("double"), F.col("nc").cast("double")
    by_count = cells.groupBy("term", "tf").agg(
        F.sum("o").alias("r"), F.sum(o * o / nc).alias("q")
    )
    present = by_count.groupBy("term").agg(
        F.sum(F.col("q") / F.col("r")).alias("present"),
        F.count(F.lit(1)).alias("values"),
        F.sum("r").alias("nt"),
    )
    by_category = cells.groupBy("term", "category", "nc").agg(F.sum("o").alias("o"))
    squares = by_category.groupBy("term").agg(F.sum(o * o / nc).alias("squares"))
    absent = n - 2 * F.col("nt") + F.col("squares")
    statistic = n * (F.col("present") + absent / (n - F.col("nt"))) - n
    everywhere = F.col("nt") == n
    return present.join(squares, "term").select(
        "term",
        F.when(everywhere, 0)
        .otherwise(F.col("values") * (categories - 1))
        .cast("int")
        .alias("dof"),
        F.when(everywhere, F.lit(0.0)).otherwise(statistic).alias("statistic"),
    )


def top_statistics(statistics: DataFrame, n: int) -> DataFrame:
    """``(rk, term, log_p, statistic)`` of the ``n`` best terms.

    Ranked by p-value, as tables of different terms have different degrees of freedom,
    and by its logarithm, as the value itself is 0 for most of the terms that matter. The
    logarithm is rounded to six decimals, so that ties do not depend on the order in which
    sums were added, and they go to the alphabetically smaller term.

    The logarithm takes a loop for every term, so it is computed only for those that may be
    among the best: ``n`` terms have logarithms up to the ``n``-th smallest upper bound, and
    a term whose lower bound is larger, by more than what is rounded off, comes after them.
    """
    statistics = _candidates(stored(statistics, "statistics"), n)
    tail = log_chi_square_tail(F.col("statistic"), F.col("dof"))
    rounded = statistics.select(
        "term", F.round(tail, 6).alias("log_p"), F.round("statistic", 6).alias("statistic")
    )
    order = [F.asc("log_p"), F.asc("term")]
    ranked = global_rank(rounded.orderBy(*order).limit(n), order)
    return ranked.select("rk", "term", "log_p", "statistic")


def _candidates(statistics: DataFrame, n: int) -> DataFrame:
    """The rows that can be among the ``n`` best ones; unknown logarithms come first."""
    below, above = log_chi_square_tail_bounds(F.col("statistic"), F.col("dof"))
    first = statistics.select(above.alias("above")).orderBy(F.asc("above")).limit(n)
    most = first.agg(F.max("above").alias("most")).scalar()
    return statistics.where(below.isNull() | (below <= most + ROUNDED_OFF))


def best_terms(docs: DataFrame, n: int, stopwords: StopWords = ()) -> list[str]:
    """The ``n`` best terms in their order: at most that many rows reach the driver."""
    with scratch():
        ranked = top_statistics(term_statistics(docs, stopwords), n)
        return [row.term for row in ranked.orderBy("rk").collect()]
