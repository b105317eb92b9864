"""Comparing two runs: scores, term sets, order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["category", "term"]


def compare_scores(left: DataFrame, right: DataFrame, digits: int = 6) -> DataFrame:
    """One row: pairs in one run only, with other scores, with equal scores.

    The hash aggregation after the union needs one shuffle; a full outer join
    would sort both sides.
    """
    sides = left.select(
        *KEYS, F.round("chi2", digits).alias("l"), F.lit(None).cast("double").alias("r")
    ).unionByName(
        right.select(
            *KEYS, F.lit(None).cast("double").alias("l"), F.round("chi2", digits).alias("r")
        )
    )
    paired = sides.groupBy(*KEYS).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return paired.agg(
        F.count_if(F.col("r").isNull()).alias("only_left"),
        F.count_if(F.col("l").isNull()).alias("only_right"),
        F.count_if(F.col("l") != F.col("r")).alias("differing"),
        F.count_if(F.col("l") == F.col("r")).alias("equal"),
    )


def term_set_overlap(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: sizes of two term sets and of their intersection."""
    sides = left.select("term", F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select("term", F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    terms = sides.groupBy("term").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return terms.agg(
        F.count_if(F.col("l") == 1).alias("left_terms"),
        F.count_if(F.col("r") == 1).alias("right_terms"),
        F.count_if((F.col("l") == 1) & (F.col("r") == 1)).alias("shared"),
    )


def term_set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Terms of ``left`` that ``right`` lacks."""
    return left.select("term").distinct().join(right.select("term"), "term", "left_anti")


def order_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per category: shared terms, terms with another rank, and whether the two
    rankings hold the same terms in another order."""
    sides = left.select(*KEYS, F.col("rk").alias("l"), F.lit(None).cast("int").alias("r"))
    sides = sides.unionByName(
        right.select(*KEYS, F.lit(None).cast("int").alias("l"), F.col("rk").alias("r"))
    )
    terms = sides.groupBy(*KEYS).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    counted = terms.groupBy("category").agg(
        F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("shared"),
        F.count_if(F.col("l") != F.col("r")).alias("moved"),
        F.count(F.lit(1)).alias("terms"),
    )
    order_only = (F.col("shared") == F.col("terms")) & (F.col("moved") > 0)
    return counted.select(
        "category", "shared", "moved", order_only.cast("int").alias("order_only")
    )
