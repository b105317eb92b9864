"""Splits, folds, classification metrics and summaries of tuning results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termscope.functions.stats import hash_bucket

SEED = 42
TRAIN_PERCENT = 70
VALIDATION_PERCENT = 15
FOLDS = 2


def assign_split(df: DataFrame, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Add ``split``: train, validation or test by a hash of the key."""
    bucket = hash_bucket(F.col(key), seed)
    return df.withColumn(
        "split",
        F.when(bucket < TRAIN_PERCENT, "train")
        .when(bucket < TRAIN_PERCENT + VALIDATION_PERCENT, "validation")
        .otherwise("test"),
    )


def split_part(df: DataFrame, part: str, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The rows of one part."""
    return assign_split(df, key, seed).where(F.col("split") == part).drop("split")


def train_val_union(df: DataFrame, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Train and validation together, one filter over one scan."""
    return assign_split(df, key, seed).where(F.col("split") != "test").drop("split")


def split_counts(df: DataFrame, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Rows per part."""
    return (
        assign_split(df, key, seed).groupBy("split").agg(F.count(F.lit(1)).alias("docs"))
    )


def assign_fold(
    df: DataFrame, folds: int = FOLDS, key: str = "doc_id", seed: int = SEED
) -> DataFrame:
    """Add ``fold``, independent of the split: the seed is shifted by one."""
    return df.withColumn("fold", hash_bucket(F.col(key), seed + 1, folds))


def confusion_counts(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Rows per (label, prediction)."""
    return predictions.groupBy(
        F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("cnt"))


def class_f1(confusion: DataFrame) -> DataFrame:
    """Per class: ``(class, support, predicted, hits, f1)``.

    Each cell counts once for its label and once for its prediction, so the
    sums need one aggregation of the few cells and no join.
    """
    hit = F.when(F.col("label") == F.col("prediction"), F.col("cnt")).otherwise(0)
    nothing = F.lit(0).cast("bigint")
    roles = F.array(
        F.struct(
            F.col("label").alias("class"),
            F.col("cnt").alias("support"),
            nothing.alias("predicted"),
            hit.cast("bigint").alias("hits"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            nothing.alias("support"),
            F.col("cnt").alias("predicted"),
            nothing.alias("hits"),
        ),
    )
    sums = (
        confusion.select(F.inline(roles))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    # 2PR/(P+R) with P = hits/predicted and R = hits/support.
    f1 = F.lit(2.0) * F.col("hits") / (F.col("support") + F.col("predicted"))
    return sums.withColumn("f1", f1)


def weighted_f1(confusion: DataFrame) -> DataFrame:
    """One row: F1 per class weighted by its support."""
    return class_f1(confusion).agg(
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1")
    )


def majority_f1(labels: DataFrame, label: str = "label") -> DataFrame:
    """One row: the weighted F1 of always predicting the most frequent label.

    What a classifier has to beat before it can be said to have learned anything.
    """
    counts = labels.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("cnt"))
    most, total = F.max("cnt").alias("most"), F.sum("cnt").alias("total")
    share = F.col("most") / F.col("total")
    return counts.agg(most, total).select((share * 2 * share / (1 + share)).alias("f1"))


def main_effects(
    df: DataFrame, factors: Sequence[str], metric: str, digits: int = 6
) -> DataFrame:
    """Mean metric per factor level and its distance to the factor's lowest mean.

    Rows are first summed per combination of levels; only those few sums are
    unpivoted.
    """
    combos = df.groupBy(*factors).agg(
        F.sum(metric).alias("_sum"), F.count(metric).alias("_n")
    )
    levels = F.array(
        *[
            F.struct(F.lit(f).alias("factor"), F.col(f).cast("string").alias("level"))
            for f in factors
        ]
    )
    means = (
        combos.select(F.inline(levels), "_sum", "_n")
        .groupBy("factor", "level")
        .agg((F.sum("_sum") / F.sum("_n")).alias("_mean"))
    )
    lowest = F.min("_mean").over(Window.partitionBy("factor"))
    return means.select(
        "factor",
        "level",
        F.round("_mean", digits).alias("mean"),
        F.round(F.col("_mean") - lowest, digits).alias("delta"),
    )
