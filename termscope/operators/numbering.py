"""Row numbers over a whole table, and the best rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termscope.sources.storage import stored

# Spark prunes a ranked window before its shuffle only below this many rows.
_PRUNED_WINDOW_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rk") -> DataFrame:
    """Number all rows from 1 in the given order, which must be total.

    A window without partitions would pull the table into one task. Here the
    rows are range partitioned and sorted, each knows its place in its part, and
    a table with one row per part supplies the offsets. The sorted rows are
    stored first, so both readers see the same parts.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The id holds the part number above its lower 33 bits and the place below.
    placed = (
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    placed = stored(placed, "ranked")
    part = F.shiftright("_id", 33)
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg((F.max(place) + 1).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    # One row per shuffle partition: its size is fixed by configuration.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + place + 1)
        .drop("_part", "_start", "_id")
    )


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str = "rk"
) -> DataFrame:
    """The first ``k`` rows of each group in the given order, ranked from 1.

    Below Spark's threshold the window itself discards all but ``k`` rows per
    group and task before it shuffles. From there on the group is first split
    into salted parts, so a hot group is ranked by many tasks; the best ``k`` of
    the parts contain the best ``k`` of the group.
    """
    spark = df.sparkSession
    if k >= int(spark.conf.get(_PRUNED_WINDOW_LIMIT, "1000")):
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(_salts(df)))
        within = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn(name, F.row_number().over(within))
            .where(F.col(name) <= k)
            .drop("_salt", name)
        )
    ranked = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(name, ranked).where(F.col(name) <= k)


def _salts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of the table in the given order."""
    return df.orderBy(*order).limit(n)


def best_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The first row of each group in the given order."""
    return top_k_per_group(df, group, order, 1, "_rk").drop("_rk")
