"""How far a fitted binary SVM is from the best one, told by its dual."""

from __future__ import annotations

from pyspark.ml.classification import LinearSVCModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Widths of the margin band in which a document's dual weight falls from 1 to 0. Any of
#: them gives a bound; the best one counts.
BANDS = (0.001, 0.01, 0.03, 0.1, 0.3, 1.0)

_ROW = -1


def _dual_weight(margin: Column, band: float) -> Column:
    """1 well inside the margin, 0 well outside, in between falling."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (1 - margin) / band + 0.5))


def duality_gap(
    rows: DataFrame, model: LinearSVCModel, features: str = "norm_features", label: str = "label"
) -> DataFrame:
    """One row ``(documents, primal, dual, gap)``; the gap is relative to the primal.

    The primal is the mean hinge loss plus the penalty of the model's coefficients, scaled
    by their standard deviations if it was fitted so. Margins give dual weights between 0
    and 1; those of the larger side are scaled down until both sides weigh the same, as the
    free intercept demands, and all are scaled by what makes their dual largest. Such
    weights are feasible, so their dual is a lower bound of any primal, and a small gap
    proves that no other coefficients would do much better.

    All sums over documents come from one aggregate by feature: the vector of weighted
    features for each band and side, the moments, and the totals as a feature of their own.
    Labels are 0 and 1; rows with a null vector or label are left out.
    """
    reg, scaled = model.getRegParam(), model.getStandardization()
    if reg <= 0:
        raise ValueError("without a penalty there is no dual bound")
    coefficients = model.coefficients.toArray()
    sign = F.col(label) * 2 - 1
    scored = model.transform(rows.where(F.col(features).isNotNull() & F.col(label).isNotNull()))
    margins = scored.select(
        sign.alias("y"),
        (sign * vector_to_array("rawPrediction")[1]).alias("m"),
        vector_to_array(features).alias("x"),
    )
    entries = F.filter(
        F.transform("x", lambda v, i: F.struct(i.alias("slot"), v.alias("v"))), lambda e: e["v"] != 0
    )
    whole = F.array(F.struct(F.lit(_ROW).alias("slot"), F.lit(1.0).alias("v")))
    parts = margins.select("y", "m", F.explode(F.concat(whole, entries)).alias("e")).select(
        "y", "m", F.col("e.slot").alias("slot"), F.col("e.v").alias("v")
    )
    sums = [
        F.sum(F.when(F.col("y") * side > 0, _dual_weight(F.col("m"), band) * F.col("v")).otherwise(0.0)).alias(f"d{k}{name}")
        for k, band in enumerate(BANDS)
        for side, name in ((1, "p"), (-1, "n"))
    ]
    by_slot = parts.groupBy("slot").agg(
        F.sum("v").alias("s1"),
        F.sum(F.col("v") * F.col("v")).alias("s2"),
        F.sum(F.greatest(F.lit(0.0), 1 - F.col("m"))).alias("hinge"),
        *sums,
    )
    total = by_slot.where(F.col("slot") == _ROW).select(
        F.col("s1").alias("n"), F.col("hinge").alias("loss"), *(F.col(s).alias(f"t{s}") for s in _names())
    )
    spark = rows.sparkSession
    weights = spark.createDataFrame(
        [(i, float(w)) for i, w in enumerate(coefficients) if w], "slot int, w double"
    )
    # The table of totals is one row, that of coefficients one of the model's features.
    joined = by_slot.where(F.col("slot") != _ROW).join(weights, "slot", "left").crossJoin(F.broadcast(total))
    n = F.col("n")
    variance = (F.col("s2") - F.col("s1") * F.col("s1") / n) / (n - 1)
    penalty = variance if scaled else F.lit(1.0)
    used = F.lit(True) if not scaled else variance > 1e-18
    w = F.coalesce("w", F.lit(0.0))
    duals = []
    for k in range(len(BANDS)):
        plus, minus = F.col(f"td{k}p"), F.col(f"td{k}n")
        least = F.least(plus, minus)
        v = (
            F.coalesce(F.col(f"d{k}p") * least / F.nullif(plus, F.lit(0.0)), F.lit(0.0))
            - F.coalesce(F.col(f"d{k}n") * least / F.nullif(minus, F.lit(0.0)), F.lit(0.0))
        ) / n
        square = F.sum(F.when(used, v * v / penalty).otherwise(0.0))
        mass = F.first(2 * least / n)
        scale = F.least(F.lit(1.0), F.coalesce(reg * mass / F.nullif(square, F.lit(0.0)), F.lit(1.0)))
        duals.append(scale * mass - scale * scale * square / (2 * reg))
    row = joined.agg(
        F.first("n").cast("bigint").alias("documents"),
        (F.first("loss") / F.first("n") + F.sum(w * w * penalty) * reg / 2).alias("primal"),
        F.greatest(F.lit(0.0), *duals).alias("dual"),
    )
    return row.withColumn("gap", (F.col("primal") - F.col("dual")) / F.col("primal"))


def _names() -> list[str]:
    return [f"d{k}{side}" for k in range(len(BANDS)) for side in "pn"]
