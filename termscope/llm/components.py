"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termscope.sources.storage import stored

MAX_ROUNDS = 60


def _hub(edges: DataFrame) -> DataFrame:
    """``(u, v, m)``: m is the least of u and all its v."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return edges.join(least, "u")


def connected(edges: DataFrame) -> DataFrame:
    """``(id, component_id)`` of every id in ``edges (a, b)``.

    The component is the least id reachable. A round links each node's larger
    neighbours to its least one, then its smaller ones; a node's neighbours meet in
    aggregates and joins only, never in one task, so hubs may be of any degree. The
    edges of a round are a stored table, so a lost executor costs no more than its
    own round. Self links make their node a component of one; nulls are dropped.
    """
    edges = edges.where("a is not null and b is not null").select(
        F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")
    )
    alone = edges.where("a = b").select("a").distinct()
    edges = stored(edges.where("a <> b").distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = (
            _hub(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        large = large.where("u <> v")
        small = _hub(large.where("v < u"))
        edges = stored(
            small.select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .where("a <> b")
            .distinct(),
            "edges",
        )
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    named = edges.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
    rest = alone.select(F.col("a").alias("id"), F.col("a").alias("component_id"))
    known = named.union(roots)
    return known.union(rest.join(known, "id", "left_anti"))
