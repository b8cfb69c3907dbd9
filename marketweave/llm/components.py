"""Connected components of a graph given as an edge table, without collecting any of it.

Alternating large-star and small-star rounds: each node hands its larger (then its smaller)
neighbours to the smallest node it knows, until every edge points at its component's smallest
node. A round is two grouped minima with joins, so a node with very many edges is pre-
aggregated in every task and split by the join; edges never grow in number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketweave.llm.common import Shelf

MAX_ROUNDS = 60


def _fingerprint(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected_components(edges: DataFrame, shelf: Shelf | None = None) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; the component is named by its
    smallest node. Self-loops, repeated edges and either direction are fine; rows with a null
    end are ignored; no edges give no rows. The result reads the last table put on ``shelf``
    (default: one of its own); those of the rounds before are deleted."""
    shelf = shelf or Shelf(edges.sparkSession)
    before = [d for d, _ in shelf.held]
    e = shelf.put(edges.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
                    .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct())
    seen = _fingerprint(e)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        # large star: every neighbour above the node points at the node's smallest neighbour
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("x"), F.least("u", "m").alias("m"))
        e = (both.filter("v > u").join(low, F.col("u") == F.col("x"))
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: the node and its smaller neighbours point at the smallest of them
        low = e.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        e = (e.join(low, F.col("u") == F.col("x"))
             .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                       F.struct(F.col("u"), F.col("m").alias("v")))).alias("p"))
             .select("p.u", "p.v").filter("u <> v").distinct())
        e = shelf.put(e)
        shelf.clear(*before, e)
        now = _fingerprint(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
