"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Workspace


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, space: Workspace, name: str) -> DataFrame:
    """(id, label) of every node of ``edges`` (columns u, v): the smallest node reachable.

    Every round is written to the shared folder.  Degrees may be large: the least neighbour is found by a
    pre-aggregated minimum, and the joins on a frequent node are split by adaptive execution.
    """
    big, small = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = space.store(edges.where("u <> v").select(big, small).distinct(), f"{name}-0")
    seen, step = None, 0
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen, step = mark, step + 1
        now = space.store(_small_star(_large_star(now).where("u <> v").distinct()), f"{name}-{step}")
        space.drop(f"{name}-{step - 1}")
    return now.select(F.col("u").alias("id"), F.col("v").alias("label")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("label")).distinct()
    )
