"""Unions with rules: cut-over, waterfall, tagged sources, column supersets, differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.lake import store


def cutover_union(old: DataFrame, new: DataFrame, ts: str, cut: Column) -> DataFrame:
    """Old system before the cut-over moment, new system from it on."""
    return old.where(F.col(ts) < cut).unionByName(
        new.where(F.col(ts) >= cut), allowMissingColumns=True
    )


def union_distinct(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames).distinct()


def union_sources(frames: Mapping[str, DataFrame], source_col: str = "source") -> DataFrame:
    """Stack frames of the same shape with the name of the source in a column."""
    tagged = [df.withColumn(source_col, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def union_superset(
    frames: Mapping[str, DataFrame],
    source_col: str | None = "source",
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """Stack frames with differing columns; missing ones become NULL."""
    wanted = []
    for name, df in frames.items():
        cols = [c for c in df.columns if (not include or c in include) and c not in exclude]
        df = (df.where(where) if where is not None else df).select(*cols)
        wanted.append(df.withColumn(source_col, F.lit(name)) if source_col else df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), wanted)


def waterfall_union(
    branches: Sequence[DataFrame], keys: Sequence[str], rank_col: str = "branch"
) -> DataFrame:
    """Stack branches; a key keeps only the rows of the first branch it occurs in.

    The first branch of each key is stored when this is called: every branch is then read twice, for its
    keys and for its rows, however many there are.
    """
    keys = list(keys)
    numbered = [df.withColumn(rank_col, F.lit(i + 1)) for i, df in enumerate(branches)]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)
    slim = reduce(DataFrame.unionByName, [df.select(*keys, rank_col) for df in numbered])
    first = store(slim.groupBy(*keys).agg(F.min(rank_col).alias(rank_col)), "first-branches")
    return every.join(first, [*keys, rank_col], "left_semi")


def lowest_rank(df: DataFrame, keys: Sequence[str], rank_col: str) -> DataFrame:
    """All rows of a key that carry the key's lowest rank.

    Branches cut from one frame by conditions are better numbered by an
    expression and passed here than stacked by ``waterfall_union``.
    """
    first = df.groupBy(*keys).agg(F.min(rank_col).alias(rank_col))
    return df.join(first, [*keys, rank_col], "left_semi")


def symmetric_difference(a: DataFrame, b: DataFrame, side_col: str = "only_in") -> DataFrame:
    """Rows (with multiplicity) that only one side holds."""
    cols = a.columns
    both = a.withColumn("_w", F.lit(1)).unionByName(b.select(*cols).withColumn("_w", F.lit(-1)))
    surplus = both.groupBy(*cols).agg(F.sum("_w").alias("_w")).where("_w <> 0")
    side = F.when(F.col("_w") > 0, "a").otherwise("b").alias(side_col)
    copies = F.explode(F.sequence(F.lit(1), F.abs("_w"))).alias("_copy")
    return surplus.select(*cols, side, copies).drop("_copy")
