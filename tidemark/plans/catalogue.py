"""Product catalogue plans and small look-ups."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def features_of(plans: DataFrame, key: str, name: str, patterns: Mapping[str, str]) -> DataFrame:
    """One row per plan and feature whose LIKE pattern its name matches."""
    hits = [F.when(F.col(name).like(p), F.lit(feature)) for feature, p in patterns.items()]
    return plans.select(key, F.explode(F.array_compact(F.array(*hits))).alias("feature"))


def column_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values with their frequency, most frequent first."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("times"))
    return counts.orderBy(F.desc("times"), "value")


def single_value(df: DataFrame, col: str):
    """The value of a one-row result on the driver; None for no row, an error for several."""
    rows = df.select(col).limit(2).collect()
    if len(rows) > 1:
        raise ValueError("more than one row")
    return rows[0][0] if rows else None
