"""Links between rows that share a key within a band of days.

The rows of one shared key (an address, a phone) can be very many, so links
are answered from one row per (key, day) and never by pairing the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def earlier_link(
    df: DataFrame,
    keys: Sequence[str],
    row_id: str,
    opened: str,
    closed: str,
    before_days: int,
    after_days: int,
    out: str,
) -> DataFrame:
    """Add the smallest id of a closed row that shares ``keys`` and qualifies, else NULL.

    A row qualifies when its id is smaller and its closing day lies from
    ``before_days`` before to ``after_days`` after the opening day of the row.
    """
    keys = list(keys)
    marks = df.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col(closed).alias("_day"), F.col(row_id).alias("_low")),
                F.struct(F.col(opened).alias("_day"), F.lit(None).cast(df.schema[row_id].dataType).alias("_low")),
            )
        ).alias("_m"),
    ).select(*keys, "_m.*")
    # one row per key and day, so the window groups stay small
    daily = marks.where(F.col("_day").isNotNull()).groupBy(*keys, "_day").agg(F.min("_low").alias("_low"))
    near = Window.partitionBy(*keys).orderBy(F.unix_date("_day")).rangeBetween(-before_days, after_days)
    lows = daily.select(*keys, F.col("_day").alias(opened), F.min("_low").over(near).alias("_best"))
    joined = df.join(lows, [*keys, opened], "left")
    return joined.withColumn(out, F.when(F.col("_best") < F.col(row_id), F.col("_best"))).drop("_best")


def link_flags(
    df: DataFrame, row_id: str, opened: str, closed: str, key_sets: Mapping[str, Sequence[str]], band_days: int
) -> DataFrame:
    """One 0/1 flag per key set: is there an earlier closed row with the same keys in the band?"""
    out = df
    for flag, keys in key_sets.items():
        out = earlier_link(out, keys, row_id, opened, closed, band_days, band_days, "_link")
        out = out.withColumn(flag, F.col("_link").isNotNull().cast("int")).drop("_link")
    return out
