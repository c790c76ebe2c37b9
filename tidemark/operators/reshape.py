"""Nested data, text lists, unpivots and date grids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def json_children(
    df: DataFrame, keys: Sequence[str], json_col: str, schema: str, outer: bool = False
) -> DataFrame:
    """Explode a JSON array of objects kept as text into one row per object."""
    gen = F.explode_outer if outer else F.explode
    return df.select(*keys, gen(F.from_json(json_col, schema)).alias("_c")).select(*keys, "_c.*")


def json_grandchildren(
    df: DataFrame, keys: Sequence[str], json_col: str, schema: str, arrays: Sequence[str], zipped: bool = False
) -> DataFrame:
    """Explode an array of objects and then inner arrays of each object.

    Several inner arrays multiply; ``zipped`` pairs their elements by position instead.
    """
    child = json_children(df, keys, json_col, schema)
    if zipped:
        plain = [c for c in child.columns if c not in arrays]
        return child.select(*plain, F.explode(F.arrays_zip(*arrays)).alias("_z")).select(*plain, "_z.*")
    for name in arrays:
        child = child.withColumn(name, F.explode(name))
    return child


def split_rows(df: DataFrame, col: str, sep: str, out: str | None = None) -> DataFrame:
    """One row per trimmed part of a delimited text."""
    return df.withColumn(out or col, F.explode(F.split(col, sep))).withColumn(
        out or col, F.trim(F.col(out or col))
    )


def unpivot_metrics(
    df: DataFrame,
    ids: Sequence[str],
    columns: Mapping[str, str],
    name: str = "metric",
    value: str = "value",
    drop_nulls: bool = True,
) -> DataFrame:
    """Columns to rows; ``columns`` maps column to label (their types must agree)."""
    pairs = F.array(
        *[F.struct(F.lit(label).alias(name), F.col(c).alias(value)) for c, label in columns.items()]
    )
    long = df.select(*ids, F.explode(pairs).alias("_p")).select(*ids, "_p.*")
    return long.where(F.col(value).isNotNull()) if drop_nulls else long


def date_grid(spark: SparkSession, start: Column, end: Column, step: str, out: str = "day") -> DataFrame:
    """One row per step from start to end, both included (``step`` like '1 day')."""
    return spark.range(1).select(F.explode(F.sequence(start, end, F.expr(f"interval {step}"))).alias(out))


def month_ends(first: Column, last: Column) -> Column:
    """Array of month-end dates from the month of ``first`` to the month of ``last``."""
    starts = F.sequence(F.trunc(first, "MM"), F.trunc(last, "MM"), F.expr("interval 1 month"))
    return F.transform(starts, lambda m: F.last_day(m))


def date_spine(spark: SparkSession, start: Column, end: Column, unit: str, out: str) -> DataFrame:
    """Dates from ``start`` up to but not including ``end``, one per ``unit``."""
    every = F.sequence(start, end, F.expr(f"interval 1 {unit}"))
    return spark.range(1).select(F.explode(F.filter(every, lambda d: d < end)).alias(out))
