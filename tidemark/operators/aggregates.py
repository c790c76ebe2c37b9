"""Aggregation shapes: conditional and pivoted aggregates, lists, KPI arithmetic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import along_key, ordinal
from tidemark.operators.skew import HOT_ROWS


def money(col: str | Column) -> Column:
    """Exact two-decimal amount, so sums do not depend on row order."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("decimal(18,2)")


def cents(col: str | Column) -> Column:
    """Amount in whole hundredths (bigint); much cheaper to sum than a decimal made from a double."""
    c = F.col(col) if isinstance(col, str) else col
    return F.rint(c * 100).cast("bigint")


def exact_sum(whole: Column, scale: int = 100) -> Column:
    """Sum of whole units, exact and without overflow, as a double divided by ``scale``.

    For products and global totals; ``sum_money`` is faster for plain amounts.
    """
    return F.sum(whole.cast("decimal(18,0)")).cast("double") / scale


def sum_money(col: str | Column, when: Column | None = None) -> Column:
    """Exact sum of two-decimal amounts (of the rows under ``when``), whatever the row order.

    Sums hundredths as bigint: good up to totals of 92 quadrillion, beyond which
    ANSI mode raises an error instead of giving a wrong sum.
    """
    c = cents(col)
    return F.sum(c if when is None else F.when(when, c)).cast("double") / 100


def conditional_agg(
    df: DataFrame, keys: Sequence[str], aggs: Mapping[str, tuple[str, Column, Column | None]]
) -> DataFrame:
    """``{name: (function, condition, value)}`` with function count, sum, min, max or count_distinct."""
    calls = {"sum": F.sum, "min": F.min, "max": F.max, "count_distinct": F.count_distinct}
    out = []
    for name, (fn, cond, value) in aggs.items():
        agg = F.count_if(cond) if fn == "count" else calls[fn](F.when(cond, value))
        out.append(agg.alias(name))
    return df.groupBy(*keys).agg(*out)


def pivot_max(
    df: DataFrame, keys: Sequence[str], category: str, value: str, columns: Mapping[object, str], agg=F.max
) -> DataFrame:
    """One column per listed category value; ``columns`` maps category value to output name."""
    return df.groupBy(*keys).agg(
        *[agg(F.when(F.col(category) == F.lit(v), F.col(value))).alias(n) for v, n in columns.items()]
    )


def list_parts(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    out: str,
    sep: str = ", ",
    part_size: int = 1_000,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Values of a key joined to text, in order, in numbered parts of ``part_size`` values.

    Almost every key has one part; a key with very many rows has many instead
    of one cell that no task could hold.
    """
    numbered = along_key(df, keys, order_by, {"_pos": ordinal()}, hot_rows=hot_rows)
    part = (F.floor((F.col("_pos") - 1) / part_size) + 1).alias("part")
    packed = numbered.groupBy(*keys, part).agg(
        F.sort_array(F.collect_list(F.struct("_pos", F.col(value).cast("string").alias("_v")))).alias("_l")
    )
    return packed.select(*keys, "part", F.array_join(F.transform("_l", lambda s: s["_v"]), sep).alias(out))


def joined_set(value: Column, sep: str = ", ") -> Column:
    """Aggregate: distinct values of a small domain, sorted and joined; NULL when there are none.

    The set is built map-side, so a frequent key ships one small set per task.
    """
    found = F.collect_set(value.cast("string"))
    return F.when(F.size(found) > 0, F.array_join(F.sort_array(found), sep))


def distinct_list(df: DataFrame, keys: Sequence[str], value: str, out: str, sep: str = ", ") -> DataFrame:
    """Distinct values of a small domain (codes, flags) per key, sorted and joined to text."""
    return df.groupBy(*keys).agg(joined_set(F.col(value), sep).alias(out))


def ratio(num: Column, den: Column, scale: float = 1.0, zero_as: float | None = None) -> Column:
    """``num / den * scale``; NULL on a zero denominator, or divide by ``zero_as`` instead."""
    d = den.cast("double")
    if zero_as is not None:
        d = F.when(d == 0, F.lit(zero_as)).otherwise(d)
    value = F.try_divide(num.cast("double"), d)
    return value if scale == 1.0 else value * scale


def run_rate(value: Column, as_of: Column) -> Column:
    """Month-to-date value extended to the month end at the same daily pace."""
    day, days = F.dayofmonth(as_of), F.dayofmonth(F.last_day(as_of))
    return value + value / day * (days - day)


def kpi_score(value: Column, polarity: Column, upper: Column, lower: Column, weight: Column) -> Column:
    """Full, 80 % or 60 % of the weight by two limits; ``up`` means larger is better."""
    full, most, least = weight * 1.0, weight * 0.8, weight * 0.6
    rising = F.when(value >= upper, full).when(value < lower, least).otherwise(most)
    falling = F.when(value <= upper, full).when(value > lower, least).otherwise(most)
    return F.when(polarity == "up", rising).otherwise(falling)
