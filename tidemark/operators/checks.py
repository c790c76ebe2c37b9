"""Data-quality checks.  Each returns the violating rows or groups; empty means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.intervals import range_violations
from tidemark.operators.ordered import along_key, lag
from tidemark.operators.sets import symmetric_difference
from tidemark.operators.skew import HOT_ROWS


def accepted_range(df, col: str, low=None, high=None, inclusive: bool = True) -> DataFrame:
    c, ok = F.col(col), F.lit(True)
    if low is not None:
        ok = ok & ((c >= low) if inclusive else (c > low))
    if high is not None:
        ok = ok & ((c <= high) if inclusive else (c < high))
    return df.where(~ok)  # NULL is not a violation


def at_least_one(df, col: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.count(col).alias("filled")).where("filled = 0")


def cardinality_equality(a, a_col: str, b, b_col: str) -> DataFrame:
    left = a.groupBy(F.col(a_col).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    right = b.groupBy(F.col(b_col).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return symmetric_difference(left, right)


def equal_rowcount(a, b, by: Sequence[str] = ()) -> DataFrame:
    return _compare_counts(a, b, by).where(~F.col("rows_a").eqNullSafe(F.col("rows_b")))


def fewer_rows_than(a, b, by: Sequence[str] = ()) -> DataFrame:
    return _compare_counts(a, b, by).where("rows_a >= rows_b")


def _compare_counts(a, b, by) -> DataFrame:
    by = list(by)
    tagged = a.select(*by, F.lit(1).alias("_a")).unionByName(
        b.select(*by, F.lit(0).alias("_a"))
    )
    return tagged.groupBy(*by).agg(
        F.count_if(F.col("_a") == 1).alias("rows_a"), F.count_if(F.col("_a") == 0).alias("rows_b")
    )


def equality(a, b, columns: Sequence[str] | None = None, exclude: Sequence[str] = (), precision: int | None = None):
    cols = [c for c in (columns or a.columns) if c not in exclude]

    def shaped(df):
        types = dict(df.dtypes)
        return df.select(
            *[
                F.round(c, precision).alias(c)
                if precision is not None and types[c] in ("double", "float")
                else F.col(c)
                for c in cols
            ]
        )

    return symmetric_difference(shaped(a), shaped(b))


def expression_is_true(df, expression: Column) -> DataFrame:
    return df.where(~expression)


def mutually_exclusive_ranges(
    df, lower: str, upper: str, by: Sequence[str] = (), gaps: str = "allowed", zero_length: bool = False,
    tiebreak: Sequence[str] = (), hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``gaps``: allowed, not_allowed (next starts exactly at the end) or required.

    ``tiebreak`` columns decide which of several identical ranges is reported.
    """
    keys, frame = list(by), df
    if not keys:
        keys, frame = ["_all"], df.withColumn("_all", F.lit(1))
    return range_violations(frame, keys, lower, upper, gaps, zero_length, tiebreak, hot_rows).drop("_all")


def not_accepted_values(df, col: str, values: Sequence) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def not_constant(df, col: str, by: Sequence[str] = ()) -> DataFrame:
    # min = max says "one distinct value" without a distinct aggregation
    spread = df.groupBy(*by).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    return spread.where(F.col("_lo") == F.col("_hi")).select(*by, F.col("_lo").alias("only_value"))


def not_empty_string(df, col: str, trim: bool = True) -> DataFrame:
    text = F.trim(F.col(col)) if trim else F.col(col)
    return df.where(text == "")


def not_null_proportion(df, col: str, at_least: float, at_most: float = 1.0, by: Sequence[str] = ()):
    share = (F.count(col) / F.count(F.lit(1))).alias("share")
    return df.groupBy(*by).agg(share).where((F.col("share") < at_least) | (F.col("share") > at_most))


def recency(df, ts: str, as_of: Column, days: int, by: Sequence[str] = ()) -> DataFrame:
    newest = df.groupBy(*by).agg(F.max(ts).alias("newest"))
    limit = F.date_sub(as_of, days).cast("timestamp_ntz")
    return newest.where(F.col("newest").cast("timestamp_ntz") < limit)


def relationships_where(child, child_key: str, parent, parent_key: str, child_where=None, parent_where=None):
    child = child.where(child_where) if child_where is not None else child
    parent = parent.where(parent_where) if parent_where is not None else parent
    known = parent.select(F.col(parent_key).alias("_pk"))
    held = child.where(F.col(child_key).isNotNull())
    return held.join(known, held[child_key] == known["_pk"], "left_anti")


def sequential_values(df, col: str, step: Column | None = None, interval=1, by: Sequence[str] = (), hot_rows=HOT_ROWS):
    """Rows whose value is not the previous value of the key plus ``interval`` (or ``step(prev)``)."""
    keys, frame = list(by), df
    if not keys:
        keys, frame = ["_all"], df.withColumn("_all", F.lit(1))
    seq = along_key(frame, keys, [col], {"previous": lag(col)}, hot_rows=hot_rows)
    expected = step(F.col("previous")) if step is not None else F.col("previous") + interval
    return seq.where(F.col("previous").isNotNull() & (F.col(col) != expected)).drop("_all")


def unique_combination(df, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def run_checks(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Violation counts of many row rules in a single pass over the table."""
    one = df.agg(*[F.count_if(~c).alias(n) for n, c in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules])
    return one.select(F.explode(pairs).alias("_p")).select("_p.*")


def report(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check with its number of violations."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(n).alias("rule"), "violations")
        for n, df in checks.items()
    ]
    return reduce(DataFrame.unionByName, counted)
