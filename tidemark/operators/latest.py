"""One or a few rows per key: latest version, n-th, top-k, priority, versions.

Ranks that are filtered by a small constant are planned by Catalyst as a
window group limit, which drops the other rows before the shuffle.  A frequent
key therefore sends at most k rows per map task to the final window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import along_key, is_last, ordinal, running_sum
from tidemark.operators.skew import HOT_ROWS, find_cuts

Order = Sequence[Column]


def topk_per_key(
    df: DataFrame, keys: Sequence[str | Column], order_by: Order, k: int, rank_col: str = "rank"
) -> DataFrame:
    """First ``k`` rows per key under ``order_by``, numbered in ``rank_col``."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")).where(F.col(rank_col) <= k)


def nth_by(df: DataFrame, keys: Sequence[str | Column], order_by: Order, n: int) -> DataFrame:
    """The ``n``-th row per key."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == n).drop("_rn")


def latest_version(
    df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str], keep_ties: bool = False
) -> DataFrame:
    """Newest row per key: greatest ``order_by`` columns (end them with a unique one).

    ``keep_ties`` keeps every row that shares the greatest order values.
    """
    if not keep_ties:
        return nth_by(df, keys, [F.col(c).desc() for c in order_by], 1)
    named = df.select("*", *[F.col(k).alias(f"_k{i}") if isinstance(k, str) else k.alias(f"_k{i}") for i, k in enumerate(keys)])
    named = named.withColumn("_ord", F.struct(*order_by))
    top = named.groupBy(*[F.col(f"_k{i}").alias(f"_t{i}") for i in range(len(keys))]).agg(
        F.max("_ord").alias("_top")
    )
    cond = F.col("_ord") == F.col("_top")
    for i in range(len(keys)):
        cond = cond & F.col(f"_k{i}").eqNullSafe(F.col(f"_t{i}"))
    return named.join(top, cond, "left_semi").select(*df.columns)


def dedupe_by_priority(
    df: DataFrame, keys: Sequence[str], priority: Column, then_by: Order
) -> DataFrame:
    """One row per key: lowest ``priority`` number first, then ``then_by``."""
    return nth_by(df, keys, [priority.asc_nulls_last(), *then_by], 1)


def representative_or_fallback(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], preferred: Column, allowed: Column
) -> DataFrame:
    """One row per key: its newest preferred row, or for a key without any its newest allowed one.

    A key whose newest preferred row is not allowed has no row.  ``order_by`` ends with a unique column.  One
    aggregation over one scan: the candidates of a key are carried along and combined map-side.
    """
    rest = [c for c in df.columns if c not in order_by]
    row = F.struct(*order_by, *rest)
    marked = df.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], row.alias("_row"),
        F.coalesce(preferred, F.lit(False)).alias("_better"), F.coalesce(allowed, F.lit(False)).alias("_allowed"),
    )
    best = marked.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(
        F.max(F.when(F.col("_better"), F.struct("_row", "_allowed"))).alias("_best"),
        F.max(F.when(F.col("_allowed"), F.col("_row"))).alias("_other"),
    )
    picked = F.when(F.col("_best").isNull(), F.col("_other")).when(F.col("_best._allowed"), F.col("_best._row"))
    return best.select(picked.alias("_row")).where(F.col("_row").isNotNull()).select("_row.*").select(*df.columns)


def number_versions(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    version_col: str = "version",
    last_col: str = "is_last",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All versions with their ordinal (1 = oldest) and a flag on the newest."""
    return along_key(
        df, keys, order_by, {version_col: ordinal(), last_col: is_last()}, hot_rows=hot_rows
    )


def rank_with_gaps(
    df: DataFrame, keys: Sequence[str], order_col: str, rank_col: str = "rank"
) -> DataFrame:
    """SQL RANK per key: rows with equal ``order_col`` share a rank.

    Ranks the distinct values with their row counts, so a frequent value is
    one row by the time it reaches the window.
    """
    counts = df.groupBy(*keys, order_col).agg(F.count(F.lit(1)).alias("_n"))
    # cuts of the rows serve their counts as well, and finding them takes no second aggregation of all values
    upto = along_key(counts, keys, [order_col], {"_upto": running_sum("_n")}, cuts=find_cuts(df, keys, [order_col]))
    ranks = upto.select(
        *[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)],
        F.col(order_col).alias("_ro"),
        (F.col("_upto") - F.col("_n") + 1).alias(rank_col),
    )
    cond = F.col(order_col).eqNullSafe(F.col("_ro"))
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r{i}"))
    return df.join(ranks, cond, "left").select(*df.columns, rank_col)


def summary_row_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], first: bool, **take: str
) -> DataFrame:
    """Columns of the first or last row per key by plain aggregation (map-side combined)."""
    rank = F.struct(*order_by)
    pick = F.min_by if first else F.max_by
    return df.groupBy(*keys).agg(*[pick(src, rank).alias(out) for out, src in take.items()])
