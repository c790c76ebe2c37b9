"""Cutting the rows of very frequent keys into ordered slices.

A window partitioned by a key puts all rows of that key in one task.  That is
fine for ordinary keys and fatal for a key that holds a third of the table.
``with_slices`` leaves ordinary keys whole (slice 0) and cuts the frequent ones
along their order, so a window over (key, slice) has bounded groups;
``along_key`` in ``ordered.py`` then stitches neighbouring slices together.

A slice that is still too large is cut again: along the same column, or, where
all its rows share one value of it (one day, one thread), along the next one.

The frequent keys are found by a pre-aggregated count that runs when the plan
is built, like the sampling job of a range partitioning.  What it finds are
tables under the session's shared folder: cuts never come back to the driver,
and every branch and every retried task cuts at the same places.
Results never depend on where the cuts are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.lake import store

SLICE = "_slice"

# A key is frequent above this many rows; slices aim at about this size.  The
# session setting spark.tidemark.hotRows overrides the default.
HOT_ROWS = 1_000_000
HOT_ROWS_SETTING = "spark.tidemark.hotRows"
# Quantile cuts of a slice that is too large, at most.
QUANTILES = 64
# Rows of a part where a step says itself in how many parts it works; the session setting
# spark.tidemark.partRows overrides the default.
PART_ROWS = 500_000
PART_ROWS_SETTING = "spark.tidemark.partRows"
# Slices of one cutting and the cuttings that fit in the number of a slice.
_SLOTS, _LEVELS = 256, 7


def same_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """NULL-safe equality of the paired columns (window partitions group NULLs too)."""
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def as_number(df: DataFrame, name: str) -> Column:
    """The order column as a double, keeping its order; texts by their first six bytes."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        # by its parts: going through a time zone could swap values around a clock change
        seconds = F.unix_date(F.to_date(col)) * 86400.0 + F.hour(col) * 3600 + F.minute(col) * 60
        return seconds + F.date_part(F.lit("SECOND"), col).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    if isinstance(kind, T.StringType):
        front = F.rpad(F.hex(F.substring(col.cast("binary"), 1, 6)), 12, "0")
        return F.conv(front, 16, 10).cast("double")
    raise TypeError(f"order column {name} must be numeric, date, timestamp or text, not {kind}")


def _can_order(df: DataFrame, name: str) -> bool:
    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType, T.NumericType, T.StringType)
    return isinstance(df.schema[name].dataType, kinds)


def parts_for(rows: int) -> int:
    """In how many parts so many rows are worked on: the number follows the rows, so a part does not grow with them."""
    most = int(SparkSession.active().conf.get(PART_ROWS_SETTING, str(PART_ROWS)))
    return max(1, -(-rows // most))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows as a stored table (_h0.., _rows); None without any."""
    named = [F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)]
    found = df.groupBy(*named).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    return store(found, "hot-keys") if found.count() else None


@dataclass(frozen=True)
class Cuts:
    """Where to cut frequent keys: one table and order column for each cutting; none when no key is frequent."""

    levels: tuple[tuple[DataFrame, str], ...] = ()

    @property
    def table(self) -> DataFrame | None:
        return self.levels[0][0] if self.levels else None


def find_cuts(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], hot_rows: int = HOT_ROWS) -> Cuts:
    """Per frequent key its quantile cuts along ``order``, and those of slices that stay too large.

    Cuts found once serve every later step over the same keys and order.  A slice of up to twice ``hot_rows``
    stays as it is; so does one whose rows the order columns can't tell apart as numbers.
    """
    if hot_rows == HOT_ROWS:
        hot_rows = int(df.sparkSession.conf.get(HOT_ROWS_SETTING, str(HOT_ROWS)))
    columns = [order] if isinstance(order, str) else list(order)
    columns = columns[: next((i for i, c in enumerate(columns) if not _can_order(df, c)), len(columns))]
    hot = hot_keys(df, keys, hot_rows) if columns else None
    if hot is None:
        return Cuts()
    named = [f"_h{i}" for i in range(len(keys))]
    pairs = list(zip(keys, named))
    # only the rows of frequent keys are looked at again
    rows = df.select(*[F.col(k).alias(h) for k, h in pairs], *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    rows = rows.select("*", *[as_number(rows, f"_c{i}").alias(f"_o{i}") for i in range(len(columns))])
    large = hot.select(*named, F.lit(0).cast("long").alias(SLICE), "_rows", F.lit(0).alias("_at"))
    laid = rows.withColumn(SLICE, F.lit(0).cast("long"))
    levels: list[tuple[DataFrame, str]] = []
    while len(levels) < _LEVELS:
        for i, column in enumerate(columns):
            here = large.where(F.col("_at") == i)
            if len(levels) == _LEVELS or here.isEmpty():
                continue
            levels.append((store(_quantiles(laid, here, named, f"_o{i}", hot_rows), "cuts"), column))
            laid = _cut(laid, levels[-1][0], named, F.col(f"_o{i}"))
        large = _too_large(laid, hot, named, len(columns), hot_rows)
        if large is None:
            break
    return Cuts(tuple(levels))


def _quantiles(laid: DataFrame, large: DataFrame, named: Sequence[str], number: str, hot_rows: int) -> DataFrame:
    """The cuts of each slice that is too large: so many quantiles of its rows that each holds less than ``hot_rows``."""
    own = [*named, SLICE]
    at = F.array(*[F.lit(i / QUANTILES) for i in range(QUANTILES + 1)])
    renamed = large.select(*[F.col(c).alias(f"_l{c}") for c in own], "_rows")
    every = laid.join(renamed, same_keys(laid, renamed, [(c, f"_l{c}") for c in own])).groupBy(*own, "_rows").agg(
        F.percentile_approx(number, at).alias("_every")
    )
    wanted = F.least(F.ceil(F.col("_rows") * 1.5 / hot_rows), F.lit(QUANTILES))
    step = lambda i: F.get("_every", F.floor(i * QUANTILES / wanted).cast("int"))
    cuts = F.transform(F.sequence(F.lit(0).cast("long"), wanted), step).alias("_cuts")
    return every.select(*[F.col(c).alias(f"_q{c}") for c in own], F.coalesce(cuts, F.array().cast("array<double>")).alias("_cuts"))


def _cut(df: DataFrame, cuts: DataFrame, keys: Sequence[str], number: Column) -> DataFrame:
    """The slices after one more cutting, numbered in order: below a cut, on a repeated cut, above it."""
    pairs = [(k, f"_q_h{i}") for i, k in enumerate(keys)] + [(SLICE, f"_q{SLICE}")]
    wide = df.join(cuts, same_keys(df, cuts, pairs), "left").withColumn("_num", number)
    less = F.size(F.filter("_cuts", lambda c: c < F.col("_num")))
    upto = F.size(F.filter("_cuts", lambda c: c <= F.col("_num")))
    # a value that fills whole quantiles is a cut several times over and gets a slice of its own
    slot = F.when(upto - less >= 2, 2 * less + 1).otherwise(2 * upto)
    deeper = F.col(SLICE) * _SLOTS + F.when(F.col("_num").isNull(), 0).otherwise(slot)
    cut = F.when(F.col("_cuts").isNotNull(), deeper).otherwise(F.col(SLICE) * _SLOTS)
    return wide.withColumn(SLICE, cut).drop("_cuts", "_num", *[b for _, b in pairs])


def _too_large(laid: DataFrame, hot: DataFrame, named: Sequence[str], columns: int, hot_rows: int) -> DataFrame | None:
    """Slices of more than twice ``hot_rows`` rows and the first column that differs inside; None without any."""
    only = hot.select(*[F.col(h).alias(f"_f{h}") for h in named])
    inside = laid.join(only, same_keys(laid, only, [(h, f"_f{h}") for h in named]), "left_semi")
    facts = [
        f(F.struct(F.col(f"_{kind}{i}"))).alias(f"_{name}_{kind}{i}")
        for i in range(columns) for kind in ("c", "o") for name, f in (("min", F.min), ("max", F.max))
    ]
    sizes = inside.groupBy(*named, SLICE).agg(F.count(F.lit(1)).alias("_rows"), *facts).where(F.col("_rows") > 2 * hot_rows)
    differs = lambda kind, i: ~F.col(f"_min_{kind}{i}").eqNullSafe(F.col(f"_max_{kind}{i}"))
    at = F
    for i in range(columns):
        # values that differ but have one number can't be cut, and no later column may be cut before them
        at = at.when(differs("c", i), F.when(differs("o", i), F.lit(i)))
    found = sizes.select(*named, SLICE, "_rows", at.otherwise(None).cast("int").alias("_at")).where("_at is not null")
    return store(found, "large-slices") if found.count() else None


def with_slices(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], found: Cuts) -> DataFrame | None:
    """Add ``_slice``: 0 for ordinary keys, ascending along ``order`` for frequent ones.

    None when no key is frequent, so that callers use a plain window.
    """
    if not found.levels:
        return None
    laid = df.withColumn(SLICE, F.lit(0).cast("long"))
    for cuts, column in found.levels:
        laid = _cut(laid, cuts, keys, as_number(df, column))
    # frequent keys start at 1: their first slice may have number 0 so far
    first = found.levels[0][0].select(*[F.col(f"_q_h{i}").alias(f"_f{i}") for i in range(len(keys))]).withColumn("_hot", F.lit(1))
    marked = laid.join(first, same_keys(laid, first, [(k, f"_f{i}") for i, k in enumerate(keys)]), "left")
    number = F.when(F.col("_hot") == 1, F.col(SLICE) + 1).otherwise(0)
    return marked.withColumn(SLICE, number).drop("_hot", *[f"_f{i}" for i in range(len(keys))])
