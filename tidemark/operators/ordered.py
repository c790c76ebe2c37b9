"""Order-dependent values along a key, safe when one key holds most of the rows.

``along_key`` computes lag, lead, ordinals, first/last values and running sums
inside (key, slice) windows and repairs the slice borders from a small table
with one row per slice.  For keys that are not frequent it is a plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import HOT_ROWS, SLICE, Cuts, find_cuts, same_keys, with_slices


@dataclass(frozen=True)
class Step:
    kind: str
    column: str | None = None


def lag(column: str) -> Step:
    """Value of the previous row of the key."""
    return Step("lag", column)


def lead(column: str) -> Step:
    """Value of the next row of the key."""
    return Step("lead", column)


def ordinal() -> Step:
    """1, 2, 3 ... along the key."""
    return Step("ordinal")


def is_last() -> Step:
    """True on the last row of the key."""
    return Step("is_last")


def first_value(column: str) -> Step:
    """Value of the key's first row (NULL if that row holds NULL)."""
    return Step("first", column)


def last_seen(column: str) -> Step:
    """Latest non-NULL value up to and including this row."""
    return Step("last_seen", column)


def running_sum(column: str) -> Step:
    """Sum up to and including this row; NULLs count as 0."""
    return Step("running_sum", column)


def running_max(column: str) -> Step:
    """Maximum up to and including this row."""
    return Step("running_max", column)


def group_count() -> Step:
    """Number of rows of the key."""
    return Step("count")


def _inside(step: Step, ordered, so_far, whole) -> Column:
    c = F.col(step.column) if step.column else None
    if step.kind == "lag":
        return F.lag(F.struct(c)).over(ordered)
    if step.kind == "lead":
        return F.lead(F.struct(c)).over(ordered)
    if step.kind == "ordinal":
        return F.row_number().over(ordered).cast("long")
    if step.kind == "is_last":
        return F.lead(F.lit(True)).over(ordered).isNull()
    if step.kind == "first":
        return F.first(F.struct(c)).over(so_far)
    if step.kind == "last_seen":
        return F.last(c, ignorenulls=True).over(so_far)
    if step.kind == "running_sum":
        return F.sum(F.coalesce(c, F.lit(0))).over(so_far)
    if step.kind == "running_max":
        return F.max(c).over(so_far)
    if step.kind == "count":
        return F.count(F.lit(1)).over(whole)
    raise ValueError(step.kind)


def _summary(step: Step, rank: Column, descending: bool) -> Column:
    """What a slice must tell its neighbours."""
    head, tail = (F.max_by, F.min_by) if descending else (F.min_by, F.max_by)
    c = F.col(step.column) if step.column else None
    if step.kind == "lag":
        return tail(F.struct(c), rank)
    if step.kind in ("lead", "first"):
        return head(F.struct(c), rank)
    if step.kind == "last_seen":
        return tail(c, F.when(c.isNotNull(), rank))
    if step.kind == "running_sum":
        return F.sum(F.coalesce(c, F.lit(0)))
    if step.kind == "running_max":
        return F.max(c)
    return F.count(F.lit(1))


def _from_neighbours(step: Step, value: Column, slices, before, whole) -> Column:
    if step.kind == "lag":
        return F.lag(value).over(slices)
    if step.kind in ("lead", "is_last"):
        return F.lead(value).over(slices)
    if step.kind == "first":
        return F.first(value).over(before)
    if step.kind == "last_seen":
        return F.last(value, ignorenulls=True).over(before)
    if step.kind in ("running_sum", "ordinal"):
        return F.sum(value).over(before)
    if step.kind == "running_max":
        return F.max(value).over(before)
    return F.sum(value).over(whole)


def _stitch(step: Step, inside: Column, outside: Column) -> Column:
    if step.kind in ("lag", "lead", "last_seen"):
        return F.coalesce(inside, outside)
    if step.kind == "first":
        return F.coalesce(outside, inside)
    if step.kind in ("running_sum", "ordinal"):
        return inside + F.coalesce(outside, F.lit(0))
    if step.kind == "running_max":
        return F.greatest(inside, outside)
    if step.kind == "is_last":
        return inside & outside.isNull()
    return F.coalesce(outside, inside)


def _unpack(step: Step, value: Column) -> Column:
    return value.getField(step.column) if step.kind in ("lag", "lead", "first") else value


def along_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    steps: Mapping[str, Step],
    *,
    descending: bool = False,
    hot_rows: int | None = HOT_ROWS,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Add one column per step, computed along ``order_by`` inside each key.

    ``order_by`` must be total inside a key (end it with a unique column) and
    start with a numeric, date, timestamp or text column.  NULL order values
    sort first, or last when ``descending``.  Pass ``hot_rows=None`` only where
    the rows per key are bounded anyway (one row per key and day); pass ``cuts``
    found before for the same keys and order to save the counting pass.
    """
    keys = list(keys)
    if cuts is None and hot_rows is not None:
        cuts = find_cuts(df, keys, order_by, hot_rows)
    laid = None if cuts is None else with_slices(df, keys, order_by, cuts)
    group = keys if laid is None else [*keys, SLICE]
    direction = [F.col(c).desc() if descending else F.col(c).asc() for c in order_by]
    whole = Window.partitionBy(*group)
    ordered = whole.orderBy(*direction)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = {n: _inside(s, ordered, so_far, whole) for n, s in steps.items()}
    kept = [F.col(c) for c in df.columns if c not in steps]
    if laid is None:
        plain = df.select("*", *[c.alias(f"_in_{n}") for n, c in within.items()])
        return plain.select(*kept, *[_unpack(s, F.col(f"_in_{n}")).alias(n) for n, s in steps.items()])

    inside = laid.select("*", *[c.alias(f"_in_{n}") for n, c in within.items()])
    rank = F.struct(*order_by)
    all_slices = Window.partitionBy(*keys)
    slices = all_slices.orderBy(F.col(SLICE).desc() if descending else F.col(SLICE).asc())
    before = slices.rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        laid.where(F.col(SLICE) > 0)
        .groupBy(*keys, SLICE)
        .agg(*[_summary(s, rank, descending).alias(f"_sum_{n}") for n, s in steps.items()])
        .select(
            *[F.col(k).alias(f"_e{i}") for i, k in enumerate(keys)],
            F.col(SLICE).alias("_e_slice"),
            *[
                _from_neighbours(s, F.col(f"_sum_{n}"), slices, before, all_slices).alias(f"_out_{n}")
                for n, s in steps.items()
            ],
        )
    )
    pairs = [(k, f"_e{i}") for i, k in enumerate(keys)] + [(SLICE, "_e_slice")]
    joined = inside.join(edges, same_keys(inside, edges, pairs), "left")
    return joined.select(
        *kept,
        *[_unpack(s, _stitch(s, F.col(f"_in_{n}"), F.col(f"_out_{n}"))).alias(n) for n, s in steps.items()],
    )
