"""Write strategies as DataFrame functions: old table and new rows in, next table content out.

Nothing is updated in place; write the result as a new ``Lake`` version, or
only its changed periods with ``Lake.replace_periods``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_version
from tidemark.sources.lake import Lake, store


def new_rows(src: DataFrame, tgt: DataFrame, col: str, strict: bool = True, floor=None) -> DataFrame:
    """Source rows past the target's greatest value; an empty target means ``floor`` or everything."""
    mark = tgt.agg(F.max(col).alias("_m")).select("_m").scalar()
    if floor is not None:
        mark = F.coalesce(mark, F.lit(floor).cast(src.schema[col].dataType))
    past = F.col(col) > mark if strict else F.col(col) >= mark
    return src.where(past if floor is not None else (mark.isNull() | past))


def append_newer(
    src: DataFrame, tgt: DataFrame, col: str, strict: bool = True, floor=None, dedupe_keys: Sequence[str] = ()
) -> DataFrame:
    """Append rows above the watermark.

    With ``strict=False`` the rows at the watermark come again, as in a source
    that may still add rows to its last instant; ``dedupe_keys`` keeps them single.
    """
    fresh = new_rows(src, tgt, col, strict, floor)
    if dedupe_keys:
        fresh = fresh.join(tgt, list(dedupe_keys), "left_anti")
    return tgt.unionByName(fresh)


def append_missing(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append the source rows whose key the target does not hold yet."""
    return tgt.unionByName(src.join(tgt, list(keys), "left_anti"))


def merge_upsert(tgt: DataFrame, src: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()) -> DataFrame:
    """Source rows replace target rows of the same key.

    A source with several rows per key needs ``newest_by`` to say which one counts.
    """
    rows = latest_version(src, keys, newest_by) if newest_by else src
    return tgt.join(rows, list(keys), "left_anti").unionByName(rows)


def replace_by_key(tgt: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All target rows of the keys present in the source are replaced by the source rows."""
    return tgt.join(src.select(*keys).distinct(), list(keys), "left_anti").unionByName(src)


def carry_forward(
    current: DataFrame,
    previous: DataFrame,
    period_col: str,
    current_periods: Sequence,
    retain_days: int | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Newly computed periods plus the stored rows of all other periods.

    ``retain_days`` drops stored rows older than that many days before ``as_of``.
    """
    kept = previous.where(~F.col(period_col).isin(list(current_periods)))
    if retain_days is not None:
        kept = kept.where(F.col(period_col) >= F.date_sub(as_of, retain_days))
    return current.unionByName(kept)


def month_on_month(
    current: DataFrame, stored: DataFrame | None, keys: Sequence[str], values: Sequence[str], period: str, month: Column
) -> DataFrame:
    """A month's rows against the last stored month before it.

    Keys, ``period``, the values now and before (``previous_*``), and ``change``: GAINED, KEPT, CHANGED (some value
    differs) or LOST (stored for the month before, gone now).  ``current`` has the keys and values, one row per
    key, and ``stored`` is what earlier calls returned; it may hold the month itself or later ones, which don't count.
    """
    keys, values = list(keys), list(values)
    now = current.select(F.struct(*keys).alias("_key"), F.struct(*values).alias("_now"))
    if stored is None:
        both = now.withColumn("_then", F.lit(None).cast(now.schema["_now"].dataType))
    else:
        earlier = stored.where(F.col(period) < month)
        newest = earlier.agg(F.max(period)).scalar()
        there = earlier.where((F.col(period) == newest) & (F.col("change") != "LOST"))
        then = there.select(F.struct(*keys).alias("_old"), F.struct(*values).alias("_then"))
        joined = now.join(then, F.col("_key").eqNullSafe(F.col("_old")), "full")
        both = joined.select(F.coalesce("_key", "_old").alias("_key"), "_now", "_then")
    a, b = F.col("_now"), F.col("_then")
    change = (
        F.when(b.isNull(), "GAINED").when(a.isNull(), "LOST").when(a.eqNullSafe(b), "KEPT").otherwise("CHANGED").alias("change")
    )
    previous = [b.getField(v).alias(f"previous_{v}") for v in values]
    return both.select("_key.*", month.alias(period), *[a.getField(v).alias(v) for v in values], *previous, change)


def roll_month(
    lake: Lake, place: tuple[str, str, str], current: DataFrame, keys: Sequence[str], values: Sequence[str], period: str, month: Column
) -> int:
    """Add a month to a table that compares itself with its own last stored month (see ``month_on_month``).

    Only the month's partition is written.  Running it again for the same month leaves the same rows, since the month
    itself is not what it is compared with.
    """
    stored = lake.read(*place) if lake.exists(*place) else None
    return lake.replace_periods(month_on_month(current, stored, keys, values, period, month), *place, period)


def carry_under(
    lake: Lake, place: tuple[str, str, str], current: DataFrame, today: DataFrame, keys: Sequence[str], period: str, keep: Column
) -> int:
    """Replace the periods of ``current`` and drop stored rows of other periods that ``keep`` does not hold for any more.

    ``keep`` sees the stored row (its columns) and the row of ``today`` with its keys (struct ``today``, NULL without
    one).  Earlier periods are written again only where they lose rows; all others keep their files.
    """
    stored = lake.read(*place)
    facts = today.select(*[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)], F.struct("*").alias("today"))
    fresh = current.select(period).distinct()
    old = stored.join(fresh, period, "left_anti")
    judged = old
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & (F.col(k) == F.col(f"_t{i}"))
    judged = old.join(facts, match, "left").withColumn("_keep", F.coalesce(keep, F.lit(False)))
    losing = store(judged.where(~F.col("_keep")).select(period).distinct(), "losing-periods")
    kept = judged.where("_keep").select(*stored.columns).join(losing, period, "left_semi")
    return lake.replace_periods(kept.unionByName(current.select(*stored.columns)), *place, period, gone=losing)


def refresh_window(new: DataFrame, old: DataFrame, date_col: str, cutoff) -> DataFrame:
    """Rows from the cutoff on come from the rebuild, older ones from the stored table."""
    mark = F.lit(cutoff).cast("date")
    return new.where(F.col(date_col) >= mark).unionByName(old.where(F.col(date_col) < mark))


def refresh_open_rows(
    history: DataFrame, new: DataFrame, keys: Sequence[str], is_open: Column, columns: Sequence[str]
) -> DataFrame:
    """Stored rows that are still open take the new values; closed ones keep theirs; unseen keys are added."""
    keys = list(keys)
    fresh = new.select(*keys, F.struct(*columns).alias("_new"))
    open_rows = history.select("*", F.coalesce(is_open, F.lit(False)).alias("_open"))
    joined = open_rows.join(fresh, keys, "left")
    picked = [
        F.when(F.col("_open"), F.coalesce(F.col("_new").getField(c), F.col(c))).otherwise(F.col(c)).alias(c)
        if c in columns
        else F.col(c)
        for c in history.columns
    ]
    added = new.join(history, keys, "left_anti")
    return joined.select(*picked).unionByName(added, allowMissingColumns=True)


def scd2_snapshot(
    current: DataFrame, history: DataFrame, keys: Sequence[str], updated_at: str
) -> DataFrame:
    """Next content of a history table with ``valid_from`` / ``valid_to`` (NULL = in force).

    A current row newer than the open version of its key closes that version
    and opens one at its own update time.  Running it twice changes nothing.
    """
    keys = list(keys)
    data = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    open_now = history.where(F.col("valid_to").isNull()).select(
        *keys, F.col(updated_at).alias("_seen"), F.lit(True).alias("_known")
    )
    moved = current.join(open_now, keys, "left").where(
        F.col("_known").isNull() | (F.col(updated_at) > F.col("_seen"))
    )
    opened = moved.select(
        *data,
        F.col(updated_at).alias("valid_from"),
        F.lit(None).cast(history.schema["valid_to"].dataType).alias("valid_to"),
    )
    closing = moved.select(*keys, F.col(updated_at).alias("_until"))
    kept = history.join(closing, keys, "left").withColumn(
        "valid_to", F.when(F.col("valid_to").isNull(), F.col("_until")).otherwise(F.col("valid_to"))
    )
    return kept.select(*data, "valid_from", "valid_to").unionByName(opened)
