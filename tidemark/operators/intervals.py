"""Intervals against cycles, calendars and each other, by running totals.

The sum of clipped lengths of many intervals inside a cycle is the difference
of one piecewise-linear function at the two cycle ends, and that function only
needs running totals of interval starts and ends.  No interval is ever paired
with a cycle, so a key with very many of both costs no more than its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import Step, along_key, lag, lead, running_sum
from tidemark.operators.skew import HOT_ROWS


def clipped_length(start, end, cycle_start, cycle_end) -> Column:
    """Days of one interval inside one cycle, by the rule of ``clipped_days``."""
    after = F.date_add(cycle_end, 1)
    low, high = F.greatest(start, cycle_start), F.least(F.coalesce(F.col(end), after), after)
    return F.greatest(F.datediff(high, low), F.lit(0)).cast("bigint")


def clipped_days(
    intervals: DataFrame,
    cycles: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    cycle_start: str,
    cycle_end: str,
    out: str = "days",
) -> DataFrame:
    """Days of each (key, cycle) covered by the key's intervals, summed.

    Intervals run from their start day up to but not including their end day;
    an interval without an end is still open.  The cycle end day is included.
    So a suspension lifted inside the cycle does not count the day it was
    lifted, and one still open at the cycle end counts that day.  Intervals
    without a start or key, or that end before they start, cover nothing.
    """
    keys = list(keys)
    usable = F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start)))
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    marks = intervals.where(usable).select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col(start).alias("_day"), F.lit(1).alias("_w")),
                F.struct(F.col(end).alias("_day"), F.lit(-1).alias("_w")),
            )
        ).alias("_m"),
    ).select(*keys, "_m.*")
    number = F.unix_date("_day").cast("long")
    daily = (
        marks.where(F.col("_day").isNotNull())
        .groupBy(*keys, "_day")
        .agg(F.sum("_w").cast("long").alias("_open"))
        .select(*keys, "_day", F.lit(0).alias("_side"), "_open", (F.col("_open") * number).alias("_moment"))
    )
    cyc = cycles.select(*keys, cycle_start, cycle_end).distinct()
    asked = cyc.select(
        *keys,
        cycle_start,
        cycle_end,
        F.explode(
            F.array(
                F.struct(F.col(cycle_start).alias("_day"), F.lit(1).alias("_side"), F.lit(-1).alias("_sign")),
                F.struct(F.date_add(cycle_end, 1).alias("_day"), F.lit(1).alias("_side"), F.lit(1).alias("_sign")),
            )
        ).alias("_p"),
    ).select(*keys, cycle_start, cycle_end, "_p.*")
    line = daily.unionByName(asked, allowMissingColumns=True)
    totals = along_key(
        line,
        keys,
        ["_day", "_side", cycle_start, cycle_end, "_sign"],
        {"_n": running_sum("_open"), "_s": running_sum("_moment")},
        hot_rows=None,  # one row per key and day, plus two per cycle
    )
    covered = number * F.col("_n") - F.col("_s")
    return (
        totals.where(F.col("_side") == 1)
        .groupBy(*keys, cycle_start, cycle_end)
        .agg(F.coalesce(F.sum(F.col("_sign") * covered), F.lit(0)).alias(out))
    )


def overlap_totals(
    spans: DataFrame,
    cycles: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    value: str,
    cycle_start: str,
    cycle_end: str,
    count_col: str = "overlapping",
    sum_col: str = "overlapping_value",
    open_end: bool = False,
) -> DataFrame:
    """Per (key, cycle): how many spans touch the cycle and the sum of their value.

    Spans and cycles include both end days.  Spans touching a cycle are those
    started by its end minus those ended before its start.  Spans without a key
    or an end, or that end before they start, touch nothing; with ``open_end``
    one without an end goes on.
    """
    keys = list(keys)
    usable = F.col(start) <= F.col(end)
    if open_end:
        usable = usable | (F.col(start).isNotNull() & F.col(end).isNull())
    for key in keys:
        usable = usable & F.col(key).isNotNull()
    marks = spans.where(usable).select(
        *keys,
        F.col(value).alias("_v"),
        F.explode(
            F.array(
                F.struct(F.col(start).alias("_day"), F.lit(True).alias("_begins")),
                F.struct(F.date_add(end, 1).alias("_day"), F.lit(False).alias("_begins")),
            )
        ).alias("_m"),
    ).select(*keys, "_v", "_m.*")
    begins, none = F.col("_begins"), F.lit(0)
    daily = (
        marks.where(F.col("_day").isNotNull())
        .groupBy(*keys, "_day")
        .agg(
            F.count_if(begins).alias("_bn"),
            F.count_if(~begins).alias("_gn"),
            F.sum(F.when(begins, F.col("_v")).otherwise(none)).alias("_bv"),
            F.sum(F.when(begins, none).otherwise(F.col("_v"))).alias("_gv"),
        )
        .withColumn("_side", F.lit(0))
    )
    cyc = cycles.select(*keys, cycle_start, cycle_end).distinct()
    asked = cyc.select(
        *keys,
        cycle_start,
        cycle_end,
        F.explode(F.array(F.struct(F.col(cycle_start).alias("_day"), F.lit(1).alias("_side")),
                          F.struct(F.col(cycle_end).alias("_day"), F.lit(2).alias("_side")))).alias("_p"),
    ).select(*keys, cycle_start, cycle_end, "_p.*")
    line = daily.unionByName(asked, allowMissingColumns=True)
    totals = along_key(
        line,
        keys,
        ["_day", "_side", cycle_start, cycle_end],
        {f"_r{c}": running_sum(c) for c in ("_bn", "_bv", "_gn", "_gv")},
        hot_rows=None,  # one row per key and day, plus two per cycle
    )
    at_end, at_start = F.col("_side") == 2, F.col("_side") == 1
    return (
        totals.where(F.col("_side") > 0)
        .groupBy(*keys, cycle_start, cycle_end)
        .agg(
            F.coalesce(F.max(F.when(at_end, F.col("_r_bn"))) - F.max(F.when(at_start, F.col("_r_gn"))), F.lit(0)).alias(count_col),
            F.coalesce(F.max(F.when(at_end, F.col("_r_bv"))) - F.max(F.when(at_start, F.col("_r_gv"))), F.lit(0)).alias(sum_col),
        )
    )


def business_seconds(
    df: DataFrame, start: str, end: str, calendar: DataFrame, day: str, is_open: str, out: str = "business_seconds"
) -> DataFrame:
    """Seconds between two times that fall on working days.

    ``calendar`` has one row per day (a few thousand rows), which is what makes
    its single running total safe; the joins with it are Catalyst's to plan.
    Only days of the calendar count: time before its first or past its last day,
    or on a day it leaves out, is no working time.
    """
    known = calendar.groupBy(F.col(day).alias("_day")).agg(F.max(F.col(is_open).cast("int")).alias("_open"))
    ends = known.agg(F.min("_day").alias("_first"), F.max("_day").alias("_last"))
    days = ends.where("_first is not null").select(F.explode(F.sequence("_first", "_last")).alias("_day"))
    by_day = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    cal = days.join(known, "_day", "left").select(
        "_day",
        F.coalesce("_open", F.lit(0)).alias("_open"),
        F.coalesce(F.sum("_open").over(by_day), F.lit(0)).alias("_before"),
    )
    first, last = ends.select("_first").scalar(), ends.select("_last").scalar()
    total = F.coalesce(known.agg(F.sum("_open")).scalar(), F.lit(0)) * 86400

    def clock(frame: DataFrame, ts: str, name: str) -> DataFrame:
        c = cal.select(F.col("_day").alias("_d"), F.col("_open").alias("_o"), F.col("_before").alias("_b"))
        joined = frame.join(c, F.to_date(frame[ts]) == c["_d"], "left")
        into = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts))
        inside = F.col("_b") * 86400 + F.col("_o") * into
        on = F.to_date(F.col(ts))
        at = F.coalesce(inside, F.when(on < first, 0).when(on > last, total))
        return joined.withColumn(name, at).drop("_d", "_o", "_b")

    both = clock(clock(df, start, "_from"), end, "_to")
    return both.withColumn(out, (F.col("_to") - F.col("_from")).cast("bigint")).drop("_from", "_to")


def status_intervals(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    row_id: str,
    opens: Column,
    closes: Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Intervals opened by an event and closed by the very next event of the key.

    One row per opening event; the close columns stay NULL unless the next
    event of the key is a closing one.
    """
    nxt = F.struct(F.col(ts).alias("at"), F.col(row_id).alias("id"), closes.alias("closes"))
    marked = df.select(*keys, ts, row_id, opens.alias("_opens"), nxt.alias("_this"))
    seq = along_key(marked, keys, [ts, row_id], {"_next": lead("_this")}, hot_rows=hot_rows)
    closed = F.when(F.col("_next.closes"), F.col("_next"))
    return seq.where("_opens").select(
        *keys,
        F.col(ts).alias("opened_at"),
        closed.getField("at").alias("closed_at"),
        F.col(row_id).alias("open_event"),
        closed.getField("id").alias("close_event"),
    )


def repeats_within(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    row_id: str,
    hours: int,
    out: str = "is_repeat",
    look: str = "ahead",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add 1/0: does the key return within ``hours`` (ahead), or came back within them (behind)?"""
    step: Step = lead(ts) if look == "ahead" else lag(ts)
    seq = along_key(df, keys, [ts, row_id], {"_other": step}, hot_rows=hot_rows)
    gap = F.unix_micros(F.col("_other").cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))
    near = F.abs(gap) <= hours * 3_600_000_000
    return seq.withColumn(out, F.coalesce(near, F.lit(False)).cast("int")).drop("_other")


def handover_intervals(
    df: DataFrame, keys: Sequence[str], ts: str, row_id: str, seconds: str = "held_seconds", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the previous time of the key (own time on the first row) and the seconds since."""
    seq = along_key(df, keys, [ts, row_id], {"_prev": lag(ts)}, hot_rows=hot_rows)
    began = F.coalesce(F.col("_prev"), F.col(ts))
    return seq.withColumn("held_from", began).withColumn(
        seconds,
        F.unix_seconds(F.col(ts).cast("timestamp")) - F.unix_seconds(F.col("held_from").cast("timestamp")),
    ).drop("_prev")


def range_violations(
    df: DataFrame,
    keys: Sequence[str],
    lower: str,
    upper: str,
    gaps: str = "allowed",
    zero_length: bool = False,
    tiebreak: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Ranges of a key that overlap the next one or break the gap rule (see checks)."""
    seq = along_key(df, keys, [lower, upper, *tiebreak], {"_next": lead(lower)}, hot_rows=hot_rows)
    c, n = F.col(upper), F.col("_next")
    rule = {"allowed": c <= n, "not_allowed": c == n, "required": c < n}[gaps]
    ordered_ok = (F.col(lower) <= c) if zero_length else (F.col(lower) < c)
    good = F.coalesce(ordered_ok, F.lit(False)) & F.coalesce(rule, n.isNull())
    return seq.where(~good).drop("_next")
