"""Aggregate indicators: projections, active base, tax allocation, payments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import bucketize
from tidemark.operators.aggregates import run_rate, sum_money
from tidemark.operators.joins import star_join


def tax_by_kind(
    lines: DataFrame, keys: Sequence[str], kind: str, tax: Column, scale: int, columns: Mapping[str, str]
) -> DataFrame:
    """Tax per key and kind, then one row per key with a column per kind and the total.

    ``tax`` is in whole units of 1/``scale``.
    """
    per_kind = lines.groupBy(*keys, kind).agg(F.sum(tax.cast("decimal(18,0)")).alias("_tax"))
    units = lambda c: F.sum(c).cast("double") / scale
    return per_kind.groupBy(*keys).agg(
        *[units(F.when(F.col(kind) == k, F.col("_tax"))).alias(n) for k, n in columns.items()],
        units(F.col("_tax")).alias("tax_total"),
    )


def _month_to_date(facts: DataFrame, ts: str, keys: Sequence[str], as_of: Column) -> DataFrame:
    stamp = F.col(ts)
    seen = (stamp >= F.trunc(as_of, "MM").cast("timestamp_ntz")) & (stamp < F.date_add(as_of, 1).cast("timestamp_ntz"))
    return facts.where(seen).groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("sold"))


def month_projection(facts: DataFrame, ts: str, keys: Sequence[str], as_of: Column) -> DataFrame:
    """Month to date and its extension to the month end at the same daily pace."""
    return _month_to_date(facts, ts, keys, as_of).withColumn("projected", run_rate(F.col("sold"), as_of))


def weighted_projection(
    facts: DataFrame, ts: str, keys: Sequence[str], as_of: Column, weights: DataFrame
) -> DataFrame:
    """Projection by daily sales weights (``day``, ``weight``): Sundays and holidays weigh less."""
    month = weights.where(F.trunc("day", "MM") == F.trunc(as_of, "MM"))
    total = month.agg(
        F.sum(F.when(F.col("day") <= as_of, F.col("weight"))).alias("gone"), F.sum("weight").alias("whole")
    )
    gone, whole = total.select("gone").scalar(), total.select("whole").scalar()
    return _month_to_date(facts, ts, keys, as_of).withColumn(
        "projected", F.try_divide(F.col("sold"), gone) * whole
    )


def is_active(at: Column) -> Column:
    """Activated by the day and not cancelled by it."""
    return (F.col("activated") <= at) & (F.col("cancelled").isNull() | (F.col("cancelled") > at))


def two_point_average(contracts: DataFrame, keys: Sequence[str], now: Column, before: Column) -> DataFrame:
    """Mean of the active base on two days, counted in one pass."""
    counted = contracts.groupBy(*keys).agg(
        F.count_if(is_active(now)).alias("base_now"), F.count_if(is_active(before)).alias("base_before")
    )
    return counted.withColumn("average_base", (F.col("base_now") + F.col("base_before")) / 2)


def first_last_payment(invoices: DataFrame, client: str, paid_on: str, amount: str) -> DataFrame:
    """First and last payment day per client with the amounts paid on those days."""
    paid = invoices.where(F.col(paid_on).isNotNull())
    daily = paid.groupBy(client, paid_on).agg(sum_money(amount).alias("_sum"))
    return daily.groupBy(client).agg(
        F.min(paid_on).alias("first_payment"),
        F.max(paid_on).alias("last_payment"),
        F.min_by("_sum", paid_on).alias("first_amount"),
        F.max_by("_sum", paid_on).alias("last_amount"),
    )


def active_base(contracts: DataFrame, clients: DataFrame, units: DataFrame, regions: DataFrame, as_of: Column) -> DataFrame:
    """Active contracts on a day by plan, unit, region and tenure.

    Dimensions: clients (client_id, unit_id), units (unit_id, unit, region_id), regions (region_id, region).

    Contracts are counted per client before the dimensions are joined.
    """
    age = F.datediff(as_of, F.col("activated"))
    tenure = bucketize(age, [90, 365], ["up to 3 months", "4 to 12 months", "over 12 months"])
    counted = (
        contracts.where(is_active(as_of))
        .groupBy("client_id", "plan", tenure.alias("tenure"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    wide = star_join(
        counted,
        [
            (clients, "client_id", "client_id", {"unit_id": "_n_key"}),
            (units, "_n_key", "unit_id", {"unit": "unit", "region_id": "_r_key"}),
            (regions, "_r_key", "region_id", {"region": "region"}),
        ],
    )
    return wide.groupBy(as_of.alias("ref"), "plan", "unit", "region", "tenure").agg(F.sum("_n").alias("active"))
