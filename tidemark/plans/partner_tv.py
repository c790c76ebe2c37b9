"""Partner TV: which contracts have which service, month on month, and activations that came to nothing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sets import union_sources
from tidemark.plans.catalogue import features_of
from tidemark.sources.lake import Lake
from tidemark.sources.writers import roll_month

KEYS, VALUES = ["contract_id", "feature"], ["plan", "status", "suspended"]


def featured_contracts(contracts: DataFrame, patterns: Mapping[str, str], suspended: Sequence[str]) -> DataFrame:
    """One row per contract and service that its plan includes (contracts: contract_id, plan, status)."""
    plans = contracts.select("plan").distinct()
    found = contracts.join(features_of(plans, "plan", "plan", patterns), "plan")
    return found.select("contract_id", "feature", "plan", "status", F.col("status").isin(list(suspended)).cast("int").alias("suspended"))


def partner_tv_month(
    lake: Lake, place: tuple[str, str, str], contracts: DataFrame, patterns: Mapping[str, str], suspended: Sequence[str], month: Column
) -> int:
    """Store a month of services per contract, with what was gained, lost or changed since the last stored month."""
    return roll_month(lake, place, featured_contracts(contracts, patterns, suspended), KEYS, VALUES, "month", F.trunc(month, "MM"))


def failed_activations(providers: Mapping[str, DataFrame], states: Sequence[str], month: Column) -> DataFrame:
    """Subscribers of all providers that were created in the month, are not active and whose state is one of ``states``."""
    first = F.trunc(month, "MM")
    tagged = union_sources(providers, "provider")
    inside = (F.to_date("created") >= first) & (F.to_date("created") <= F.last_day(first))
    return tagged.where(~F.col("active") & F.col("state").isin(list(states)) & inside).withColumn("month", first)


def store_failed_activations(
    lake: Lake, place: tuple[str, str, str], providers: Mapping[str, DataFrame], states: Sequence[str], month: Column
) -> int:
    """The month's failed activations instead of those stored for it; earlier months stay."""
    return lake.replace_periods(failed_activations(providers, states, month), *place, "month")
