"""Billing: monthly base, class waterfall, past months, events, discounts, pro rata, fiscal parts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day_in_month, days_between
from tidemark.functions.text import rule_ladder
from tidemark.operators.aggregates import cents, exact_sum, pivot_max, sum_money
from tidemark.operators.intervals import clipped_length
from tidemark.operators.joins import newest_inside
from tidemark.operators.latest import dedupe_by_priority, latest_version
from tidemark.operators.sets import lowest_rank


# How item lists write fines, and the names of the fines.
EQUIPMENT_ITEM, LOYALTY_TYPE = "%REPOS%", "MULTA DE FIDELIDADE"
EQUIPMENT_FINE, LOYALTY_FINE, BOTH_FINES = "Equipamento", "Fidelidade", "Equipamento e Fidelidade"


def migration_way(old_value: str = "old_value", new_value: str = "new_value") -> Column:
    """Whether a plan change went up or down."""
    old, new = F.col(old_value), F.col(new_value)
    return rule_ladder([(new > old, "UP"), (new < old, "DOWN"), (new == old, "SAME")])


def invoice_fines(items: DataFrame) -> DataFrame:
    """Kind and value of the fines per invoice, out of its items (invoice_id, item_type, item_name, price)."""
    equipment, loyalty = F.upper("item_name").like(EQUIPMENT_ITEM), F.upper("item_type") == LOYALTY_TYPE
    either = F.coalesce(equipment, F.lit(False)) | F.coalesce(loyalty, F.lit(False))
    found = items.where(either).groupBy("invoice_id").agg(
        F.bool_or(F.coalesce(equipment, F.lit(False))).alias("_e"), F.bool_or(F.coalesce(loyalty, F.lit(False))).alias("_l"),
        sum_money("price").alias("fine_value"),
    )
    kind = rule_ladder([(F.col("_e") & F.col("_l"), BOTH_FINES), (F.col("_e"), EQUIPMENT_FINE)], LOYALTY_FINE)
    return found.select("invoice_id", kind.alias("fine"), "fine_value")


def billing_base(
    invoices: DataFrame,
    contracts: DataFrame,
    suspensions: DataFrame,
    lines: DataFrame,
    migrations: DataFrame,
    items: DataFrame,
    month: Column,
) -> DataFrame:
    """Invoices of a month with cycle, last migration, discounts, suspended days, extra services, fines and net value.

    A contract's cycle ends on its ``closing_day`` of the month (the last day of
    a shorter month) and starts the day after the one before.  Contracts active
    at the cycle end or cancelled inside the cycle take part.  ``suspensions``
    (end day not included) are day spans per contract.  ``lines`` are what a contract
    was sold: ``percent`` is a discount from ``begun`` to ``ended``, ``price`` an extra service
    of the day ``begun``; either may be NULL.  Every contract has one cycle, so spans and lines meet
    at most one cycle row and are summed right after that join, discounts and extras in one pass.
    ``migrations`` (contract_id, migration_id, day, old_value, new_value, accepted) give the newest
    accepted one inside the cycle; ``items`` are the lines of the invoices (see ``invoice_fines``).
    """
    first, last = F.trunc(month, "MM"), F.last_day(month)
    earliest = F.add_months(first, -1)  # no cycle of this month starts before
    ends = day_in_month(first, "closing_day")
    starts = F.date_add(day_in_month(F.add_months(first, -1), "closing_day"), 1)
    cycles = (
        contracts.select("contract_id", "unit_id", "activated", "cancelled", starts.alias("cycle_start"), ends.alias("cycle_end"))
        .where((F.col("activated") <= F.col("cycle_end")) & (F.col("cancelled").isNull() | (F.col("cancelled") >= F.col("cycle_start"))))
        .withColumn(
            "contract_status",
            F.when(F.col("cancelled") <= F.col("cycle_end"), "CANCELLED").otherwise("ACTIVE"),
        )
    )
    window = cycles.select("contract_id", "cycle_start", "cycle_end")
    stopped = (
        suspensions.where((F.col("begun") <= last) & (F.col("ended").isNull() | (F.col("ended") > earliest)))
        .join(window, "contract_id")
        .groupBy("contract_id")
        .agg(F.sum(clipped_length("begun", "ended", "cycle_start", "cycle_end")).alias("_suspended"))
    )
    runs = F.col("percent").isNotNull() & (F.col("begun") <= F.col("cycle_end")) & (F.col("ended") >= F.col("cycle_start"))
    sold = F.col("price").isNotNull() & F.col("begun").between(F.col("cycle_start"), F.col("cycle_end"))
    touched = (
        lines.where((F.col("begun") <= last) & ((F.col("ended") >= earliest) | (F.col("begun") >= earliest)))
        .join(window, "contract_id")
        .groupBy("contract_id")
        .agg(
            F.count_if(runs).alias("_discounts"),
            F.sum(F.when(runs, F.col("percent"))).cast("double").alias("_percent"),
            F.count_if(sold).alias("_extras"),
            sum_money("price", sold).alias("_extra_value"),
        )
    )
    accepted = migrations.where(F.col("accepted") & (F.col("day") >= earliest) & (F.col("day") <= last))
    take = {"migration_id": "migration_id", "day": "migrated_on", "old_value": "_old", "new_value": "_new"}
    facts = newest_inside(cycles, accepted, ["contract_id"], "cycle_start", "cycle_end", "day", "migration_id", take)
    for part in (stopped, touched):
        facts = facts.join(part, "contract_id", "left")
    billed = invoices.where((F.col("issued") >= first) & (F.col("issued") <= last))
    fines = invoice_fines(items.join(billed.select("invoice_id"), "invoice_id", "left_semi"))
    days = days_between("cycle_start", "cycle_end") + 1
    none = F.lit(0).cast("bigint")
    wide = billed.join(facts, "contract_id").join(fines, "invoice_id", "left").select(
        "invoice_id", "contract_id", "unit_id", "contract_status", "kind", "amount", "issued",
        "cycle_start", "cycle_end",
        days.alias("cycle_days"),
        F.least(F.coalesce("_suspended", none), days).alias("suspended_days"),
        F.coalesce("_discounts", none).alias("discounts"),
        F.least(F.coalesce("_percent", F.lit(0.0)), F.lit(100.0)).alias("discount_percent"),
        F.coalesce("_extras", none).alias("extra_services"),
        F.coalesce("_extra_value", F.lit(0.0)).alias("extra_value"),
        "migration_id", "migrated_on", migration_way("_old", "_new").alias("migration"),
        "fine", F.coalesce("fine_value", F.lit(0.0)).alias("fine_value"),
    )
    kept = F.col("amount") * (F.col("cycle_days") - F.col("suspended_days")) / F.col("cycle_days")
    return wide.withColumn("net_value", kept * (1 - F.col("discount_percent") / 100) + F.col("extra_value"))


def billing_tree(invoices: DataFrame, classes: Sequence[str]) -> DataFrame:
    """One invoice per contract: the first class in the list that it was billed in, oldest invoice first."""
    known = invoices.where(F.col("kind").isin(list(classes)))
    rank = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("kind"))
    return dedupe_by_priority(known, ["contract_id"], rank, [F.asc("due"), F.asc("invoice_id")])


def past_months(invoices: DataFrame, suspended: DataFrame, month: Column) -> DataFrame:
    """Open invoices of suspended contracts from the newest earlier month that has any: M-1, M-2, M-3, older."""
    first = F.trunc(month, "MM")
    held = invoices.where(F.col("paid_on").isNull() & (F.col("issued") < first)).join(
        suspended.select("contract_id").distinct(), "contract_id", "left_semi"
    )
    months = F.months_between(first, F.trunc("issued", "MM")).cast("int")
    return lowest_rank(held.withColumn("months_ago", F.least(months, F.lit(4))), ["contract_id"], "months_ago")


def month_events(events: DataFrame, kinds: Mapping[str, str], month: Column) -> DataFrame:
    """Counts and values per contract of each kind of event in a month, one column pair per kind."""
    inside = events.where((F.col("day") >= F.trunc(month, "MM")) & (F.col("day") <= F.last_day(month)))
    aggs = []
    for kind, name in kinds.items():
        hit = F.col("kind") == kind
        aggs += [F.count_if(hit).alias(f"{name}_count"), sum_money("value", hit).alias(f"{name}_value")]
    return inside.groupBy("contract_id").agg(*aggs)


def discounts_expiring(discounts: DataFrame, as_of: Column, categories: Mapping[str, str], months: int = 6) -> DataFrame:
    """Discounts that end within the coming months: last end day per contract and category.

    A discount removed by hand ends on the removal day, else on its own last day.
    """
    ends = F.coalesce(F.col("removed"), F.col("ended"))
    soon = discounts.withColumn("_end", ends).where(
        (F.col("_end") >= as_of) & (F.col("_end") <= F.add_months(as_of, months))
    )
    names = {k: f"{v}_until" for k, v in categories.items()}
    return pivot_max(soon, ["contract_id"], "category", "_end", names)


def prorata_billing(contracts: DataFrame, month: Column) -> DataFrame:
    """Billed in full, pro rata (activated or cancelled inside the month) or not at all."""
    first, last = F.trunc(month, "MM"), F.last_day(month)
    start = F.greatest("activated", first)
    end = F.least(F.coalesce(F.date_sub("cancelled", 1), last), last)
    days = F.greatest(days_between(start, end) + 1, F.lit(0).cast("bigint"))
    whole = days_between(first, last) + 1
    kind = rule_ladder([(days == 0, "NOT BILLED"), (days == whole, "FULL")], "PRO RATA")
    return contracts.select(
        "contract_id", "plan", days.alias("billed_days"), kind.alias("billing"),
        (F.col("price") * days / whole).alias("billed_value"),
    )


def component_totals(components: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Gross, discount and net per key out of priced components with a discount share."""
    gross, share = cents("price"), cents("share")
    return components.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("components"),
        exact_sum(gross).alias("gross"),
        exact_sum(gross * share, 10_000).alias("discount"),
        exact_sum(gross * (100 - share), 10_000).alias("net"),
    )


def fiscal_components(lines: DataFrame, notes: DataFrame, units: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Tax by kind per region.

    Lines become one row per note before notes are joined to regions, so the
    joins carry notes, not lines, and notes are counted without a distinct.
    """
    value = cents("value")
    per_note = lines.groupBy("note_id").agg(
        *[F.sum(F.when(F.col("kind") == k, value)).alias(n) for k, n in kinds.items()], F.sum(value).alias("total")
    )
    placed = per_note.join(notes.select("note_id", "unit_id"), "note_id").join(units.select("unit_id", "region"), "unit_id")
    return placed.groupBy("region").agg(
        *[(F.sum(n).cast("double") / 100).alias(n) for n in [*kinds.values(), "total"]],
        F.count(F.lit(1)).alias("notes"),
    )


def last_migration(migrations: DataFrame, month: Column) -> DataFrame:
    """Newest accepted plan change per contract inside the month, and whether it went up or down."""
    inside = migrations.where(
        F.col("accepted") & (F.col("day") >= F.trunc(month, "MM")) & (F.col("day") <= F.last_day(month))
    )
    newest = latest_version(inside, ["contract_id"], ["day", "migration_id"])
    way = F.coalesce(migration_way(), F.lit("SAME"))
    return newest.select("contract_id", "migration_id", "day", "old_value", "new_value", way.alias("direction"))
