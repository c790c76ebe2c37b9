"""Contract plans: 360 view, status, activation, cancellation, big base, sheets, audits and churned pairs.

Contracts carry ``contract_id, client_id, plan, price, activated, cancelled``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between, whole_months_between
from tidemark.functions.numbers import discounted_value
from tidemark.functions.text import bucketize, digits_only, extract_after, rule_ladder, speed_mbps
from tidemark.operators.aggregates import distinct_list, joined_set, pivot_max, sum_money
from tidemark.operators.joins import exclude, recurrence
from tidemark.operators.latest import latest_version, nth_by, summary_row_per_key
from tidemark.operators.linkage import earlier_link
from tidemark.operators.sets import cutover_union, union_distinct
from tidemark.sources.lake import Lake
from tidemark.sources.writers import carry_under


def replaced_contracts(contracts: DataFrame, keys: Sequence[str], from_days: int, to_days: int) -> DataFrame:
    """Contracts opened around the cancellation of an earlier contract with the same keys.

    The earlier contract ends ``from_days`` to ``to_days`` after the activation
    of the new one (negative: before it).
    """
    out = earlier_link(
        contracts, keys, "contract_id", "activated", "cancelled", -from_days, to_days, "replaced_contract"
    )
    return out.where(F.col("replaced_contract").isNotNull())


def contract_360(
    contracts: DataFrame, clients: DataFrame, items: DataFrame, is_add_on: Column, loyalty_days: int, as_of: Column,
    channels: Sequence[tuple[Column, str]], other_channel: str,
) -> DataFrame:
    """Contract with plan and add-on value, add-on names, newest item, loyalty flag and channel.

    ``channels`` are rules over contract and client columns, the first that holds counts.
    """
    value = items.groupBy("contract_id").agg(
        sum_money("price", ~is_add_on).alias("plan_value"),
        sum_money("price", is_add_on).alias("add_on_value"),
        F.count_if(is_add_on).alias("add_ons"),
        F.max("sold").alias("last_item"),
        joined_set(F.when(is_add_on, F.col("name")), "; ").alias("add_on_names"),
    )
    channel = rule_ladder(channels, other_channel)
    loyal = days_between("activated", as_of) <= loyalty_days
    return (
        contracts.join(clients, "client_id", "left")
        .join(value, "contract_id", "left")
        .select(
            "contract_id", "client_id", "segment", "plan", "price", "activated", "cancelled",
            "plan_value", "add_on_value", "add_ons", "add_on_names", "last_item",
            loyal.cast("int").alias("in_loyalty"), channel.alias("channel"),
        )
    )


def contract_status(contracts: DataFrame, own_clients: DataFrame, voluntary: Column) -> DataFrame:
    """Status with cancellation type; contracts of the company itself are left out.

    ``voluntary`` says which cancellations after activation the client asked for.
    """
    early = F.col("cancelled") < F.date_add("activated", 7)
    how = rule_ladder(
        [
            (F.col("cancelled").isNull(), "NONE"),
            (early, "BEFORE ACTIVATION"),
            (voluntary, "VOLUNTARY"),
        ],
        "INVOLUNTARY",
    )
    kept = exclude(contracts, own_clients, "client_id")
    return kept.select(
        "contract_id", "client_id", "activated", "cancelled",
        F.when(F.col("cancelled").isNull(), "ACTIVE").otherwise("CANCELLED").alias("status"),
        how.alias("cancellation_type"),
    )


def first_activation(legacy: DataFrame, current: DataFrame, cut: Column, holidays: DataFrame) -> DataFrame:
    """First activation per client over the old and the new system, with a working-day mark."""
    every = cutover_union(legacy, current, "activated", cut)
    first = summary_row_per_key(
        every, ["client_id"], ["activated", "contract_id"], True, contract_id="contract_id", activated="activated", origin="origin"
    )
    marked = first.join(holidays.select(F.col("day").alias("activated"), F.lit(True).alias("_h")), "activated", "left")
    return marked.select(
        "client_id", "contract_id", "activated", "origin",
        (F.col("_h").isNull() & (F.weekday("activated") < 5)).alias("working_day"),
    )


def cancellation_fact(contracts: DataFrame, excluded: DataFrame, as_of: Column) -> DataFrame:
    """Cancelled contracts with tenure band, minus the excluded ones."""
    gone = contracts.where(F.col("cancelled") <= as_of)
    months = whole_months_between("activated", "cancelled")
    band = bucketize(months, [3, 6, 12], ["0-3", "4-6", "7-12", "13+"])
    return exclude(gone, excluded, "contract_id").select(
        "contract_id", "client_id", "plan", "activated", "cancelled",
        days_between("activated", "cancelled").alias("lived_days"), band.alias("tenure"),
    )


def big_base(
    contracts: DataFrame, discounts: DataFrame, as_of: Column, categories: Mapping[str, str]
) -> DataFrame:
    """Active contracts with the running discount of each category and the price after them.

    Of several running discounts of a category the one ending last counts.
    """
    running = discounts.where((F.col("begun") <= as_of) & (F.col("ended") >= as_of))
    last = nth_by(running, ["contract_id", "category"], [F.desc("ended"), F.desc("percent")], 1)
    wide = pivot_max(last, ["contract_id"], "category", "percent", categories)
    active = contracts.where((F.col("activated") <= as_of) & (F.col("cancelled").isNull() | (F.col("cancelled") > as_of)))
    joined = active.join(wide, "contract_id", "left")
    total = sum((F.coalesce(F.col(n), F.lit(0.0)) for n in categories.values()), F.lit(0.0))
    return joined.select(
        "contract_id", "client_id", "plan", "price", *categories.values(),
        F.least(total, F.lit(100.0)).alias("total_percent"),
        discounted_value("price", total).alias("final_price"),
    )


def store_big_base(lake: Lake, place: tuple[str, str, str], month: DataFrame, contracts: DataFrame) -> int:
    """Store a month of the big base (``big_base`` with ``reference`` day and ``month``) and look at the months before again.

    A stored row stays as long as its contract, as known today, was not cancelled by the row's reference day;
    months that lose no row keep their files.
    """
    cancelled = F.col("today.cancelled")
    keep = F.col("today").isNull() | cancelled.isNull() | (cancelled > F.col("reference"))
    return carry_under(lake, place, month, contracts.select("contract_id", "cancelled"), ["contract_id"], "month", keep)


def contract_sheet(contracts: DataFrame, speeds: DataFrame, markers: DataFrame) -> DataFrame:
    """Contract with its newest plan speed in Mbps and its markers as sorted text."""
    newest = latest_version(speeds, ["contract_id"], ["day", "version_id"])
    tags = distinct_list(markers, ["contract_id"], "marker", "markers")
    return (
        contracts.select("contract_id", "client_id", "activated")
        .join(newest.select("contract_id", speed_mbps("label").alias("mbps")), "contract_id", "left")
        .join(tags, "contract_id", "left")
    )


def status_reconciliation(own: DataFrame, provider: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Does the provider's state agree with ours?  One row per key on either side."""
    keys = list(keys)
    both = own.select(*keys, F.col("state").alias("own_state")).join(
        provider.select(*keys, F.col("state").alias("provider_state")), keys, "full"
    )
    a, b = F.col("own_state"), F.col("provider_state")
    verdict = rule_ladder(
        [(a.isNull(), "ONLY PROVIDER"), (b.isNull(), "ONLY OWN"), (a == b, "AGREES")], "DIFFERS"
    )
    return both.withColumn("verdict", verdict)


def to_suspend(contracts: DataFrame, invoices: DataFrame, as_of: Column, days: int = 11) -> DataFrame:
    """Active contracts with invoices open for more than ``days`` after the due day."""
    late = invoices.where(F.col("paid_on").isNull() & (F.col("due") < F.date_sub(as_of, days)))
    owed = late.groupBy("contract_id").agg(
        F.count(F.lit(1)).alias("late_invoices"), F.min("due").alias("oldest_due"),
        sum_money("amount").alias("owed"),
    )
    active = contracts.where(F.col("cancelled").isNull()).select("contract_id", "client_id")
    return active.join(owed, "contract_id")


def latest_event_with_ref(events: DataFrame, key: str, ts: str, row_id: str, note: str, marker: str, length: int) -> DataFrame:
    """Newest event per key with the reference number that follows a marker in its note."""
    newest = latest_version(events, [key], [ts, row_id])
    ref = F.regexp_extract(extract_after(note, marker, length), r"^(\d+)", 1).try_cast("bigint")
    return newest.select(key, row_id, ts, ref.alias("reference"))


def cancellation_requests(
    requests: DataFrame, cancellations: DataFrame, groups: Sequence[tuple[Column, str]], days: int = 90
) -> DataFrame:
    """Retention requests and cancellations in one list with reason group and recurrence.

    Both frames have ``request_id, contract_id, day, reason``; ids must not clash.
    """
    every = union_distinct(requests, cancellations).withColumn("reason_group", rule_ladder(groups, "OTHER"))
    return recurrence(every, ["contract_id"], "day", "request_id", days, "requests_before", "last_request")


def enabled_log(contracts: DataFrame, logins: DataFrame, invoices: DataFrame, as_of: Column) -> DataFrame:
    """Daily row per contract: status, last login and last invoice up to the day."""
    seen = logins.where(F.to_date("ts") <= as_of).groupBy("contract_id").agg(F.max("ts").alias("last_login"))
    billed = invoices.where(F.col("issued") <= as_of).groupBy("contract_id").agg(
        F.max_by("invoice_id", F.struct("issued", "invoice_id")).alias("last_invoice")
    )
    status = F.when(F.col("cancelled").isNull() | (F.col("cancelled") > as_of), "ENABLED").otherwise("CANCELLED")
    return (
        contracts.select("contract_id", as_of.alias("day"), status.alias("status"))
        .join(seen, "contract_id", "left")
        .join(billed, "contract_id", "left")
    )


def contract_terms(
    contracts: DataFrame, migrations: DataFrame, sales: DataFrame, due_days: DataFrame, suspensions: DataFrame,
    discounts: DataFrame, as_of: Column, forced: Column, weak: Column, legacy: Column, loyalty_days: int = 365,
) -> DataFrame:
    """Contracts with their last accepted migration, due day, suspension rule and loyalty mark.

    ``migrations``: migration_id, contract_id, version, sale_id, rejected; the newest one that was not rejected counts,
    and only for the version that it led to.  ``sales``: sale_id, kind, sold.  ``due_days`` has due_id and due_day,
    ``suspensions`` rule_id, rule and late_days.  ``discounts`` (discount_id, contract_id, ...) are those that bind a
    contract, by the newest one, unless it is ``weak``.  ``forced`` looks at the migration's kind: it binds nobody.
    Otherwise a contract is bound for ``loyalty_days`` after its migration, or else its activation, as of today or of its
    cancellation; one of the ``legacy`` system cancelled before it was created says nothing.
    """
    accepted = migrations.where(~F.coalesce(F.col("rejected"), F.lit(True)))
    last = nth_by(accepted, ["contract_id"], [F.desc("migration_id")], 1)
    moved = last.join(sales, "sale_id", "left").select(
        "contract_id", "version", "migration_id", F.col("kind").alias("migration_kind"), F.col("sold").alias("migrated")
    )
    newest = nth_by(discounts, ["contract_id"], [F.desc("discount_id")], 1)
    bound = newest.where(~F.coalesce(weak, F.lit(False))).select("contract_id", F.lit(True).alias("_bound"))
    lived = days_between(F.coalesce("migrated", "activated"), F.coalesce("cancelled", as_of))
    active = F.col("activated").isNotNull()
    mark = rule_ladder(
        [
            ((F.col("cancelled") < F.col("created")) & legacy, "NO INFORMATION"),
            (active & F.col("_bound"), "YES"),
            (active & forced, "NO"),
            (active & lived.between(0, loyalty_days), "YES"),
        ],
        "NO",
    )
    return (
        contracts.join(moved, ["contract_id", "version"], "left")
        .join(due_days, "due_id", "left")
        .join(suspensions, "rule_id", "left")
        .join(bound, "contract_id", "left")
        .select(
            "contract_id", "client_id", "version", "migration_id", "migration_kind", "migrated", "due_day", "rule",
            "late_days", mark.alias("loyal"),
        )
    )


def retention_requests(
    requests: DataFrame, cancellations: DataFrame, discounts: DataFrame, groups: Sequence[tuple[Column, str]],
    tools: Sequence[tuple[Column, str]], days: int = 90,
) -> DataFrame:
    """Requests to cancel, cancellations, and retention discounts that nobody profiled, in one list.

    All frames have row_id, contract_id, at, agent, reason and tool.  Of requests of one contract, day, agent and reason
    the newest counts; a discount is unprofiled where its agent has no such request of the contract that day.  ``groups``
    and ``tools`` class reason and tool.  Each row has the number of requests of its contract in the ``days`` days
    before its day, and of the newest of them its time, tool and reason.
    """
    day = F.to_date("at").alias("day")
    named = lambda df, kind: df.select(F.lit(kind).alias("kind"), "row_id", "contract_id", "at", day, "agent", "reason", "tool")
    asked = nth_by(
        named(requests, "REQUEST"), ["contract_id", "day", "agent", "reason"], [F.desc("at"), F.desc("row_id")], 1
    )
    profiled = asked.select("contract_id", "day", "agent").distinct()
    bare = named(discounts, "NOT PROFILED").join(profiled, ["contract_id", "day", "agent"], "left_anti")
    every = asked.unionByName(named(cancellations, "CANCELLATION")).unionByName(bare)
    newest = F.max(F.when(F.col("kind") == "REQUEST", F.struct("at", "row_id", "tool", "reason")))
    daily = every.groupBy("contract_id", "day").agg(F.count_if(F.col("kind") == "REQUEST").alias("_n"), newest.alias("_last"))
    back = Window.partitionBy("contract_id").orderBy(F.unix_date("day")).rangeBetween(-days, -1)  # a row per day
    facts = daily.select(
        "contract_id", "day", F.coalesce(F.sum("_n").over(back), F.lit(0)).alias("requests_before"),
        F.last("_last", ignorenulls=True).over(back).alias("_last"),
    )
    return every.join(facts, ["contract_id", "day"], "left").select(
        "kind", "row_id", "contract_id", "at", "agent", "reason", "tool",
        rule_ladder(groups, "OTHER").alias("reason_group"), rule_ladder(tools, "OTHER").alias("tool_group"),
        F.coalesce("requests_before", F.lit(0)).alias("requests_before"), F.col("_last.at").alias("last_request"),
        F.col("_last.tool").alias("last_tool"), F.col("_last.reason").alias("last_reason"),
    )


def listed_payments(
    contracts: DataFrame, clients: DataFrame, invoices: DataFrame, tickets: DataFrame, negotiations: DataFrame,
    listed: Column, counts: Column,
) -> DataFrame:
    """Invoices that count (``counts``, over invoices) of cancelled contracts whose client is ``listed``.

    Each has the debtor's document (kind and digits), the client's newest ticket (client_id, ticket_id, opened, queue)
    and the number and list of invoices that it renegotiates (``negotiations``: invoice_id, original).
    """
    digits = digits_only(F.coalesce("personal_id", "company_id"))
    letter = F.when(F.col("person") == "NATURAL", "F").when(F.col("person") == "LEGAL", "J")
    debtors = clients.where(listed).select("client_id", F.concat(letter, digits).alias("document"))
    gone = contracts.where(F.col("cancelled").isNotNull()).select("contract_id", "client_id")
    newest = nth_by(tickets, ["client_id"], [F.desc("opened"), F.desc("ticket_id")], 1)
    parts = negotiations.select("invoice_id", "original").distinct().groupBy("invoice_id").agg(
        F.count("original").alias("negotiated"), joined_set(F.col("original")).alias("originals")
    )
    owed = invoices.where(counts).join(gone, "contract_id").join(debtors, "client_id")
    return (
        owed.join(newest.select("client_id", F.col("queue").alias("last_queue"), F.col("opened").alias("last_ticket")), "client_id", "left")
        .join(parts, "invoice_id", "left")
    )
