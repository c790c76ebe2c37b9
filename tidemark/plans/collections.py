"""Collections: mailing cohort, exit reasons, monthly upsert, contacts and the bureau list.

Contracts carry ``contract_id, client_id, unit_id, segment, activated, cancelled``;
invoices carry ``invoice_id, contract_id, amount, kind, due, paid_on``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between
from tidemark.functions.text import bucketize, clean_text_key, first_match, valid_email
from tidemark.operators.aggregates import list_parts, pivot_max, sum_money
from tidemark.operators.joins import exclude
from tidemark.operators.latest import nth_by, topk_per_key

MIN_AMOUNT = 30


def eligible_contracts(contracts: DataFrame, exclusions: Sequence[DataFrame]) -> DataFrame:
    """Activated contracts that are on none of the exclusion lists (contract and client must match)."""
    keys = ["contract_id", "client_id"]
    listed = reduce(DataFrame.unionByName, [e.select(*keys) for e in exclusions]).distinct()
    status = F.when(F.col("cancelled").isNull(), "ATIVO").otherwise("INATIVO")
    return exclude(contracts.where(F.col("activated").isNotNull()), listed, keys).withColumn("mailing_status", status)


def overdue_invoices(invoices: DataFrame, as_of: Column) -> DataFrame:
    """Open invoices worth collecting that were due before the day."""
    return invoices.where(
        F.col("paid_on").isNull() & (F.col("amount") >= MIN_AMOUNT) & (F.col("due") < as_of)
    )


def mailing_cohort(
    contracts: DataFrame, invoices: DataFrame, exclusions: Sequence[DataFrame], as_of: Column, agreement: Column
) -> DataFrame:
    """One row per contract to be collected, led by its oldest overdue invoice.

    Debt, last payment and the agreement flag come from one pre-aggregated pass.
    """
    overdue = overdue_invoices(invoices, as_of)
    oldest = nth_by(overdue, ["contract_id"], [F.asc("due"), F.asc("invoice_id")], 1)
    is_overdue = F.col("paid_on").isNull() & (F.col("amount") >= MIN_AMOUNT) & (F.col("due") < as_of)
    facts = invoices.groupBy("contract_id").agg(
        sum_money("amount", is_overdue).alias("debt"),
        F.count_if(is_overdue).alias("open_invoices"),
        F.max("paid_on").alias("last_payment"),
        F.max(agreement.cast("int")).alias("negotiated"),
    )
    age = days_between("due", as_of)
    led = oldest.select(
        "contract_id",
        F.col("invoice_id").alias("motivating_invoice"),
        F.col("due").alias("oldest_due"),
        F.trunc("due", "MM").alias("due_month"),
        age.alias("aging"),
        bucketize(age, [30, 60, 90, 180], ["1-30", "31-60", "61-90", "91-180", "181+"]).alias("age_band"),
        (age >= 180).alias("last_chance"),
    )
    picked = eligible_contracts(contracts, exclusions).select(
        "contract_id", "client_id", "unit_id", "segment", "mailing_status"
    )
    return picked.join(led, "contract_id").join(facts, "contract_id", "left").withColumn(
        "reference", F.trunc(as_of, "MM")
    )


def open_list(invoices: DataFrame, as_of: Column) -> DataFrame:
    """Overdue invoice ids per contract as text, in numbered parts."""
    return list_parts(overdue_invoices(invoices, as_of), ["contract_id"], ["due", "invoice_id"], "invoice_id", "open_list")


def bureau_list(cohort: DataFrame, invoices: DataFrame, as_of: Column) -> DataFrame:
    """One row per overdue invoice of the cohort's contracts."""
    rows = overdue_invoices(invoices, as_of).select("contract_id", "invoice_id", "due", "amount")
    return rows.join(cohort.select("contract_id", "client_id", "reference"), "contract_id")


def exit_reasons(
    cohort: DataFrame, contracts: DataFrame, invoices_now: DataFrame, as_of: Column, agreement: Column
) -> DataFrame:
    """Why a cohort row leaves: the contract's reason first, then that of its motivating invoice."""
    base = cohort.select("motivating_invoice", "contract_id")
    gone = contracts.where(F.col("cancelled") <= as_of).select("contract_id", "cancelled")
    now = invoices_now.select(F.col("invoice_id").alias("motivating_invoice"), "paid_on", agreement.alias("_agreed"))
    known = base.join(gone, "contract_id", "left").join(now, "motivating_invoice", "left")
    reasons = [
        (F.col("cancelled").isNotNull(), "CANCELAMENTO", F.col("cancelled")),
        (F.col("_agreed"), "NEGOCIACAO", F.coalesce("paid_on", as_of)),
        (F.col("paid_on") <= as_of, "PAGAMENTO", F.col("paid_on")),
    ]
    found = F
    for i, (cond, label, on) in enumerate(reasons):
        entry = F.struct(F.lit(label).alias("exit_reason"), on.alias("reason_day"), F.lit(i + 1).alias("priority"))
        found = found.when(cond, entry)
    return known.select("motivating_invoice", found.alias("_r")).where(F.col("_r").isNotNull()).select(
        "motivating_invoice", "_r.*"
    )


def apply_exits(mailing: DataFrame, reasons: DataFrame, as_of: Column) -> DataFrame:
    """Mailing rows with new exit data where there is one, else what they had."""
    new = reasons.select(
        "motivating_invoice", F.col("exit_reason").alias("_reason"), F.col("reason_day").alias("_day")
    )
    joined = mailing.join(new, "motivating_invoice", "left")
    return joined.select(
        *[c for c in mailing.columns if c not in ("exit_reason", "reason_day", "left_on")],
        F.coalesce("_reason", "exit_reason").alias("exit_reason"),
        F.coalesce("_day", "reason_day").alias("reason_day"),
        F.when(F.col("_reason").isNotNull(), F.coalesce("left_on", as_of)).otherwise(F.col("left_on")).alias("left_on"),
    )


def monthly_mailing(stored: DataFrame, reasons: DataFrame, new_cohort: DataFrame | None, as_of: Column) -> DataFrame:
    """Next content of the mailing table: exits applied; on a month's first day the new cohort joins.

    The key is motivating invoice and reference month; running it again adds nothing.
    """
    updated = apply_exits(stored, reasons, as_of)
    if new_cohort is not None:
        blank = new_cohort.select(
            *[c for c in stored.columns if c not in ("exit_reason", "reason_day", "left_on")],
            F.lit(None).cast("string").alias("exit_reason"),
            F.lit(None).cast("date").alias("reason_day"),
            F.lit(None).cast("date").alias("left_on"),
        )
        updated = updated.unionByName(exclude(blank, stored, ["motivating_invoice", "reference"]))
    return updated


def mailing_summary(mailing: DataFrame, units: DataFrame, reference: Column) -> DataFrame:
    """Contracts, debt and exits of one reference month by unit (unit_id, unit) and age band."""
    month = mailing.where(F.col("reference") == reference)
    named = month.join(units.select("unit_id", "unit"), "unit_id", "left")
    return named.groupBy("unit", "age_band").agg(
        F.count(F.lit(1)).alias("contracts"),
        sum_money("debt").alias("debt"),
        F.count("exit_reason").alias("left_mailing"),
    )


def contact_sheet(contacts: DataFrame, kinds: Mapping[str, int]) -> DataFrame:
    """One row per client with the first contacts of each kind side by side.

    ``contacts`` has ``client_id, kind, contact, rank_value`` (greater is better);
    ``kinds`` says how many of a kind to keep.
    """
    most = max(kinds.values())
    top = topk_per_key(contacts, ["client_id", "kind"], [F.desc("rank_value"), F.asc("contact")], most, "n")
    slot = top.withColumn("_slot", F.concat_ws("_", "kind", "n"))
    columns = {f"{kind}_{i}": f"{kind}_{i}" for kind, k in kinds.items() for i in range(1, k + 1)}
    return pivot_max(slot, ["client_id"], "_slot", "contact", columns)


def contact_priority(systems: Sequence[DataFrame], how_many: int) -> DataFrame:
    """Best contacts per client over several systems: earlier systems win, then newer entries.

    Each frame has ``client_id, contact, updated``; the same contact counts once.
    """
    ranked = [s.withColumn("_system", F.lit(i)) for i, s in enumerate(systems)]
    every = reduce(DataFrame.unionByName, ranked)
    once = every.groupBy("client_id", "contact").agg(
        F.min("_system").alias("_system"), F.max("updated").alias("updated")
    )
    order = [F.asc("_system"), F.desc("updated"), F.asc("contact")]
    top = topk_per_key(once, ["client_id"], order, how_many, "n")
    return pivot_max(top, ["client_id"], "n", "contact", {i: f"contact_{i}" for i in range(1, how_many + 1)})


def cadastre(
    contracts: DataFrame, units: DataFrame, places: DataFrame, contacts: DataFrame, hubs: Sequence[tuple[str, str]],
    blocked: Sequence[str], systems: Sequence[str], phones: int = 3, emails: int = 2,
) -> DataFrame:
    """One row per contract with hub, region and the first phones and e-mails that each system knows of its client.

    ``contracts``: contract_id, client_id, unit_id, city, state; ``units``: unit_id, brand; ``hubs``: LIKE patterns of
    brands; ``places``: city, state, region, compared without accents and case; ``contacts``: client_id, system, kind
    (phone, email), contact, recorded; oldest first, e-mails that match a blocked pattern and repeated contacts left out.
    """
    named = contracts.join(units.select("unit_id", "brand"), "unit_id", "left")
    named = named.select("*", clean_text_key("city").alias("_city"), clean_text_key("state").alias("_state"))
    where = places.select(clean_text_key("city").alias("_city"), clean_text_key("state").alias("_state"), "region")
    where = where.groupBy("_city", "_state").agg(F.min("region").alias("region"))
    usable = (F.col("kind") == "phone") | ((F.col("kind") == "email") & valid_email("contact", blocked))
    once = contacts.where(usable & F.col("system").isin(list(systems))).groupBy("client_id", "system", "kind", "contact").agg(
        F.min("recorded").alias("recorded")
    )
    top = topk_per_key(once, ["client_id", "system", "kind"], [F.asc("recorded"), F.asc("contact")], max(phones, emails), "n")
    slot = top.withColumn("_slot", F.concat_ws("_", "kind", "n", "system"))
    wanted = [f"{kind}_{i}_{s}" for s in systems for kind, k in (("phone", phones), ("email", emails)) for i in range(1, k + 1)]
    sheet = pivot_max(slot, ["client_id"], "_slot", "contact", {w: w for w in wanted})
    joined = named.join(where, ["_city", "_state"], "left").join(sheet, "client_id", "left")
    return joined.select("contract_id", "client_id", "brand", first_match("brand", hubs).alias("hub"), "region", *wanted)
