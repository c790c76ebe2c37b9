"""Receivables: doubtful debt, payer profiles, current invoices, collections and negotiations.

Invoices carry ``invoice_id, client_id, amount, status, kind, issued, due, paid_on``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between, period_key
from tidemark.functions.text import bucketize, digits_only, rule_ladder
from tidemark.operators.aggregates import ratio, sum_money
from tidemark.operators.joins import asof_validity
from tidemark.operators.latest import dedupe_by_priority, latest_version, nth_by
from tidemark.sources.lake import Lake

# Class names of the doubtful-debt report and of the payer profile.
DOUBTFUL, DRAGGED, NOT_DUE, OVERDUE = "PDD", "PDD ARRASTO", "A VENCER", "VENCIDO DE 1 A 90"
GOOD, LOW, MEDIUM, HIGH = "BOM PAGADOR", "BAIXO RISCO", "MEDIO RISCO", "ALTO RISCO"

DOUBTFUL_AFTER = 90
BANDS = [0, 30, 60, 90, 120, 150, 180, 210, 240, 270, 300, 330, 365]
BAND_NAMES = [
    "A VENCER", "1-30", "31-60", "61-90", "91-120", "121-150", "151-180", "181-210", "211-240",
    "241-270", "271-300", "301-330", "331-365", "366+",
]


def open_invoices(invoices: DataFrame) -> DataFrame:
    return invoices.where(F.col("paid_on").isNull())


def pdd_aging(invoices: DataFrame, as_of: Column) -> DataFrame:
    """Open invoices with their age in days, ageing band, band order and own class."""
    aged = open_invoices(invoices).withColumn("aging", days_between("due", as_of))
    own = rule_ladder(
        [(F.col("aging") > DOUBTFUL_AFTER, DOUBTFUL), (F.col("aging") <= 0, NOT_DUE)], OVERDUE
    )
    order = bucketize("aging", BANDS, [str(i) for i in range(len(BAND_NAMES))]).cast("int")
    return aged.select(
        "invoice_id", "client_id", "amount", "due", "aging",
        bucketize("aging", BANDS, BAND_NAMES).alias("band"),
        order.alias("band_order"),
        own.alias("own_class"),
    )


def pdd_drag(invoices: DataFrame, as_of: Column) -> DataFrame:
    """Ageing classes where one doubtful invoice drags the client's other open invoices along."""
    aged = pdd_aging(invoices, as_of)
    marked = aged.where(F.col("own_class") == DOUBTFUL).select("client_id").distinct()
    both = aged.join(marked.withColumn("_dragged", F.lit(True)), "client_id", "left")
    final = rule_ladder(
        [(F.col("own_class") == DOUBTFUL, DOUBTFUL), (F.col("_dragged"), DRAGGED)]
    )
    return both.withColumn("debt_class", F.coalesce(final, F.col("own_class"))).drop("_dragged")


def payment_behaviour(late_days: Column) -> Column:
    """Behaviour by days late; an unpaid invoice is high risk."""
    return rule_ladder(
        [(late_days <= 0, GOOD), (late_days.between(1, 5), LOW), (late_days.between(6, 15), MEDIUM)], HIGH
    )


def payer_profile_month(invoices: DataFrame, month: Column, ignored: Sequence[str] = ()) -> DataFrame:
    """Behaviour on every invoice due in the month; ignored kinds get none."""
    first = F.trunc(month, "MM")
    due = invoices.where((F.col("due") >= first) & (F.col("due") <= F.last_day(first)))
    late = days_between("due", "paid_on")
    behaviour = F.when(~F.col("kind").isin(list(ignored)), payment_behaviour(late))
    return due.select(
        period_key("due").alias("period"), "client_id", "invoice_id", "kind", "due", "paid_on", "amount",
        late.alias("late_days"), behaviour.alias("behaviour"),
    )


def payer_profile_recurrent(
    invoices: DataFrame, month: Column, kinds: Sequence[str], ignored: Sequence[str] = ()
) -> DataFrame:
    """One invoice per client in the month and the client's profile over the six months before.

    ``kinds`` is the order in which invoice kinds are preferred; of each kind a
    paid invoice goes before an unpaid one.
    """
    current = payer_profile_month(invoices, month, ignored).where(F.col("behaviour").isNotNull())
    rank = rule_ladder(
        [
            (c, str(n))
            for i, kind in enumerate(kinds)
            for c, n in (
                ((F.col("kind") == kind) & F.col("paid_on").isNotNull(), 2 * i + 1),
                (F.col("kind") == kind, 2 * i + 2),
            )
        ],
        str(2 * len(kinds) + 1),
    ).cast("int")
    chosen = dedupe_by_priority(current, ["client_id"], rank, [F.asc("due"), F.asc("invoice_id")])

    first = F.trunc(month, "MM")
    past = invoices.where((F.col("due") >= F.add_months(first, -6)) & (F.col("due") < first))
    past = past.where(~F.col("kind").isin(list(ignored)))
    seen = past.select("client_id", payment_behaviour(days_between("due", "paid_on")).alias("_b"))
    names = {GOOD: "good", LOW: "low", MEDIUM: "medium", HIGH: "high"}
    counts = seen.groupBy("client_id").agg(
        *[F.count_if(F.col("_b") == label).alias(n) for label, n in names.items()]
    )
    g, l, m, h = (F.col(n) for n in names.values())
    worst = rule_ladder([(h > 0, HIGH), (m > 0, MEDIUM), (l > 0, LOW), (g > 0, GOOD)])
    profile = rule_ladder(
        [
            (g >= 5, GOOD),
            ((g == 4) | ((g == 3) & (l >= 1) & (h == 0)) | (l >= 4), LOW),
            (((g == 3) & (m >= 1) & (h == 0)) | (m >= 4), MEDIUM),
            (((g == 3) & (h >= 1)) | (h >= 4), HIGH),
        ]
    )
    joined = chosen.join(counts, "client_id", "left")
    return joined.select(
        *chosen.columns, F.coalesce(profile, worst, F.col("behaviour")).alias("recurrent_profile")
    )


def invoice_current(
    versions: DataFrame, clients: DataFrame, units: DataFrame, as_of: Column, collectable_from: float
) -> DataFrame:
    """Newest version per invoice with client, unit, and whether it may be collected.

    Dimensions: clients (client_id, unit_id, segment), units (unit_id, unit).
    """
    newest = latest_version(versions, ["invoice_id"], ["version"])
    named = newest.join(
        clients.select("client_id", F.col("unit_id").alias("_unit"), "segment"), "client_id", "left"
    ).join(units.select(F.col("unit_id").alias("_unit"), "unit"), "_unit", "left")
    may = F.col("paid_on").isNull() & (F.col("due") < as_of) & (F.col("amount") >= collectable_from)
    return named.select(
        "invoice_id", "client_id", "version", "amount", "due", "paid_on", "segment", "unit",
        F.coalesce(may, F.lit(False)).alias("collectable"),
    )


def invoice_clients(invoices: DataFrame, clients: DataFrame, contracts: DataFrame) -> DataFrame:
    """The client and brand of each invoice, out of the billing system's tax id: one row per invoice.

    Of the clients with the invoice's tax id (compared by digits) the newest one created by the time of the invoice
    counts, else the newest of all; among those created at once one that is not excluded.  ``rivals`` says how
    many clients share the tax id besides.  ``invoices``: invoice_id, contract_id, tax_id, created; ``clients``:
    client_id, tax_id, created, excluded; ``contracts``: contract_id, client_id, brand.  Tax ids meet on a time line,
    so one that very many clients and invoices share makes no pairs.
    """
    digits = F.nullif(digits_only("tax_id"), F.lit(""))
    best = F.struct(~F.col("excluded"), F.col("client_id"))
    known = clients.select(digits.alias("_tax"), F.col("created").alias("_since"), best.alias("_best"), "client_id")
    known = known.where(F.col("_tax").isNotNull())
    asked = invoices.withColumn("_tax", digits)
    before = asof_validity(asked, known, ["_tax"], "created", "_since", "_best", {"client_id": "_before"})
    any_time = known.groupBy("_tax").agg(
        F.max_by("client_id", F.struct("_since", "_best")).alias("_any"), (F.count(F.lit(1)) - 1).alias("_rivals")
    )
    found = before.join(any_time, "_tax", "left").select(
        *invoices.columns, F.coalesce("_before", "_any").alias("client_id"),
        F.when(F.col("_before").isNotNull(), "CREATED BEFORE").when(F.col("_any").isNotNull(), "CREATED LATER").alias("matched"),
        F.coalesce("_rivals", F.lit(0)).alias("rivals"),
    )
    return found.join(contracts.select("contract_id", "client_id", "brand"), ["contract_id", "client_id"], "left").select(*found.columns, "brand")


def collected_months(invoices: DataFrame, as_of: Column) -> DataFrame:
    """Invoices paid in the month of ``as_of`` or the month before, by how late they were paid."""
    first = F.trunc(as_of, "MM")
    paid = invoices.where((F.col("paid_on") >= F.add_months(first, -1)) & (F.col("paid_on") <= F.last_day(first)))
    late = days_between("due", "paid_on")
    band = bucketize(late, [0, 5, 15, 30], ["on time", "1-5", "6-15", "16-30", "31+"])
    return paid.groupBy(F.trunc("paid_on", "MM").alias("period"), "kind", band.alias("paid_band")).agg(
        F.count(F.lit(1)).alias("invoices"), sum_money("amount").alias("collected")
    )


def negotiation_reversal(invoices: DataFrame, agreed: Column, as_of: Column) -> DataFrame:
    """Per client and month: debt before, agreed value, discount share and the age band of the debt."""
    age = days_between("due", as_of)
    totals = invoices.groupBy("client_id", F.trunc("issued", "MM").alias("month")).agg(
        sum_money("amount", ~agreed).alias("debt_before"),
        sum_money("amount", agreed).alias("agreed_value"),
        F.max(F.when(~agreed, age)).alias("_age"),
    )
    both = totals.where(F.col("debt_before").isNotNull() & F.col("agreed_value").isNotNull())
    return both.select(
        "client_id",
        "month",
        "debt_before",
        "agreed_value",
        (1 - ratio(F.col("agreed_value"), F.col("debt_before"))).alias("discount_share"),
        bucketize("_age", [30, 90, 365], ["up to 30", "31-90", "91-365", "366+"]).alias("age_band"),
    )


def cancelled_month(
    invoices: DataFrame, contracts: DataFrame, addresses: DataFrame, units: DataFrame, hubs: Sequence[tuple[Column, str]], as_of: Column
) -> DataFrame:
    """Invoices cancelled in the month of ``as_of``, with class, person and place of their contract.

    ``invoices``: invoice_id, contract_id, status, updated, due, amount; ``contracts``: contract_id, client_id, unit_id,
    business, small, public; ``addresses``: contract_id, address_id, city, unit_id, of which the newest counts and goes
    before the contract's own unit; ``units``: unit_id, brand; ``hubs`` are rules over brand.
    """
    first = F.trunc(as_of, "MONTH")
    gone = invoices.where((F.col("status") == "CANCELLED") & (F.trunc("updated", "MONTH") == first))
    newest = nth_by(addresses, ["contract_id"], [F.desc("address_id")], 1)
    placed = contracts.join(newest.select("contract_id", "city", F.col("unit_id").alias("_unit")), "contract_id", "left")
    segment = F.when(F.col("business"), "B2B").when(F.col("small"), "PME").otherwise("B2C")
    legal = F.when(F.col("business"), "LEGAL").otherwise("NATURAL")
    public = F.col("public") & (F.col("business") | F.col("small"))
    known = placed.select(
        "contract_id", "client_id", "city", F.coalesce("_unit", "unit_id").alias("unit_id"), segment.alias("segment"),
        F.when(public, F.concat(legal, F.lit("-PUBLIC"))).otherwise(legal).alias("person"),
    )
    wide = gone.join(known, "contract_id", "left").join(units, "unit_id", "left")
    return wide.select(
        "invoice_id", "contract_id", "client_id", "updated", "due", "amount", "segment", "person", "city", "brand",
        rule_ladder(hubs, None).alias("hub"), first.alias("month"),
    )


def store_cancelled_month(lake: Lake, place: tuple[str, str, str], month: DataFrame) -> int:
    """Put a month of ``cancelled_month`` into its table; other months stay, a second run replaces its own."""
    return lake.replace_periods(month, *place, "month")
