"""First- and second-payment default.

Contracts carry ``contract_id, client_id, activated, cancelled``; invoices
``invoice_id, contract_id, amount, due, paid_on``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between
from tidemark.operators.latest import nth_by, topk_per_key
from tidemark.sources.writers import refresh_open_rows, refresh_window

LATE_DAYS = (1, 5, 10, 15, 20, 30)
STILL_OPEN_DAYS = 35


def installments(contracts: DataFrame, invoices: DataFrame, how_many: int) -> DataFrame:
    """The first invoices per contract that fall due after its activation, numbered from 1."""
    own = invoices.join(contracts.select("contract_id", "activated"), "contract_id").where(
        F.col("due") >= F.col("activated")
    )
    return topk_per_key(own, ["contract_id"], [F.asc("due"), F.asc("invoice_id")], how_many, "installment")


def fpd_flags(contracts: DataFrame, invoices: DataFrame, as_of: Column) -> DataFrame:
    """First invoice per contract with its days late and one flag per threshold."""
    first = installments(contracts, invoices, 1)
    late = days_between("due", F.coalesce("paid_on", as_of))
    return first.select(
        "contract_id", "invoice_id", "due", "paid_on", "amount",
        late.alias("late_days"),
        (days_between("due", as_of) >= 0).cast("int").alias("flag_fb"),
        *[(late >= n).cast("int").alias(f"flag_fpd{n}d") for n in LATE_DAYS],
    )


def refresh_fpd(new: DataFrame, stored: DataFrame, as_of: Column, days: int = 100) -> DataFrame:
    """Rebuild the invoices due in the last ``days`` days and keep the older stored rows."""
    return refresh_window(new, stored, "due", F.date_sub(as_of, days))


def fpd_spd(contracts: DataFrame, invoices: DataFrame, as_of: Column) -> DataFrame:
    """First and second invoice side by side, never-paid and long-overdue marks."""
    two = installments(contracts, invoices, 2)
    late = days_between("due", F.coalesce("paid_on", as_of))
    age = days_between("due", as_of)
    picks = []
    for n, p in ((1, "first"), (2, "second")):
        here = F.col("installment") == n
        picks += [
            F.max(F.when(here, F.col("invoice_id"))).alias(f"{p}_invoice"),
            F.max(F.when(here, F.col("due"))).alias(f"{p}_due"),
            F.max(F.when(here, F.col("paid_on"))).alias(f"{p}_paid_on"),
            F.max(F.when(here, age)).alias(f"{p}_age"),
            F.max(F.when(here, (late >= 30).cast("int"))).alias(f"{p}_late30"),
        ]
    side = two.groupBy("contract_id").agg(*picks)
    facts = invoices.groupBy("contract_id").agg(
        F.min("paid_on").alias("_paid"), F.max(F.when(F.col("paid_on").isNull(), age)).alias("_worst")
    )
    wide = contracts.select("contract_id", "client_id", "activated").join(side, "contract_id", "left").join(facts, "contract_id", "left")
    never = F.col("_paid").isNull() & (F.col("first_age") > 30)
    over = (F.col("activated") < F.date_sub(as_of, 180)) & (F.col("_worst") > 30)
    return wide.select(
        *[c for c in wide.columns if not c.startswith("_")],
        F.coalesce(never, F.lit(False)).alias("never_paid"),
        F.coalesce(over, F.lit(False)).alias("over30_in_6m"),
    )


def refresh_history(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Re-evaluate only rows whose first invoice is missing or young; older rows keep what they had."""
    is_open = F.col("first_invoice").isNull() | (F.col("first_age") <= STILL_OPEN_DAYS)
    values = [c for c in new.columns if c.startswith("first_")]
    return refresh_open_rows(stored, new.select("contract_id", *values), ["contract_id"], is_open, values)


def outreach(contracts: DataFrame, invoices: DataFrame, contacts: DataFrame, as_of: Column) -> DataFrame:
    """Contracts whose first or second invoice is open and overdue, with their best contact."""
    due = installments(contracts, invoices, 2).where(F.col("paid_on").isNull() & (F.col("due") < as_of))
    best = nth_by(contacts, ["contract_id"], [F.desc("updated"), F.asc("contact")], 1).select("contract_id", "contact")
    return due.select("contract_id", "invoice_id", "installment", "due", "amount").join(best, "contract_id", "left")
