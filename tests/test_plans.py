"""Rules of the plans that the test tables do not reach."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.plans import billing, calls, collections, first_payment, receivables
from tidemark.operators.sets import symmetric_difference
from tidemark.plans.catalogue import single_value
from tidemark.session import CLUSTER

def as_of():
    return F.lit("2024-06-30").cast("date")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_transfers_skip_supervisors(spark):
    legs = [
        (1, 1, "ana", "sales", "call"), (1, 2, "sup", "listen", "monitor"), (1, 3, "ana", "sales", "call"),
        (1, 4, "bob", "tech", "call"), (2, 5, "eva", "tech", "call"),
    ]
    df = spark.createDataFrame(legs, "call int, seq int, agent string, skill string, kind string")
    got = calls.transfers(df, ["call"], ["seq"], "agent", "skill", F.col("kind") == "monitor")
    assert rows(got, "seq", "transferred", "transferred_to") == [
        (1, 0, None), (2, 0, None), (3, 1, "tech"), (4, 0, None), (5, 0, None)
    ]


def test_inbound_calls_keep_lonely_calls_and_single_values(spark):
    whole = spark.createDataFrame([(1, 60), (2, 10)], "call int, seconds int")
    legs = spark.createDataFrame([(1, 1, "ana", "s"), (1, 2, "bob", "t")], "call int, seq int, agent string, skill string")
    got = calls.inbound_calls(whole, legs, ["call"], ["seq"], "agent", "skill", F.lit(False), ["seconds"])
    assert rows(got, "call", "seq", "seconds", "transferred") == [(1, 1, None, 1), (1, 2, 60, 0), (2, None, 10, 0)]
    assert got.select("call_key").distinct().count() == 3


def invoices(spark, data):
    return spark.createDataFrame(data, "invoice_id int, client_id int, amount double, kind string, issued date, due date, paid_on date")


@pytest.mark.parametrize(
    "late,profile",
    [
        ([0, 0, 0, 0, 0, 20], receivables.GOOD),
        ([0, 0, 0, 0, 20, 20], receivables.LOW),
        ([0, 0, 0, 3, 10, 10], receivables.LOW),
        ([0, 0, 0, 3, 20, 10], receivables.HIGH),
        ([0, 0, 0, 10, 10, 10], receivables.MEDIUM),
        ([3, 3, 3, 3, 20, 20], receivables.LOW),
        ([10, 10, 10, 10, 20, 20], receivables.MEDIUM),
        ([20, None, 20, 20, 0, 0], receivables.HIGH),
        ([0, 0, 3, 3], receivables.LOW),
    ],
)
def test_recurrent_profile_rules(spark, late, profile):
    data = [(0, 1, 10.0, "A", date(2024, 6, 1), date(2024, 6, 10), date(2024, 6, 9))]
    for i, days in enumerate(late):
        due = date(2024, 5 - i % 5, 1) if i < 5 else date(2023, 12, 15)
        paid = None if days is None else date.fromordinal(due.toordinal() + days)
        data.append((i + 1, 1, 10.0, "A", due, due, paid))
    got = receivables.payer_profile_recurrent(invoices(spark, data), as_of(), ["A"])
    assert rows(got, "client_id", "recurrent_profile") == [(1, profile)]


def test_drag_marks_only_clients_with_doubtful_invoices(spark):
    d = date.fromisoformat
    data = [
        (1, 1, 5.0, "A", d("2024-01-01"), d("2024-01-10"), None), (2, 1, 5.0, "A", d("2024-06-01"), d("2024-07-10"), None),
        (3, 2, 5.0, "A", d("2024-06-01"), d("2024-06-29"), None), (4, 2, 5.0, "A", d("2024-06-01"), d("2024-07-01"), None),
        (5, 2, 5.0, "A", d("2024-03-01"), d("2024-04-01"), None), (6, 3, 5.0, "A", d("2023-01-01"), d("2023-01-01"), d("2023-02-01")),
    ]
    got = receivables.pdd_drag(invoices(spark, data), as_of())
    # invoice 5 is exactly 90 days old: not doubtful yet
    assert rows(got, "invoice_id", "debt_class") == [
        (1, "PDD"), (2, "PDD ARRASTO"), (3, "VENCIDO DE 1 A 90"), (4, "A VENCER"), (5, "VENCIDO DE 1 A 90")
    ]


def test_monthly_mailing_again_adds_nothing(spark):
    schema = "motivating_invoice int, reference date, unit_id int, exit_reason string, reason_day date, left_on date"
    month = date(2024, 6, 1)
    stored = spark.createDataFrame([(1, month, 1, None, None, None), (2, month, 1, "PAGAMENTO", month, month)], schema)
    reasons = spark.createDataFrame([(1, "CANCELAMENTO", date(2024, 6, 20))], "motivating_invoice int, exit_reason string, reason_day date")
    fresh = spark.createDataFrame([(3, date(2024, 7, 1), 2)], "motivating_invoice int, reference date, unit_id int")
    once = collections.monthly_mailing(stored, reasons, fresh, as_of())
    got = rows(once, "motivating_invoice", "exit_reason", "left_on")
    assert got == [(1, "CANCELAMENTO", date(2024, 6, 30)), (2, "PAGAMENTO", month), (3, None, None)]
    assert rows(collections.monthly_mailing(once, reasons, fresh, as_of()), "motivating_invoice", "exit_reason", "left_on") == got


def test_first_invoices_count_from_activation(spark):
    d = date.fromisoformat
    con = spark.createDataFrame([(1, 1, d("2024-01-15"), None), (2, 2, d("2024-06-01"), None)], "contract_id int, client_id int, activated date, cancelled date")
    inv = spark.createDataFrame(
        [(1, 1, 5.0, d("2024-01-01"), None), (2, 1, 5.0, d("2024-02-01"), d("2024-03-05")), (3, 1, 5.0, d("2024-03-01"), None), (4, 2, 5.0, d("2024-07-10"), None)],
        "invoice_id int, contract_id int, amount double, due date, paid_on date",
    )
    flags = first_payment.fpd_flags(con, inv, as_of())
    assert rows(flags, "contract_id", "invoice_id", "flag_fb", "flag_fpd30d") == [(1, 2, 1, 1), (2, 4, 0, 0)]
    both = first_payment.fpd_spd(con, inv, as_of())
    assert rows(both, "contract_id", "second_invoice", "never_paid", "over30_in_6m") == [(1, 3, False, False), (2, None, False, False)]


def test_prorata(spark):
    d = date.fromisoformat
    data = [(1, d("2024-01-01"), None), (2, d("2024-06-21"), None), (3, d("2024-01-01"), d("2024-06-11")), (4, d("2024-01-01"), d("2024-06-01")), (5, d("2024-07-01"), None)]
    con = spark.createDataFrame(data, "contract_id int, activated date, cancelled date").withColumns({"plan": F.lit("p"), "price": F.lit(30.0)})
    got = billing.prorata_billing(con, as_of())
    assert rows(got, "contract_id", "billing", "billed_value") == [
        (1, "FULL", 30.0), (2, "PRO RATA", 10.0), (3, "PRO RATA", 10.0), (4, "NOT BILLED", 0.0), (5, "NOT BILLED", 0.0)
    ]


def test_single_value_is_single(spark):
    df = spark.range(5)
    assert single_value(df.where("id = 3"), "id") == 3 and single_value(df.limit(0), "id") is None
    with pytest.raises(ValueError):
        single_value(df, "id")


def test_scans_and_filters(spark):
    """A difference reads each side once; a month is a range that reaches the scan."""
    sf = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey")
    plan = symmetric_difference(orders, orders.where("o_custkey > 3"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    events = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(
        "l_orderkey AS contract_id", "cast(l_shipdate AS date) AS day", "l_returnflag AS kind", "l_extendedprice AS value"
    )
    inside = billing.month_events(events, {"R": "returned"}, F.lit("1996-02-01").cast("date"))
    plan = inside._jdf.queryExecution().optimizedPlan().toString()
    assert "trunc(cast" not in plan and ">=" in plan


def test_cluster_sessions_begin_with_many_partitions():
    assert int(CLUSTER["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 10_000
