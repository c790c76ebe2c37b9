"""Business-shaped views of the test tables, in Spark and as SQL common table expressions.

Orders play invoices and contracts, events play calls and status logs.  Missing
attributes (paid date, cancellation) are derived from the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.queries.registry import Tables

AS_OF = "2001-06-30"
EV_AS_OF = "2024-01-31"


def day(text: str = AS_OF) -> Column:
    return F.lit(text).cast("date")


def invoices(t: Tables) -> DataFrame:
    """One invoice per order, due after ten days; 2 % are never paid, others -5 to 34 days after issue."""
    issued = F.to_date("o_orderdate")
    paid = F.date_add(issued, (F.col("o_orderkey") % 40 - 5).cast("int"))
    return t.orders.select(
        F.col("o_orderkey").alias("invoice_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("kind"),
        issued.alias("issued"),
        F.date_add(issued, 10).alias("due"),
        F.when((F.col("o_orderkey") % 50 != 0) & (paid <= day()), paid).alias("paid_on"),
    )


INV = f"""inv AS (
  SELECT o_orderkey AS invoice_id, o_custkey AS client_id, o_totalprice AS amount, o_orderstatus AS status,
         o_orderpriority AS kind, CAST(o_orderdate AS DATE) AS issued, CAST(o_orderdate AS DATE) + 10 AS due,
         CASE WHEN o_orderkey % 50 <> 0
               AND CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 - 5 AS INTEGER) <= DATE '{AS_OF}'
              THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 - 5 AS INTEGER) END AS paid_on
  FROM orders)"""


def contracts(t: Tables) -> DataFrame:
    """One contract per order; status F means cancelled up to 400 days after activation."""
    activated = F.to_date("o_orderdate")
    ended = F.date_add(activated, (F.col("o_orderkey") % 400).cast("int"))
    return t.orders.select(
        F.col("o_orderkey").alias("contract_id"),
        F.col("o_custkey").alias("client_id"),
        (F.col("o_orderkey") % 97).alias("address_id"),
        (F.col("o_custkey") % 211).alias("phone_id"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("plan"),
        activated.alias("activated"),
        F.when((F.col("o_orderstatus") == "F") & (ended <= day()), ended).alias("cancelled"),
    )


CON = f"""con AS (
  SELECT o_orderkey AS contract_id, o_custkey AS client_id, o_orderkey % 97 AS address_id, o_custkey % 211 AS phone_id,
         o_totalprice AS price, o_orderpriority AS plan, CAST(o_orderdate AS DATE) AS activated,
         CASE WHEN o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) <= DATE '{AS_OF}'
              THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) END AS cancelled
  FROM orders)"""


def calls(t: Tables) -> DataFrame:
    """Events as call legs: one call per user and day, the event type as agent."""
    return t.events.select(
        "event_id",
        "ts",
        "user_id",
        F.to_date("ts").alias("call_day"),
        F.col("event_type").alias("agent"),
        F.concat(F.lit("skill_"), F.floor(F.col("value")) % 5).alias("skill"),
        "value",
    )


CALLS = """calls AS (
  SELECT event_id, ts, user_id, CAST(ts AS DATE) AS call_day, event_type AS agent,
         'skill_' || CAST(CAST(floor(value) AS BIGINT) % 5 AS VARCHAR) AS skill, value
  FROM events)"""


def month_end_grid(t: Tables, first: str, last: str) -> DataFrame:
    """Every customer at every month end."""
    from tidemark.operators.reshape import month_ends

    return t.customer.select(
        F.col("c_custkey").alias("client_id"), F.explode(month_ends(day(first), day(last))).alias("ref")
    )


def grid_sql(first: str, last: str) -> str:
    return f"""grid AS (
  SELECT c_custkey AS client_id, CAST(last_day(m) AS DATE) AS ref
  FROM customer, generate_series(DATE '{first}', DATE '{last}', INTERVAL 1 MONTH) AS g(m))"""


def accounts(t: Tables) -> DataFrame:
    """One contract per customer; every seventh is cancelled in 2000 or 2001."""
    key = F.col("c_custkey")
    ended = F.date_add(day("2000-06-01"), (key % 500).cast("int"))
    return t.customer.select(
        key.alias("contract_id"),
        key.alias("client_id"),
        F.col("c_nationkey").alias("unit_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        F.date_add(day("1995-01-01"), ((key * 13) % 2000).cast("int")).alias("activated"),
        F.when((key % 7 == 0) & (ended <= day()), ended).alias("cancelled"),
    )


ACC = f"""acc AS (
  SELECT c_custkey AS contract_id, c_custkey AS client_id, c_nationkey AS unit_id, c_mktsegment AS segment, c_acctbal AS balance,
         DATE '1995-01-01' + CAST(c_custkey * 13 % 2000 AS INTEGER) AS activated,
         CASE WHEN c_custkey % 7 = 0 AND DATE '2000-06-01' + CAST(c_custkey % 500 AS INTEGER) <= DATE '{AS_OF}'
              THEN DATE '2000-06-01' + CAST(c_custkey % 500 AS INTEGER) END AS cancelled
  FROM customer)"""
