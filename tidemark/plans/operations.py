"""Devices, messages and app events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import rule_ladder
from tidemark.operators.joins import semi
from tidemark.operators.latest import latest_version


def latest_device_state(readings: DataFrame, device: str, ts: str, row_id: str, alarm: Column, contracts: DataFrame) -> DataFrame:
    """Newest reading per device with its contract and how many alarms the device had."""
    newest = latest_version(readings, [device], [ts, row_id])
    alarms = readings.groupBy(device).agg(
        F.count_if(alarm).alias("alarms"), F.count_distinct(F.to_date(ts)).alias("days_seen")
    )
    return newest.join(alarms, device).join(contracts, device, "left")


def provisioned_by_unit(state: DataFrame, unit: str, device: str) -> DataFrame:
    return state.groupBy(unit).agg(
        F.count_distinct(device).alias("devices"), F.count_if(F.col("alarms") > 0).alias("with_alarms")
    )


def confirmation_status(
    turns: DataFrame, chat: str, turn: str, role: str, text: str, rules: Sequence[tuple[Column, str]], client: str, agent: str
) -> DataFrame:
    """Dispatch (first agent turn) and the last answer of the client, classified."""
    mine, theirs = F.col(role) == agent, F.col(role) == client
    facts = turns.groupBy(chat).agg(
        F.min(F.when(mine, F.col(turn))).alias("dispatched_turn"),
        F.max_by(F.when(theirs, F.col(text)), F.when(theirs, F.col(turn))).alias("answer"),
        F.max(F.when(theirs, F.col(turn))).alias("answered_turn"),
    )
    answered = F.col("answered_turn") > F.col("dispatched_turn")
    status = F.when(F.col("dispatched_turn").isNull(), "NOT SENT").when(~F.coalesce(answered, F.lit(False)), "NO ANSWER")
    return facts.select(
        chat, "dispatched_turn", "answered_turn", status.otherwise(rule_ladder(rules, "OTHER")).alias("status")
    )


def session_event_counts(events: DataFrame, user: str, ts: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    """Events per user and day: totals by kind and the span of use in seconds."""
    first, last = F.min(ts), F.max(ts)
    return events.groupBy(user, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("events"),
        *[F.count_if(F.col(kind) == k).alias(f"{k}s") for k in kinds],
        first.alias("first_seen"),
        last.alias("last_seen"),
        (F.unix_seconds(last.cast("timestamp")) - F.unix_seconds(first.cast("timestamp"))).alias("span_seconds"),
    )


def incident_devices(
    alarms: DataFrame, devices: DataFrame, links: DataFrame, contracts: DataFrame, warned: DataFrame, incidents: DataFrame,
    units: DataFrame, problem: Column, active: Column,
) -> DataFrame:
    """Devices in an incident: one row per alarm time, incident, serial and unit, with the incident's state.

    ``alarms`` (device_id, created, incident_id) that are a ``problem`` and belong to an incident, of known ``devices``
    (device_id, serial), through ``links`` (serial, contract_id) to ``active`` contracts that were ``warned``.
    """
    bad = alarms.where(problem & F.col("incident_id").isNotNull()).select("device_id", "created", "incident_id")
    told = semi(contracts.where(active), warned, "contract_id").select("contract_id", "unit_id")
    placed = links.select("serial", "contract_id").join(told, "contract_id").select("serial", "unit_id").distinct()
    state = F.when(F.col("status") == "OPEN", "RUNNING").otherwise("ENDED").alias("state")
    return (
        bad.join(devices.select("device_id", "serial"), "device_id")
        .join(placed, "serial")
        .join(incidents.select("incident_id", state), "incident_id")
        .join(units, "unit_id", "left")
        .select(F.to_date("created").alias("day"), "created", "unit_id", "unit", "incident_id", "serial", "state")
        .distinct()
    )


def dispatch_orders(
    messages: DataFrame, notices: DataFrame, orders: DataFrame, until: Column, queues: Sequence[tuple[Column, str]],
    rebooked: Column, cancelled: Column,
) -> DataFrame:
    """Messages sent by ``until`` that announce a service order, with the order's queue class and what became of it.

    ``messages``: message_id, sent, delivery; ``notices``: message_id, order_id, client_id, contract_id; ``orders``:
    order_id, queue, unit_id, confirmed, and what ``rebooked`` and ``cancelled`` look at.  All of an order comes from one
    join; a notice whose order is unknown stays, as not confirmed.
    """
    rules = [(rebooked, "REBOOKED"), (cancelled, "CANCELLED"), (F.col("confirmed").isNotNull(), "CONFIRMED")]
    outcome = rule_ladder([(F.col("_known") & cond, name) for cond, name in rules], "NOT CONFIRMED")
    known = orders.withColumn("_known", F.lit(True))
    every = messages.where(F.to_date("sent") <= until).join(notices, "message_id").join(known, "order_id", "left")
    return every.select(
        "message_id", "sent", "delivery", "order_id", "client_id", "contract_id",
        rule_ladder(queues, F.col("queue")).alias("queue"), "unit_id", "confirmed", outcome.alias("outcome"),
    )
