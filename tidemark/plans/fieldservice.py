"""Field service: KPI sets, indicators, bonus score, service orders and back-office SLA.

Service orders carry ``order_id, ticket_id, client_id, company, opened, done`` and whatever the rules look at.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between
from tidemark.functions.text import bucketize, rule_ladder
from tidemark.operators.aggregates import kpi_score, ratio, run_rate
from tidemark.operators.intervals import business_seconds, handover_intervals
from tidemark.operators.joins import asof_first
from tidemark.operators.latest import representative_or_fallback
from tidemark.operators.ordered import along_key, lag
from tidemark.sources.lake import store

EFFECTIVENESS, ACTIVATION_AGEING, INFANCY = "EFFECTIVENESS", "ACTIVATION AGEING", "INFANCY"
REPAIRS_24H, TECHNICAL_REPAIR, REPEATED_REPAIR = "REPAIRS 24H", "TECHNICAL REPAIR", "REPEATED REPAIR"


@dataclass(frozen=True)
class ServiceRules:
    """What the KPI sets need to know of an order.

    ``moves`` names the kind of move (NULL for other orders); ``countable`` says which repair orders the
    technical-repair index may count.
    """

    activation: Column
    repair: Column
    moves: Column
    performed: Column
    failed: Column
    countable: Column
    move_days: int = 7
    standard_days: int = 2
    infancy_days: int = 15
    repeat_days: int = 30


def _kpi(indicator: Column | str, ageing: Column, category: Column, hit: Column) -> list[Column]:
    """The columns that all sets share."""
    name = F.lit(indicator) if isinstance(indicator, str) else indicator
    return [
        F.col("ticket_id"), F.col("order_id"), F.col("client_id"), F.col("company"), F.to_date("opened").alias("opened"),
        name.alias("indicator"), ageing.cast("long").alias("ageing"), category.alias("category"), hit.cast("int").alias("hit"),
    ]


def newest_performed(orders: DataFrame, rules: ServiceRules) -> DataFrame:
    """One order per ticket: the newest that was performed."""
    return representative_or_fallback(orders, ["ticket_id"], ["order_id"], rules.performed, rules.performed)


def moves(orders: DataFrame, rules: ServiceRules) -> DataFrame:
    """Performed moves of each kind by the days they took; reached within ``move_days``."""
    kinds = orders.withColumn("_move", rules.moves).where(F.col("_move").isNotNull())
    took = days_between("opened", "done")
    band = bucketize(took, [2, 4, 7], ["up to 2 d", "3-4 d", "5-7 d", "over 7 d"])
    return newest_performed(kinds, rules).select(*_kpi(F.col("_move"), took, band, took <= rules.move_days))


def effectiveness(orders: DataFrame, rules: ServiceRules) -> DataFrame:
    """Activation orders that were carried out or came to nothing."""
    ended = orders.where(rules.activation & (rules.performed | rules.failed))
    done = F.when(rules.performed, "PERFORMED").otherwise("NOT PERFORMED")
    return ended.select(*_kpi(EFFECTIVENESS, F.lit(None), done, rules.performed))


def activation_ageing(activations: DataFrame, rules: ServiceRules) -> DataFrame:
    """Days from contract to activation (client_id, company, created, activated); standard up to ``standard_days``."""
    took = days_between("created", "activated")
    fine = F.coalesce(took.between(0, rules.standard_days), F.lit(False))
    none = {"ticket_id": F.lit(None).cast("long"), "order_id": F.lit(None).cast("long"), "opened": F.col("created")}
    band = F.when(fine, "IN STANDARD").otherwise("OUT OF STANDARD")
    return activations.withColumns(none).select(*_kpi(ACTIVATION_AGEING, took, band, fine))


def infancy(activations: DataFrame, repairs: DataFrame, rules: ServiceRules) -> DataFrame:
    """Activations with the first performed repair of the client within ``infancy_days``; reached where there is one."""
    take = {"ticket_id": "ticket_id", "order_id": "order_id", "opened": "opened"}
    found = asof_first(activations, repairs, ["client_id"], "activated", "opened", "order_id", take, days=rules.infancy_days)
    early = F.col("order_id").isNotNull()
    band = F.when(early, "EARLY REPAIR").otherwise("NONE")
    seen = found.withColumn("_after", days_between("activated", "opened")).withColumn("opened", F.coalesce("opened", "activated"))
    return seen.select(*_kpi(INFANCY, F.col("_after"), band, early))


def repairs_24h(repairs: DataFrame) -> DataFrame:
    """Performed repairs by the minutes they took; reached within a day."""
    took = F.floor((F.unix_micros(F.col("done").cast("timestamp")) - F.unix_micros(F.col("opened").cast("timestamp"))) / 60_000_000)
    band = bucketize(took, [1080, 1440, 2880], ["up to 18 h", "up to 24 h", "up to 48 h", "over 48 h"])
    return repairs.select(*_kpi(REPAIRS_24H, took, band, took <= 1440))


def technical_repair(orders: DataFrame, rules: ServiceRules) -> DataFrame:
    """Repair tickets that count, each by one order: its newest performed one, else its newest countable one."""
    picked = representative_or_fallback(orders.where(rules.repair), ["ticket_id"], ["order_id"], rules.performed, rules.countable)
    band = F.when(rules.performed, "PERFORMED").otherwise("OPEN")
    return picked.select(*_kpi(TECHNICAL_REPAIR, F.lit(None), band, F.lit(True)))


def repeated_repairs(repairs: DataFrame, rules: ServiceRules) -> DataFrame:
    """Performed repairs; reached where the client's repair before ended at most ``repeat_days`` days earlier."""
    before = F.struct("opened", "done").alias("_this")
    seq = along_key(repairs.select("*", before), ["client_id"], ["opened", "ticket_id"], {"_last": lag("_this")})
    since = days_between(F.col("_last.done"), F.col("opened"))
    later = (F.col("opened") > F.col("_last.opened")) & (F.col("done") > F.col("_last.done"))
    again = F.coalesce((since <= rules.repeat_days) & later, F.lit(False))
    band = F.when(again, "REPEATED").otherwise("SINGLE")
    return seq.select(*_kpi(REPEATED_REPAIR, F.when(again, since), band, again))


def kpi_analytic(orders: DataFrame, activations: DataFrame, rules: ServiceRules) -> DataFrame:
    """All seven KPI sets in one list: what each is about, its ageing (days, minutes for repairs), band, and 1/0.

    The performed repairs are stored when this is called, since three sets look at them.
    """
    repairs = store(newest_performed(orders.where(rules.repair), rules), "repairs")
    sets = [
        moves(orders, rules), effectiveness(orders, rules), activation_ageing(activations, rules),
        infancy(activations, repairs, rules), repairs_24h(repairs), technical_repair(orders, rules), repeated_repairs(repairs, rules),
    ]
    return reduce(DataFrame.unionByName, sets)


def kpi_indicators(analytic: DataFrame, bases: DataFrame, as_of: Column) -> DataFrame:
    """Rows, rows reached and their share per company and indicator.

    The technical-repair index is the month's tickets, extended to the month end at the same pace, against the
    mean number of active clients now and a month before (``company, base_now, base_before``).
    """
    per = analytic.groupBy("company", "indicator").agg(F.count(F.lit(1)).alias("orders"), F.sum("hit").alias("hits"))
    both = per.join(bases, "company", "left")
    projected = F.round(run_rate(F.col("orders"), as_of)).cast("long")
    mean = F.round((F.col("base_now") + F.col("base_before")) / 2).cast("long")
    index = F.col("indicator") == TECHNICAL_REPAIR
    both = both.select(
        "company", "indicator", F.when(index, mean).otherwise(F.col("orders")).alias("orders"),
        F.when(index, projected).otherwise(F.col("hits")).alias("hits"),
    )
    return both.withColumn("result", ratio(F.col("hits"), F.col("orders")))


def kpi_bonus(indicators: DataFrame, goals: DataFrame) -> DataFrame:
    """Points per company and indicator by the newest goal of the indicator."""
    newest = goals.groupBy("indicator").agg(
        F.max_by(F.struct("polarity", "upper", "lower", "weight"), "valid_from").alias("_g")
    )
    scored = indicators.join(newest.select("indicator", "_g.*"), "indicator")
    points = kpi_score(F.col("result"), F.col("polarity"), F.col("upper"), F.col("lower"), F.col("weight"))
    return scored.select("company", "indicator", "result", "weight", points.alias("points"))


def service_orders(events: DataFrame, order: Sequence[str], ts: str, row_id: str, kind: str, rules: Sequence[tuple[Column, str]], start: str, finish: str) -> DataFrame:
    """One row per order: first start, first finish, last event and conclusion, by one aggregation."""
    at = F.struct(ts, row_id)
    only = lambda k: F.when(F.col(kind) == k, at)
    facts = events.groupBy(*order).agg(
        F.min(only(start)).alias("_start"),
        F.min(only(finish)).alias("_finish"),
        F.max_by(F.col(kind), at).alias("last_event"),
        F.max(F.col(ts)).alias("last_at"),
        F.count(F.lit(1)).alias("events"),
    )
    return facts.select(
        *order,
        F.col("_start").getField(ts).alias("first_start"),
        F.col("_finish").getField(ts).alias("first_finish"),
        "last_event", "last_at", "events",
    ).withColumn("conclusion", rule_ladder(rules, "OPEN"))


def backoffice_sla(tickets: DataFrame, key: str, ts: str, row_id: str, calendar: DataFrame) -> DataFrame:
    """Time each hand-over of a ticket took in working time, and its SLA band."""
    held = handover_intervals(tickets, [key], ts, row_id)
    timed = business_seconds(held, "held_from", ts, calendar, "day", "is_open")
    band = bucketize("business_seconds", [4 * 3600, 86_400, 7 * 86_400], ["4 hours", "1 day", "7 days", "over 7 days"])
    return timed.select(key, row_id, ts, "held_seconds", "business_seconds", band.alias("sla_band"))


def order_dimension(
    orders: DataFrame, events: DataFrame, technicians: DataFrame, contractors: DataFrame, queues: DataFrame, reasons: DataFrame,
    start: str, finish: str, conclusions: Sequence[tuple[Column, str]], system_user: str, own_company: str,
) -> DataFrame:
    """Service orders with technician, contractor, queue, reason, newest event, first start and who closed them.

    ``events``: order_id, event_id, at, kind, user; ``technicians``: technician_id, technician, contractor_id;
    ``conclusions`` are rules over reason_code and reason_group.  An order closed by ``system_user`` was closed by its
    technician; a technician without contractor belongs to ``own_company``.  All of an order's events pass through one
    aggregation.
    """
    at = F.struct("at", "event_id")
    only = lambda kind, value: F.min_by(value, F.when(F.col("kind") == kind, at))
    facts = events.groupBy("order_id").agg(
        F.max_by(F.struct("kind", "at"), at).alias("_newest"),
        only(start, F.col("at")).alias("work_began"), only(finish, F.col("user")).alias("_closer"),
    )
    closer = F.when(F.col("_closer") == system_user, F.col("technician")).otherwise(F.col("_closer"))
    return (
        orders.join(technicians, "technician_id", "left")
        .join(contractors, "contractor_id", "left")
        .join(queues, "queue_code", "left")
        .join(reasons, "reason_code", "left")
        .join(facts, "order_id", "left")
        .select(
            "order_id", "ticket_id", "opened", "technician_id", "technician", "queue",
            F.coalesce("contractor", F.lit(own_company)).alias("contractor"),
            "reason_code", "reason", rule_ladder(conclusions, None).alias("conclusion"),
            F.col("_newest.kind").alias("event"), F.col("_newest.at").alias("event_at"), "work_began", closer.alias("closed_by"),
        )
    )
