"""Call-centre plans: transfers, inbound facts, repeat contacts, retention and chat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import digits_only, hms_to_seconds, rule_ladder, surrogate_key, to_int_lenient
from tidemark.operators import ordered as o
from tidemark.operators.aggregates import ratio
from tidemark.operators.latest import nth_by
from tidemark.operators.sets import cutover_union
from tidemark.operators.skew import Cuts, find_cuts
from tidemark.sources.writers import append_missing


def transfers(
    legs: DataFrame,
    call: Sequence[str],
    order_by: Sequence[str],
    agent: str,
    skill: str,
    ignored: Column,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Flag legs handed to another agent and name the skill they went to.

    The last leg of a call and a leg followed by the same agent are no
    transfers.  ``ignored`` legs (supervisors listening in) stay in the result
    but neither transfer nor receive.
    """
    marked = legs.withColumn("_ignored", F.coalesce(ignored, F.lit(False)))
    steps = {"_next_agent": o.lead(agent), "_next_skill": o.lead(skill)}
    real = o.along_key(marked.where(~F.col("_ignored")), call, order_by, steps, cuts=cuts)
    moved = F.col("_next_agent").isNotNull() & (F.col("_next_agent") != F.col(agent))
    real = real.select(
        *legs.columns,
        moved.cast("int").alias("transferred"),
        F.when(moved, F.col("_next_skill")).alias("transferred_to"),
    )
    idle = marked.where("_ignored").select(*legs.columns, F.lit(0).alias("transferred"))
    return real.unionByName(idle, allowMissingColumns=True)


def keep_on_first_row(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], columns: Sequence[str], last: bool = False
) -> DataFrame:
    """Keep call-level attributes on one leg only, so that summing them does not count twice."""
    seq = o.along_key(df, keys, order_by, {"_no": o.ordinal(), "_last": o.is_last()})
    here = F.col("_last") if last else F.col("_no") == 1
    return seq.select(
        *[F.when(here, F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def inbound_calls(
    calls: DataFrame,
    legs: DataFrame,
    call: Sequence[str],
    order_by: Sequence[str],
    agent: str,
    skill: str,
    ignored: Column,
    call_values: Sequence[str],
) -> DataFrame:
    """Calls with their agent legs; calls without legs stay, call values sit on the last leg only."""
    cuts = find_cuts(legs, call, order_by)
    flagged = transfers(legs, call, order_by, agent, skill, ignored, cuts)
    ranked = o.along_key(flagged, call, order_by, {"leg_no": o.ordinal(), "_last": o.is_last()}, cuts=cuts)
    joined = calls.join(ranked, list(call), "left")
    lonely = F.col("leg_no").isNull()
    values = [
        F.when(lonely | F.col("_last"), F.col(c)).alias(c) if c in call_values else F.col(c) for c in calls.columns
    ]
    rest = [F.col(c) for c in ranked.columns if c not in calls.columns and c != "_last"]
    out = joined.select(*values, *rest)
    return out.withColumn("call_key", surrogate_key(*call, "leg_no")).fillna({"transferred": 0})


def repeat_contacts(df: DataFrame, keys: Sequence[str], ts: str, row_id: str) -> DataFrame:
    """Does the key call again within 24 hours, and again the same day?"""
    seq = o.along_key(df, keys, [ts, row_id], {"_next": o.lead(ts)})
    gap = F.unix_micros(F.col("_next").cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))
    no = F.lit(False)
    return seq.select(
        *df.columns,
        F.coalesce(gap <= 86_400_000_000, no).cast("int").alias("repeat_24h"),
        F.coalesce(F.to_date("_next") == F.to_date(F.col(ts)), no).cast("int").alias("repeat_same_day"),
    )


def retention_points(
    legs: DataFrame, call: Sequence[str], caller: str, ts: str, row_id: str, rules: Sequence[tuple[Column, str]]
) -> DataFrame:
    """First leg per call, how the call ended, and whether the caller came back."""
    first = nth_by(legs, call, [F.asc(ts), F.asc(row_id)], 1)
    ended = first.withColumn("ending", rule_ladder(rules, "OTHER"))
    out = repeat_contacts(ended, [caller], ts, row_id)
    answered = F.col("ending").isin("RETAINED", "TRANSFERRED")
    return out.withColumn("kept_in_ivr", (answered & (F.col("repeat_24h") == 0)).cast("int"))


def chat_fact(turns: DataFrame, chat: str, turn: str, role: str, text: str, client: str, agent: str) -> DataFrame:
    """One row per chat: turns by role, first and last speaker, characters written, surrogate key."""
    pos = F.struct(turn, role)
    fact = turns.groupBy(chat).agg(
        F.count(F.lit(1)).alias("turns"),
        F.count_if(F.col(role) == client).alias("client_turns"),
        F.count_if(F.col(role) == agent).alias("agent_turns"),
        F.min_by(role, pos).alias("opened_by"),
        F.max_by(role, pos).alias("closed_by"),
        F.sum(F.length(text)).alias("characters"),
    )
    return fact.withColumn("chat_key", surrogate_key(chat))


def outbound_calls(legacy: DataFrame, current: DataFrame, cut: Column, whole: Sequence[str], stored: DataFrame | None = None) -> DataFrame:
    """Outbound calls of both systems with their key; with ``stored``, that table and the calls that it does not hold.

    The old system has everything as text: ``started`` is read as a time, the ``whole`` columns as numbers (``12.0`` is
    12), what can't be read is NULL.  A call without a readable start belongs to neither side of the cut.
    """
    numbers = {c: to_int_lenient(c) for c in whole}
    read = legacy.withColumns({"started": F.col("started").try_cast("timestamp_ntz"), **numbers})
    every = cutover_union(read, current, "started", cut).withColumn("call_key", surrogate_key("call_id"))
    return every if stored is None else append_missing(every, stored, ["call_key"])


def agent_states(legacy: DataFrame, current: DataFrame, cut: Column) -> DataFrame:
    """States of agents in both systems (agent, since, state, reason, held as HH:MM:SS) with key and seconds held."""
    read = legacy.withColumn("since", F.col("since").try_cast("timestamp_ntz"))
    every = cutover_union(read, current, "since", cut)
    return every.withColumns({"held_seconds": hms_to_seconds("held"), "state_key": surrogate_key("agent", "since", "state")})


def agent_day(states: DataFrame, working: Column) -> DataFrame:
    """Per agent and day: seconds signed in, seconds in ``working`` states and their share."""
    per = states.groupBy("agent", F.to_date("since").alias("day")).agg(
        F.sum("held_seconds").alias("seconds"), F.sum(F.when(working, F.col("held_seconds")).otherwise(0)).alias("working_seconds")
    )
    return per.withColumn("occupancy", ratio(F.col("working_seconds"), F.col("seconds")))


def point_clients(points: DataFrame, contracts: DataFrame, clients: DataFrame, addresses: DataFrame) -> DataFrame:
    """Retention points with client, unit and city where tax id and contract belong together.

    ``points`` has tax_id and contract_id; a client's tax id is the digits of its personal id, else of its company id.
    ``contracts``, ``clients`` and ``addresses`` hold an id once, so no point comes back twice.
    """
    tax = digits_only(F.coalesce("personal_id", "company_id"))
    known = (
        contracts.join(clients.select("client_id", tax.alias("tax_id")), "client_id")
        .join(addresses.select("address_id", "city"), "address_id", "left")
        .select("contract_id", "tax_id", "client_id", "unit_id", "city")
    )
    return points.join(known, ["contract_id", "tax_id"], "left")
