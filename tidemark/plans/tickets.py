"""Tickets: their stays in queues, the client's package then, notes, and whether the contract came back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import days_between
from tidemark.operators.joins import asof_validity, semi
from tidemark.operators.latest import nth_by
from tidemark.operators.ordered import along_key, lag, ordinal, running_max
from tidemark.operators.skew import HOT_ROWS, find_cuts
from tidemark.sources.lake import store


def queue_stays(tickets: DataFrame, moves: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every stay of a ticket in a queue: ticket_id, move_id, queue, agent, started, ended.

    ``tickets``: ticket_id, queue, agent (as they are now), opened, closed; ``moves``: ticket_id, move_id, queue, agent
    (those left) and moved.  A stay lasts from the move before it (the opening for the first one) to its own move; the
    last one, without move_id, to the closing.  Moves of unknown tickets are left out.
    """
    left = moves.select("ticket_id", F.lit(0).alias("_last"), "move_id", "queue", "agent", F.col("moved").alias("ended"))
    now = tickets.select("ticket_id", F.lit(1).alias("_last"), "queue", "agent", F.col("closed").alias("ended"))
    line = left.unionByName(now, allowMissingColumns=True)
    seen = along_key(line, ["ticket_id"], ["_last", "move_id"], {"_before": lag("ended")}, hot_rows=hot_rows)
    both = seen.join(tickets.select("ticket_id", "opened"), "ticket_id")
    return both.select("ticket_id", "move_id", "queue", "agent", F.coalesce("_before", "opened").alias("started"), "ended")


def previous_opening(tickets: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """ticket_id and the newest opening among the contract's tickets with a smaller id (NULL without one)."""
    keys, order = ["contract_id"], ["ticket_id"]
    slim = tickets.where("contract_id is not null").select("ticket_id", "contract_id", "opened")
    cuts = find_cuts(slim, keys, order, hot_rows)
    so_far = along_key(slim, keys, order, {"_most": running_max("opened")}, cuts=cuts)
    return along_key(so_far, keys, order, {"previous_opened": lag("_most")}, cuts=cuts).select("ticket_id", "previous_opened")


def queue_attendances(
    tickets: DataFrame, moves: DataFrame, wanted: Column, packages: DataFrame, notes: DataFrame,
    soon_seconds: int = 86_400, soon_days: int = 7, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The stays in ``wanted`` queues (a condition on queue), numbered per ticket by their start.

    Each has the package that was in force when the ticket was opened (``packages``: contract_id, version_id, begun,
    package), the newest note of its agent in its queue and the ticket's first note (``notes``: note_id, ticket_id,
    queue, agent, written, note), and the contract's opening before among tickets with such a stay, with marks for one
    less than ``soon_seconds`` or ``soon_days`` earlier.  Stays and their tickets are stored when this is called.
    """
    stays = store(queue_stays(tickets, moves, hot_rows).where(wanted), "stays")
    order = ["started", "_last", "move_id"]
    marked = stays.withColumn("_last", F.col("move_id").isNull().cast("int"))
    numbered = along_key(marked, ["ticket_id"], order, {"stay_no": ordinal()}, hot_rows=hot_rows).drop("_last")
    own = store(semi(tickets, stays, "ticket_id").select("ticket_id", "contract_id", "opened", "closed"), "tickets")
    take = {"package": "package"}
    sold = asof_validity(own, packages, ["contract_id"], "opened", "begun", "version_id", take, hot_rows=hot_rows)
    newest = nth_by(notes, ["ticket_id", "queue", "agent"], [F.desc("written"), F.desc("note_id")], 1)
    first = nth_by(notes, ["ticket_id"], [F.asc("written"), F.asc("note_id")], 1)
    gap = F.unix_seconds(F.col("opened").cast("timestamp")) - F.unix_seconds(F.col("previous_opened").cast("timestamp"))
    no = F.lit(False)
    return (
        numbered.join(sold, "ticket_id")
        .join(previous_opening(own, hot_rows), "ticket_id", "left")
        .join(newest.select("ticket_id", "queue", "agent", F.col("note").alias("last_note")), ["ticket_id", "queue", "agent"], "left")
        .join(first.select("ticket_id", F.col("note").alias("first_note")), "ticket_id", "left")
        .withColumn("state", F.when(F.col("closed").isNull(), "OPEN").otherwise("CLOSED"))
        .withColumn("again_at_once", F.coalesce(gap < soon_seconds, no).cast("int"))
        .withColumn("again_in_days", F.coalesce(days_between("previous_opened", "opened") < soon_days, no).cast("int"))
    )
