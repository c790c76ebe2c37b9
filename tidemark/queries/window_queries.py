from pyspark.sql import functions as F

from tidemark.operators import intervals, latest
from tidemark.operators import ordered as o
from tidemark.plans import calls as call_plans
from tidemark.queries.registry import query
from tidemark.queries.testbed import CALLS, INV, calls, invoices


@query(
    "latest_version",
    """SELECT event_id, user_id, ts, event_type, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(t):
    return latest.latest_version(t.events, ["user_id"], ["ts", "event_id"]).select(
        "event_id", "user_id", "ts", "event_type", "value"
    )


@query(
    "latest_version_expr_key",
    """SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(t):
    newest = latest.latest_version(t.events, ["user_id", F.to_date("ts")], ["ts", "event_id"])
    return newest.select("event_id", "user_id", F.to_date("ts").alias("day"), "event_type")


@query(
    "first_event_per_key",
    """SELECT user_id, event_type, event_id, ts FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def _(t):
    return latest.summary_row_per_key(
        t.events, ["user_id", "event_type"], ["ts", "event_id"], True, event_id="event_id", ts="ts"
    )


@query(
    "priority_dedupe",
    """SELECT user_id, event_id, event_type, ts FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY
         CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 WHEN 'click' THEN 3 WHEN 'view' THEN 4 ELSE 5 END,
         ts DESC, event_id) = 1""",
)
def _(t):
    kind = F.col("event_type")
    priority = (
        F.when(kind == "purchase", 1).when(kind == "signup", 2).when(kind == "click", 3).when(kind == "view", 4)
    ).otherwise(5)
    one = latest.dedupe_by_priority(t.events, ["user_id"], priority, [F.desc("ts"), F.asc("event_id")])
    return one.select("user_id", "event_id", "event_type", "ts")


@query(
    "nth_event",
    """SELECT user_id, event_id, ts,
         CASE WHEN event_type = 'error' THEN 'SUSPENDED' WHEN event_type IN ('signup', 'purchase') THEN 'ACTIVE'
              ELSE 'UNCHANGED' END AS previous_status
       FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 2""",
)
def _(t):
    second = latest.nth_by(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")], 2)
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", "SUSPENDED").when(kind.isin("signup", "purchase"), "ACTIVE").otherwise("UNCHANGED")
    )
    return second.select("user_id", "event_id", "ts", status.alias("previous_status"))


@query(
    "topk_per_key",
    """SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS priority
       FROM events QUALIFY priority <= 3""",
)
def _(t):
    top = latest.topk_per_key(t.events, ["user_id"], [F.desc("value"), F.asc("event_id")], 3, "priority")
    return top.select("user_id", "event_id", "value", "priority")


@query(
    "version_numbering",
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_day,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1 AS is_last
       FROM orders""",
)
def _(t):
    numbered = latest.number_versions(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return numbered.select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_day"), "version", "is_last"
    )


@query(
    "installment_number",
    f"""WITH {INV} SELECT invoice_id, client_id, due,
         row_number() OVER (PARTITION BY client_id ORDER BY due, invoice_id) AS installment
       FROM inv WHERE status <> 'P'""",
)
def _(t):
    counted = invoices(t).where("status <> 'P'")
    return o.along_key(counted, ["client_id"], ["due", "invoice_id"], {"installment": o.ordinal()}).select(
        "invoice_id", "client_id", "due", "installment"
    )


@query(
    "rank_within_key",
    """SELECT event_id, user_id, CAST(ts AS DATE) AS day,
         rank() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE)) AS rank FROM events""",
)
def _(t):
    days = t.events.select("event_id", "user_id", F.to_date("ts").alias("day"))
    return latest.rank_with_gaps(days, ["user_id"], "day")


@query(
    "repeat_within_30d",
    """SELECT o_orderkey, o_custkey,
         CASE WHEN date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
                             o_orderdate) <= 30 THEN 1 ELSE 0 END AS is_repeat
       FROM orders""",
)
def _(t):
    marked = intervals.repeats_within(
        t.orders, ["o_custkey"], "o_orderdate", "o_orderkey", hours=30 * 24, look="behind"
    )
    return marked.select("o_orderkey", "o_custkey", "is_repeat")


@query(
    "repeat_24h",
    """SELECT event_id, user_id, ts,
         CASE WHEN lead(ts) OVER w - ts <= INTERVAL 24 HOUR THEN 1 ELSE 0 END AS repeat_24h,
         CASE WHEN CAST(lead(ts) OVER w AS DATE) = CAST(ts AS DATE) THEN 1 ELSE 0 END AS repeat_same_day
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def _(t):
    return call_plans.repeat_contacts(t.events, ["user_id"], "ts", "event_id").select(
        "event_id", "user_id", "ts", "repeat_24h", "repeat_same_day"
    )


@query(
    "handover_intervals",
    """SELECT event_id, user_id, ts, coalesce(lag(ts) OVER w, ts) AS held_from,
         CAST(floor(epoch(ts)) - floor(epoch(coalesce(lag(ts) OVER w, ts))) AS BIGINT) AS held_seconds
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def _(t):
    return intervals.handover_intervals(t.events, ["user_id"], "ts", "event_id").select(
        "event_id", "user_id", "ts", "held_from", "held_seconds"
    )


@query(
    "next_start",
    """SELECT event_id, user_id, ts AS valid_from,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to FROM events""",
)
def _(t):
    spans = o.along_key(t.events, ["user_id"], ["ts", "event_id"], {"valid_to": o.lead("ts")})
    return spans.select("event_id", "user_id", F.col("ts").alias("valid_from"), "valid_to")


@query(
    "first_value_frame",
    f"""WITH {CALLS} SELECT event_id, user_id, call_day,
         first_value(skill) OVER (PARTITION BY user_id, call_day ORDER BY ts, event_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_skill,
         max(value) OVER (PARTITION BY user_id, call_day ORDER BY ts, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS highest_so_far
       FROM calls""",
)
def _(t):
    steps = {"first_skill": o.first_value("skill"), "highest_so_far": o.running_max("value")}
    return o.along_key(calls(t), ["user_id", "call_day"], ["ts", "event_id"], steps).select(
        "event_id", "user_id", "call_day", "first_skill", "highest_so_far"
    )


@query(
    "partition_totals",
    f"""WITH {CALLS} SELECT event_id, user_id, call_day, count(*) OVER w AS legs, min(ts) OVER w AS call_start
       FROM calls WINDOW w AS (PARTITION BY user_id, call_day)""",
)
def _(t):
    legs = calls(t).select("event_id", "user_id", "call_day", "ts")
    totals = legs.groupBy("user_id", "call_day").agg(
        F.count(F.lit(1)).alias("legs"), F.min("ts").alias("call_start")
    )
    return legs.join(totals, ["user_id", "call_day"]).select("event_id", "user_id", "call_day", "legs", "call_start")


@query(
    "transfer_detection",
    f"""WITH {CALLS}, legs AS (
         SELECT *, lead(agent) OVER w AS next_agent, lead(skill) OVER w AS next_skill
         FROM calls WHERE agent <> 'error' WINDOW w AS (PARTITION BY user_id, call_day ORDER BY ts, event_id)),
       flagged AS (SELECT event_id, CASE WHEN next_agent IS NOT NULL AND next_agent <> agent THEN 1 ELSE 0 END AS transferred,
                          next_skill FROM legs)
       SELECT c.event_id, c.user_id, c.call_day, c.agent, coalesce(f.transferred, 0) AS transferred,
              CASE WHEN f.transferred = 1 THEN f.next_skill END AS transferred_to
       FROM calls c LEFT JOIN flagged f USING (event_id)""",
)
def _(t):
    return call_plans.transfers(
        calls(t), ["user_id", "call_day"], ["ts", "event_id"], "agent", "skill", F.col("agent") == "error"
    ).select("event_id", "user_id", "call_day", "agent", "transferred", "transferred_to")


@query(
    "attribute_on_first_row",
    f"""WITH {CALLS} SELECT event_id, user_id, call_day,
         CASE WHEN row_number() OVER (PARTITION BY user_id, call_day ORDER BY ts, event_id) = 1 THEN value END AS value
       FROM calls""",
)
def _(t):
    return call_plans.keep_on_first_row(
        calls(t), ["user_id", "call_day"], ["ts", "event_id"], ["value"]
    ).select("event_id", "user_id", "call_day", "value")


@query(
    "dual_ranking",
    """SELECT event_id, user_id, event_type,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS overall_no,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS category_no
       FROM events""",
)
def _(t):
    order = ["ts", "event_id"]
    one = o.along_key(t.events, ["user_id"], order, {"overall_no": o.ordinal()}, descending=True)
    two = o.along_key(one, ["user_id", "event_type"], order, {"category_no": o.ordinal()}, descending=True)
    return two.select("event_id", "user_id", "event_type", "overall_no", "category_no")


@query(
    "suspension_intervals",
    """WITH seq AS (SELECT user_id, ts, event_id, event_type, lead(ts) OVER w AS nts, lead(event_id) OVER w AS nid,
                          lead(event_type) OVER w AS ntype
                   FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
       SELECT user_id, ts AS opened_at, CASE WHEN ntype IN ('signup', 'purchase') THEN nts END AS closed_at,
              event_id AS open_event, CASE WHEN ntype IN ('signup', 'purchase') THEN nid END AS close_event
       FROM seq WHERE event_type = 'error'""",
)
def _(t):
    kind = F.col("event_type")
    return intervals.status_intervals(
        t.events, ["user_id"], "ts", "event_id", kind == "error", kind.isin("signup", "purchase")
    )
