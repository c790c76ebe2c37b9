"""Reports that join many tables: tickets, contract terms, requests, listed clients, calls, incidents, orders, cancelled invoices."""

from pyspark.sql import functions as F

from tidemark.plans import calls, fieldservice, operations, receivables, tickets
from tidemark.plans import contracts as contract_plans
from tidemark.queries.registry import query
from tidemark.queries.testbed import ACC, AS_OF, CON, INV, accounts, contracts, day, invoices
from tidemark.sources.lake import Lake, work_dir


def lines(t):
    """One row per order and line number, since the table has some twice."""
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_suppkey").alias("supp"), F.max("l_partkey").alias("part"), F.max("l_shipdate").alias("at"), F.max("l_returnflag").alias("flag"),
        F.max("l_linestatus").alias("status"), F.max("l_quantity").cast("int").alias("qty"), F.max("l_discount").alias("discount"),
    )


LINES = """lines AS (SELECT l_orderkey, l_linenumber, max(l_suppkey) AS supp, max(l_partkey) AS part, max(l_shipdate) AS "at", max(l_returnflag) AS flag,
  max(l_linestatus) AS status, CAST(max(l_quantity) AS INTEGER) AS qty, max(l_discount) AS discount FROM lineitem GROUP BY 1, 2)"""


def _tickets(t):
    key = F.col("o_orderkey")
    closed = F.expr("o_orderdate + make_dt_interval(CAST(o_orderkey % 30 AS INT))")
    return t.orders.select(
        key.alias("ticket_id"), F.col("o_custkey").alias("contract_id"), (key % 7).alias("queue"), (key % 5).alias("agent"),
        F.col("o_orderdate").alias("opened"), F.when(F.col("o_orderstatus") != "O", closed).alias("closed"),
    )


TICKETS = """tickets AS (SELECT o_orderkey AS ticket_id, o_custkey AS contract_id, o_orderkey % 7 AS queue, o_orderkey % 5 AS agent, o_orderdate AS opened,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) END AS closed FROM orders)"""


@query(
    "queue_attendances",
    f"""WITH {LINES}, {TICKETS}, line AS (SELECT l_orderkey AS ticket_id, CAST(l_linenumber AS BIGINT) AS move_id, supp % 7 AS queue, part % 5 AS agent, "at" AS ended FROM lines
           UNION ALL SELECT ticket_id, NULL, queue, agent, closed FROM tickets),
       stays AS (SELECT line.*, coalesce(lag(ended) OVER (PARTITION BY ticket_id ORDER BY move_id NULLS LAST), opened) AS started, contract_id, opened, closed FROM line JOIN tickets USING (ticket_id)),
       mine AS (SELECT *, row_number() OVER (PARTITION BY ticket_id ORDER BY started NULLS FIRST, move_id NULLS LAST) AS stay_no FROM stays WHERE queue IN (2, 5)),
       own AS (SELECT DISTINCT ticket_id, contract_id, opened FROM mine),
       prev AS (SELECT ticket_id, max(opened) OVER (PARTITION BY contract_id ORDER BY ticket_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_opened FROM own),
       sold AS (SELECT ticket_id, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS package FROM own JOIN orders ON o_custkey = contract_id AND o_orderdate <= opened AND o_orderstatus = 'F' GROUP BY 1),
       notes AS (SELECT l_orderkey AS ticket_id, l_linenumber AS note_id, supp % 7 AS queue, part % 5 AS agent, "at" AS written, flag || qty AS note FROM lines),
       ln AS (SELECT ticket_id, queue, agent, arg_max(note, (written, note_id)) AS last_note FROM notes GROUP BY ALL), fn AS (SELECT ticket_id, arg_min(note, (written, note_id)) AS first_note FROM notes GROUP BY ALL)
       SELECT mine.ticket_id, move_id, queue, agent, started, ended, stay_no, contract_id, opened, closed, package, previous_opened, last_note, first_note, CASE WHEN closed IS NULL THEN 'OPEN' ELSE 'CLOSED' END AS state,
         CAST(coalesce(epoch(opened) - epoch(previous_opened) < 86400 * 20, FALSE) AS INTEGER) AS again_at_once, CAST(coalesce(CAST(opened AS DATE) - CAST(previous_opened AS DATE) < 90, FALSE) AS INTEGER) AS again_in_days
       FROM mine LEFT JOIN sold USING (ticket_id) LEFT JOIN prev USING (ticket_id) LEFT JOIN ln USING (ticket_id, queue, agent) LEFT JOIN fn USING (ticket_id)""",
)
def _(t):
    each = lines(t).withColumns({"ticket_id": F.col("l_orderkey"), "queue": F.col("supp") % 7, "agent": F.col("part") % 5})
    moves = each.select("ticket_id", F.col("l_linenumber").cast("bigint").alias("move_id"), "queue", "agent", F.col("at").alias("moved"))
    notes = each.select("ticket_id", F.col("l_linenumber").alias("note_id"), "queue", "agent", F.col("at").alias("written"), F.concat("flag", "qty").alias("note"))
    packages = t.orders.where("o_orderstatus = 'F'").select(
        F.col("o_custkey").alias("contract_id"), F.col("o_orderkey").alias("version_id"), F.col("o_orderdate").alias("begun"), F.col("o_orderpriority").alias("package")
    )
    return tickets.queue_attendances(_tickets(t), moves, F.col("queue").isin(2, 5), packages, notes, 86_400 * 20, 90)


@query(
    "contract_terms",
    f"""WITH {LINES}, {CON}, c AS (SELECT *, contract_id % 3 + 1 AS version, contract_id % 27 AS due_id, contract_id % 6 AS rule_id FROM con),
       m AS (SELECT l_orderkey AS contract_id, l_linenumber AS migration_id, qty % 3 + 1 AS version, status AS kind, CAST("at" AS DATE) AS sold FROM lines WHERE flag <> 'R' QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) = 1),
       d AS (SELECT l_orderkey AS contract_id, discount FROM lines WHERE qty > 25 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC) = 1)
       SELECT c.contract_id, client_id, c.version, CAST(migration_id AS BIGINT) AS migration_id, kind AS migration_kind, sold AS migrated, n_nationkey + 1 AS due_day, r_name AS rule, r_regionkey * 10 AS late_days,
         CASE WHEN cancelled < activated + 30 AND c.contract_id % 2 = 0 THEN 'NO INFORMATION' WHEN d.contract_id IS NOT NULL THEN 'YES' WHEN kind = 'F' THEN 'NO'
           WHEN coalesce(cancelled, DATE '{AS_OF}') - coalesce(sold, activated) BETWEEN 0 AND 365 THEN 'YES' ELSE 'NO' END AS loyal
       FROM c LEFT JOIN m ON m.contract_id = c.contract_id AND m.version = c.version LEFT JOIN nation ON due_id = n_nationkey LEFT JOIN region ON rule_id = r_regionkey LEFT JOIN d ON d.contract_id = c.contract_id AND d.discount > 0.04""",
)
def _(t):
    key = F.col("contract_id")
    con = contracts(t).withColumns({"version": key % 3 + 1, "due_id": key % 27, "rule_id": key % 6, "created": F.date_add("activated", 30)})
    each = lines(t).withColumn("sale_id", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    moved = each.select(
        F.col("l_orderkey").alias("contract_id"), F.col("l_linenumber").cast("bigint").alias("migration_id"), (F.col("qty") % 3 + 1).cast("bigint").alias("version"),
        "sale_id", (F.col("flag") == "R").alias("rejected"),
    )
    sold = each.select("sale_id", F.col("status").alias("kind"), F.to_date("at").alias("sold"))
    dues = t.nation.select(F.col("n_nationkey").alias("due_id"), (F.col("n_nationkey") + 1).alias("due_day"))
    rules = t.region.select(F.col("r_regionkey").alias("rule_id"), F.col("r_name").alias("rule"), (F.col("r_regionkey") * 10).alias("late_days"))
    discounts = each.where("qty > 25").select(F.col("l_orderkey").alias("contract_id"), F.col("l_linenumber").alias("discount_id"), "discount")
    return contract_plans.contract_terms(
        con, moved, sold, dues, rules, discounts, day(), F.col("migration_kind") == "F", F.col("discount") <= 0.04, key % 2 == 0
    )


def _asked(t, status):
    key = F.col("o_orderkey")
    return t.orders.where(F.col("o_orderstatus") == status).select(
        key.alias("row_id"), (F.col("o_custkey") % 40).alias("contract_id"), F.expr("o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT))").alias("at"),
        (key % 2).alias("agent"), F.col("o_orderpriority").alias("reason"), F.concat(F.lit("TOOL "), key % 6).alias("tool"),
    )


@query(
    "retention_requests",
    """WITH r AS (SELECT o_orderkey AS row_id, o_custkey % 40 AS contract_id, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS "at", o_orderkey % 2 AS agent, o_orderpriority AS reason, 'TOOL ' || (o_orderkey % 6) AS tool, o_orderstatus AS s,
           CAST(o_orderdate AS DATE) AS day FROM orders),
       asked AS (SELECT * FROM r WHERE s = 'F' QUALIFY row_number() OVER (PARTITION BY contract_id, day, agent, reason ORDER BY "at" DESC, row_id DESC) = 1),
       every AS (SELECT 'REQUEST' AS kind, * FROM asked UNION ALL SELECT 'CANCELLATION', * FROM r WHERE s = 'P'
                 UNION ALL SELECT 'NOT PROFILED', * FROM r WHERE s = 'O' AND NOT EXISTS (SELECT 1 FROM asked a WHERE a.contract_id = r.contract_id AND a.day = r.day AND a.agent = r.agent)),
       back AS (SELECT e.kind, e.row_id, count(a.row_id) AS requests_before, arg_max(a."at", (a."at", a.row_id)) AS last_request, arg_max(a.tool, (a."at", a.row_id)) AS last_tool, arg_max(a.reason, (a."at", a.row_id)) AS last_reason
                FROM every e LEFT JOIN asked a ON a.contract_id = e.contract_id AND a.day BETWEEN e.day - 90 AND e.day - 1 GROUP BY 1, 2)
       SELECT kind, row_id, contract_id, "at", agent, reason, tool, CASE WHEN reason LIKE '1-%' THEN 'COMPETITION' WHEN reason LIKE '2-%' THEN 'PRICE' ELSE 'OTHER' END AS reason_group,
         CASE WHEN tool IN ('TOOL 1', 'TOOL 2') THEN 'DISCOUNT' WHEN tool = 'TOOL 3' THEN 'PLAN' ELSE 'OTHER' END AS tool_group, requests_before, last_request, last_tool, last_reason
       FROM every JOIN back USING (kind, row_id)""",
)
def _(t):
    groups = [(F.col("reason").like("1-%"), "COMPETITION"), (F.col("reason").like("2-%"), "PRICE")]
    tools = [(F.col("tool").isin("TOOL 1", "TOOL 2"), "DISCOUNT"), (F.col("tool") == "TOOL 3", "PLAN")]
    return contract_plans.retention_requests(_asked(t, "F"), _asked(t, "P"), _asked(t, "O"), groups, tools)


def _people(t):
    """Clients with a personal id, or every third with a company id, as text with signs."""
    key = F.col("c_custkey")
    digits = F.lpad((key * 7).cast("string"), 11, "0")
    personal = F.concat_ws("-", F.substring(digits, 1, 9), F.substring(digits, 10, 2))
    return t.customer.select(
        key.alias("client_id"), F.when(key % 3 == 0, "LEGAL").when(key % 3 == 1, "NATURAL").alias("person"),
        F.when(key % 3 != 0, personal).alias("personal_id"), F.concat(digits, F.lit("/0001")).alias("company_id"), F.col("c_acctbal").alias("balance"),
    )


DOCUMENT = "CASE WHEN c_custkey % 3 = 0 THEN lpad(CAST(c_custkey * 7 AS VARCHAR), 11, '0') || '0001' ELSE lpad(CAST(c_custkey * 7 AS VARCHAR), 11, '0') END"


@query(
    "listed_payments",
    f"""WITH {CON}, {INV}, g AS (SELECT l_orderkey AS invoice_id, count(DISTINCT l_suppkey) AS negotiated, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ', ' ORDER BY CAST(l_suppkey AS VARCHAR)) AS originals FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
       k AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_queue, max(ts) AS last_ticket FROM events WHERE event_type IN ('error', 'purchase') GROUP BY 1)
       SELECT inv.invoice_id, contract_id, con.client_id, amount, due, paid_on, CASE c_custkey % 3 WHEN 0 THEN 'J' WHEN 1 THEN 'F' END || {DOCUMENT} AS document, last_queue, last_ticket, negotiated, originals
       FROM inv JOIN con ON invoice_id = contract_id JOIN customer ON con.client_id = c_custkey LEFT JOIN g USING (invoice_id) LEFT JOIN k ON user_id = con.client_id
       WHERE cancelled IS NOT NULL AND c_acctbal < 3000 AND (paid_on IS NULL OR paid_on >= DATE '{AS_OF}' - 900)""",
)
def _(t):
    billed = invoices(t).select("invoice_id", F.col("invoice_id").alias("contract_id"), "amount", "due", "paid_on")
    asked = t.events.where(F.col("event_type").isin("error", "purchase")).select(
        F.col("user_id").alias("client_id"), F.col("event_id").alias("ticket_id"), F.col("ts").alias("opened"), F.col("event_type").alias("queue")
    )
    dealt = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("invoice_id"), F.col("l_suppkey").alias("original"))
    recent = F.col("paid_on").isNull() | (F.col("paid_on") >= F.date_sub(day(), 900))
    return contract_plans.listed_payments(contracts(t), _people(t), billed, asked, dealt, F.col("balance") < 3000, recent)


def _dialled(t):
    return t.events.select(
        F.col("event_id").alias("call_id"), F.col("ts").alias("started"), F.col("event_type").alias("campaign"),
        (F.col("user_id") % 9).alias("agent"), F.floor("value").alias("contract_id"),
    )


@query(
    "outbound_calls",
    """SELECT event_id AS call_id, ts AS started, event_type AS campaign, user_id % 9 AS agent, CASE WHEN ts < TIMESTAMP '2024-01-15' AND event_type = 'view' THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS contract_id,
         md5(CAST(event_id AS VARCHAR)) AS call_key FROM events WHERE NOT (event_id % 11 = 0 AND ts < TIMESTAMP '2024-01-15')""",
)
def _(t):
    """The old system's rows are text, some without a readable start or contract; half of all are stored before."""
    every = _dialled(t)
    number = F.when(F.col("campaign") == "view", "none").otherwise(F.concat(F.col("contract_id").cast("string"), F.lit(".0")))
    start = F.when(F.col("call_id") % 11 == 0, "?").otherwise(F.col("started").cast("string"))
    old = every.withColumns({"contract_id": number, "started": start})
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    before = calls.outbound_calls(old.where("call_id % 2 = 0"), every.where("call_id % 2 = 0"), cut, ["contract_id"])
    return calls.outbound_calls(old, every, cut, ["contract_id"], before)


def _states(t):
    held = F.floor("value").cast("int")
    clock = F.concat_ws(":", F.lpad((held / 60).cast("int").cast("string"), 2, "0"), F.lpad((held % 60).cast("string"), 2, "0"), F.lit("07"))
    every = t.events.select((F.col("user_id") % 9).alias("agent"), F.col("ts").alias("since"), F.col("event_type").alias("state"), "event_id", clock.alias("held"))
    old = every.withColumns({"since": F.col("since").cast("string"), "held": F.when(F.col("event_id") % 17 == 0, "-").otherwise(F.col("held"))})
    return calls.agent_states(old, every, F.lit("2024-01-15").cast("timestamp_ntz"))


STATES = """st AS (SELECT user_id % 9 AS agent, ts AS since, event_type AS state, event_id, CASE WHEN ts < TIMESTAMP '2024-01-15' AND event_id % 17 = 0 THEN '-'
    ELSE lpad(CAST(CAST(floor(value) AS INTEGER) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(CAST(floor(value) AS INTEGER) % 60 AS VARCHAR), 2, '0') || ':07' END AS held FROM events),
  states AS (SELECT *, CASE WHEN held = '-' THEN 0 ELSE CAST(split_part(held, ':', 1) AS INTEGER) * 3600 + CAST(split_part(held, ':', 2) AS INTEGER) * 60 + 7 END AS held_seconds FROM st)"""


@query("agent_states", f"WITH {STATES} SELECT agent, since, state, event_id, held, held_seconds FROM states")
def _(t):
    return _states(t).drop("state_key")


@query(
    "agent_day",
    f"""WITH {STATES}, d AS (SELECT agent, CAST(since AS DATE) AS day, CAST(sum(held_seconds) AS BIGINT) AS seconds, CAST(sum(CASE WHEN state IN ('click', 'purchase') THEN held_seconds ELSE 0 END) AS BIGINT) AS working_seconds FROM states GROUP BY 1, 2)
       SELECT *, CASE WHEN seconds <> 0 THEN working_seconds / seconds END AS occupancy FROM d""",
)
def _(t):
    return calls.agent_day(_states(t), F.col("state").isin("click", "purchase"))


@query(
    "point_clients",
    f"""WITH {ACC}, p AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN user_id + 1 ELSE user_id END AS contract_id, {DOCUMENT.replace("c_custkey", "user_id")} AS tax_id FROM events WHERE event_type = 'error')
       SELECT event_id, p.contract_id, tax_id, client_id, unit_id, n_name AS city FROM p
       LEFT JOIN (SELECT acc.*, {DOCUMENT} AS doc FROM acc JOIN customer ON client_id = c_custkey) a ON p.contract_id = a.contract_id AND tax_id = doc LEFT JOIN nation ON a.contract_id % 30 = n_nationkey""",
)
def _(t):
    """Every fourth point names a contract of somebody else."""
    key = F.col("user_id")
    digits = F.lpad((key * 7).cast("string"), 11, "0")
    points = t.events.where("event_type = 'error'").select(
        "event_id", F.when(F.col("event_id") % 4 == 0, key + 1).otherwise(key).alias("contract_id"),
        F.when(key % 3 == 0, F.concat(digits, F.lit("0001"))).otherwise(digits).alias("tax_id"),
    )
    places = t.nation.select(F.col("n_nationkey").cast("bigint").alias("address_id"), F.col("n_name").alias("city"))
    return calls.point_clients(points, accounts(t).withColumn("address_id", F.col("contract_id") % 30), _people(t), places)


@query(
    "incident_devices",
    f"""WITH {CON} SELECT DISTINCT CAST(ts AS DATE) AS day, ts AS created, address_id AS unit_id, n_name AS unit, event_id % 120 AS incident_id, 'SN' || user_id AS serial, CASE WHEN s_acctbal > 5000 THEN 'RUNNING' ELSE 'ENDED' END AS state
       FROM events JOIN con ON client_id = user_id JOIN supplier ON event_id % 120 = s_suppkey LEFT JOIN nation ON address_id = n_nationkey
       WHERE event_type = 'error' AND event_id % 5 <> 0 AND cancelled IS NULL AND user_id % 10 <> 3 AND contract_id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def _(t):
    alarms = t.events.select(
        F.col("user_id").alias("device_id"), F.col("ts").alias("created"), F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 120).alias("incident_id"), "event_type"
    )
    serial = F.concat(F.lit("SN"), "c_custkey")
    devices = t.customer.where("c_custkey % 10 <> 3").select(F.col("c_custkey").alias("device_id"), serial.alias("serial"))
    con = contracts(t).withColumn("unit_id", F.col("address_id"))
    links = con.select(F.concat(F.lit("SN"), "client_id").alias("serial"), "contract_id")
    warned = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("contract_id"))
    incidents = t.supplier.select(F.col("s_suppkey").alias("incident_id"), F.when(F.col("s_acctbal") > 5000, "OPEN").otherwise("CLOSED").alias("status"))
    units = t.nation.select(F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("unit"))
    return operations.incident_devices(
        alarms, devices, links, con, warned, incidents, units, F.col("event_type") == "error", F.col("cancelled").isNull()
    )


@query(
    "dispatch_orders",
    f"""SELECT event_id AS message_id, ts AS sent, event_type AS delivery, event_id * 3 AS order_id, user_id AS client_id, user_id * 10 AS contract_id, CASE WHEN o_orderpriority LIKE '%HIGH%' THEN 'REPAIR' WHEN o_orderpriority LIKE '1-%' THEN 'ACTIVATION' ELSE o_orderpriority END AS queue,
         o_custkey % 25 AS unit_id, paid_on AS confirmed, CASE WHEN o_orderkey % 8 = 1 THEN 'REBOOKED' WHEN o_orderstatus = 'P' THEN 'CANCELLED' WHEN paid_on IS NOT NULL THEN 'CONFIRMED' ELSE 'NOT CONFIRMED' END AS outcome
       FROM events LEFT JOIN (WITH {INV} SELECT orders.*, paid_on FROM orders JOIN inv ON o_orderkey = invoice_id) o ON event_id * 3 = o_orderkey WHERE event_type <> 'view' AND CAST(ts AS DATE) <= DATE '2024-01-20'""",
)
def _(t):
    messages = t.events.select(F.col("event_id").alias("message_id"), F.col("ts").alias("sent"), F.col("event_type").alias("delivery"))
    notices = t.events.where("event_type <> 'view'").select(
        F.col("event_id").alias("message_id"), (F.col("event_id") * 3).alias("order_id"), F.col("user_id").alias("client_id"), (F.col("user_id") * 10).alias("contract_id")
    )
    orders = invoices(t).select("invoice_id", "client_id", "kind", "status", "paid_on").select(
        F.col("invoice_id").alias("order_id"), F.col("kind").alias("queue"), (F.col("client_id") % 25).alias("unit_id"), F.col("paid_on").alias("confirmed"), "status"
    )
    queues = [(F.col("queue").like("%HIGH%"), "REPAIR"), (F.col("queue").like("1-%"), "ACTIVATION")]
    return operations.dispatch_orders(messages, notices, orders, day("2024-01-20"), queues, F.col("order_id") % 8 == 1, F.col("status") == "P")


@query(
    "order_dimension",
    f"""WITH {LINES}, e AS (SELECT l_orderkey, l_linenumber, "at", CASE flag WHEN 'A' THEN 'START' WHEN 'R' THEN 'FINISH' ELSE 'NOTE' END AS kind, CASE WHEN part % 3 = 0 THEN 'SYSTEM' ELSE 'user ' || (part % 20) END AS who FROM lines),
       f AS (SELECT l_orderkey, arg_max(kind, ("at", l_linenumber)) AS event, max("at") AS event_at, min("at") FILTER (kind = 'START') AS work_began, arg_min(who, ("at", l_linenumber)) FILTER (kind = 'FINISH') AS closer FROM e GROUP BY 1)
       SELECT o_orderkey AS order_id, o_custkey AS ticket_id, o_orderdate AS opened, o_orderkey % 130 AS technician_id, s_name AS technician, 'queue of ' || r_name AS queue, coalesce(n.n_name, 'OWN') AS contractor, 'MTV_' || (o_orderkey % 40) AS reason_code,
         m.n_name AS reason, CASE WHEN o_orderkey % 40 < 15 THEN 'DONE' WHEN m.n_regionkey = 2 THEN 'CANCELLED' END AS conclusion, event, event_at, work_began, CASE WHEN closer = 'SYSTEM' THEN s_name ELSE closer END AS closed_by
       FROM orders LEFT JOIN supplier ON s_suppkey = o_orderkey % 130 LEFT JOIN nation n ON n.n_nationkey = s_nationkey AND n.n_regionkey <> 1 LEFT JOIN region ON r_regionkey = o_orderkey % 6 LEFT JOIN nation m ON m.n_nationkey = o_orderkey % 40 LEFT JOIN f ON l_orderkey = o_orderkey""",
)
def _(t):
    key = F.col("o_orderkey")
    orders = t.orders.select(
        key.alias("order_id"), F.col("o_custkey").alias("ticket_id"), F.col("o_orderdate").alias("opened"), (key % 130).alias("technician_id"),
        (key % 6).alias("queue_code"), F.concat(F.lit("MTV_"), key % 40).alias("reason_code"),
    )
    kind = F.when(F.col("flag") == "A", "START").when(F.col("flag") == "R", "FINISH").otherwise("NOTE")
    who = F.when(F.col("part") % 3 == 0, "SYSTEM").otherwise(F.concat(F.lit("user "), F.col("part") % 20))
    events = lines(t).select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("event_id"), "at", kind.alias("kind"), who.alias("user"))
    technicians = t.supplier.select(F.col("s_suppkey").alias("technician_id"), F.col("s_name").alias("technician"), F.col("s_nationkey").alias("contractor_id"))
    contractors = t.nation.where("n_regionkey <> 1").select(F.col("n_nationkey").alias("contractor_id"), F.col("n_name").alias("contractor"))
    queues = t.region.select(F.col("r_regionkey").alias("queue_code"), F.concat(F.lit("queue of "), "r_name").alias("queue"))
    reasons = t.nation.select(F.concat(F.lit("MTV_"), "n_nationkey").alias("reason_code"), F.col("n_name").alias("reason"), F.col("n_regionkey").alias("reason_group"))
    done = F.regexp_extract("reason_code", r"(\d+)", 1).cast("int") < 15
    return fieldservice.order_dimension(
        orders, events, technicians, contractors, queues, reasons, "START", "FINISH",
        [(done, "DONE"), (F.col("reason_group") == 2, "CANCELLED")], "SYSTEM", "OWN",
    )


@query(
    "cancelled_month",
    f"""WITH {ACC}, {INV}, i AS (SELECT invoice_id, client_id AS contract_id, issued + CAST(invoice_id % 20 AS INTEGER) AS updated, due, amount FROM inv WHERE status = 'F'),
       a AS (SELECT o_custkey AS contract_id, arg_max('CITY ' || (o_orderkey % 40), o_orderkey) AS city, CAST(max(o_orderkey) % 25 AS INTEGER) AS u FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
       k AS (SELECT acc.*, city, coalesce(u, acc.unit_id) AS place, segment = 'BUILDING' AS b2b, segment = 'AUTOMOBILE' AS pme FROM acc LEFT JOIN a USING (contract_id))
       SELECT invoice_id, i.contract_id, client_id, updated, due, amount, CASE WHEN b2b THEN 'B2B' WHEN pme THEN 'PME' ELSE 'B2C' END AS segment,
         CASE WHEN b2b THEN 'LEGAL' ELSE 'NATURAL' END || CASE WHEN client_id % 5 = 0 AND (b2b OR pme) THEN '-PUBLIC' ELSE '' END AS person, city, n_name AS brand,
         CASE WHEN n_name LIKE '%A' THEN 'NORTH' WHEN n_name LIKE '%N%' THEN 'SOUTH' END AS hub, CAST(date_trunc('month', updated) AS DATE) AS month
       FROM i LEFT JOIN k USING (contract_id) LEFT JOIN nation ON place = n_nationkey WHERE updated >= DATE '2000-04-01' AND updated < DATE '2000-07-01'""",
)
def _(t):
    """Three months, the second of them run twice."""
    gone = invoices(t).select(
        "invoice_id", F.col("client_id").alias("contract_id"), F.when(F.col("status") == "F", "CANCELLED").alias("status"),
        F.date_add("issued", (F.col("invoice_id") % 20).cast("int")).alias("updated"), "due", "amount",
    )
    con = accounts(t).select(
        "contract_id", "client_id", "unit_id", (F.col("segment") == "BUILDING").alias("business"), (F.col("segment") == "AUTOMOBILE").alias("small"),
        (F.col("client_id") % 5 == 0).alias("public"),
    )
    key = F.col("o_orderkey")
    places = t.orders.where("o_orderstatus = 'O'").select(
        F.col("o_custkey").alias("contract_id"), key.alias("address_id"), F.concat(F.lit("CITY "), key % 40).alias("city"), (key % 25).cast("int").alias("unit_id")
    )
    units = t.nation.select(F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("brand"))
    hubs = [(F.col("brand").like("%A"), "NORTH"), (F.col("brand").like("%N%"), "SOUTH")]
    lake, place = Lake(t.spark, work_dir(t.spark, "cancelled")), ("gold", "billing", "cancelled_invoices")
    for ref in ("2000-04-30", "2000-05-20", "2000-05-31", "2000-06-15"):
        receivables.store_cancelled_month(lake, place, receivables.cancelled_month(gone, con, places, units, hubs, day(ref)))
    return lake.read(*place)
