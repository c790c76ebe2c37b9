from pyspark.sql import functions as F

from tidemark.plans import contracts as plans
from tidemark.plans import partner_tv
from tidemark.queries.registry import query
from tidemark.queries.testbed import ACC, AS_OF, CON, INV, accounts, contracts, day, invoices
from tidemark.sources.lake import Lake, work_dir

def _channels():
    return [
        (F.col("segment") == "BUILDING", "CORPORATE"), (F.col("plan").like("1-%"), "TELESALES"), (F.col("plan").like("5-%"), "STORE")
    ]


@query(
    "contract_360",
    f"""WITH {CON}, i AS (SELECT l_orderkey AS contract_id, count(*) FILTER (l_linenumber > 1) AS add_ons, max(l_shipdate) AS last_item,
           CAST(sum(CASE WHEN l_linenumber = 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS plan_value,
           CAST(sum(CASE WHEN l_linenumber > 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS add_on_value,
           string_agg(DISTINCT CASE WHEN l_linenumber > 1 THEN 'flag ' || l_returnflag END, '; ' ORDER BY CASE WHEN l_linenumber > 1 THEN 'flag ' || l_returnflag END) AS add_on_names
         FROM lineitem GROUP BY 1)
       SELECT con.contract_id, client_id, c_mktsegment AS segment, plan, price, activated, cancelled, plan_value, add_on_value, add_ons, add_on_names, last_item,
         CAST(DATE '{AS_OF}' - activated <= 365 AS INTEGER) AS in_loyalty,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 'CORPORATE' WHEN plan LIKE '1-%' THEN 'TELESALES' WHEN plan LIKE '5-%' THEN 'STORE' ELSE 'DIGITAL' END AS channel
       FROM con LEFT JOIN customer ON client_id = c_custkey LEFT JOIN i USING (contract_id)""",
)
def _(t):
    items = t.lineitem.select(
        F.col("l_orderkey").alias("contract_id"), "l_linenumber", F.col("l_extendedprice").alias("price"),
        F.concat(F.lit("flag "), "l_returnflag").alias("name"), F.col("l_shipdate").alias("sold"),
    )
    clients = t.customer.select(F.col("c_custkey").alias("client_id"), F.col("c_mktsegment").alias("segment"))
    return plans.contract_360(contracts(t), clients, items, F.col("l_linenumber") > 1, 365, day(), _channels(), "DIGITAL")


@query(
    "contract_status",
    f"""WITH {CON} SELECT contract_id, client_id, activated, cancelled, CASE WHEN cancelled IS NULL THEN 'ACTIVE' ELSE 'CANCELLED' END AS status,
         CASE WHEN cancelled IS NULL THEN 'NONE' WHEN cancelled < activated + 7 THEN 'BEFORE ACTIVATION' WHEN plan IN ('1-URGENT', '2-HIGH') THEN 'VOLUNTARY' ELSE 'INVOLUNTARY' END AS cancellation_type
       FROM con WHERE client_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9500)""",
)
def _(t):
    own = t.customer.where("c_acctbal > 9500").select(F.col("c_custkey").alias("client_id"))
    return plans.contract_status(contracts(t), own, F.col("plan").isin("1-URGENT", "2-HIGH"))


@query(
    "first_activation",
    f"""WITH {CON}, x AS (SELECT client_id, contract_id, activated, CASE WHEN activated < DATE '1998-01-01' THEN 'legacy' ELSE 'current' END AS origin FROM con)
       SELECT client_id, contract_id, activated, origin, isodow(activated) <= 5 AND strftime(activated, '%m-%d') <> '01-01' AS working_day FROM x
       QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY activated, contract_id) = 1""",
)
def _(t):
    con = contracts(t).select("client_id", "contract_id", "activated")
    new_years = t.orders.select(F.trunc("o_orderdate", "YEAR").alias("day")).distinct()
    return plans.first_activation(
        con.withColumn("origin", F.lit("legacy")), con.withColumn("origin", F.lit("current")), day("1998-01-01"), new_years
    )


@query(
    "cancellation_fact",
    f"""WITH {CON}, g AS (SELECT *, (date_diff('month', activated, cancelled) - CASE WHEN day(activated) > day(cancelled) THEN 1 ELSE 0 END) AS m FROM con WHERE cancelled <= DATE '{AS_OF}')
       SELECT contract_id, client_id, plan, activated, cancelled, cancelled - activated AS lived_days,
         CASE WHEN m <= 3 THEN '0-3' WHEN m <= 6 THEN '4-6' WHEN m <= 12 THEN '7-12' ELSE '13+' END AS tenure
       FROM g WHERE contract_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50)""",
)
def _(t):
    excluded = t.lineitem.where("l_quantity = 50").select(F.col("l_orderkey").alias("contract_id"))
    return plans.cancellation_fact(contracts(t), excluded, day())


@query(
    "big_base",
    f"""WITH {CON}, d AS (SELECT l_orderkey AS contract_id, l_returnflag AS category, CAST(l_shipdate AS DATE) AS b, CAST(l_shipdate AS DATE) + 200 AS e, l_discount * 100 AS p FROM lineitem),
       k AS (SELECT * FROM d WHERE b <= DATE '{AS_OF}' AND e >= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY contract_id, category ORDER BY e DESC, p DESC) = 1),
       w AS (SELECT contract_id, max(CASE WHEN category = 'A' THEN p END) AS campaign, max(CASE WHEN category = 'N' THEN p END) AS retention, max(CASE WHEN category = 'R' THEN p END) AS loyalty FROM k GROUP BY 1)
       SELECT con.contract_id, client_id, plan, price, campaign, retention, loyalty,
         least(0.0::DOUBLE + coalesce(campaign, 0) + coalesce(retention, 0) + coalesce(loyalty, 0), 100) AS total_percent,
         price * (1 - least(0.0::DOUBLE + coalesce(campaign, 0) + coalesce(retention, 0) + coalesce(loyalty, 0), 100) / 100) AS final_price
       FROM con LEFT JOIN w USING (contract_id) WHERE activated <= DATE '{AS_OF}' AND (cancelled IS NULL OR cancelled > DATE '{AS_OF}')""",
)
def _(t):
    begun = F.to_date("l_shipdate")
    discounts = t.lineitem.select(
        F.col("l_orderkey").alias("contract_id"), F.col("l_returnflag").alias("category"), begun.alias("begun"),
        F.date_add(begun, 200).alias("ended"), (F.col("l_discount") * 100).alias("percent"),
    )
    return plans.big_base(contracts(t), discounts, day(), {"A": "campaign", "N": "retention", "R": "loyalty"})


def _base_of(t, ref):
    """The big base as it was on a day, with the day and its month."""
    begun = F.to_date("l_shipdate")
    discounts = t.lineitem.select(
        F.col("l_orderkey").alias("contract_id"), F.col("l_returnflag").alias("category"), begun.alias("begun"),
        F.date_add(begun, 200).alias("ended"), (F.col("l_discount") * 100).alias("percent"),
    )
    found = plans.big_base(contracts(t), discounts, day(ref), {"A": "campaign", "N": "retention", "R": "loyalty"})
    return found.select("contract_id", "plan", "total_percent", "final_price", day(ref).alias("reference"), F.trunc(day(ref), "MM").alias("month"))


@query(
    "big_base_months",
    f"""WITH {CON}, m AS (SELECT unnest([DATE '2001-03-31', DATE '2001-04-30', DATE '2001-05-31']) AS reference),
       d AS (SELECT l_orderkey AS contract_id, l_returnflag AS category, CAST(l_shipdate AS DATE) AS b, CAST(l_shipdate AS DATE) + 200 AS e, l_discount * 100 AS p FROM lineitem),
       k AS (SELECT d.*, reference FROM d JOIN m ON b <= reference AND e >= reference QUALIFY row_number() OVER (PARTITION BY contract_id, category, reference ORDER BY e DESC, p DESC) = 1),
       w AS (SELECT contract_id, reference, max(CASE WHEN category = 'A' THEN p END) AS c, max(CASE WHEN category = 'N' THEN p END) AS n, max(CASE WHEN category = 'R' THEN p END) AS r FROM k GROUP BY 1, 2),
       x AS (SELECT con.*, m.reference, least(0.0::DOUBLE + coalesce(c, 0) + coalesce(n, 0) + coalesce(r, 0), 100) AS total_percent FROM con JOIN m ON activated <= m.reference AND (cancelled IS NULL OR cancelled > m.reference)
             LEFT JOIN w ON w.contract_id = con.contract_id AND w.reference = m.reference)
       SELECT contract_id, plan, total_percent, price * (1 - total_percent / 100) AS final_price, reference, CAST(date_trunc('month', reference) AS DATE) AS month FROM x
       WHERE reference = DATE '2001-05-31' OR NOT coalesce(contract_id % 3 = 0 AND cancelled - 20 <= reference, FALSE)""",
)
def _(t):
    """Two months are stored; by the third, some contracts turn out to have ended twenty days earlier."""
    lake, place = Lake(t.spark, work_dir(t.spark, "big-base")), ("gold", "reports", "big_base")
    known = contracts(t)
    for ref in ("2001-03-31", "2001-04-30"):
        lake.replace_periods(_base_of(t, ref), *place, "month")
    today = known.withColumn("cancelled", F.when(F.col("contract_id") % 3 == 0, F.date_sub("cancelled", 20)).otherwise(F.col("cancelled")))
    plans.store_big_base(lake, place, _base_of(t, "2001-05-31"), today)
    return lake.read(*place)


TV = {"streaming": "%U%", "sports": "%H%", "kids": "%LOW"}


def _subscribed(t, ref, number):
    """Contracts of a month end; every fifth has another plan each month."""
    alive = contracts(t).where((F.col("activated") <= day(ref)) & (F.col("cancelled").isNull() | (F.col("cancelled") > day(ref))))
    plan = F.when((F.col("contract_id") + number) % 5 == 0, "5-LOW").otherwise(F.col("plan"))
    status = F.when(F.col("contract_id") % 9 == number, "SUSPENDED").otherwise("ENABLED")
    return alive.select("contract_id", plan.alias("plan"), status.alias("status"))


@query(
    "partner_tv_months",
    f"""WITH {CON}, m AS (SELECT * FROM (VALUES (4, DATE '2001-04-30', DATE '2001-04-01'), (5, DATE '2001-05-31', DATE '2001-05-01'), (6, DATE '2001-06-30', DATE '2001-06-01')) AS v(no, ref, month)),
       s AS (SELECT contract_id, m.no, m.month, CASE WHEN (contract_id + no) % 5 = 0 THEN '5-LOW' ELSE plan END AS plan, CASE WHEN contract_id % 9 = no THEN 'SUSPENDED' ELSE 'ENABLED' END AS status
             FROM con JOIN m ON activated <= ref AND (cancelled IS NULL OR cancelled > ref)),
       f AS (SELECT contract_id, feature, no, month, plan, status, CAST(status = 'SUSPENDED' AS INTEGER) AS suspended FROM s
             JOIN (VALUES ('streaming', '%U%'), ('sports', '%H%'), ('kids', '%LOW')) AS p(feature, pattern) ON plan LIKE pattern),
       j AS (SELECT coalesce(a.contract_id, b.contract_id) AS contract_id, coalesce(a.feature, b.feature) AS feature, coalesce(a.no, b.no + 1) AS no, a.plan, a.status, a.suspended,
               b.plan AS previous_plan, b.status AS previous_status, b.suspended AS previous_suspended, a.plan IS NULL AS lost, b.plan IS NULL AS gained
             FROM f a FULL JOIN f b ON a.contract_id = b.contract_id AND a.feature = b.feature AND a.no = b.no + 1)
       SELECT contract_id, feature, m.month, plan, status, suspended, previous_plan, previous_status, previous_suspended,
         CASE WHEN gained THEN 'GAINED' WHEN lost THEN 'LOST' WHEN plan = previous_plan AND status = previous_status THEN 'KEPT' ELSE 'CHANGED' END AS change FROM j JOIN m USING (no)""",
)
def _(t):
    """Three months, the last one run twice."""
    lake, place = Lake(t.spark, work_dir(t.spark, "partner-tv")), ("gold", "reports", "partner_tv")
    for ref, number in (("2001-04-30", 4), ("2001-05-31", 5), ("2001-06-30", 6), ("2001-06-30", 6)):
        partner_tv.partner_tv_month(lake, place, _subscribed(t, ref, number), TV, ["SUSPENDED"], day(ref))
    return lake.read(*place)


@query(
    "partner_tv_failed",
    """WITH p AS (SELECT 'signal' AS provider, o_orderkey AS subscriber_id, o_orderdate AS created, o_orderstatus = 'F' AS active, CASE o_orderkey % 3 WHEN 0 THEN 'activate' WHEN 1 THEN 'cancel' ELSE 'change' END AS state FROM orders WHERE o_orderkey % 2 = 0
                  UNION ALL SELECT 'cinema', o_orderkey, o_orderdate, o_orderstatus = 'O', CASE o_orderkey % 3 WHEN 0 THEN 'activate' WHEN 1 THEN 'cancel' ELSE 'change' END FROM orders WHERE o_orderkey % 2 = 1)
       SELECT provider, subscriber_id, created, state, CAST(date_trunc('month', created) AS DATE) AS month FROM p
       WHERE NOT active AND state IN ('activate', 'cancel') AND created >= TIMESTAMP '2001-04-01' AND created < TIMESTAMP '2001-06-01'""",
)
def _(t):
    def provider(rest, active):
        state = F.when(F.col("o_orderkey") % 3 == 0, "activate").when(F.col("o_orderkey") % 3 == 1, "cancel").otherwise("change")
        return t.orders.where(F.col("o_orderkey") % 2 == rest).select(
            F.col("o_orderkey").alias("subscriber_id"), F.col("o_orderdate").alias("created"), (F.col("o_orderstatus") == active).alias("active"), state.alias("state")
        )

    lake, place = Lake(t.spark, work_dir(t.spark, "partner-tv")), ("gold", "reports", "partner_tv_failed")
    for ref in ("2001-04-30", "2001-05-31", "2001-05-31"):
        partner_tv.store_failed_activations(lake, place, {"signal": provider(0, "F"), "cinema": provider(1, "O")}, ["activate", "cancel"], day(ref))
    return lake.read(*place).drop("active")


@query(
    "contract_sheet",
    f"""WITH {CON}, s AS (SELECT l_orderkey AS contract_id, CAST(l_quantity AS INTEGER) * (CASE WHEN l_tax > 0.04 THEN 1000 ELSE 1 END) AS v FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey * 100 + l_linenumber DESC) = 1),
       m AS (SELECT l_orderkey AS contract_id, string_agg(DISTINCT l_returnflag || l_linestatus, ', ' ORDER BY l_returnflag || l_linestatus) AS markers FROM lineitem GROUP BY 1)
       SELECT contract_id, client_id, activated, CAST(v AS DOUBLE) AS mbps, markers FROM con LEFT JOIN s USING (contract_id) LEFT JOIN m USING (contract_id)""",
)
def _(t):
    unit = F.when(F.col("l_tax") > 0.04, "G").otherwise(" MBPS")
    speeds = t.lineitem.select(
        F.col("l_orderkey").alias("contract_id"), F.col("l_shipdate").alias("day"),
        (F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("version_id"), F.concat(F.col("l_quantity").cast("int"), unit).alias("label"),
    )
    markers = t.lineitem.select(F.col("l_orderkey").alias("contract_id"), F.concat("l_returnflag", "l_linestatus").alias("marker"))
    return plans.contract_sheet(contracts(t), speeds, markers)


@query(
    "status_reconciliation",
    f"""WITH {ACC}, a AS (SELECT contract_id, CASE WHEN cancelled IS NULL THEN 'ON' ELSE 'OFF' END AS s FROM acc),
       b AS (SELECT user_id AS contract_id, CASE WHEN event_type = 'error' THEN 'OFF' ELSE 'ON' END AS s FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
       SELECT coalesce(a.contract_id, b.contract_id) AS contract_id, a.s AS own_state, b.s AS provider_state,
         CASE WHEN a.s IS NULL THEN 'ONLY PROVIDER' WHEN b.s IS NULL THEN 'ONLY OWN' WHEN a.s = b.s THEN 'AGREES' ELSE 'DIFFERS' END AS verdict
       FROM a FULL JOIN b ON a.contract_id = b.contract_id""",
)
def _(t):
    from tidemark.operators.latest import latest_version

    own = accounts(t).select("contract_id", F.when(F.col("cancelled").isNull(), "ON").otherwise("OFF").alias("state"))
    newest = latest_version(t.events, ["user_id"], ["ts", "event_id"])
    provider = newest.select(F.col("user_id").alias("contract_id"), F.when(F.col("event_type") == "error", "OFF").otherwise("ON").alias("state"))
    return plans.status_reconciliation(own, provider, ["contract_id"])


@query(
    "to_suspend",
    f"""WITH {ACC}, {INV} SELECT contract_id, acc.client_id, count(*) AS late_invoices, min(due) AS oldest_due, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS owed
       FROM acc JOIN inv ON inv.client_id = contract_id WHERE cancelled IS NULL AND paid_on IS NULL AND due < DATE '{AS_OF}' - 11 GROUP BY ALL""",
)
def _(t):
    billed = invoices(t).withColumn("contract_id", F.col("client_id")).drop("client_id")
    return plans.to_suspend(accounts(t), billed, day())


@query(
    "latest_event_with_ref",
    """SELECT user_id, event_id, ts, CASE WHEN event_type = 'error' THEN NULL ELSE event_id * 7 END AS reference FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(t):
    note = F.when(F.col("event_type") == "error", "suspended by hand").otherwise(
        F.concat(F.lit("suspended, invoice: "), F.col("event_id") * 7, F.lit(" unpaid"))
    )
    log = t.events.withColumn("note", note)
    return plans.latest_event_with_ref(log, "user_id", "ts", "event_id", "note", "invoice: ", 18)


@query(
    "cancellation_requests",
    """WITH r AS (SELECT o_orderkey AS request_id, o_custkey AS contract_id, CAST(o_orderdate AS DATE) AS day, o_orderpriority AS reason FROM orders WHERE o_orderstatus IN ('F', 'P')),
       g AS (SELECT *, CASE WHEN reason LIKE '1-%' THEN 'COMPETITION' WHEN reason IN ('2-HIGH', '3-MEDIUM') THEN 'PRICE' ELSE 'OTHER' END AS reason_group FROM r)
       SELECT a.*, count(b.request_id) AS requests_before, arg_max(b.request_id, (b.day, b.request_id)) AS last_request
       FROM g a LEFT JOIN r b ON a.contract_id = b.contract_id AND b.day BETWEEN a.day - 90 AND a.day - 1 GROUP BY ALL""",
)
def _(t):
    pick = lambda s: t.orders.where(F.col("o_orderstatus") == s).select(
        F.col("o_orderkey").alias("request_id"), F.col("o_custkey").alias("contract_id"), F.to_date("o_orderdate").alias("day"),
        F.col("o_orderpriority").alias("reason"),
    )
    reason = F.col("reason")
    groups = [(reason.like("1-%"), "COMPETITION"), (reason.isin("2-HIGH", "3-MEDIUM"), "PRICE")]
    return plans.cancellation_requests(pick("P"), pick("F"), groups).select(
        "request_id", "contract_id", "day", "reason", "reason_group", "requests_before", "last_request"
    )


@query(
    "enabled_contracts_log",
    f"""WITH {ACC}, {INV}, l AS (SELECT user_id AS contract_id, max(ts) - INTERVAL 8280 DAY AS last_login FROM events WHERE CAST(ts - INTERVAL 8280 DAY AS DATE) <= DATE '{AS_OF}' GROUP BY 1),
       b AS (SELECT client_id AS contract_id, arg_max(invoice_id, (issued, invoice_id)) AS last_invoice FROM inv WHERE issued <= DATE '{AS_OF}' GROUP BY 1)
       SELECT contract_id, DATE '{AS_OF}' AS day, CASE WHEN cancelled IS NULL OR cancelled > DATE '{AS_OF}' THEN 'ENABLED' ELSE 'CANCELLED' END AS status, last_login, last_invoice
       FROM acc LEFT JOIN l USING (contract_id) LEFT JOIN b USING (contract_id)""",
)
def _(t):
    logins = t.events.select(F.col("user_id").alias("contract_id"), (F.col("ts") - F.expr("interval 8280 days")).alias("ts"))
    billed = invoices(t).withColumn("contract_id", F.col("client_id")).drop("client_id")
    return plans.enabled_log(accounts(t), logins, billed, day())
