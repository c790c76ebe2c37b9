from pyspark.sql import functions as F

from tidemark.operators.latest import latest_version
from tidemark.operators.reshape import date_grid
from tidemark.plans import calls as call_plans
from tidemark.plans import churn, fieldservice, first_payment, operations, sales
from tidemark.queries.registry import query
from tidemark.queries.testbed import ACC, AS_OF, CALLS, EV_AS_OF, INV, accounts, calls, day, invoices


def _billed(t):
    return invoices(t).withColumn("contract_id", F.col("client_id")).drop("client_id")


@query(
    "sales_fact",
    """WITH c AS (SELECT l_orderkey AS contract_id, l_partkey * 100 + l_linenumber AS campaign_id, l_shipdate AS b, l_discount * 100 AS percent, CAST(l_quantity AS INTEGER) % 15 AS months FROM lineitem
           QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey * 100 + l_linenumber) = 1)
       SELECT o_orderkey AS sale_id, o_orderkey AS contract_id, o_custkey AS client_id, CAST(o_orderdate AS DATE) AS sold, o_totalprice AS price, campaign_id, s_name AS seller,
         o_totalprice * (1 - coalesce(percent, 0) / 100) AS final_price,
         (o_totalprice * (1 - coalesce(percent, 0) / 100) * least(coalesce(months, 0), 12) + o_totalprice * (12 - least(coalesce(months, 0), 12))) / 12 AS mean_ticket,
         coalesce(months, 0) AS discount_months,
         CASE WHEN o_orderpriority LIKE '1-%' THEN 'TELESALES' WHEN o_orderpriority ILIKE '%low' THEN 'STORE' ELSE 'DIGITAL' END AS channel,
         o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AS coupon_valid
       FROM orders LEFT JOIN c ON o_orderkey = contract_id LEFT JOIN supplier ON o_orderkey % 100 = s_suppkey""",
)
def _(t):
    sold = t.orders.select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_orderkey").alias("contract_id"), F.col("o_custkey").alias("client_id"),
        (F.col("o_orderkey") % 100).alias("seller_id"), F.to_date("o_orderdate").alias("sold"), F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("team"),
    )
    campaigns = t.lineitem.select(
        F.col("l_orderkey").alias("contract_id"), (F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("campaign_id"),
        F.col("l_shipdate").alias("begun"), (F.col("l_discount") * 100).alias("percent"), (F.col("l_quantity").cast("int") % 15).alias("months"),
    )
    coupons = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("client_id"))
    sellers = t.supplier.select(F.col("s_suppkey").alias("seller_id"), F.col("s_name").alias("seller"))
    return sales.sales_fact(sold, campaigns, coupons, sellers, [("1-%", "TELESALES"), ("%low", "STORE")])


@query(
    "hourly_sales",
    f"""SELECT date_trunc('hour', ts) AS hour, CASE WHEN user_id % 3 = 0 THEN 'STORE' WHEN user_id % 3 = 1 THEN 'TELESALES' ELSE 'DIGITAL' END AS channel,
         count(*) AS sales, count(DISTINCT user_id) AS clients FROM events
       WHERE event_type = 'purchase' AND ts >= DATE '{EV_AS_OF}' - 7 AND ts < DATE '{EV_AS_OF}' GROUP BY ALL""",
)
def _(t):
    team = F.element_at(F.array(F.lit("shop floor"), F.lit("phone desk"), F.lit("web")), (F.col("user_id") % 3 + 1).cast("int"))
    return sales.hourly_sales(
        t.events.withColumn("team", team), F.col("event_type") == "purchase", day(EV_AS_OF), 7,
        [("shop%", "STORE"), ("phone%", "TELESALES")], "team",
    )


INST = f"""{ACC}, {INV}, inst AS (SELECT contract_id, invoice_id, due, paid_on, amount, row_number() OVER (PARTITION BY contract_id ORDER BY due, invoice_id) AS n
  FROM inv JOIN acc ON inv.client_id = contract_id WHERE due >= activated)"""


@query(
    "fpd_flags",
    f"""WITH {INST}, x AS (SELECT *, coalesce(paid_on, DATE '{AS_OF}') - due AS late_days FROM inst WHERE n = 1)
       SELECT contract_id, invoice_id, due, paid_on, amount, late_days, CAST(due <= DATE '{AS_OF}' AS INTEGER) AS flag_fb, """
    + ", ".join(f"CAST(late_days >= {n} AS INTEGER) AS flag_fpd{n}d" for n in (1, 5, 10, 15, 20, 30))
    + " FROM x",
)
def _(t):
    return first_payment.fpd_flags(accounts(t), _billed(t), day())


@query(
    "fpd_refresh",
    f"""WITH {INST} SELECT contract_id, invoice_id, due, CASE WHEN due >= DATE '{AS_OF}' - 100 THEN paid_on END AS paid_on FROM inst WHERE n = 1""",
)
def _(t):
    new = first_payment.fpd_flags(accounts(t), _billed(t), day()).select("contract_id", "invoice_id", "due", "paid_on")
    stored = new.withColumn("paid_on", F.lit(None).cast("date"))
    return first_payment.refresh_fpd(new, stored, day())


SPD = f"""{INST}, s AS (SELECT contract_id, """ + ", ".join(
    f"max(CASE WHEN n = {n} THEN invoice_id END) AS {p}_invoice, max(CASE WHEN n = {n} THEN due END) AS {p}_due, max(CASE WHEN n = {n} THEN paid_on END) AS {p}_paid_on, "
    f"max(CASE WHEN n = {n} THEN DATE '{AS_OF}' - due END) AS {p}_age, max(CASE WHEN n = {n} THEN CAST(coalesce(paid_on, DATE '{AS_OF}') - due >= 30 AS INTEGER) END) AS {p}_late30"
    for n, p in ((1, "first"), (2, "second"))
) + f""" FROM inst WHERE n <= 2 GROUP BY 1),
 f AS (SELECT client_id AS contract_id, min(paid_on) AS p, max(CASE WHEN paid_on IS NULL THEN DATE '{AS_OF}' - due END) AS w FROM inv GROUP BY 1),
 spd AS (SELECT acc.contract_id, acc.client_id, activated, s.* EXCLUDE (contract_id), coalesce(p IS NULL AND first_age > 30, FALSE) AS never_paid,
   coalesce(activated < DATE '{AS_OF}' - 180 AND w > 30, FALSE) AS over30_in_6m FROM acc LEFT JOIN s USING (contract_id) LEFT JOIN f USING (contract_id))"""


@query("fpd_spd", f"WITH {SPD} SELECT * FROM spd")
def _(t):
    return first_payment.fpd_spd(accounts(t), _billed(t), day())


@query(
    "fpd_history",
    f"""WITH {SPD} SELECT * REPLACE (CASE WHEN first_invoice IS NULL OR first_age <= 35 THEN first_paid_on END AS first_paid_on) FROM spd""",
)
def _(t):
    new = first_payment.fpd_spd(accounts(t), _billed(t), day())
    stored = new.withColumn("first_paid_on", F.lit(None).cast("date"))
    return first_payment.refresh_history(stored, new)


@query(
    "fpd_outreach",
    f"""WITH {INST}, c AS (SELECT o_custkey AS contract_id, 'c' || CAST(o_orderkey AS VARCHAR) AS contact FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, 'c' || CAST(o_orderkey AS VARCHAR)) = 1)
       SELECT contract_id, invoice_id, n AS installment, due, amount, contact FROM inst LEFT JOIN c USING (contract_id)
       WHERE n <= 2 AND paid_on IS NULL AND due < DATE '{AS_OF}'""",
)
def _(t):
    contacts = t.orders.select(
        F.col("o_custkey").alias("contract_id"), F.concat(F.lit("c"), F.col("o_orderkey")).alias("contact"), F.col("o_orderdate").alias("updated")
    )
    return first_payment.outreach(accounts(t), _billed(t), contacts, day())


# loyalty ends, current speed and list price per contract, out of its newest order
LOYAL = """loy AS (SELECT o_custkey AS contract_id, CAST(o_orderdate AS DATE) + 200 AS loyal_until FROM orders WHERE o_orderstatus <> 'P'),
 net AS (SELECT o_custkey AS contract_id, o_orderkey % 900 + 100 AS units, o_orderkey % 3 AS unit, o_totalprice AS final_price, o_totalprice - o_orderkey % 30 AS list_price FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
 speed AS (SELECT contract_id, final_price, list_price, CAST(units AS DOUBLE) / CASE unit WHEN 1 THEN 1000 ELSE 1 END * CASE unit WHEN 2 THEN 1000 ELSE 1 END AS mbps FROM net)"""
CHURN_KINDS = {"support": "1-URGENT", "service": "2-HIGH", "repair": "3-MEDIUM", "finance": "5-LOW"}
GRID = f"""{ACC}, {INV}, {LOYAL}, g AS (SELECT acc.*, CAST(last_day(m) AS DATE) AS ref FROM acc, generate_series(DATE '2001-01-01', DATE '2001-06-01', INTERVAL 1 MONTH) AS s(m)
   WHERE activated <= CAST(last_day(m) AS DATE) AND (cancelled IS NULL OR cancelled >= CAST(m AS DATE))),
 n AS (SELECT contract_id, ref, {", ".join(f"count(*) FILTER (kind = '{k}') AS {n}" for n, k in CHURN_KINDS.items())} FROM g
   LEFT JOIN inv ON inv.client_id = contract_id AND issued BETWEEN ref - 60 AND ref GROUP BY ALL),
 p AS (SELECT contract_id, ref, max(paid_on) AS last_payment FROM g LEFT JOIN inv ON inv.client_id = contract_id AND paid_on <= ref GROUP BY ALL),
 f AS (SELECT contract_id, ref, max(loyal_until) AS loyal_until FROM g LEFT JOIN loy USING (contract_id) WHERE loyal_until >= ref GROUP BY ALL),
 i AS (SELECT contract_id, ref, max(issued) AS last_invoice FROM g LEFT JOIN inv ON inv.client_id = contract_id AND issued <= ref GROUP BY ALL),
 w AS (SELECT *, ref - last_payment AS since, date_diff('month', ref, loyal_until) - CASE WHEN day(ref) > day(loyal_until) THEN 1 ELSE 0 END AS loyal_months,
   CAST(round(final_price - list_price) AS BIGINT) AS above, date_diff('month', activated, ref) - CASE WHEN day(activated) > day(ref) THEN 1 ELSE 0 END AS months FROM g JOIN n USING (contract_id, ref) JOIN p USING (contract_id, ref)
   JOIN i USING (contract_id, ref) LEFT JOIN f USING (contract_id, ref) LEFT JOIN speed USING (contract_id)),
 grid AS (SELECT contract_id, ref, segment, CASE WHEN months <= 3 THEN '0-3' WHEN months <= 6 THEN '4-6' WHEN months <= 12 THEN '7-12' WHEN months <= 24 THEN '13-24' ELSE '25+' END AS tenure,
   CASE WHEN balance <= 0 THEN 'A' WHEN balance <= 2500 THEN 'B' WHEN balance <= 5000 THEN 'C' WHEN balance <= 7500 THEN 'D' ELSE 'E' END AS price_band,
   CASE WHEN since <= 30 THEN '30' WHEN since <= 60 THEN '60' WHEN since <= 90 THEN '90' WHEN since <= 120 THEN '120' WHEN since <= 150 THEN '150' WHEN since IS NULL THEN 'none' ELSE '150+' END AS payment_band,
   support, service, repair, finance, {", ".join(f"CAST({n} >= 1 AS INTEGER) AS {n}_flag" for n in CHURN_KINDS)}, {", ".join(f"CAST({n} > 1 AS INTEGER) AS {n}_repeat" for n in CHURN_KINDS)},
   {" + ".join(f"CAST({n} >= 1 AS INTEGER)" for n in CHURN_KINDS)} AS flags_total,
   CAST(coalesce(date_trunc('month', cancelled) = date_trunc('month', ref), FALSE) AS INTEGER) AS left_in_month,
   loyal_until, CASE WHEN loyal_months <= 3 THEN 'up to 3 months' WHEN loyal_months <= 6 THEN '4-6 months' WHEN loyal_months > 6 THEN 'over 6 months' ELSE 'none' END AS loyalty,
   mbps, above, CASE WHEN above < 5 THEN 'under 5' WHEN above <= 10 THEN '5-10' WHEN above <= 15 THEN '11-15' WHEN above <= 20 THEN '16-20' WHEN above > 20 THEN 'over 20' END AS price_position,
   CAST(coalesce(above >= 5, FALSE) OR coalesce(mbps < 300, FALSE) AS INTEGER) AS out_of_position, last_invoice FROM w)"""


def _grid(t):
    contacts = invoices(t).select(F.col("client_id").alias("contract_id"), F.col("issued").alias("day"), "kind")
    kinds = {n: F.col("kind") == k for n, k in CHURN_KINDS.items()}
    loyalty = t.orders.where("o_orderstatus <> 'P'").select(
        F.col("o_custkey").alias("contract_id"), F.date_add(F.to_date("o_orderdate"), 200).alias("loyal_until")
    )
    unit = F.element_at(F.array(F.lit(" MBPS"), F.lit(" KBPS"), F.lit(" GBPS")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    newest = latest_version(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        F.col("o_custkey").alias("contract_id"), F.concat((F.col("o_orderkey") % 900 + 100).cast("string"), unit).alias("speed"),
        F.col("o_totalprice").alias("final_price"), (F.col("o_totalprice") - F.col("o_orderkey") % 30).alias("list_price"),
    )
    return churn.churn_grid(
        accounts(t), contacts, _billed(t), day("2001-01-01"), day("2001-06-30"), kinds, loyalty=loyalty, services=newest
    )


@query("churn_grid", f"WITH {GRID} SELECT * FROM grid")
def _(t):
    return _grid(t)


@query(
    "churn_cluster",
    f"""WITH {GRID} SELECT contract_id, ref, CASE WHEN flags_total = 0 AND tenure IN ('25+', '13-24', '7-12') AND price_band = 'A' THEN '1.1'
         WHEN flags_total = 0 AND tenure IN ('25+', '13-24', '7-12') AND price_band = 'B' THEN '1.2' WHEN flags_total = 0 AND price_band = 'E' THEN '1.4'
         WHEN flags_total = 0 THEN '1.5' WHEN flags_total = 1 THEN '2.1' WHEN flags_total = 2 THEN '2.2' ELSE '2.3' END AS cluster,
         CASE WHEN finance_repeat = 1 THEN '3.2.1' WHEN support_repeat = 1 THEN '3.2.2' WHEN service_repeat = 1 THEN '3.2.3' WHEN repair_repeat = 1 THEN '3.2.4' END AS repeat_cluster,
         '3.1.' || CASE WHEN loyalty = 'none' THEN '1' ELSE '2' END || CASE WHEN out_of_position = 0 THEN '.1' ELSE '.2' END AS loyalty_cluster FROM grid""",
)
def _(t):
    order = [("finance_repeat", "3.2.1"), ("support_repeat", "3.2.2"), ("service_repeat", "3.2.3"), ("repair_repeat", "3.2.4")]
    return churn.churn_cluster(_grid(t), order)


SO = f"""{ACC}, so AS (SELECT o_orderkey AS order_id, o_custkey * 100 + month(o_orderdate) AS ticket_id, o_custkey AS client_id, o_orderkey % 100 AS company,
   o_orderdate AS opened, o_orderdate + to_hours(CAST(o_orderkey * 7 % 80 AS INTEGER)) AS done, o_orderpriority AS kind, o_orderstatus AS status,
   o_orderstatus = 'F' AS performed, o_orderstatus <> 'P' AND o_orderkey % 13 <> 0 AS countable FROM orders),
 act AS (SELECT contract_id AS client_id, contract_id % 100 AS company, activated - CAST(contract_id * 7 % 9 AS INTEGER) AS created, activated FROM acc),
 rep AS (SELECT * FROM so WHERE kind IN ('2-HIGH', '3-MEDIUM')),
 done AS (SELECT * FROM rep WHERE performed QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY order_id DESC) = 1),
 moved AS (SELECT * FROM so WHERE kind = '5-LOW' AND performed QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY order_id DESC) = 1),
 early AS (SELECT act.*, done.ticket_id, done.order_id, done.opened FROM act JOIN done USING (client_id) WHERE CAST(opened AS DATE) - activated BETWEEN 0 AND 60
           QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY opened, order_id) = 1),
 single AS (SELECT * FROM done UNION ALL (SELECT * FROM rep WHERE countable AND ticket_id NOT IN (SELECT ticket_id FROM done)
            QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY order_id DESC) = 1)),
 seq AS (SELECT *, lag(opened) OVER w AS po, lag(done) OVER w AS pd FROM done WINDOW w AS (PARTITION BY client_id ORDER BY opened, ticket_id)),
 again AS (SELECT *, coalesce(CAST(opened AS DATE) - CAST(pd AS DATE) <= 30 AND opened > po AND done > pd, FALSE) AS again FROM seq),
 took AS (SELECT *, CAST(done AS DATE) - CAST(opened AS DATE) AS d FROM moved), mins AS (SELECT *, date_diff('minute', opened, done) AS m FROM done),
 wait AS (SELECT *, activated - created AS d FROM act),
 ana AS (
  SELECT ticket_id, order_id, client_id, company, CAST(opened AS DATE) AS opened, CASE WHEN order_id % 2 = 0 THEN 'ADDRESS MOVE' ELSE 'UPGRADE' END AS indicator, CAST(d AS BIGINT) AS ageing,
    CASE WHEN d <= 2 THEN 'up to 2 d' WHEN d <= 4 THEN '3-4 d' WHEN d <= 7 THEN '5-7 d' ELSE 'over 7 d' END AS category, CAST(d <= 2 AS INTEGER) AS hit FROM took
  UNION ALL SELECT ticket_id, order_id, client_id, company, CAST(opened AS DATE), 'EFFECTIVENESS', NULL, CASE WHEN performed THEN 'PERFORMED' ELSE 'NOT PERFORMED' END, CAST(performed AS INTEGER)
    FROM so WHERE kind = '1-URGENT' AND status IN ('F', 'O')
  UNION ALL SELECT NULL, NULL, client_id, company, created, 'ACTIVATION AGEING', d, CASE WHEN d BETWEEN 0 AND 2 THEN 'IN STANDARD' ELSE 'OUT OF STANDARD' END, CAST(d BETWEEN 0 AND 2 AS INTEGER) FROM wait
  UNION ALL SELECT ticket_id, order_id, client_id, act.company, CAST(coalesce(opened, act.activated) AS DATE), 'INFANCY', CAST(opened AS DATE) - act.activated,
    CASE WHEN order_id IS NULL THEN 'NONE' ELSE 'EARLY REPAIR' END, CAST(order_id IS NOT NULL AS INTEGER) FROM act LEFT JOIN early USING (client_id)
  UNION ALL SELECT ticket_id, order_id, client_id, company, CAST(opened AS DATE), 'REPAIRS 24H', m,
    CASE WHEN m <= 1080 THEN 'up to 18 h' WHEN m <= 1440 THEN 'up to 24 h' WHEN m <= 2880 THEN 'up to 48 h' ELSE 'over 48 h' END, CAST(m <= 1440 AS INTEGER) FROM mins
  UNION ALL SELECT ticket_id, order_id, client_id, company, CAST(opened AS DATE), 'TECHNICAL REPAIR', NULL, CASE WHEN performed THEN 'PERFORMED' ELSE 'OPEN' END, 1
    FROM single WHERE countable OR NOT performed
  UNION ALL SELECT ticket_id, order_id, client_id, company, CAST(opened AS DATE), 'REPEATED REPAIR', CASE WHEN again THEN CAST(opened AS DATE) - CAST(pd AS DATE) END,
    CASE WHEN again THEN 'REPEATED' ELSE 'SINGLE' END, CAST(again AS INTEGER) FROM again),
 base AS (SELECT contract_id % 100 AS company, count(*) FILTER (WHERE cancelled IS NULL OR cancelled > DATE '2001-06-20') AS bn,
            count(*) FILTER (WHERE cancelled IS NULL OR cancelled > DATE '2001-05-31') AS bb FROM acc GROUP BY 1),
 ind AS (SELECT company, indicator, orders, CAST(hits AS BIGINT) AS hits, CAST(hits AS DOUBLE) / nullif(CAST(orders AS DOUBLE), 0) AS result FROM (
   SELECT company, indicator, CASE WHEN indicator = 'TECHNICAL REPAIR' THEN CAST(round((any_value(bn) + any_value(bb)) / 2) AS BIGINT) ELSE count(*) END AS orders,
     CASE WHEN indicator = 'TECHNICAL REPAIR' THEN CAST(round(count(*) + count(*) / 20 * 10) AS BIGINT) ELSE sum(hit) END AS hits
   FROM ana LEFT JOIN base USING (company) GROUP BY company, indicator))"""


def _service(t):
    hours = F.expr("make_dt_interval(0, cast(o_orderkey * 7 % 80 AS int))")
    return t.orders.select(
        F.col("o_orderkey").alias("order_id"), (F.col("o_custkey") * 100 + F.month("o_orderdate")).alias("ticket_id"),
        F.col("o_custkey").alias("client_id"), (F.col("o_orderkey") % 100).alias("company"), F.col("o_orderdate").alias("opened"),
        (F.col("o_orderdate") + hours).alias("done"), F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("status"),
    )


def _activations(t):
    key = F.col("contract_id")
    waited = F.date_sub("activated", (key * 7 % 9).cast("int"))
    return accounts(t).select(F.col("client_id"), (key % 100).alias("company"), waited.alias("created"), "activated")


def service_rules():
    kind, status = F.col("kind"), F.col("status")
    return fieldservice.ServiceRules(
        activation=kind == "1-URGENT", repair=kind.isin("2-HIGH", "3-MEDIUM"),
        moves=F.when(kind == "5-LOW", F.when(F.col("order_id") % 2 == 0, "ADDRESS MOVE").otherwise("UPGRADE")),
        performed=status == "F", failed=status == "O", countable=(status != "P") & (F.col("order_id") % 13 != 0),
        move_days=2, infancy_days=60,
    )


def _analytic(t):
    return fieldservice.kpi_analytic(_service(t), _activations(t), service_rules())


def _indicators(t):
    alive = lambda on: F.count_if(F.col("cancelled").isNull() | (F.col("cancelled") > day(on)))
    bases = accounts(t).groupBy((F.col("contract_id") % 100).alias("company")).agg(
        alive("2001-06-20").alias("base_now"), alive("2001-05-31").alias("base_before")
    )
    return fieldservice.kpi_indicators(_analytic(t), bases, day("2001-06-20"))


@query("kpi_analytic", f"WITH {SO} SELECT * FROM ana")
def _(t):
    return _analytic(t)


@query("kpi_indicators", f"WITH {SO} SELECT * FROM ind")
def _(t):
    return _indicators(t)


@query(
    "kpi_bonus",
    f"""WITH {SO}, goal AS (SELECT * FROM (VALUES ('EFFECTIVENESS', 'up', 0.2, 0.1, 30.0), ('REPAIRS 24H', 'up', 0.1, 0.05, 40.0), ('REPEATED REPAIR', 'down', 0.08, 0.12, 30.0)) AS v(indicator, polarity, upper, lower, weight))
       SELECT company, indicator, result, CAST(weight AS DOUBLE) AS weight, CAST(weight AS DOUBLE) * CAST(CASE WHEN polarity = 'up' THEN CASE WHEN result >= CAST(upper AS DOUBLE) THEN 1.0 WHEN result < CAST(lower AS DOUBLE) THEN 0.6 ELSE 0.8 END
         ELSE CASE WHEN result <= CAST(upper AS DOUBLE) THEN 1.0 WHEN result > CAST(lower AS DOUBLE) THEN 0.6 ELSE 0.8 END END AS DOUBLE) AS points
       FROM ind JOIN goal USING (indicator)""",
)
def _(t):
    goals = t.spark.createDataFrame(
        [
            ("EFFECTIVENESS", "up", 0.5, 0.4, 10.0, 1), ("EFFECTIVENESS", "up", 0.2, 0.1, 30.0, 2),
            ("REPAIRS 24H", "up", 0.1, 0.05, 40.0, 2), ("REPEATED REPAIR", "down", 0.08, 0.12, 30.0, 2),
        ],
        "indicator string, polarity string, upper double, lower double, weight double, valid_from int",
    )
    return fieldservice.kpi_bonus(_indicators(t), goals)


@query(
    "service_orders",
    """SELECT user_id, CAST(ts AS DATE) AS order_day, min(CASE WHEN event_type = 'signup' THEN ts END) AS first_start, min(CASE WHEN event_type = 'purchase' THEN ts END) AS first_finish,
         arg_max(event_type, (ts, event_id)) AS last_event, max(ts) AS last_at, count(*) AS events,
         CASE WHEN arg_max(event_type, (ts, event_id)) = 'error' THEN 'FAILED' WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'DONE' ELSE 'OPEN' END AS conclusion
       FROM events GROUP BY 1, 2""",
)
def _(t):
    log = t.events.withColumn("order_day", F.to_date("ts"))
    rules = [(F.col("last_event") == "error", "FAILED"), (F.col("first_finish").isNotNull(), "DONE")]
    return fieldservice.service_orders(log, ["user_id", "order_day"], "ts", "event_id", "event_type", rules, "signup", "purchase")


@query(
    "backoffice_sla",
    """WITH cal AS (SELECT CAST(m AS DATE) AS day, isodow(m) <= 5 AS is_open FROM generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) AS g(m)),
       h AS (SELECT event_id, user_id, ts, date_trunc('second', ts) AS b, date_trunc('second', coalesce(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts)) AS a FROM events),
       s AS (SELECT user_id, event_id, ts, date_diff('second', a, b) AS held_seconds, CAST(sum(CASE WHEN is_open THEN greatest(0, date_diff('second', greatest(a, CAST(day AS TIMESTAMP)), least(b, CAST(day AS TIMESTAMP) + INTERVAL 1 DAY))) ELSE 0 END) AS BIGINT) AS business_seconds
             FROM h JOIN cal ON day BETWEEN CAST(a AS DATE) AND CAST(b AS DATE) GROUP BY ALL)
       SELECT *, CASE WHEN business_seconds <= 14400 THEN '4 hours' WHEN business_seconds <= 86400 THEN '1 day' WHEN business_seconds <= 604800 THEN '7 days' ELSE 'over 7 days' END AS sla_band FROM s""",
)
def _(t):
    cal = date_grid(t.spark, day("2024-01-01"), day(EV_AS_OF), "1 day").withColumn("is_open", F.weekday("day") < 5)
    return fieldservice.backoffice_sla(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", "event_id", cal)


@query(
    "inbound_calls",
    f"""WITH {CALLS}, c AS (SELECT user_id, call_day, max(value) AS duration, count(*) AS segments FROM calls GROUP BY 1, 2),
       legs AS (SELECT event_id, ts, user_id, call_day, agent, skill, lead(agent) OVER w AS na, lead(skill) OVER w AS ns, agent = 'error' AS ign
                FROM calls WHERE agent NOT IN ('view', 'error') WINDOW w AS (PARTITION BY user_id, call_day ORDER BY ts, event_id)),
       every AS (SELECT event_id, ts, user_id, call_day, agent, skill, CAST(coalesce(na <> agent, FALSE) AS INTEGER) AS transferred, CASE WHEN na <> agent THEN ns END AS transferred_to FROM legs
                 UNION ALL SELECT event_id, ts, user_id, call_day, agent, skill, 0, NULL FROM calls WHERE agent = 'error'),
       r AS (SELECT *, row_number() OVER w AS leg_no, row_number() OVER (PARTITION BY user_id, call_day ORDER BY ts DESC, event_id DESC) = 1 AS is_last FROM every WINDOW w AS (PARTITION BY user_id, call_day ORDER BY ts, event_id))
       SELECT c.user_id, c.call_day, CASE WHEN leg_no IS NULL OR is_last THEN duration END AS duration, segments, event_id, ts, agent, skill, coalesce(transferred, 0) AS transferred, transferred_to, leg_no,
         md5(CAST(c.user_id AS VARCHAR) || '-' || CAST(c.call_day AS VARCHAR) || '-' || coalesce(CAST(leg_no AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS call_key
       FROM c LEFT JOIN r ON c.user_id = r.user_id AND c.call_day = r.call_day""",
)
def _(t):
    every = calls(t)
    whole = every.groupBy("user_id", "call_day").agg(F.max("value").alias("duration"), F.count(F.lit(1)).alias("segments"))
    legs = every.where("agent <> 'view'").drop("value")
    return call_plans.inbound_calls(
        whole, legs, ["user_id", "call_day"], ["ts", "event_id"], "agent", "skill", F.col("agent") == "error", ["duration"]
    )


@query(
    "chat_fact",
    """SELECT conv_id, count(*) AS turns, count(*) FILTER (role = 'user') AS client_turns, count(*) FILTER (role = 'assistant') AS agent_turns,
         arg_min(role, (turn, role)) AS opened_by, arg_max(role, (turn, role)) AS closed_by, CAST(sum(length(text)) AS BIGINT) AS characters, md5(CAST(conv_id AS VARCHAR)) AS chat_key
       FROM conversations GROUP BY conv_id""",
)
def _(t):
    return call_plans.chat_fact(t.conversations, "conv_id", "turn", "role", "text", "user", "assistant")


@query(
    "retention_points",
    """WITH f AS (SELECT event_id, user_id, ts, event_type, CASE WHEN event_type = 'error' THEN 'DROPPED' WHEN event_type = 'purchase' THEN 'RETAINED' WHEN event_type = 'signup' THEN 'TRANSFERRED' ELSE 'OTHER' END AS ending
                  FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1),
       r AS (SELECT *, CAST(coalesce(lead(ts) OVER w - ts <= INTERVAL 24 HOUR, FALSE) AS INTEGER) AS repeat_24h, 0 AS repeat_same_day FROM f WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
       SELECT event_id, user_id, ts, ending, repeat_24h, repeat_same_day, CAST(ending IN ('RETAINED', 'TRANSFERRED') AND repeat_24h = 0 AS INTEGER) AS kept_in_ivr FROM r""",
)
def _(t):
    kind = F.col("event_type")
    rules = [(kind == "error", "DROPPED"), (kind == "purchase", "RETAINED"), (kind == "signup", "TRANSFERRED")]
    legs = t.events.withColumn("call_day", F.to_date("ts"))
    return call_plans.retention_points(legs, ["user_id", "call_day"], "user_id", "ts", "event_id", rules).select(
        "event_id", "user_id", "ts", "ending", "repeat_24h", "repeat_same_day", "kept_in_ivr"
    )


@query(
    "latest_device_state",
    """WITH n AS (SELECT user_id, event_id, ts, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
            a AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS alarms, count(DISTINCT CAST(ts AS DATE)) AS days_seen FROM events GROUP BY 1)
       SELECT n.*, alarms, days_seen, c_nationkey AS unit_id FROM n JOIN a USING (user_id) LEFT JOIN customer ON user_id = c_custkey""",
)
def _(t):
    readings = t.events.select("user_id", "event_id", "ts", "event_type")
    owners = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("unit_id"))
    return operations.latest_device_state(readings, "user_id", "ts", "event_id", F.col("event_type") == "error", owners)


@query(
    "provisioned_by_unit",
    """SELECT c_nationkey AS unit_id, count(DISTINCT user_id) AS devices, count(DISTINCT CASE WHEN event_type = 'error' THEN user_id END) AS with_alarms
       FROM events LEFT JOIN customer ON user_id = c_custkey GROUP BY 1""",
)
def _(t):
    readings = t.events.select("user_id", "event_id", "ts", "event_type")
    owners = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("unit_id"))
    state = operations.latest_device_state(readings, "user_id", "ts", "event_id", F.col("event_type") == "error", owners)
    return operations.provisioned_by_unit(state, "unit_id", "user_id")


@query(
    "confirmation_status",
    """WITH f AS (SELECT conv_id, min(CASE WHEN role = 'assistant' THEN turn END) AS dispatched_turn, max(CASE WHEN role = 'user' THEN turn END) AS answered_turn,
           arg_max(text, turn) FILTER (role = 'user') AS answer FROM conversations GROUP BY 1)
       SELECT conv_id, dispatched_turn, answered_turn, CASE WHEN dispatched_turn IS NULL THEN 'NOT SENT' WHEN NOT coalesce(answered_turn > dispatched_turn, FALSE) THEN 'NO ANSWER'
         WHEN answer ILIKE '%the%' THEN 'CONFIRMED' WHEN length(answer) > 500 THEN 'RESCHEDULE' ELSE 'OTHER' END AS status FROM f""",
)
def _(t):
    rules = [(F.col("answer").ilike("%the%"), "CONFIRMED"), (F.length("answer") > 500, "RESCHEDULE")]
    return operations.confirmation_status(t.conversations, "conv_id", "turn", "role", "text", rules, "user", "assistant")


@query(
    "session_event_counts",
    """SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS events, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks,
         count(*) FILTER (event_type = 'purchase') AS purchases, min(ts) AS first_seen, max(ts) AS last_seen, CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS BIGINT) AS span_seconds
       FROM events GROUP BY 1, 2""",
)
def _(t):
    return operations.session_event_counts(t.events, "user_id", "ts", "event_type", ["view", "click", "purchase"])
