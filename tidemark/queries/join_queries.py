from pyspark.sql import functions as F

from tidemark.functions.text import clean_text_key
from tidemark.operators import intervals, joins, latest, linkage
from tidemark.operators import ordered as o
from tidemark.operators.aggregates import cents, sum_money
from tidemark.operators.skew import find_cuts
from tidemark.plans import contracts as contract_plans
from tidemark.queries.registry import query
from tidemark.queries.testbed import CON, INV, contracts, day, grid_sql, invoices, month_end_grid


@query(
    "join_inner_chain",
    """SELECT r_name, c_mktsegment, count(*) AS lines,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
)
def _(t):
    chain = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return chain.groupBy("r_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("lines"), sum_money("l_extendedprice").alias("gross")
    )


@query(
    "star_join",
    """SELECT o_orderkey, c_name AS client, c_mktsegment AS segment, n_name AS unit, r_name AS region
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _(t):
    return joins.star_join(
        t.orders.select("o_orderkey", "o_custkey"),
        [
            (t.customer, "o_custkey", "c_custkey", {"c_name": "client", "c_mktsegment": "segment", "c_nationkey": "_n"}),
            (t.nation, "_n", "n_nationkey", {"n_name": "unit", "n_regionkey": "_r"}),
            (t.region, "_r", "r_regionkey", {"r_name": "region"}),
        ],
    ).select("o_orderkey", "client", "segment", "unit", "region")


@query(
    "left_join_filtered_right",
    """SELECT c_custkey, count(o_orderkey) AS urgent_closed FROM customer
       LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
       GROUP BY c_custkey""",
)
def _(t):
    picked = t.orders.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    counts = picked.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("urgent_closed"))
    return t.customer.select("c_custkey").join(counts, "c_custkey", "left").fillna(0, ["urgent_closed"])


@query(
    "right_only_rows",
    """SELECT c_custkey, c_name FROM (SELECT * FROM orders WHERE o_orderstatus = 'P') RIGHT JOIN customer
       ON o_custkey = c_custkey WHERE o_orderkey IS NULL""",
)
def _(t):
    pending = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.exclude(t.customer, pending, "c_custkey").select("c_custkey", "c_name")


@query(
    "full_outer_coalesce",
    """WITH a AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, count(*) AS n FROM orders GROUP BY 1),
            b AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, count(*) AS n FROM lineitem GROUP BY 1)
       SELECT coalesce(a.m, b.m) AS month, coalesce(a.n, 0) AS ordered, coalesce(b.n, 0) AS shipped
       FROM a FULL JOIN b ON a.m = b.m""",
)
def _(t):
    a = t.orders.groupBy(F.trunc("o_orderdate", "MM").alias("month")).agg(F.count(F.lit(1)).alias("ordered"))
    b = t.lineitem.groupBy(F.trunc("l_shipdate", "MM").alias("month")).agg(F.count(F.lit(1)).alias("shipped"))
    return a.join(b, "month", "full").fillna(0, ["ordered", "shipped"])


@query(
    "cross_month_grid",
    f"WITH {grid_sql('2000-07-01', '2001-06-01')} SELECT client_id, ref FROM grid",
)
def _(t):
    return month_end_grid(t, "2000-07-01", "2001-06-30")


@query(
    "one_row_factor",
    """SELECT o_orderkey, o_totalprice / (SELECT max(o_totalprice) FROM orders) AS share_of_top FROM orders""",
)
def _(t):
    top = t.orders.agg(F.max("o_totalprice").alias("top")).select("top").scalar()
    return t.orders.select("o_orderkey", (F.col("o_totalprice") / top).alias("share_of_top"))


@query(
    "scalar_parameter",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 0.9 * (SELECT max(o_totalprice) FROM orders)""",
)
def _(t):
    top = t.orders.agg(F.max("o_totalprice").alias("top")).select("top").scalar()
    return t.orders.where(F.col("o_totalprice") > F.lit(0.9) * top).select("o_orderkey", "o_totalprice")


@query(
    "anti_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem ANTI JOIN
       (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R') USING (l_partkey, l_suppkey)""",
)
def _(t):
    returned = t.lineitem.where("l_returnflag = 'R'").select("l_partkey", "l_suppkey")
    return joins.exclude(t.lineitem, returned, ["l_partkey", "l_suppkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )


@query(
    "semi_join",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN
       (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)""",
)
def _(t):
    bulky = t.lineitem.where("l_returnflag = 'R' AND l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.semi(t.orders, bulky, "o_orderkey").select("o_orderkey", "o_custkey")


@query(
    "not_in_exclusion",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
)
def _(t):
    debtors = t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return joins.exclude(t.orders, debtors, "o_custkey", null_aware=True).select("o_orderkey", "o_custkey")


@query(
    "in_list_flag",
    """SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AS big_buyer
       FROM customer""",
)
def _(t):
    big = t.orders.where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.flag_in(t.customer.select("c_custkey"), big, "c_custkey", "big_buyer")


@query(
    "exists_or_not_exists",
    """SELECT c_custkey FROM customer c WHERE
         EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_totalprice > 450000)
         OR NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o_orderpriority = '1-URGENT')""",
)
def _(t):
    key = F.col("o_custkey").alias("c_custkey")
    out = joins.flag_in(t.customer.select("c_custkey"), t.orders.where("o_totalprice > 450000").select(key), "c_custkey", "_big")
    out = joins.flag_in(out, t.orders.where("o_orderpriority = '1-URGENT'").select(key), "c_custkey", "_urgent")
    return out.where("_big OR NOT _urgent").select("c_custkey")


@query(
    "role_playing_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, a.n_name AS client_unit, b.n_name AS supplier_unit
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation a ON c_nationkey = a.n_nationkey
       LEFT JOIN nation b ON s_nationkey = b.n_nationkey""",
)
def _(t):
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return joins.star_join(
        facts,
        [
            (t.orders, "l_orderkey", "o_orderkey", {"o_custkey": "_c"}),
            (t.customer, "_c", "c_custkey", {"c_nationkey": "_cn"}),
            (t.supplier, "l_suppkey", "s_suppkey", {"s_nationkey": "_sn"}),
            (t.nation, "_cn", "n_nationkey", {"n_name": "client_unit"}),
            (t.nation, "_sn", "n_nationkey", {"n_name": "supplier_unit"}),
        ],
    ).select("l_orderkey", "l_linenumber", "l_partkey", "client_unit", "supplier_unit")


@query(
    "or_join",
    """SELECT p_partkey, s_name AS supplier_name FROM part LEFT JOIN supplier ON p_size * 3 = s_suppkey OR p_partkey = s_suppkey""",
)
def _(t):
    parts = t.part.select("p_partkey", (F.col("p_size") * 3).cast("bigint").alias("main_key"))
    joined = joins.or_join(
        parts,
        t.supplier.select("s_suppkey", F.col("s_suppkey").alias("legacy_key"), "s_name"),
        [("main_key", "s_suppkey"), ("p_partkey", "legacy_key")],
        {"s_name": "supplier_name"},
    )
    return joined.select("p_partkey", "supplier_name")


@query(
    "computed_key_join",
    """SELECT s_suppkey, n_name, n_regionkey FROM supplier JOIN nation
       ON CASE WHEN s_acctbal < 0 THEN 'NATION_0' ELSE 'NATION_' || CAST(s_nationkey AS VARCHAR) END = n_name""",
)
def _(t):
    key = F.when(F.col("s_acctbal") < 0, "NATION_0").otherwise(F.concat(F.lit("NATION_"), F.col("s_nationkey")))
    return t.supplier.withColumn("n_name", key).join(t.nation, "n_name").select("s_suppkey", "n_name", "n_regionkey")


@query(
    "normalized_text_join",
    """SELECT c_custkey, n_nationkey, n_name FROM customer JOIN nation
       ON upper(trim(strip_accents(replace(' Nátiôn_' || CAST(c_nationkey AS VARCHAR) || chr(10), chr(10), '')))) = upper(n_name)""",
)
def _(t):
    spelled = F.concat(F.lit(" Nátiôn_"), F.col("c_nationkey"), F.lit("\n"))
    left = t.customer.select("c_custkey", clean_text_key(spelled).alias("_key"))
    right = t.nation.select("n_nationkey", "n_name", clean_text_key("n_name").alias("_key"))
    return left.join(right, "_key").select("c_custkey", "n_nationkey", "n_name")


@query(
    "contains_join",
    """WITH words AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS word FROM part)
       SELECT p_partkey, word FROM part JOIN words ON p_name LIKE '%' || word || '%' WHERE word <> ''""",
)
def _(t):
    words = t.part.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("word")).distinct()
    return joins.contains_join(t.part.select("p_partkey", "p_name"), "p_name", words, "word", ["word"]).select(
        "p_partkey", "word"
    )


@query(
    "contains_join_documents",
    """WITH w AS (SELECT string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' ') AS w FROM benchmark),
       needles AS (SELECT DISTINCT unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS words FROM w)
       SELECT doc_id, count(*) AS needles, min(words) AS first_needle FROM documents JOIN needles ON contains(text, words)
       WHERE length(words) >= 8 GROUP BY doc_id""",
)
def _(t):
    """Well over a thousand needles: neighbouring words of the benchmark in all documents."""
    words = F.split(F.regexp_replace("text", r"\s+", " "), " ")
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.get("w", i - 1), F.get("w", i))
    )
    split = t.benchmark.select(words.alias("w")).where(F.size("w") > 1)
    needles = split.select(F.explode(pairs).alias("words")).distinct().where(F.length("words") >= 8)
    found = joins.contains_join(t.documents.select("doc_id", "text"), "text", needles, "words", ["words"])
    return found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("needles"), F.min("words").alias("first_needle"))


@query(
    "asof_validity",
    """SELECT e.event_id, e.user_id, e.ts, v.event_id AS version_id, v.value AS plan_value
       FROM (SELECT * FROM events WHERE event_type <> 'signup') e
       ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') v ON e.user_id = v.user_id AND e.ts >= v.ts""",
)
def _(t):
    versions = t.events.where("event_type = 'signup'").select("user_id", "ts", "event_id", "value")
    asked = t.events.where("event_type <> 'signup'").select("event_id", "user_id", "ts")
    return joins.asof_validity(
        asked, versions, ["user_id"], "ts", "ts", "event_id", {"event_id": "version_id", "value": "plan_value"}
    )


@query(
    "lookback_counts_60d",
    f"""WITH {grid_sql('2000-01-01', '2001-06-01')}
       SELECT client_id, ref, count(o_orderkey) AS contacts,
         count(*) FILTER (o_orderstatus = 'F') AS complaints FROM grid
       LEFT JOIN orders ON o_custkey = client_id AND CAST(o_orderdate AS DATE) BETWEEN ref - 60 AND ref
       GROUP BY client_id, ref""",
)
def _(t):
    contacts = t.orders.select(
        F.col("o_custkey").alias("client_id"), F.to_date("o_orderdate").alias("day"), "o_orderstatus"
    )
    return joins.lookback_counts(
        month_end_grid(t, "2000-01-01", "2001-06-30"),
        contacts,
        ["client_id"],
        "ref",
        "day",
        60,
        {"contacts": F.lit(True), "complaints": F.col("o_orderstatus") == "F"},
    )


@query(
    "asof_last_before",
    f"""WITH {INV}, {grid_sql('2000-07-01', '2001-06-01')}
       SELECT g.client_id, g.ref, max(paid_on) AS last_payment FROM grid g
       LEFT JOIN inv ON inv.client_id = g.client_id AND paid_on <= ref GROUP BY ALL""",
)
def _(t):
    paid = invoices(t).where(F.col("paid_on").isNotNull()).select("client_id", "paid_on")
    grid = month_end_grid(t, "2000-07-01", "2001-06-30")
    return joins.asof_last(grid, paid, ["client_id"], "ref", "paid_on", "last_payment")


@query(
    "recurrence_90d",
    """WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)
       SELECT a.o_orderkey, a.o_custkey, a.day, count(b.o_orderkey) AS previous,
              arg_max(b.o_orderkey, (b.day, b.o_orderkey)) AS last_id
       FROM o a LEFT JOIN o b ON a.o_custkey = b.o_custkey AND b.day BETWEEN a.day - 90 AND a.day - 1
       GROUP BY ALL""",
)
def _(t):
    requests = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    return joins.recurrence(requests, ["o_custkey"], "day", "o_orderkey", 90).select(
        "o_orderkey", "o_custkey", "day", "previous", "last_id"
    )


REJOIN = """WITH {con} SELECT a.contract_id, a.client_id, a.activated, min(b.contract_id) AS replaced_contract
  FROM con a JOIN con b ON a.client_id = b.client_id AND a.contract_id > b.contract_id
   AND b.cancelled - a.activated BETWEEN {low} AND {high} GROUP BY ALL"""


@query("rejoin_pairs_fwd", REJOIN.format(con=CON, low=0, high=40))
def _(t):
    return contract_plans.replaced_contracts(contracts(t), ["client_id"], 0, 40).select(
        "contract_id", "client_id", "activated", "replaced_contract"
    )


@query("rejoin_pairs_back", REJOIN.format(con=CON, low=-40, high=0))
def _(t):
    return contract_plans.replaced_contracts(contracts(t), ["client_id"], -40, 0).select(
        "contract_id", "client_id", "activated", "replaced_contract"
    )


@query(
    "link_pairs_flags",
    f"""WITH {CON}, pairs AS (
         SELECT a.contract_id, b.client_id = a.client_id AS same_client, b.address_id = a.address_id AS same_address,
                b.phone_id = a.phone_id AS same_phone
         FROM con a JOIN con b ON b.cancelled IS NOT NULL AND a.contract_id > b.contract_id
          AND a.activated - b.cancelled BETWEEN -40 AND 40
          AND (b.client_id = a.client_id OR b.address_id = a.address_id OR b.phone_id = a.phone_id))
       SELECT con.contract_id, CAST(coalesce(max(same_client), FALSE) AS INTEGER) AS same_client,
              CAST(coalesce(max(same_address), FALSE) AS INTEGER) AS same_address,
              CAST(coalesce(max(same_phone), FALSE) AS INTEGER) AS same_phone
       FROM con LEFT JOIN pairs USING (contract_id) GROUP BY con.contract_id""",
)
def _(t):
    return linkage.link_flags(
        contracts(t),
        "contract_id",
        "activated",
        "cancelled",
        {"same_client": ["client_id"], "same_address": ["address_id"], "same_phone": ["phone_id"]},
        40,
    ).select("contract_id", "same_client", "same_address", "same_phone")


@query(
    "interval_overlap",
    """WITH span AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS s, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS e,
                     CAST(l_extendedprice AS DECIMAL(18,2)) AS v FROM lineitem),
       cyc AS (SELECT s_suppkey AS l_suppkey, CAST(m AS DATE) AS cycle_start, CAST(last_day(m) AS DATE) AS cycle_end
               FROM supplier, generate_series(DATE '2001-01-01', DATE '2001-06-01', INTERVAL 1 MONTH) AS g(m))
       SELECT cyc.l_suppkey, cycle_start, cycle_end, count(s) AS overlapping,
              CAST(coalesce(sum(v), 0) AS DOUBLE) AS overlapping_value
       FROM cyc LEFT JOIN span ON span.l_suppkey = cyc.l_suppkey AND s <= cycle_end AND e >= cycle_start GROUP BY ALL""",
)
def _(t):
    spans = t.lineitem.select(
        "l_suppkey",
        F.to_date("l_shipdate").alias("begun"),
        F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int")).alias("ended"),
        cents("l_extendedprice").alias("value"),
    )
    starts = F.sequence(day("2001-01-01"), day("2001-06-01"), F.expr("interval 1 month"))
    cycles = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.explode(starts).alias("cycle_start"))
    cycles = cycles.withColumn("cycle_end", F.last_day("cycle_start"))
    out = intervals.overlap_totals(
        spans, cycles, ["l_suppkey"], "begun", "ended", "value", "cycle_start", "cycle_end"
    )
    return out.withColumn("overlapping_value", F.col("overlapping_value") / 100)


SUSPENDED = """susp AS (
  SELECT user_id, CAST(ts AS DATE) AS s, CASE WHEN ntype IN ('signup', 'purchase') THEN CAST(nts AS DATE) END AS e
  FROM (SELECT user_id, ts, event_type, lead(ts) OVER w AS nts, lead(event_type) OVER w AS ntype
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE event_type = 'error'),
 cyc AS (SELECT user_id, CAST(m AS DATE) AS cycle_start, CAST(m AS DATE) + 6 AS cycle_end
         FROM (SELECT DISTINCT user_id FROM events), generate_series(DATE '2024-01-01', DATE '2024-01-22', INTERVAL 7 DAY) AS g(m))"""


@query(
    "clipped_days",
    f"""WITH {SUSPENDED} SELECT cyc.user_id, cycle_start, cycle_end,
         CAST(coalesce(sum(greatest(0, least(coalesce(e, DATE '9999-12-31'), cycle_end + 1) - greatest(s, cycle_start))), 0)
              AS BIGINT) AS days
       FROM cyc LEFT JOIN susp USING (user_id) GROUP BY ALL""",
)
def _(t):
    kind = F.col("event_type")
    spans = intervals.status_intervals(
        t.events, ["user_id"], "ts", "event_id", kind == "error", kind.isin("signup", "purchase")
    )
    spans = spans.select("user_id", F.to_date("opened_at").alias("begun"), F.to_date("closed_at").alias("ended"))
    weeks = F.sequence(day("2024-01-01"), day("2024-01-22"), F.expr("interval 7 day"))
    cycles = t.events.select("user_id").distinct().select("user_id", F.explode(weeks).alias("cycle_start"))
    cycles = cycles.withColumn("cycle_end", F.date_add("cycle_start", 6))
    return intervals.clipped_days(spans, cycles, ["user_id"], "begun", "ended", "cycle_start", "cycle_end")


@query(
    "business_duration",
    """WITH cal AS (SELECT CAST(m AS DATE) AS day, isodow(m) <= 5 AS is_open
                    FROM generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) AS g(m)),
       h AS (SELECT event_id, user_id, date_trunc('second', ts) AS b,
                    date_trunc('second', coalesce(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts)) AS a
             FROM events)
       SELECT event_id, user_id, CAST(sum(CASE WHEN is_open THEN greatest(0, date_diff('second',
              greatest(a, CAST(day AS TIMESTAMP)), least(b, CAST(day AS TIMESTAMP) + INTERVAL 1 DAY))) ELSE 0 END) AS BIGINT)
              AS business_seconds
       FROM h JOIN cal ON day BETWEEN CAST(a AS DATE) AND CAST(b AS DATE) GROUP BY ALL""",
)
def _(t):
    from tidemark.operators.reshape import date_grid

    cal = date_grid(t.spark, day("2024-01-01"), day("2024-01-31"), "1 day")
    cal = cal.withColumn("is_open", F.weekday("day") < 5)
    held = intervals.handover_intervals(t.events, ["user_id"], "ts", "event_id")
    return intervals.business_seconds(held, "held_from", "ts", cal, "day", "is_open").select(
        "event_id", "user_id", "business_seconds"
    )


@query(
    "positional_pairing",
    """WITH a AS (SELECT o_orderkey AS cancelled_id, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS position
                  FROM orders WHERE o_orderstatus = 'F'),
            b AS (SELECT o_orderkey AS rebilled_id, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS position
                  FROM orders WHERE o_orderstatus = 'P')
       SELECT o_custkey, position, cancelled_id, rebilled_id FROM a LEFT JOIN b USING (o_custkey, position)""",
)
def _(t):
    cols = ["o_custkey", F.col("o_orderdate").alias("at")]
    a = t.orders.where("o_orderstatus = 'F'").select(*cols, F.col("o_orderkey").alias("cancelled_id"))
    b = t.orders.where("o_orderstatus = 'P'").select(*cols, F.col("o_orderkey").alias("rebilled_id"))
    paired = joins.pair_positionally(a, b, ["o_custkey"], ["at", "cancelled_id"], ["at", "rebilled_id"])
    return paired.select("o_custkey", "position", "cancelled_id", "rebilled_id")


@query(
    "groupwise_max_ties",
    """SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders
       QUALIFY rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC) = 1""",
)
def _(t):
    newest = latest.latest_version(t.orders, ["o_orderpriority"], ["o_orderdate"], keep_ties=True)
    return newest.select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))


@query(
    "groupwise_max_unique",
    """SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS newest_order,
         arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS newest_price FROM orders GROUP BY o_custkey""",
)
def _(t):
    return latest.summary_row_per_key(
        t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], False,
        newest_order="o_orderkey", newest_price="o_totalprice",
    )


@query(
    "correlated_max",
    """SELECT o_orderkey, o_custkey FROM orders a
       WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders b WHERE b.o_custkey = a.o_custkey)""",
)
def _(t):
    top = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("o_totalprice"))
    return joins.semi(t.orders, top, ["o_custkey", "o_totalprice"]).select("o_orderkey", "o_custkey")


@query(
    "prev_event_max",
    """SELECT event_id, user_id, (SELECT max(ts) FROM events b WHERE b.user_id = a.user_id AND b.event_type = 'signup'
         AND b.ts < a.ts) AS previous_signup FROM events a""",
)
def _(t):
    marked = t.events.select("event_id", "user_id", "ts", F.when(F.col("event_type") == "signup", F.col("ts")).alias("_s"))
    cuts = find_cuts(marked, ["user_id"], "ts")
    seen = o.along_key(marked, ["user_id"], ["ts", "event_id"], {"_seen": o.last_seen("_s")}, cuts=cuts)
    before = o.along_key(seen, ["user_id"], ["ts", "event_id"], {"previous_signup": o.lag("_seen")}, cuts=cuts)
    return before.select("event_id", "user_id", "previous_signup")


@query(
    "latest_with_exclusion",
    """SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey NOT IN (
         SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2001-01-01')
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def _(t):
    urgent = t.orders.where("o_orderpriority = '1-URGENT' AND o_orderdate >= timestamp_ntz'2001-01-01'")
    kept = joins.exclude(t.orders, urgent.select("o_custkey"), "o_custkey")
    return latest.latest_version(kept, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


_KEYED = """e AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS k, o_orderkey AS id,
                          CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS TIMESTAMP) AS ts FROM orders)"""


def _keyed(t):
    """Orders as events of clients, every fifth without its client."""
    k = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey"))
    day = F.to_date("o_orderdate")
    return t.orders.select(k.alias("k"), F.col("o_orderkey").alias("id"), day.alias("day"), day.cast("timestamp_ntz").alias("ts"))


@query(
    "null_keys_asof",
    f"""WITH {_KEYED}, v AS (SELECT k, CASE WHEN id % 7 = 0 THEN NULL ELSE ts END AS since, id AS v FROM e WHERE id % 3 = 0)
       SELECT id, (SELECT max_by(v.v, (v.since, v.v)) FROM v WHERE v.k = e.k AND v.since <= e.ts) AS version FROM e""",
)
def _(t):
    events = _keyed(t)
    versions = events.where("id % 3 = 0").select("k", F.when(F.col("id") % 7 != 0, F.col("ts")).alias("since"), F.col("id").alias("v"))
    got = joins.asof_validity(events, versions, ["k"], "ts", "since", "v", {"v": "version"})
    return got.select("id", "version")


@query(
    "null_keys_lookback",
    f"""WITH {_KEYED}, g AS (SELECT DISTINCT k, day AS ref FROM e WHERE id % 4 = 0)
       SELECT g.k, g.ref, count(e.id) AS seen FROM g LEFT JOIN e ON e.k = g.k AND e.day BETWEEN g.ref - 400 AND g.ref GROUP BY 1, 2""",
)
def _(t):
    events = _keyed(t)
    grid = events.where("id % 4 = 0").select("k", F.col("day").alias("ref"))
    return joins.lookback_counts(grid, events, ["k"], "ref", "day", 400, {"seen": F.lit(True)})


@query(
    "null_keys_last_before",
    f"""WITH {_KEYED}, g AS (SELECT DISTINCT k, day AS ref FROM e WHERE id % 4 = 0)
       SELECT g.k, g.ref, max(e.ts) AS last FROM g LEFT JOIN e ON e.k = g.k AND e.id % 3 = 0 AND e.day <= g.ref GROUP BY 1, 2""",
)
def _(t):
    events = _keyed(t)
    grid = events.where("id % 4 = 0").select("k", F.col("day").alias("ref"))
    return joins.asof_last(grid, events.where("id % 3 = 0"), ["k"], "ref", "ts", "last")


@query(
    "null_keys_recurrence",
    f"""WITH {_KEYED}
       SELECT e.id, count(b.id) AS previous FROM e LEFT JOIN e b ON b.k = e.k AND b.day BETWEEN e.day - 90 AND e.day - 1 GROUP BY 1""",
)
def _(t):
    return joins.recurrence(_keyed(t), ["k"], "day", "id", 90).select("id", "previous")


_SPANS = """s AS (SELECT o_custkey AS k, o_orderkey % 9 AS v,
                         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS a,
                         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 - 10 AS INTEGER) END AS b
                  FROM orders),
            c AS (SELECT DISTINCT o_custkey AS k, date_trunc('month', o_orderdate)::DATE AS lo, last_day(o_orderdate)::DATE AS hi FROM orders)"""


def _spans(t):
    """Orders as spans, some without start or end and some that end before they start, and months as cycles."""
    day = F.to_date("o_orderdate")
    until = F.date_add(day, (F.col("o_orderkey") % 60 - 10).cast("int"))
    spans = t.orders.select(
        F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 9).alias("v"),
        F.when(F.col("o_orderkey") % 11 != 0, day).alias("a"), F.when(F.col("o_orderkey") % 7 != 0, until).alias("b"),
    )
    cycles = t.orders.select(F.col("o_custkey").alias("k"), F.trunc(day, "MM").alias("lo"), F.last_day(day).alias("hi")).distinct()
    return spans, cycles


@query(
    "bad_spans_overlap",
    f"""WITH {_SPANS} SELECT c.k, c.lo, count(s.k) AS overlapping, CAST(coalesce(sum(s.v), 0) AS BIGINT) AS overlapping_value
        FROM c LEFT JOIN s ON s.k = c.k AND s.a <= s.b AND s.a <= c.hi AND s.b >= c.lo GROUP BY 1, 2""",
)
def _(t):
    spans, cycles = _spans(t)
    return intervals.overlap_totals(spans, cycles, ["k"], "a", "b", "v", "lo", "hi").drop("hi")


@query(
    "bad_spans_clipped",
    f"""WITH {_SPANS} SELECT c.k, c.lo, CAST(coalesce(sum(CASE WHEN s.k IS NOT NULL THEN greatest(0, date_diff('day', greatest(s.a, c.lo), least(coalesce(s.b, c.hi + 1), c.hi + 1))) END), 0) AS BIGINT) AS days
        FROM c LEFT JOIN s ON s.k = c.k AND s.a IS NOT NULL AND (s.b IS NULL OR s.b >= s.a) GROUP BY 1, 2""",
)
def _(t):
    spans, cycles = _spans(t)
    return intervals.clipped_days(spans, cycles, ["k"], "a", "b", "lo", "hi").drop("hi")
