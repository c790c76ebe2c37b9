from pyspark.sql import functions as F

from tidemark.operators import checks
from tidemark.queries.registry import query
from tidemark.queries.testbed import day


@query("dq_accepted_range", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE NOT (l_quantity >= 2 AND l_quantity <= 49)")
def _(t):
    return checks.accepted_range(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), "l_quantity", 2, 49)


@query(
    "dq_at_least_one",
    "SELECT o_custkey, count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) AS filled FROM orders GROUP BY 1 HAVING filled = 0",
)
def _(t):
    urgent = t.orders.withColumn("urgent", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(1)))
    return checks.at_least_one(urgent, "urgent", ["o_custkey"])


COUNTS = "SELECT {} AS value, count(*) AS rows FROM {} GROUP BY 1"


@query(
    "dq_cardinality_equality",
    f"""WITH a AS ({COUNTS.format('c_nationkey', 'customer')}), b AS ({COUNTS.format('s_nationkey', 'supplier')})
       (SELECT *, 'a' AS only_in FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) UNION ALL (SELECT *, 'b' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))""",
)
def _(t):
    return checks.cardinality_equality(t.customer, "c_nationkey", t.supplier, "s_nationkey")


GROUPED = """SELECT o_custkey AS client, count(*) FILTER (o_orderstatus = 'F') AS rows_a, count(*) FILTER (o_orderstatus = 'P') AS rows_b
             FROM orders WHERE o_orderstatus IN ('F', 'P') GROUP BY 1"""


def _halves(t):
    rows = t.orders.select(F.col("o_custkey").alias("client"), "o_orderstatus")
    return rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus = 'P'")


@query("dq_equal_rowcount", f"{GROUPED} HAVING rows_a <> rows_b")
def _(t):
    return checks.equal_rowcount(*_halves(t), by=["client"])


@query("dq_fewer_rows_than", f"{GROUPED} HAVING rows_a >= rows_b")
def _(t):
    return checks.fewer_rows_than(*_halves(t), by=["client"])


@query(
    "dq_equality",
    """WITH a AS (SELECT l_orderkey, l_partkey, l_quantity FROM lineitem), b AS (SELECT l_orderkey, l_partkey,
         CASE WHEN l_returnflag = 'R' AND l_quantity = 50 THEN 0 ELSE l_quantity END AS l_quantity FROM lineitem)
       (SELECT *, 'a' AS only_in FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) UNION ALL (SELECT *, 'b' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))""",
)
def _(t):
    a = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_tax")
    changed = F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50), 0.0).otherwise(F.col("l_quantity"))
    b = t.lineitem.select("l_orderkey", "l_partkey", (changed + 0.0001).alias("l_quantity"))
    return checks.equality(a, b, exclude=["l_tax"], precision=2)


@query("dq_expression_is_true", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_totalprice < 400000)")
def _(t):
    return checks.expression_is_true(t.orders.select("o_orderkey", "o_totalprice"), F.col("o_totalprice") < 400000)


@query(
    "dq_mutually_exclusive_ranges",
    """WITH r AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS lower, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS upper FROM orders),
            n AS (SELECT *, lead(lower) OVER (PARTITION BY o_custkey ORDER BY lower, upper, o_orderkey) AS nxt FROM r)
       SELECT o_orderkey, o_custkey, lower, upper FROM n WHERE NOT (lower < upper AND coalesce(upper <= nxt, TRUE))""",
)
def _(t):
    lower = F.to_date("o_orderdate")
    spans = t.orders.select("o_orderkey", "o_custkey", lower.alias("lower"), F.date_add(lower, (F.col("o_orderkey") % 60).cast("int")).alias("upper"))
    return checks.mutually_exclusive_ranges(spans, "lower", "upper", ["o_custkey"], tiebreak=["o_orderkey"])


@query("dq_not_accepted_values", "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'click')")
def _(t):
    return checks.not_accepted_values(t.events.select("event_id", "event_type"), "event_type", ["error", "click"])


@query(
    "dq_not_constant",
    """SELECT o_custkey, min(o_orderstatus) AS only_value FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) = 1""",
)
def _(t):
    return checks.not_constant(t.orders, "o_orderstatus", ["o_custkey"])


@query("dq_not_empty_string", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '  ' ELSE o_orderstatus END AS status FROM orders WHERE o_orderstatus = 'P'")
def _(t):
    blank = F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.col("o_orderstatus")).alias("status")
    return checks.not_empty_string(t.orders.select("o_orderkey", blank), "status")


@query(
    "dq_not_null_proportion",
    """SELECT o_custkey, CAST(count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS share
       FROM orders GROUP BY 1 HAVING share < 0.5""",
)
def _(t):
    some = t.orders.withColumn("x", F.when(F.col("o_orderstatus") != "P", F.lit(1)))
    return checks.not_null_proportion(some, "x", 0.5, by=["o_custkey"])


@query("dq_recency", "SELECT o_custkey, max(o_orderdate) AS newest FROM orders GROUP BY 1 HAVING newest < TIMESTAMP '2001-01-01'")
def _(t):
    return checks.recency(t.orders, "o_orderdate", day("2001-01-31"), 30, ["o_custkey"])


@query(
    "dq_relationships_where",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def _(t):
    return checks.relationships_where(
        t.orders, "o_custkey", t.customer, "c_custkey", F.col("o_orderstatus") == "F", F.col("c_acctbal") >= 0
    ).select("o_orderkey", "o_custkey")


@query(
    "dq_sequential_values",
    """WITH s AS (SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS previous FROM orders)
       SELECT * FROM s WHERE previous IS NOT NULL AND o_orderkey <> previous + 1""",
)
def _(t):
    return checks.sequential_values(t.orders.select("o_custkey", "o_orderkey"), "o_orderkey", by=["o_custkey"])


@query("dq_unique_combination", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(t):
    return checks.unique_combination(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dq_run_checks",
    """SELECT 'positive_price' AS rule, count(*) FILTER (NOT l_extendedprice > 0) AS violations FROM lineitem
       UNION ALL SELECT 'small_tax', count(*) FILTER (NOT l_tax <= 0.05) FROM lineitem
       UNION ALL SELECT 'known_flag', count(*) FILTER (NOT l_returnflag IN ('A', 'N')) FROM lineitem""",
)
def _(t):
    return checks.run_checks(
        t.lineitem,
        {
            "positive_price": F.col("l_extendedprice") > 0,
            "small_tax": F.col("l_tax") <= 0.05,
            "known_flag": F.col("l_returnflag").isin("A", "N"),
        },
    )


@query(
    "dq_report",
    """SELECT 'urgent_orders' AS rule, count(*) AS violations FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderpriority = '1-URGENT') = 0)
       UNION ALL SELECT 'line_number', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def _(t):
    urgent = t.orders.withColumn("urgent", F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(1)))
    return checks.report(
        {
            "urgent_orders": checks.at_least_one(urgent, "urgent", ["o_custkey"]),
            "line_number": checks.unique_combination(t.lineitem, ["l_orderkey", "l_linenumber"]),
        }
    )
