from pyspark.sql import functions as F

from tidemark.functions.numbers import safe_divide
from tidemark.operators import aggregates as agg
from tidemark.operators import latest
from tidemark.operators.aggregates import cents, exact_sum, money, sum_money
from tidemark.plans import indicators
from tidemark.queries.registry import query
from tidemark.queries.testbed import AS_OF, CON, INV, contracts, day, invoices

DEC = "CAST({} AS DECIMAL(18,2))"


@query(
    "agg_basic",
    """SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DOUBLE) AS net,
         min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
       FROM lineitem GROUP BY ALL""",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"),
        sum_money("l_quantity").alias("quantity"),
        exact_sum(cents("l_extendedprice") * (100 - cents("l_discount")), 10_000).alias("net"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
    )


@query(
    "group_by_expression",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END AS band, count(*) AS orders
       FROM orders GROUP BY ALL""",
)
def _(t):
    band = F.when(F.col("o_totalprice") > 250000, "high").otherwise("low").alias("band")
    return t.orders.groupBy(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), band
    ).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "having_filter",
    "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY o_custkey HAVING count(*) >= 15",
)
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders")).where("orders >= 15")


@query(
    "count_distinct",
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers
       FROM lineitem GROUP BY l_returnflag""",
)
def _(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers")
    )


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def _(t):
    return t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@query(
    "conditional_agg",
    """SELECT o_custkey, count(*) FILTER (o_orderstatus = 'F') AS closed,
         CAST(sum(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS open_value,
         max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderdate END) AS last_urgent,
         count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END) AS pending_kinds
       FROM orders GROUP BY o_custkey""",
)
def _(t):
    status = F.col("o_orderstatus")
    out = agg.conditional_agg(
        t.orders,
        ["o_custkey"],
        {
            "closed": ("count", status == "F", None),
            "open_value": ("sum", status != "F", money("o_totalprice")),
            "last_urgent": ("max", F.col("o_orderpriority") == "1-URGENT", F.col("o_orderdate")),
            "pending_kinds": ("count_distinct", status == "P", F.col("o_orderpriority")),
        },
    )
    return out.withColumn("open_value", F.col("open_value").cast("double"))


PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "unspecified", "5-LOW": "low"}


@query(
    "pivot_max_case",
    "SELECT o_custkey, "
    + ", ".join(f"max(CASE WHEN o_orderpriority = '{k}' THEN o_totalprice END) AS {v}" for k, v in PRIORITIES.items())
    + " FROM orders GROUP BY o_custkey",
)
def _(t):
    return agg.pivot_max(t.orders, ["o_custkey"], "o_orderpriority", "o_totalprice", PRIORITIES)


@query(
    "pivot_counts",
    """SELECT c_nationkey, count(*) FILTER (c_mktsegment = 'BUILDING') AS building,
         count(*) FILTER (c_mktsegment = 'MACHINERY') AS machinery, count(*) FILTER (c_mktsegment = 'HOUSEHOLD') AS household
       FROM customer GROUP BY c_nationkey""",
)
def _(t):
    names = {"BUILDING": "building", "MACHINERY": "machinery", "HOUSEHOLD": "household"}
    ones = t.customer.withColumn("_one", F.lit(1))
    return agg.pivot_max(ones, ["c_nationkey"], "c_mktsegment", "_one", names, agg=F.count)


@query(
    "topn_to_columns",
    """WITH r AS (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders)
       SELECT o_custkey, max(CASE WHEN n = 1 THEN o_totalprice END) AS first_price,
         max(CASE WHEN n = 2 THEN o_totalprice END) AS second_price, max(CASE WHEN n = 3 THEN o_totalprice END) AS third_price
       FROM r GROUP BY o_custkey""",
)
def _(t):
    top = latest.topk_per_key(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, "n")
    return agg.pivot_max(top, ["o_custkey"], "n", "o_totalprice", {1: "first_price", 2: "second_price", 3: "third_price"})


@query(
    "pivot_sum_two_step",
    """WITH x AS (SELECT l_orderkey, l_returnflag, sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))) AS tax
                  FROM lineitem GROUP BY ALL)
       SELECT l_orderkey, CAST(sum(CASE WHEN l_returnflag = 'A' THEN tax END) AS DOUBLE) AS tax_a,
         CAST(sum(CASE WHEN l_returnflag = 'N' THEN tax END) AS DOUBLE) AS tax_n,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN tax END) AS DOUBLE) AS tax_r, CAST(sum(tax) AS DOUBLE) AS tax_total
       FROM x GROUP BY l_orderkey""",
)
def _(t):
    return indicators.tax_by_kind(
        t.lineitem, ["l_orderkey"], "l_returnflag", cents("l_extendedprice") * cents("l_tax"), 10_000, {"A": "tax_a", "N": "tax_n", "R": "tax_r"}
    )


@query(
    "string_agg_sorted",
    f"""WITH {INV}, n AS (SELECT client_id, invoice_id, row_number() OVER (PARTITION BY client_id ORDER BY due, invoice_id) AS p
                          FROM inv WHERE paid_on IS NULL)
       SELECT client_id, CAST((p - 1) // 1000 + 1 AS BIGINT) AS part, string_agg(CAST(invoice_id AS VARCHAR), ', ' ORDER BY p) AS open_invoices
       FROM n GROUP BY ALL""",
)
def _(t):
    unpaid = invoices(t).where(F.col("paid_on").isNull())
    return agg.list_parts(unpaid, ["client_id"], ["due", "invoice_id"], "invoice_id", "open_invoices")


@query(
    "distinct_list",
    "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS kinds FROM orders GROUP BY o_custkey",
)
def _(t):
    return agg.distinct_list(t.orders, ["o_custkey"], "o_orderpriority", "kinds", "; ")


@query(
    "kpi_ratio",
    """SELECT l_suppkey, CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100.0 AS returned_percent,
         CAST(count(*) AS DOUBLE) / (CASE WHEN count(*) FILTER (l_quantity > 49.5) = 0 THEN 0.000001
                                     ELSE CAST(count(*) FILTER (l_quantity > 49.5) AS DOUBLE) END) AS lines_per_bulk
       FROM lineitem GROUP BY l_suppkey""",
)
def _(t):
    lines, returned = F.count(F.lit(1)), F.count_if(F.col("l_returnflag") == "R")
    bulk = F.count_if(F.col("l_quantity") > 49.5)
    return t.lineitem.groupBy("l_suppkey").agg(
        agg.ratio(returned, lines, 100.0).alias("returned_percent"),
        agg.ratio(lines, bulk, zero_as=0.000001).alias("lines_per_bulk"),
    )


@query(
    "run_rate_projection",
    """WITH m AS (SELECT o_orderpriority, CAST(count(*) AS DOUBLE) AS sold FROM orders
                  WHERE o_orderdate BETWEEN TIMESTAMP '2001-06-01' AND TIMESTAMP '2001-06-18' GROUP BY 1)
       SELECT o_orderpriority, sold, sold + sold / 18 * 12 AS projected FROM m""",
)
def _(t):
    return indicators.month_projection(
        t.orders, "o_orderdate", ["o_orderpriority"], day("2001-06-18")
    )


@query(
    "weighted_projection",
    """WITH w AS (SELECT CAST(m AS DATE) AS day, CASE isodow(m) WHEN 7 THEN 0.0 WHEN 6 THEN 0.5 ELSE 1.0 END AS weight
                  FROM generate_series(DATE '2001-06-01', DATE '2001-06-30', INTERVAL 1 DAY) AS g(m)),
       f AS (SELECT CAST(sum(CASE WHEN day <= DATE '2001-06-18' THEN weight END) AS DOUBLE) AS gone, CAST(sum(weight) AS DOUBLE) AS whole FROM w),
       m AS (SELECT o_orderpriority, CAST(count(*) AS DOUBLE) AS sold FROM orders
             WHERE o_orderdate BETWEEN TIMESTAMP '2001-06-01' AND TIMESTAMP '2001-06-18' GROUP BY 1)
       SELECT o_orderpriority, sold, sold / gone * whole AS projected FROM m, f""",
)
def _(t):
    from tidemark.operators.reshape import date_grid

    weights = date_grid(t.spark, day("2001-06-01"), day("2001-06-30"), "1 day")
    dow = F.weekday("day")
    weights = weights.withColumn("weight", F.when(dow == 6, 0.0).when(dow == 5, 0.5).otherwise(1.0))
    return indicators.weighted_projection(
        t.orders, "o_orderdate", ["o_orderpriority"], day("2001-06-18"), weights
    )


@query(
    "two_point_average",
    f"""WITH {CON}, p AS (SELECT plan,
           count(*) FILTER (activated <= DATE '2001-06-29' AND (cancelled IS NULL OR cancelled > DATE '2001-06-29')) AS base_now,
           count(*) FILTER (activated <= DATE '2001-05-31' AND (cancelled IS NULL OR cancelled > DATE '2001-05-31')) AS base_before
         FROM con GROUP BY plan)
       SELECT plan, base_now, base_before, (base_now + base_before) / 2 AS average_base FROM p""",
)
def _(t):
    return indicators.two_point_average(contracts(t), ["plan"], day("2001-06-29"), day("2001-05-31"))


@query(
    "kpi_score",
    """WITH k AS (SELECT l_suppkey, CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS value
                  FROM lineitem GROUP BY l_suppkey)
       SELECT l_suppkey, value, CASE WHEN value <= 0.32 THEN 20.0 * 1.0 WHEN value > 0.34 THEN 20.0 * 0.6 ELSE 20.0 * 0.8 END AS score_down,
         CASE WHEN value >= 0.34 THEN 20.0 * 1.0 WHEN value < 0.32 THEN 20.0 * 0.6 ELSE 20.0 * 0.8 END AS score_up FROM k""".replace(
        "20.0", "CAST(20 AS DOUBLE)"
    ).replace(" 1.0 ", " CAST(1.0 AS DOUBLE) ").replace(" 0.6 ", " CAST(0.6 AS DOUBLE) ").replace(" 0.8 ", " CAST(0.8 AS DOUBLE) "),
)
def _(t):
    value = agg.ratio(F.count_if(F.col("l_returnflag") == "R"), F.count(F.lit(1)))
    k = t.lineitem.groupBy("l_suppkey").agg(value.alias("value"))
    score = lambda way, up, low: agg.kpi_score(F.col("value"), F.lit(way), F.lit(up), F.lit(low), F.lit(20.0))
    return k.select("l_suppkey", "value", score("down", 0.32, 0.34).alias("score_down"), score("up", 0.34, 0.32).alias("score_up"))


@query(
    "avg_ticket",
    f"""WITH {INV} SELECT client_id, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS billed, count(*) AS invoices,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS ticket FROM inv GROUP BY client_id""",
)
def _(t):
    billed = invoices(t).groupBy("client_id").agg(
        sum_money("amount").alias("billed"), F.count(F.lit(1)).alias("invoices")
    )
    return billed.withColumn("ticket", safe_divide("billed", F.col("invoices").cast("double")))


@query(
    "first_last_payment",
    f"""WITH {INV}, p AS (SELECT client_id, min(paid_on) AS first_payment, max(paid_on) AS last_payment FROM inv
                          WHERE paid_on IS NOT NULL GROUP BY client_id)
       SELECT p.client_id, first_payment, last_payment,
         CAST(sum(CASE WHEN paid_on = first_payment THEN CAST(amount AS DECIMAL(18,2)) END) AS DOUBLE) AS first_amount,
         CAST(sum(CASE WHEN paid_on = last_payment THEN CAST(amount AS DECIMAL(18,2)) END) AS DOUBLE) AS last_amount
       FROM p JOIN inv ON inv.client_id = p.client_id AND paid_on IN (first_payment, last_payment) GROUP BY ALL""",
)
def _(t):
    return indicators.first_last_payment(invoices(t), "client_id", "paid_on", "amount")


@query(
    "active_base_snapshot",
    f"""WITH {CON} SELECT DATE '{AS_OF}' AS ref, plan, n_name AS unit, r_name AS region,
         CASE WHEN DATE '{AS_OF}' - activated <= 90 THEN 'up to 3 months' WHEN DATE '{AS_OF}' - activated <= 365 THEN '4 to 12 months'
              ELSE 'over 12 months' END AS tenure, count(*) AS active
       FROM con LEFT JOIN customer ON client_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey
       WHERE activated <= DATE '{AS_OF}' AND (cancelled IS NULL OR cancelled > DATE '{AS_OF}') GROUP BY ALL""",
)
def _(t):
    clients = t.customer.select(F.col("c_custkey").alias("client_id"), F.col("c_nationkey").alias("unit_id"))
    units = t.nation.select(F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("unit"), F.col("n_regionkey").alias("region_id"))
    regions = t.region.select(F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region"))
    return indicators.active_base(contracts(t), clients, units, regions, day())
