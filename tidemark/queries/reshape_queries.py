from pyspark.sql import functions as F

from tidemark.operators import reshape, sets
from tidemark.queries.registry import query
from tidemark.queries.testbed import INV, day, invoices


@query(
    "cutover_union",
    """SELECT o_orderkey, o_orderdate, 'legacy' AS origin FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
       UNION ALL SELECT o_orderkey, o_orderdate, 'current' FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""",
)
def _(t):
    cols = t.orders.select("o_orderkey", "o_orderdate")
    old, new = cols.withColumn("origin", F.lit("legacy")), cols.withColumn("origin", F.lit("current"))
    return sets.cutover_union(old, new, "o_orderdate", F.lit("1999-01-01").cast("timestamp_ntz"))


@query(
    "union_distinct",
    "SELECT c_nationkey AS unit FROM customer UNION SELECT s_nationkey FROM supplier",
)
def _(t):
    return sets.union_distinct(
        t.customer.select(F.col("c_nationkey").alias("unit")), t.supplier.select(F.col("s_nationkey").alias("unit"))
    )


@query(
    "union_sources",
    """SELECT event_id, user_id, value, 'purchases' AS source FROM events WHERE event_type = 'purchase'
       UNION ALL SELECT event_id, user_id, value, 'signups' FROM events WHERE event_type = 'signup'""",
)
def _(t):
    cols = ["event_id", "user_id", "value"]
    return sets.union_sources(
        {
            "purchases": t.events.where("event_type = 'purchase'").select(*cols),
            "signups": t.events.where("event_type = 'signup'").select(*cols),
        }
    )


@query(
    "union_superset",
    """SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS label, 'customer' AS source FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_name, 'supplier' FROM supplier""",
)
def _(t):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), "c_name")
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("label"))
    return sets.union_superset({"customer": a, "supplier": b}, exclude=["c_name"])


@query(
    "symmetric_difference",
    """(SELECT o_custkey, 'a' AS only_in FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'))
       UNION ALL (SELECT o_custkey, 'b' FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' EXCEPT ALL SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'))""",
)
def _(t):
    a = t.orders.where("o_orderstatus = 'F'").select("o_custkey")
    return sets.symmetric_difference(a, t.orders.where("o_orderstatus = 'P'").select("o_custkey"))


@query(
    "waterfall_union",
    f"""WITH {INV}, b AS (
         SELECT client_id, invoice_id, 1 AS branch FROM inv WHERE kind = '1-URGENT' AND paid_on IS NULL
         UNION ALL SELECT client_id, invoice_id, 2 FROM inv WHERE kind = '2-HIGH' AND paid_on IS NULL
         UNION ALL SELECT client_id, invoice_id, 3 FROM inv WHERE paid_on IS NULL)
       SELECT * FROM b QUALIFY branch = min(branch) OVER (PARTITION BY client_id)""",
)
def _(t):
    unpaid = invoices(t).where(F.col("paid_on").isNull()).select("client_id", "invoice_id", "kind")
    return sets.waterfall_union(
        [unpaid.where("kind = '1-URGENT'"), unpaid.where("kind = '2-HIGH'"), unpaid], ["client_id"]
    ).select("client_id", "invoice_id", "branch")


@query(
    "unpivot_metrics",
    """SELECT l_orderkey, l_linenumber, l_partkey, metric, value FROM (
         SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS quantity, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax FROM lineitem)
       UNPIVOT (value FOR metric IN (quantity, discount, tax))""",
)
def _(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
        F.nullif("l_discount", F.lit(0.0)).alias("d"), F.nullif("l_tax", F.lit(0.0)).alias("x"),
    )
    return reshape.unpivot_metrics(
        lines, ["l_orderkey", "l_linenumber", "l_partkey"], {"l_quantity": "quantity", "d": "discount", "x": "tax"}
    )


@query(
    "unpivot_keep_nulls",
    """SELECT p_partkey, prop, val FROM (SELECT p_partkey, CAST(p_size AS VARCHAR) AS size,
         nullif(p_brand, 'Brand#1') AS brand, p_type AS kind FROM part)
       UNPIVOT INCLUDE NULLS (val FOR prop IN (size, brand, kind))""",
)
def _(t):
    wide = t.part.select("p_partkey", F.col("p_size").cast("string").alias("size"), F.nullif("p_brand", F.lit("Brand#1")).alias("brand"), F.col("p_type").alias("kind"))
    return reshape.unpivot_metrics(wide, ["p_partkey"], {"size": "size", "brand": "brand", "kind": "kind"}, "prop", "val", drop_nulls=False)


FEATURES = {"streaming": "%widget%", "sports": "%ring%", "movies": "%large%", "kids": "%small%"}


@query(
    "feature_flags_unpivot",
    " UNION ALL ".join(f"SELECT p_partkey, '{n}' AS feature FROM part WHERE p_name LIKE '{p}'" for n, p in FEATURES.items()),
)
def _(t):
    from tidemark.plans.catalogue import features_of

    return features_of(t.part, "p_partkey", "p_name", FEATURES)


@query(
    "date_grid_days",
    """WITH g AS (SELECT CAST(d AS DATE) AS day FROM generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY) AS s(d))
       SELECT day, count(o_orderkey) AS orders FROM g LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY day""",
)
def _(t):
    span = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    grid = span.select(F.explode(F.sequence("a", "b")).alias("day"))
    counts = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    return grid.join(counts, "day", "left").fillna(0, ["orders"])


@query(
    "date_grid_months",
    """SELECT o_custkey, CAST(last_day(m) AS DATE) AS ref FROM (SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1),
         generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH) AS g(m)""",
)
def _(t):
    span = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    ends = reshape.month_ends(F.to_date("a"), F.to_date("b"))
    return span.select("o_custkey", F.explode(ends).alias("ref"))


@query(
    "date_spine",
    """SELECT CAST(d AS DATE) AS week_start, count(o_orderkey) AS orders
       FROM generate_series(DATE '1995-01-01', DATE '2001-12-30', INTERVAL 7 DAY) AS s(d)
       LEFT JOIN orders ON CAST(o_orderdate AS DATE) >= CAST(d AS DATE) AND CAST(o_orderdate AS DATE) < CAST(d AS DATE) + 7 GROUP BY 1""",
)
def _(t):
    spine = reshape.date_spine(t.spark, day("1995-01-01"), day("2001-12-31"), "week", "week_start")
    offset = F.pmod(F.datediff(F.to_date("o_orderdate"), day("1995-01-01")), F.lit(7))
    counts = t.orders.groupBy(F.date_sub(F.to_date("o_orderdate"), offset).alias("week_start")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return spine.join(counts, "week_start", "left").fillna(0, ["orders"])


@query(
    "generate_series",
    "SELECT p_partkey, CAST(unnest(generate_series(1, p_size)) AS INTEGER) AS n FROM part",
)
def _(t):
    return t.part.select("p_partkey", F.explode(F.sequence(F.lit(1), F.col("p_size"))).alias("n"))


@query(
    "split_explode",
    """SELECT c_custkey, trim(unnest(string_split(c_mktsegment || ' ; ' || c_name || ';x', ';'))) AS piece FROM customer""",
)
def _(t):
    listed = t.customer.select("c_custkey", F.concat("c_mktsegment", F.lit(" ; "), "c_name", F.lit(";x")).alias("piece"))
    return reshape.split_rows(listed, "piece", ";")


@query(
    "json_path_extract",
    """SELECT event_id, CAST(coalesce(props ->> '$.key', props ->> '$.k') AS INTEGER) AS k FROM events""",
)
def _(t):
    first = F.coalesce(F.get_json_object("props", "$.key"), F.get_json_object("props", "$.k"))
    return t.events.select("event_id", first.cast("int").alias("k"))


@query(
    "json_struct_fields",
    """SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS answer, event_type AS reason FROM events""",
)
def _(t):
    # field names with blanks, as survey answers have them
    text = F.to_json(F.struct(F.get_json_object("props", "$.k").cast("int").alias("question 1/2"), F.col("event_type").alias("why so")))
    parsed = F.from_json(text, "`question 1/2` int, `why so` string")
    return t.events.select(
        "event_id", parsed.getField("question 1/2").alias("answer"), parsed.getField("why so").alias("reason")
    )


CHILD = "SELECT o_orderkey, o_custkey, o_totalprice AS amount, i AS item_no FROM orders, generate_series(1, 1 + o_orderkey % 3) AS g(i)"


def _orders_json(t):
    """Orders with their instalments as a JSON array in a text column."""
    items = F.transform(
        F.sequence(F.lit(1), (1 + F.col("o_orderkey") % 3).cast("int")),
        lambda i: F.struct(i.alias("item_no"), F.col("o_totalprice").alias("amount"),
                           F.array(F.lit("icms"), F.lit("iss")).alias("taxes"), F.array(i, i * 10).alias("bases")),
    )
    return t.orders.select("o_orderkey", "o_custkey", F.to_json(items).alias("doc"))


@query("json_explode", CHILD.replace("i AS item_no", "CAST(i AS INTEGER) AS item_no"))
def _(t):
    return reshape.json_children(_orders_json(t), ["o_orderkey", "o_custkey"], "doc", "array<struct<item_no:int,amount:double>>")


@query(
    "json_explode_nested",
    """SELECT o_orderkey, CAST(i AS INTEGER) AS item_no, tax FROM orders, generate_series(1, 1 + o_orderkey % 3) AS g(i),
         (VALUES ('icms'), ('iss')) AS x(tax)""",
)
def _(t):
    deep = reshape.json_grandchildren(
        _orders_json(t), ["o_orderkey"], "doc", "array<struct<item_no:int,taxes:array<string>>>", ["taxes"]
    )
    return deep.select("o_orderkey", "item_no", F.col("taxes").alias("tax"))


@query(
    "json_sibling_zip",
    """SELECT o_orderkey, CAST(i AS INTEGER) AS item_no, tax, CAST(i * f AS INTEGER) AS base FROM orders, generate_series(1, 1 + o_orderkey % 3) AS g(i),
         (VALUES ('icms', 1), ('iss', 10)) AS x(tax, f)""",
)
def _(t):
    schema = "array<struct<item_no:int,taxes:array<string>,bases:array<int>>>"
    deep = reshape.json_grandchildren(_orders_json(t), ["o_orderkey"], "doc", schema, ["taxes", "bases"], zipped=True)
    return deep.select("o_orderkey", "item_no", F.col("taxes").alias("tax"), F.col("bases").alias("base"))


@query(
    "json_sibling_cross",
    """SELECT o_orderkey, CAST(i AS INTEGER) AS item_no, tax, CAST(i * f AS INTEGER) AS base FROM orders, generate_series(1, 1 + o_orderkey % 3) AS g(i),
         (VALUES ('icms'), ('iss')) AS x(tax), (VALUES (1), (10)) AS y(f)""",
)
def _(t):
    schema = "array<struct<item_no:int,taxes:array<string>,bases:array<int>>>"
    deep = reshape.json_grandchildren(_orders_json(t), ["o_orderkey"], "doc", schema, ["taxes", "bases"])
    return deep.select("o_orderkey", "item_no", F.col("taxes").alias("tax"), F.col("bases").alias("base"))


@query(
    "array_transform_join",
    """SELECT o_orderkey, string_agg('item ' || CAST(i AS VARCHAR), ' | ' ORDER BY i) AS items
       FROM orders, generate_series(1, 1 + o_orderkey % 3) AS g(i) GROUP BY o_orderkey""",
)
def _(t):
    parsed = F.from_json("doc", "array<struct<item_no:int>>")
    names = F.transform(parsed, lambda s: F.concat(F.lit("item "), s["item_no"]))
    return _orders_json(t).select("o_orderkey", F.concat_ws(" | ", names).alias("items"))


@query(
    "nested_field_access",
    """SELECT DISTINCT user_id, event_type AS kind, CAST(props ->> '$.k' AS INTEGER) AS k FROM events""",
)
def _(t):
    message = F.struct(F.struct(F.col("event_type").alias("type"), F.from_json("props", "map<string,int>").alias("body")).alias("element"))
    nested = t.events.select("user_id", message.alias("message"))
    return nested.select(
        "user_id",
        F.col("message")["element"]["type"].alias("kind"),
        F.col("message")["element"]["body"]["k"].alias("k"),
    ).distinct()


@query(
    "star_except_prefix",
    "SELECT c_custkey AS src_c_custkey_x, c_name AS src_c_name_x, c_mktsegment AS src_c_mktsegment_x FROM customer",
)
def _(t):
    from tidemark.functions.text import star

    return star(t.customer, exclude=["c_nationkey", "c_acctbal"], prefix="src_", suffix="_x")


@query(
    "column_values_by_freq",
    """SELECT event_type AS value, count(*) AS times FROM events GROUP BY 1""",
)
def _(t):
    from tidemark.plans.catalogue import column_values

    return column_values(t.events, "event_type")
