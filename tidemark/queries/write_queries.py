from pyspark.sql import functions as F

from tidemark.operators.latest import latest_version
from tidemark.sources import extract, writers
from tidemark.sources.lake import Lake, work_dir
from tidemark.queries.registry import query
from tidemark.queries.testbed import AS_OF, day

EV = "event_id, user_id, ts, event_type, value"
CUT = "TIMESTAMP '2024-01-20'"


def _events(t):
    return t.events.select("event_id", "user_id", "ts", "event_type", "value")


def _ts(text):
    return F.lit(text).cast("timestamp_ntz")


@query("incremental_extract", f"SELECT {EV} FROM events WHERE ts >= {CUT}")
def _(t):
    contract = extract.TableContract("app", "events", ("hourly",), incremental_col="ts")
    return extract.extract(_events(t), contract, hwm=_ts("2024-01-20"))


@query("full_extract_where", "SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' OR o_orderstatus = 'O'")
def _(t):
    contract = extract.TableContract("sales", "orders", full_where="o_orderdate >= timestamp_ntz'2001-01-01' OR o_orderstatus = 'O'")
    return extract.extract(t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus"), contract)


@query(
    "time_slices",
    """SELECT n AS slice_no, TIMESTAMP '2024-01-01' + n * INTERVAL 45 HOUR AS slice_start, TIMESTAMP '2024-01-01' + (n + 1) * INTERVAL 45 HOUR AS slice_end,
         count(event_id) AS events FROM generate_series(0, 15) AS g(n)
       LEFT JOIN events ON ts >= TIMESTAMP '2024-01-01' + n * INTERVAL 45 HOUR AND ts < TIMESTAMP '2024-01-01' + (n + 1) * INTERVAL 45 HOUR GROUP BY n""",
)
def _(t):
    start, end = _ts("2024-01-01"), _ts("2024-01-31")
    slices = extract.time_slices(t.spark, start, end, 16)
    counts = t.events.groupBy(extract.slice_number("ts", start, end, 16).alias("slice_no")).agg(F.count(F.lit(1)).alias("events"))
    return slices.join(counts, "slice_no", "left").fillna(0, ["events"])


@query("incr_append_gt", f"SELECT {EV} FROM events")
def _(t):
    return writers.append_newer(_events(t), _events(t).where(F.col("ts") < _ts("2024-01-20")), "ts")


@query(
    "incr_append_ge",
    f"SELECT {EV} FROM events WHERE ts < {CUT} UNION ALL SELECT {EV} FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE ts < {CUT})",
)
def _(t):
    return writers.append_newer(_events(t), _events(t).where(F.col("ts") < _ts("2024-01-20")), "ts", strict=False)


@query("incr_append_floor", f"SELECT {EV} FROM events WHERE ts > TIMESTAMP '2024-01-10'")
def _(t):
    empty = _events(t).where("user_id < 0")
    return writers.append_newer(_events(t), empty, "ts", floor="2024-01-10 00:00:00")


@query("incr_append_missing_keys", f"SELECT {EV} FROM events")
def _(t):
    return writers.append_missing(_events(t), _events(t).where("event_type <> 'error'"), ["event_id"])


@query(
    "merge_upsert",
    """WITH old AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
            new AS (SELECT o_orderkey, 'N' AS o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
       SELECT * FROM new UNION ALL SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)""",
)
def _(t):
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    old = t.orders.where(F.col("o_orderdate") < _ts("2000-01-01")).select(*cols)
    new = t.orders.where(F.col("o_orderdate") >= _ts("1999-01-01")).select(
        "o_orderkey", F.lit("N").alias("o_orderstatus"), (F.col("o_totalprice") * 2).alias("o_totalprice")
    )
    return writers.merge_upsert(old, new, ["o_orderkey"])


@query(
    "replace_by_key",
    """WITH old AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey, 'old' AS origin FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
            new AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey, 'new' AS origin FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01' AND o_orderstatus = 'O')
       SELECT * FROM new UNION ALL SELECT * FROM old WHERE day NOT IN (SELECT day FROM new)""",
)
def _(t):
    rows = t.orders.select(F.to_date("o_orderdate").alias("day"), "o_orderkey", "o_orderstatus")
    old = rows.where(F.col("day") < day("2000-01-01")).select("day", "o_orderkey", F.lit("old").alias("origin"))
    new = rows.where((F.col("day") >= day("1999-07-01")) & (F.col("o_orderstatus") == "O")).select("day", "o_orderkey", F.lit("new").alias("origin"))
    return writers.replace_by_key(old, new, ["day"])


def _monthly(t, origin):
    return t.orders.select(F.trunc("o_orderdate", "MM").alias("period"), "o_orderkey", F.lit(origin).alias("origin"))


def _carried(condition, extra=""):
    return f"""WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, o_orderkey FROM orders)
       SELECT period, o_orderkey, 'new' AS origin FROM o WHERE {condition}
       UNION ALL SELECT period, o_orderkey, 'old' FROM o WHERE NOT ({condition}) {extra}"""


@query("carry_forward_period", _carried("period = DATE '2001-06-01'"))
def _(t):
    # through the files: only the period present in the new rows is rewritten
    lake = Lake(t.spark, work_dir(t.spark, "carry"))
    lake.write(_monthly(t, "old"), "gold", "billing", "history", partition_by=["period"])
    lake.replace_periods(_monthly(t, "new").where(F.col("period") == day("2001-06-01")), "gold", "billing", "history", "period")
    return lake.read("gold", "billing", "history").select(F.col("period").cast("date").alias("period"), "o_orderkey", "origin")


@query("carry_forward_retention", _carried("period = DATE '2001-06-01'", f"AND period >= DATE '{AS_OF}' - 200"))
def _(t):
    new = _monthly(t, "new").where(F.col("period") == day("2001-06-01"))
    return writers.carry_forward(new, _monthly(t, "old"), "period", [day("2001-06-01")], 200, day())


@query("carry_forward_two_periods", _carried("period IN (DATE '2001-06-01', DATE '2001-05-01')"))
def _(t):
    both = [day("2001-06-01"), day("2001-05-01")]
    new = _monthly(t, "new").where(F.col("period").isin(both))
    return writers.carry_forward(new, _monthly(t, "old"), "period", both)


@query(
    "refresh_window",
    f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN CAST(o_orderdate AS DATE) >= DATE '{AS_OF}' - 100 THEN 'new' ELSE 'old' END AS origin
       FROM orders""",
)
def _(t):
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return writers.refresh_window(rows.withColumn("origin", F.lit("new")), rows.withColumn("origin", F.lit("old")), "day", F.date_sub(day(), 100))


@query(
    "refresh_open_rows",
    f"""WITH h AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status FROM orders WHERE o_orderpriority <> '5-LOW'),
            n AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, 'X' AS status FROM orders WHERE o_orderstatus <> 'P')
       SELECT h.o_orderkey, h.day, CASE WHEN DATE '{AS_OF}' - h.day <= 365 THEN coalesce(n.status, h.status) ELSE h.status END AS status
       FROM h LEFT JOIN n USING (o_orderkey) UNION ALL SELECT * FROM n WHERE o_orderkey NOT IN (SELECT o_orderkey FROM h)""",
)
def _(t):
    cols = ["o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("status")]
    history = t.orders.where("o_orderpriority <> '5-LOW'").select(*cols)
    new = t.orders.where("o_orderstatus <> 'P'").select(*cols).withColumn("status", F.lit("X"))
    return writers.refresh_open_rows(history, new, ["o_orderkey"], F.datediff(day(), F.col("day")) <= 365, ["status"])


@query(
    "scd2_snapshot",
    f"""WITH h AS (SELECT user_id, event_type, ts FROM events WHERE ts < {CUT} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
            c AS (SELECT user_id, event_type, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
       SELECT h.user_id, h.event_type, h.ts, h.ts AS valid_from, CASE WHEN c.ts > h.ts THEN c.ts END AS valid_to FROM h JOIN c USING (user_id)
       UNION ALL SELECT c.user_id, c.event_type, c.ts, c.ts, NULL FROM c LEFT JOIN h USING (user_id) WHERE h.ts IS NULL OR c.ts > h.ts""",
)
def _(t):
    def newest(df):
        return latest_version(df, ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "ts")

    history = newest(t.events.where(F.col("ts") < _ts("2024-01-20"))).select(
        "*", F.col("ts").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to")
    )
    once = writers.scd2_snapshot(newest(t.events), history, ["user_id"], "ts")
    return once


@query(
    "bronze_append_then_latest",
    """SELECT o_orderkey, 'second' AS load, o_totalprice FROM orders WHERE o_orderstatus = 'O'
       UNION ALL SELECT o_orderkey, 'first', o_totalprice FROM orders WHERE o_orderstatus <> 'O'""",
)
def _(t):
    lake = Lake(t.spark, work_dir(t.spark, "bronze"))
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    lake.append_extraction(rows.withColumn("load", F.lit("first")), "sales", "orders", "2001-06-29")
    lake.append_extraction(rows.where("o_orderstatus = 'O'").withColumn("load", F.lit("second")), "sales", "orders", AS_OF)
    newest = latest_version(lake.read("bronze", "sales", "orders"), ["o_orderkey"], ["_extraction_date"])
    return newest.select("o_orderkey", "load", "o_totalprice")


@query(
    "time_travel_read",
    "SELECT c_custkey, c_acctbal FROM customer",
)
def _(t):
    lake = Lake(t.spark, work_dir(t.spark, "versions"))
    first = lake.write(t.customer.select("c_custkey", "c_acctbal"), "gold", "base", "clients", cluster_by=["c_custkey"])
    lake.write(lake.read("gold", "base", "clients").withColumn("c_acctbal", F.lit(0.0)), "gold", "base", "clients")
    return lake.read("gold", "base", "clients", version=first)


@query(
    "time_travel_after_append_and_replace",
    """WITH o AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period FROM orders)
       SELECT 'first' AS state, o_orderkey, period FROM o WHERE o_orderkey % 2 = 0
       UNION ALL SELECT 'appended', o_orderkey, period FROM o
       UNION ALL SELECT 'replaced', o_orderkey, period FROM o WHERE period <> DATE '1998-01-01' OR o_orderkey % 3 = 0""",
)
def _(t):
    lake, place = Lake(t.spark, work_dir(t.spark, "states")), ("gold", "base", "orders")
    rows = t.orders.select("o_orderkey", F.trunc("o_orderdate", "MM").alias("period"))
    states = {
        "first": lake.write(rows.where("o_orderkey % 2 = 0"), *place, partition_by=["period"]),
        "appended": lake.write(rows.where("o_orderkey % 2 = 1"), *place, mode="append", partition_by=["period"]),
    }
    lake.replace_periods(rows.where("period = date'1998-01-01' AND o_orderkey % 3 = 0"), *place, "period")
    states["replaced"] = lake.versions(*place)[-1]
    seen = [
        lake.read(*place, version=v).select(F.lit(name).alias("state"), "o_orderkey", F.col("period").cast("date").alias("period"))
        for name, v in states.items()
    ]
    return seen[0].union(seen[1]).union(seen[2])
