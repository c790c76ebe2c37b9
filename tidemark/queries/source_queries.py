"""Sources and sinks by round trips of the given tables."""

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.dates import anchor_dates
from tidemark.queries.registry import query
from tidemark.sources import extract
from tidemark.sources.lake import Lake, children, load_seed, rename_parts, work_dir
from tidemark.streaming import streams

NATION = "SELECT n_nationkey, n_name, n_regionkey FROM nation"


def _nation(t):
    return t.nation.select("n_nationkey", "n_name", "n_regionkey")


@query("seed_csv_with_mark", "SELECT CAST(r_regionkey AS INTEGER) AS r_regionkey, r_name FROM region")
def _(t):
    """A CSV file whose first column name has a byte-order mark before it."""
    path = work_dir(t.spark, "seed")
    marked = t.region.select(F.col("r_regionkey").alias("\ufeffr_regionkey"), "r_name")
    marked.coalesce(1).write.csv(path, header=True)
    return load_seed(t.spark, path, "r_regionkey int, r_name string")


@query("extract_strict_watermark", "SELECT o_orderkey, o_orderdate AS \"updatedAt\" FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'")
def _(t):
    contract = extract.TableContract("crm", "orders", incremental_col="updatedAt", inclusive=False)
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").alias("updatedAt"))
    return extract.extract(rows, contract, hwm=F.lit("2000-01-01").cast("timestamp_ntz"))


@query("full_extract", "SELECT c_custkey, c_name FROM customer")
def _(t):
    return extract.extract(t.customer.select("c_custkey", "c_name"), extract.TableContract("crm", "customer"))


@query(
    "cadence_extracts",
    """SELECT 'nation' AS table_name, count(*) AS rows FROM nation UNION ALL SELECT 'orders', count(*) FROM orders
       WHERE o_orderstatus = 'O'""",
)
def _(t):
    contracts = [
        extract.TableContract("erp", "nation", ("hourly", "daily")),
        extract.TableContract("erp", "orders", ("hourly",), full_where="o_orderstatus = 'O'"),
        extract.TableContract("erp", "customer", ("daily",)),
    ]
    due = [(c.table, extract.extract(getattr(t, c.table), c)) for c in extract.due_tables(contracts, "hourly")]
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in due]
    return counts[0].union(counts[1])


@query("landing_round_trip", NATION + " WHERE n_regionkey < 3")
def _(t):
    path = Lake(t.spark, work_dir(t.spark, "landing"), env="dev").landing_path("jdbc", "erp", "public", "nation")
    _nation(t).where("n_regionkey < 3").write.json(path)
    return extract.read_export(t.spark, path, "json", "n_nationkey int, n_name string, n_regionkey int")


@query("queue_landing", "SELECT event_id, user_id, event_type FROM events")
def _(t):
    """Messages landed as JSON files, taken over by a stream."""
    root = work_dir(t.spark, "queue")
    t.events.select("event_id", "user_id", "event_type").repartition(4).write.json(f"{root}/in")
    rows = streams.drop_folder(t.spark, f"{root}/in", "event_id bigint, user_id bigint, event_type string", "json", 2)
    streams.run_to_table(rows, f"{root}/out", f"{root}/checkpoint")
    return t.spark.read.parquet(f"{root}/out")


@query(
    "dated_file_drops",
    """SELECT o_orderkey, DATE '2001-06-01' + CAST(o_orderkey % 3 AS INTEGER) AS _file_generation_date FROM orders""",
)
def _(t):
    """CSV drops of each day in several files, the date in their names; another file beside them is not read."""
    root = work_dir(t.spark, "drops")
    for k, name in enumerate(("orders_20010601", "orders_20010602", "orders_20010603", "other_20010603")):
        part = t.orders.where(F.col("o_orderkey") % 3 == k % 3).select("o_orderkey")
        part.hint("rebalance").write.csv(f"{root}/parts/{k}", header=True)
        rename_parts(t.spark, f"{root}/parts/{k}", ".csv", f"{root}/drops/{name}")
    return extract.read_file_drop(t.spark, f"{root}/drops", "orders_", "o_orderkey bigint")


@query("warehouse_exports", f"SELECT 'orc' AS fmt, * FROM ({NATION}) UNION ALL SELECT 'json', * FROM ({NATION})")
def _(t):
    root, found = work_dir(t.spark, "exports"), []
    for fmt in ("orc", "json"):
        _nation(t).write.format(fmt).save(f"{root}/{fmt}")
        back = extract.read_export(t.spark, f"{root}/{fmt}", fmt, "n_nationkey int, n_name string, n_regionkey int")
        found.append(back.select(F.lit(fmt).alias("fmt"), "*"))
    return found[0].union(found[1])


@query("view_sink", NATION + " WHERE n_regionkey = 1")
def _(t):
    lake = Lake(t.spark, work_dir(t.spark, "views"))
    return lake.materialize("tidemark_nations_of_one_region", _nation(t).where("n_regionkey = 1"))


@query("clustered_files", "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS overlapping_files FROM orders")
def _(t):
    """Files of a clustered write hold ranges that do not overlap."""
    lake = Lake(t.spark, work_dir(t.spark, "clustered"))
    lake.write(t.orders.select("o_orderkey", "o_custkey"), "gold", "base", "orders", cluster_by=["o_orderkey"])
    files = lake.read("gold", "base", "orders").groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"), F.count(F.lit(1)).alias("n")
    )
    before = F.max("high").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("before", before).agg(
        F.sum("n").alias("rows"), F.count_if(F.col("before") >= F.col("low")).alias("overlapping_files")
    )


@query("purged_versions", "SELECT n_nationkey, CAST(1 AS BIGINT) AS versions_left, CAST(2 AS BIGINT) AS folders_left FROM nation WHERE n_nationkey <> 3")
def _(t):
    """Retention keeps the newest version and the folders it reads: that of the second write and of the append."""
    lake, place = Lake(t.spark, work_dir(t.spark, "purge")), ("gold", "base", "nation")
    lake.write(_nation(t), *place)
    lake.write(_nation(t).where("n_nationkey > 3"), *place)
    lake.write(_nation(t).where("n_nationkey < 3"), *place, mode="append")
    lake.purge_versions(*place, keep_hours=1, now_ms=4_102_444_800_000)
    left = [F.lit(len(lake.versions(*place))), F.lit(len([n for n, _ in children(t.spark, lake.path(*place)) if n.startswith("_load=")]))]
    return lake.read(*place).select("n_nationkey", left[0].cast("bigint").alias("versions_left"), left[1].cast("bigint").alias("folders_left"))


@query(
    "anchor_date_counts",
    """SELECT count(*) FILTER (WHERE d BETWEEN DATE '2001-06-01' AND DATE '2001-06-30') AS this_month,
              count(*) FILTER (WHERE d BETWEEN DATE '2001-05-01' AND DATE '2001-05-31') AS last_month,
              count(*) FILTER (WHERE d >= DATE '2001-07-01') AS later, count(*) FILTER (WHERE d = DATE '2001-06-14') AS yesterday
       FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def _(t):
    a = {k: F.lit(v) for k, v in anchor_dates(date(2001, 6, 15)).items()}
    d = F.to_date("o_orderdate")
    return t.orders.agg(
        F.count_if(d.between(a["first_day_month"], a["last_day_month"])).alias("this_month"),
        F.count_if(d.between(a["first_day_last_month"], a["last_day_last_month"])).alias("last_month"),
        F.count_if(d >= a["first_day_next_month"]).alias("later"), F.count_if(d == a["yesterday"]).alias("yesterday"),
    )
