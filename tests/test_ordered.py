import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import ordered as o
from tidemark.operators.skew import SLICE, as_number, find_cuts, with_slices

STEPS = {
    "prev": o.lag("v"),
    "next": o.lead("v"),
    "n": o.ordinal(),
    "last": o.is_last(),
    "head": o.first_value("v"),
    "seen": o.last_seen("v"),
    "run": o.running_sum("v"),
    "top": o.running_max("v"),
    "total": o.group_count(),
}


def rows():
    rng = random.Random(7)
    out, t0 = [], datetime(2024, 1, 1)
    for i in range(600):
        key = rng.choice([1, 1, 1, 1, 2, 3, None])
        # a burst: most of key 1 sits in one minute
        ts = t0 + timedelta(seconds=rng.choice([rng.randrange(60), rng.randrange(10**6)]))
        out.append((key, ts, i, None if rng.random() < 0.2 else rng.randrange(100)))
    return out


@pytest.mark.parametrize("descending", [False, True])
def test_along_key_equals_plain_window(spark, descending):
    df = spark.createDataFrame(rows(), "k int, ts timestamp, id int, v int")
    got = o.along_key(df, ["k"], ["ts", "id"], STEPS, descending=descending, hot_rows=20)
    d = [F.col(c).desc() if descending else F.col(c).asc() for c in ("ts", "id")]
    w = Window.partitionBy("k").orderBy(*d)
    r = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select(
        "*",
        F.lag("v").over(w).alias("prev"),
        F.lead("v").over(w).alias("next"),
        F.row_number().over(w).alias("n"),
        F.lead(F.lit(1)).over(w).isNull().alias("last"),
        F.first("v").over(r).alias("head"),
        F.last("v", True).over(r).alias("seen"),
        F.sum(F.coalesce("v", F.lit(0))).over(r).alias("run"),
        F.max("v").over(r).alias("top"),
        F.count(F.lit(1)).over(Window.partitionBy("k")).alias("total"),
    )
    key = lambda r: r["id"]
    assert [tuple(x) for x in sorted(got.collect(), key=key)] == [
        tuple(x) for x in sorted(want.collect(), key=key)
    ]


def test_hot_key_is_cut_small(spark):
    df = spark.createDataFrame(rows(), "k int, ts timestamp, id int, v int")
    sizes = with_slices(df, ["k"], "ts", find_cuts(df, ["k"], "ts", 20)).groupBy("k", SLICE).count().collect()
    hot = [r["count"] for r in sizes if r["k"] == 1]
    assert len(hot) > 20 and max(hot) <= 40
    assert find_cuts(df, ["k"], "ts").table is None


def test_one_day_is_cut_by_the_next_column(spark):
    """2,000 rows of one key and one day: about 20 slices, whatever kind the second column is."""
    day = datetime(2024, 1, 1)
    df = spark.range(2000).select(
        F.lit(1).alias("k"), F.lit(day).cast("date").alias("d"), F.col("id"), F.concat(F.lit("n"), F.lpad("id", 4, "0")).alias("name")
    )
    for second in ("id", "name"):
        cuts = find_cuts(df, ["k"], ["d", second], 100)
        laid = with_slices(df, ["k"], ["d", second], cuts)
        sizes = laid.groupBy(SLICE).agg(F.count(F.lit(1)).alias("n"), F.min(second).alias("low"), F.max(second).alias("high")).orderBy(SLICE).collect()
        assert 15 <= len(sizes) <= 35 and max(r.n for r in sizes) <= 200
        assert all(a.high < b.low for a, b in zip(sizes, sizes[1:])) and sizes[0][SLICE] > 0
        got = o.along_key(df, ["k"], ["d", second], {"n": o.ordinal()}, hot_rows=100)
        assert all(r.n == r.id + 1 for r in got.collect())


def test_heavy_values_among_others(spark):
    """Days of very different size, NULL days, and equal rows that nothing tells apart."""
    rng, t0 = random.Random(2), datetime(2024, 1, 1)
    data = [(1, t0 + timedelta(days=rng.choice([3, 3, 3, 3, 9, 9, rng.randrange(30)])), rng.randrange(50), i) for i in range(1500)]
    data += [(1, None, rng.randrange(3), i) for i in range(1500, 1900)] + [(2, t0, 0, i) for i in range(1900, 1910)]
    df = spark.createDataFrame(data, "k int, ts timestamp, part int, id int").withColumn("d", F.to_date("ts"))
    cuts = find_cuts(df, ["k"], ["d", "part", "id"], 40)
    laid = with_slices(df, ["k"], ["d", "part", "id"], cuts)
    sizes = {(r.k, r[SLICE]): r["count"] for r in laid.groupBy("k", SLICE).count().collect()}
    assert max(sizes.values()) <= 80 and sizes[2, 0] == 10
    steps = {"n": o.ordinal(), "prev": o.lag("id"), "run": o.running_sum("part")}
    key = lambda r: r["id"]
    for descending in (False, True):
        plain = o.along_key(df, ["k"], ["d", "part", "id"], steps, descending=descending, hot_rows=None).collect()
        sliced = o.along_key(df, ["k"], ["d", "part", "id"], steps, descending=descending, hot_rows=40).collect()
        assert sorted(plain, key=key) == sorted(sliced, key=key)
    same = df.select("k", "d", F.lit(1).alias("one"))
    assert with_slices(same, ["k"], ["d", "one"], find_cuts(same, ["k"], ["d", "one"], 40)).count() == 1910


def test_order_numbers_keep_the_order_of_local_times(spark):
    texts = ["2024-03-10 01:59:59.999999", "2024-03-10 02:30:00", "2024-03-10 03:00:00", "1960-01-01 00:00:00.5"]
    df = spark.createDataFrame([(x,) for x in texts], "x string").select(F.col("x").cast("timestamp_ntz").alias("t"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    got = [r[0] for r in df.select(as_number(df, "t")).collect()]
    spark.conf.set("spark.sql.session.timeZone", before)
    assert got[3] < 0 < got[0] < got[1] < got[2] and got[2] - got[1] == 1800.0


def test_plain_path_equals_hot_path(spark):
    df = spark.createDataFrame(rows(), "k int, ts timestamp, id int, v int")
    key = lambda r: r["id"]
    a = o.along_key(df, ["k"], ["ts", "id"], STEPS, hot_rows=None).collect()
    b = o.along_key(df, ["k"], ["ts", "id"], STEPS, hot_rows=50).collect()
    assert sorted(a, key=key) == sorted(b, key=key)
