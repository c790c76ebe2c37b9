from pyspark.sql import functions as F

from tidemark.operators import aggregates, latest, sets

ROWS = [(1, 1, "a"), (1, 3, "b"), (1, 3, "c"), (2, 5, "d"), (None, 1, "e"), (None, 2, "f")]


def frame(spark):
    return spark.createDataFrame(ROWS, "k int, v int, name string")


def names(df, col="name"):
    return sorted(r[col] for r in df.collect())


def test_latest_version_and_ties(spark):
    df = frame(spark)
    assert names(latest.latest_version(df, ["k"], ["v", "name"])) == ["c", "d", "f"]
    assert names(latest.latest_version(df, ["k"], ["v"], keep_ties=True)) == ["b", "c", "d", "f"]
    assert latest.latest_version(df.limit(0), ["k"], ["v"]).count() == 0


def test_latest_version_drops_rows_before_the_shuffle(spark):
    plan = latest.latest_version(frame(spark), ["k"], ["v", "name"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_nth_topk_and_priority(spark):
    df = frame(spark)
    order = [F.desc("v"), F.asc("name")]
    assert names(latest.nth_by(df, ["k"], order, 2)) == ["c", "e"]
    assert names(latest.topk_per_key(df, ["k"], order, 2)) == ["b", "c", "d", "e", "f"]
    rank = F.when(F.col("name") == "a", 1)
    assert names(latest.dedupe_by_priority(df, ["k"], rank, order)) == ["a", "d", "f"]


def test_number_versions_with_sliced_key(spark):
    rows = [(1, i) for i in range(100)] + [(2, 7)]
    df = spark.createDataFrame(rows, "k int, v int")
    got = latest.number_versions(df, ["k"], ["v"], hot_rows=10).collect()
    assert sorted((r.k, r.v, r.version, r.is_last) for r in got) == sorted(
        [(1, i, i + 1, i == 99) for i in range(100)] + [(2, 7, 1, True)]
    )


def test_rank_with_gaps(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (1, None), (2, 1)], "k int, v int")
    got = sorted(((r.k, r.v, r["rank"]) for r in latest.rank_with_gaps(df, ["k"], "v").collect()), key=str)
    assert got == sorted([(1, None, 1), (1, 5, 2), (1, 5, 2), (1, 6, 4), (2, 1, 1)], key=str)


def test_waterfall_keeps_all_rows_of_the_first_branch(spark):
    a = spark.createDataFrame([(1, "a1"), (1, "a2")], "k int, name string")
    b = spark.createDataFrame([(1, "b1"), (2, "b2")], "k int, name string")
    got = sets.waterfall_union([a, b], ["k"]).collect()
    assert sorted((r.k, r.name, r.branch) for r in got) == [(1, "a1", 1), (1, "a2", 1), (2, "b2", 2)]


def test_union_superset_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x", 2)], "id int, name string, favorite_number int")
    b = spark.createDataFrame([(2, "red", 3)], "id int, favorite_color string, favorite_number int")
    got = sets.union_superset({"a": a, "b": b}, exclude=["name"])
    assert got.columns == ["id", "favorite_number", "source", "favorite_color"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, 2, "a", None), (2, 3, "b", "red")]


def test_list_parts_split_long_lists(spark):
    df = spark.createDataFrame([(1, i) for i in range(25)] + [(2, 3)], "k int, v int")
    got = aggregates.list_parts(df, ["k"], ["v"], "v", "list", ",", part_size=10, hot_rows=5)
    parts = {(r.k, r.part): r["list"] for r in got.collect()}
    assert parts[(1, 2)] == ",".join(map(str, range(10, 20))) and parts[(2, 1)] == "3" and len(parts) == 4


def test_kpi_score_and_run_rate(spark):
    df = spark.createDataFrame([(0.9, "up"), (0.5, "up"), (0.7, "up"), (0.1, "down"), (0.9, "down"), (0.2, "down")], "v double, way string")
    up, low = F.when(F.col("way") == "up", 0.8).otherwise(0.1), F.when(F.col("way") == "up", 0.6).otherwise(0.3)
    got = df.select(aggregates.kpi_score(F.col("v"), F.col("way"), up, low, F.lit(10.0)).alias("s")).collect()
    assert [r.s for r in got] == [10.0, 6.0, 8.0, 10.0, 6.0, 8.0]
    rate = spark.range(1).select(aggregates.run_rate(F.lit(30.0), F.lit("2024-02-10").cast("date")).alias("x")).collect()
    assert rate[0].x == 30.0 + 30.0 / 10 * 19


def test_ratio_zero_handling(spark):
    one = spark.range(1)
    got = one.select(
        aggregates.ratio(F.lit(1), F.lit(0)).alias("a"), aggregates.ratio(F.lit(1), F.lit(0), zero_as=0.000001).alias("b")
    ).collect()[0]
    assert got.a is None and round(got.b) == 1_000_000


def test_money_sums_are_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 1000 + [(None,)], "x double")
    assert df.agg(aggregates.sum_money("x").alias("s")).collect()[0].s == 100.0
    assert df.agg(aggregates.exact_sum(aggregates.cents("x")).alias("s")).collect()[0].s == 100.0
