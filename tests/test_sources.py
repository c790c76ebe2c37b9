import json
import shutil
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.sources import extract, writers
from tidemark.sources.lake import Lake, load_seed, work_dir


def pairs(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def kv(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), env="dev")


def test_versions_overwrite_append_and_time_travel(spark, lake):
    assert lake.path("gold", "base", "t").endswith("/gold_dev/base/t")
    assert lake.write(kv(spark, [(1, "a")]), "gold", "base", "t") == 1
    doubled = lake.read("gold", "base", "t").union(kv(spark, [(2, "b")]))
    assert lake.write(doubled, "gold", "base", "t") == 2  # reads what it replaces
    lake.write(kv(spark, [(3, "c")]), "gold", "base", "t", mode="append")
    assert pairs(lake.read("gold", "base", "t"), "k") == [(1,), (2,), (3,)]
    assert pairs(lake.read("gold", "base", "t", version=1), "k") == [(1,)]
    with pytest.raises(FileNotFoundError):
        lake.read("gold", "base", "t", version=9)


def test_unfinished_versions_do_not_count(spark, lake, tmp_path):
    lake.write(kv(spark, [(1, "a")]), "gold", "base", "t")
    (tmp_path / "lake/gold_dev/base/t/v2").mkdir()
    assert lake.versions("gold", "base", "t") == [1]


def test_a_read_is_one_scan_of_a_list(spark, lake, tmp_path):
    """500 appended versions: the list is planned at once, and old versions stay readable."""
    lake.write(kv(spark, [(0, "a")]), "gold", "base", "t")
    base = tmp_path / "lake/gold_dev/base/t"
    (load,) = lake.folders("gold", "base", "t")
    for i in range(499):  # as 499 appends leave it
        shutil.copytree(base / load, base / f"_load=copy{i}")
    listed = json.loads((base / "_versions/v1.json").read_text())
    listed["folders"] += [f"_load=copy{i}" for i in range(499)]
    (base / "_versions/v500.json").write_text(json.dumps(listed))
    lake.read("gold", "base", "t")
    began = time.time()
    df = lake.read("gold", "base", "t")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert time.time() - began < 1.0
    assert plan.count("Relation [") == 1 and df.count() == 500
    assert lake.read("gold", "base", "t", version=1).count() == 1
    assert lake.compact("gold", "base", "t") == 501 and len(lake.folders("gold", "base", "t")) == 1
    assert lake.read("gold", "base", "t").count() == 500


def test_new_columns_types_and_partitions_of_appends(spark, lake):
    lake.write(kv(spark, [(1, "a")]), "gold", "base", "t", partition_by=["k"])
    lake.write(spark.createDataFrame([(2, "b", 5)], "k int, v string, w int"), "gold", "base", "t", mode="append")
    assert pairs(lake.read("gold", "base", "t"), "k", "v", "w") == [(1, "a", None), (2, "b", 5)]
    with pytest.raises(ValueError):
        lake.write(spark.createDataFrame([("x", "b")], "k string, v string"), "gold", "base", "t", mode="append")
    with pytest.raises(ValueError):
        lake.write(kv(spark, [(1, "a")]), "gold", "base", "t", mode="append", partition_by=["v"])
    assert lake.versions("gold", "base", "t") == [1, 2]
    lake.write(kv(spark, []), "gold", "base", "empty")
    assert lake.read("gold", "base", "empty").collect() == []


def test_replaced_periods_are_pruned_and_others_keep_their_files(spark, lake):
    old = spark.createDataFrame([(f"2024-{m:02}", m) for m in range(1, 7)] + [(None, 0)], "p string, v int")
    place = ("gold", "b", "h")
    lake.write(old, *place, partition_by=["p"])
    kept = lambda: {r.f.rsplit("/", 1)[-1] for r in lake.read(*place).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    before = kept()
    lake.replace_periods(spark.createDataFrame([("2024-03", 33)], "p string, v int"), *place, "p")
    assert len(before & kept()) == 6 and len(kept()) == 7
    gone = spark.createDataFrame([("2024-05",), (None,)], "p string")
    lake.replace_periods(spark.createDataFrame([("2024-07", 7)], "p string, v int"), *place, "p", gone=gone)
    assert pairs(lake.read(*place), "p", "v") == [("2024-01", 1), ("2024-02", 2), ("2024-03", 33), ("2024-04", 4), ("2024-06", 6), ("2024-07", 7)]
    plan = lake.read(*place).where("p = '2024-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    # a table of another layout is laid out anew
    lake.write(old, "gold", "b", "plain")
    lake.replace_periods(spark.createDataFrame([("2024-03", 33)], "p string, v int"), "gold", "b", "plain", "p")
    assert pairs(lake.read("gold", "b", "plain"), "v") == [(0,), (1,), (2,), (33,), (4,), (5,), (6,)]


def test_purge_keeps_the_newest(spark, lake):
    for i in range(3):
        lake.write(kv(spark, [(i, "x")]), "gold", "base", "t")
    later = int(time.time() * 1000) + 200 * 3_600_000
    assert lake.purge_versions("gold", "base", "t", 168, int(time.time() * 1000)) == []
    assert lake.purge_versions("gold", "base", "t", 168, later) == [1, 2]
    assert pairs(lake.read("gold", "base", "t"), "k") == [(2,)]


def test_replace_periods_twice_gives_the_same(spark, lake):
    old = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "p string, v int")
    new = spark.createDataFrame([("2024-02", 9), ("2024-03", 8)], "p string, v int")
    lake.write(old, "gold", "b", "h", partition_by=["p"])
    for _ in range(2):
        lake.replace_periods(new, "gold", "b", "h", "p")
        assert pairs(lake.read("gold", "b", "h"), "p", "v") == [("2024-01", 1), ("2024-02", 9), ("2024-03", 8)]


def test_clustered_write_orders_files(spark, lake):
    lake.write(spark.range(1000).withColumn("c", F.col("id") % 3), "gold", "b", "c", cluster_by=["c"])
    assert lake.read("gold", "b", "c").count() == 1000


def test_materialize(spark, lake):
    df = kv(spark, [(1, "a")])
    assert pairs(lake.materialize("some_view", df), "k") == [(1,)]
    assert pairs(lake.materialize("some_table", df, "table"), "k") == [(1,)]
    assert pairs(lake.materialize("some_table", df, "append"), "k") == [(1,), (1,)]


def test_work_dir_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(f"{shared}/x-") and work_dir(spark, "x") != work_dir(spark, "x")


def test_seed_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_bytes("﻿marca,ativo\nAlfa,1\nBeta,0\n".encode())
    assert pairs(load_seed(spark, str(path), "marca string, ativo int"), "marca", "ativo") == [("Alfa", 1), ("Beta", 0)]


def test_file_drop_takes_the_date_from_the_name(spark, tmp_path):
    (tmp_path / "Sent_20240105.csv").write_text("id\n1\n")
    (tmp_path / "Sent_20240106.csv").write_text("id\n1\n2\n")
    (tmp_path / "Other_20240107.csv").write_text("id\n9\n")
    got = extract.read_file_drop(spark, str(tmp_path), "Sent", "id int")
    assert pairs(got, "id", "_file_generation_date") == [(1, date(2024, 1, 5)), (1, date(2024, 1, 6)), (2, date(2024, 1, 6))]


def test_exports_and_json(spark, tmp_path):
    kv(spark, [(1, "a")]).write.json(str(tmp_path / "j"))
    assert pairs(extract.read_export(spark, str(tmp_path / "j"), "json", "k int, v string"), "k", "v") == [(1, "a")]


def test_contract_rules(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id int, seen int")
    hourly = extract.TableContract("s", "a", ("hourly", "daily"), incremental_col="seen")
    strict = extract.TableContract("s", "b", ("daily",), incremental_col="seen", inclusive=False)
    full = extract.TableContract("s", "c", ("weekly",), full_where="seen < 25 OR id = 3")
    assert pairs(extract.extract(df, hourly, hwm=20), "id") == [(2,), (3,)]
    assert pairs(extract.extract(df, strict, hwm=20), "id") == [(3,)]
    assert pairs(extract.extract(df, hourly), "id") == [(1,), (2,), (3,)]
    assert pairs(extract.extract(df, full), "id") == [(1,), (2,), (3,)]
    assert [c.table for c in extract.due_tables([hourly, strict, full], "daily")] == ["a", "b"]


def test_time_slices_cover_without_overlap(spark):
    ts = lambda s: F.lit(s).cast("timestamp_ntz")
    got = extract.time_slices(spark, ts("2024-01-01"), ts("2024-01-02"), 4).orderBy("slice_no").collect()
    assert [r.slice_start for r in got][1:] == [r.slice_end for r in got][:-1]
    assert got[-1].slice_end == datetime(2024, 1, 2)


def test_appends(spark):
    tgt = kv(spark, [(1, "a"), (2, "b")])
    src = kv(spark, [(2, "b"), (2, "c"), (3, "d")])
    assert pairs(writers.append_newer(src, tgt, "k"), "k", "v") == [(1, "a"), (2, "b"), (3, "d")]
    again = writers.append_newer(src, tgt, "k", strict=False)
    assert pairs(again, "k", "v") == [(1, "a"), (2, "b"), (2, "b"), (2, "c"), (3, "d")]
    single = writers.append_newer(src, tgt, "k", strict=False, dedupe_keys=["k", "v"])
    assert pairs(single, "k", "v") == [(1, "a"), (2, "b"), (2, "c"), (3, "d")]
    assert writers.append_newer(src, tgt.limit(0), "k").count() == 3
    assert writers.append_newer(src, tgt.limit(0), "k", floor=2).count() == 1
    assert pairs(writers.append_missing(src, tgt, ["k"]), "k", "v") == [(1, "a"), (2, "b"), (3, "d")]


def test_merge_and_replace_are_idempotent(spark):
    tgt = kv(spark, [(1, "a"), (2, "b"), (2, "bb")])
    src = kv(spark, [(2, "x"), (3, "y"), (3, "z")])
    once = writers.merge_upsert(tgt, src, ["k"], newest_by=["v"])
    assert pairs(once, "k", "v") == [(1, "a"), (2, "x"), (3, "z")]
    assert pairs(writers.merge_upsert(once, src, ["k"], newest_by=["v"]), "k", "v") == pairs(once, "k", "v")
    day = writers.replace_by_key(tgt, src, ["k"])
    assert pairs(day, "k", "v") == [(1, "a"), (2, "x"), (3, "y"), (3, "z")]
    assert pairs(writers.replace_by_key(day, src, ["k"]), "k", "v") == pairs(day, "k", "v")


def test_carry_forward_and_refresh(spark):
    d = lambda s: date.fromisoformat(s)
    old = spark.createDataFrame([(d("2024-01-01"), "old"), (d("2024-05-01"), "old"), (d("2024-06-01"), "old")], "p date, o string")
    new = spark.createDataFrame([(d("2024-06-01"), "new")], "p date, o string")
    got = writers.carry_forward(new, old, "p", [d("2024-06-01")], 100, F.lit("2024-06-15").cast("date"))
    assert pairs(got, "p", "o") == [(d("2024-05-01"), "old"), (d("2024-06-01"), "new")]
    got = writers.refresh_window(new, old, "p", d("2024-05-15"))
    assert pairs(got, "p", "o") == [(d("2024-01-01"), "old"), (d("2024-05-01"), "old"), (d("2024-06-01"), "new")]


def test_refresh_open_rows(spark):
    history = spark.createDataFrame([(1, 10, "a"), (2, 50, "b"), (3, None, "c"), (5, 5, "e")], "k int, age int, v string")
    new = spark.createDataFrame([(1, "A"), (2, "B"), (4, "D"), (5, None)], "k int, v string")
    got = writers.refresh_open_rows(history, new, ["k"], F.col("age") <= 35, ["v"])
    # closed rows and rows without a new value keep theirs
    assert pairs(got, "k", "v") == [(1, "A"), (2, "b"), (3, "c"), (4, "D"), (5, "e")]


def test_scd2_runs_twice_alike(spark):
    first = spark.createDataFrame([(1, "a", 10)], "k int, v string, u int")
    empty = first.limit(0).select("*", F.col("u").alias("valid_from"), F.lit(None).cast("int").alias("valid_to"))
    h1 = writers.scd2_snapshot(first, empty, ["k"], "u")
    now = spark.createDataFrame([(1, "b", 20), (2, "c", 15)], "k int, v string, u int")
    h2 = writers.scd2_snapshot(now, h1, ["k"], "u")
    want = sorted([(1, "a", 10, 20), (1, "b", 20, None), (2, "c", 15, None)], key=str)
    assert pairs(h2, "k", "v", "valid_from", "valid_to") == want
    assert pairs(writers.scd2_snapshot(now, h2, ["k"], "u"), "k", "v", "valid_from", "valid_to") == want


def test_month_on_month_and_again(spark, lake):
    place, month = ("gold", "r", "tv"), lambda m: F.lit(f"2024-{m:02}-01").cast("date")
    frame = lambda rows: spark.createDataFrame(rows, "k int, f string, plan string, s int")
    run = lambda rows, m: writers.roll_month(lake, place, frame(rows), ["k", "f"], ["plan", "s"], "month", month(m))
    run([(1, "a", "p", None), (2, "a", "p", 0)], 1)
    run([(1, "a", "p", None), (3, None, "p", 0)], 2)
    third = [(1, "a", "q", None), (3, None, "p", 0), (2, "a", "p", 0)]
    run(third, 3)
    got = pairs(lake.read(*place), "month", "k", "plan", "previous_plan", "change")
    d = lambda m: date(2024, m, 1)
    assert got == sorted([
        (d(1), 1, "p", None, "GAINED"), (d(1), 2, "p", None, "GAINED"),
        (d(2), 1, "p", "p", "KEPT"), (d(2), 2, None, "p", "LOST"), (d(2), 3, "p", None, "GAINED"),
        (d(3), 1, "q", "p", "CHANGED"), (d(3), 2, "p", None, "GAINED"), (d(3), 3, "p", "p", "KEPT"),
    ], key=str)
    before = lake.folders(*place)
    run(third, 3)
    assert pairs(lake.read(*place), "month", "k", "plan", "previous_plan", "change") == got
    assert set(before[:2]) <= set(lake.folders(*place))


def test_months_that_lose_nothing_keep_their_files(spark, lake):
    place, d = ("gold", "r", "base"), lambda m, n=1: date(2024, m, n)
    kind = "k int, ref date, month date"
    for m in (1, 2, 3):
        lake.replace_periods(spark.createDataFrame([(k, d(m, 28), d(m)) for k in (1, 2, m + 10)], kind), *place, "month")
    files = lambda: {r.f for r in lake.read(*place).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    before = files()
    today = spark.createDataFrame([(1, None), (2, d(2, 20)), (11, None), (13, d(3, 1))], "k int, cancelled date")
    keep = F.col("today").isNull() | F.col("today.cancelled").isNull() | (F.col("today.cancelled") > F.col("ref"))
    current = spark.createDataFrame([(1, d(4, 28), d(4))], kind)
    writers.carry_under(lake, place, current, today, ["k"], "month", keep)
    assert pairs(lake.read(*place), "k", "month") == sorted([
        (1, d(1)), (2, d(1)), (11, d(1)), (1, d(2)), (12, d(2)), (1, d(3)), (1, d(4))], key=str)
    january = {f for f in before if "month=2024-01-01" in f}
    assert january and january <= files() and not {f for f in before - january} & files()
    # a month that loses all its rows goes
    none = spark.createDataFrame([(1, d(1, 1)), (2, d(1, 1)), (11, d(1, 1)), (12, None)], "k int, cancelled date")
    writers.carry_under(lake, place, current, none, ["k"], "month", keep)
    assert pairs(lake.read(*place), "k", "month") == [(1, d(4)), (12, d(2))]
