"""Join and interval operators against brute force, with and without sliced keys."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import intervals, joins, linkage

D0 = date(2024, 1, 1)


def day(n):
    return D0 + timedelta(days=n)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def log():
    rng = random.Random(3)
    return [(i, rng.choice([1, 1, 1, 2, 3]), day(rng.randrange(120)), rng.random() < 0.4) for i in range(300)]


def test_lookback_counts_match_brute_force(spark, log):
    events = spark.createDataFrame(log, "id int, k int, d date, bad boolean")
    grid = [(k, day(n)) for k in (1, 2, 3, 4) for n in (0, 30, 60, 119, 200)]
    got = joins.lookback_counts(
        spark.createDataFrame(grid, "k int, ref date"), events, ["k"], "ref", "d", 30, {"n": F.lit(True), "bad_n": F.col("bad")}
    )
    want = [
        (
            k, ref,
            sum(1 for _, kk, d, _ in log if kk == k and ref - timedelta(30) <= d <= ref),
            sum(1 for _, kk, d, b in log if kk == k and b and ref - timedelta(30) <= d <= ref),
        )
        for k, ref in grid
    ]
    assert rows(got, "k", "ref", "n", "bad_n") == sorted(want, key=str)


def test_recurrence_matches_brute_force(spark, log):
    df = spark.createDataFrame([r[:3] for r in log], "id int, k int, d date")
    got = joins.recurrence(df, ["k"], "d", "id", 10)
    want = []
    for i, k, d, _ in log:
        before = [(dd, ii) for ii, kk, dd, _ in log if kk == k and timedelta(1) <= d - dd <= timedelta(10)]
        want.append((i, len(before), max(before)[1] if before else None))
    assert rows(got, "id", "previous", "last_id") == sorted(want, key=str)


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_asof_validity_is_half_open(spark, log, hot_rows):
    versions = [(1, day(10), 1, "a"), (1, day(50), 2, "b"), (1, day(50), 3, "c"), (2, day(0), 4, "d")]
    got = joins.asof_validity(
        spark.createDataFrame([r[:3] for r in log], "id int, k int, d date"),
        spark.createDataFrame(versions, "k int, start date, vid int, plan string"),
        ["k"], "d", "start", "vid", {"plan": "plan"}, hot_rows=hot_rows,
    )
    want = []
    for i, k, d, _ in log:
        ok = [(s, v, p) for kk, s, v, p in versions if kk == k and s <= d]
        want.append((i, max(ok)[2] if ok else None))
    assert rows(got, "id", "plan") == sorted(want, key=str)


@pytest.mark.parametrize("hot_rows", [None, 20])
def test_pair_positionally(spark, hot_rows):
    a = spark.createDataFrame([(1, i, f"a{i}") for i in range(60)] + [(2, 0, "x")], "k int, o int, a string")
    b = spark.createDataFrame([(1, i * 2, f"b{i}") for i in range(50)], "k int, o int, b string")
    got = joins.pair_positionally(a.drop("x"), b.withColumnRenamed("o", "p"), ["k"], ["o"], ["p"], hot_rows=hot_rows)
    want = [(1, f"a{i}", f"b{i}" if i < 50 else None) for i in range(60)] + [(2, "x", None)]
    assert rows(got, "k", "a", "b") == sorted(want, key=str)


def test_clipped_days_reproduces_the_six_cases(spark):
    """Closed inside, closed after a start before, spanning, closed after the end, open inside, open before."""
    cases = {
        1: (day(12), day(15), 3),   # activation day not counted
        2: (day(5), day(13), 3),    # from the cycle start to the day before activation
        3: (day(5), day(40), 10),   # the whole cycle
        4: (day(15), day(40), 5),   # to the cycle end, inclusive
        5: (day(15), None, 5),
        6: (day(5), None, 10),
        7: (day(12), day(12), 0),   # suspended and lifted the same day
        8: (day(15), day(19), 4),   # lifted on the cycle end day
        9: (day(30), None, 0),
    }
    spans = spark.createDataFrame([(k, s, e) for k, (s, e, _) in cases.items()], "k int, s date, e date")
    cycles = spark.createDataFrame([(k, day(10), day(19)) for k in [*cases, 10]], "k int, a date, b date")
    got = intervals.clipped_days(spans, cycles, ["k"], "s", "e", "a", "b")
    assert rows(got, "k", "days") == sorted([(k, n) for k, (_, _, n) in cases.items()] + [(10, 0)], key=str)
    joined = spans.join(cycles, "k").select("k", intervals.clipped_length("s", "e", "a", "b").alias("days"))
    assert rows(joined, "k", "days") == sorted([(k, n) for k, (_, _, n) in cases.items()], key=str)


def test_clipped_days_sums_many_spans_and_cycles(spark):
    rng = random.Random(5)
    spans = []
    for _ in range(200):
        s = rng.randrange(100)
        spans.append((rng.choice([1, 1, 2]), day(s), None if rng.random() < 0.1 else day(s + rng.randrange(30))))
    cycles = [(k, day(i * 7), day(i * 7 + 6)) for k in (1, 2) for i in range(15)]
    got = intervals.clipped_days(
        spark.createDataFrame(spans, "k int, s date, e date"), spark.createDataFrame(cycles, "k int, a date, b date"),
        ["k"], "s", "e", "a", "b",
    )
    want = [
        (k, a, sum(max(0, (min(e or date.max, b + timedelta(1)) - max(s, a)).days) for kk, s, e in spans if kk == k))
        for k, a, b in cycles
    ]
    assert rows(got, "k", "a", "days") == sorted(want, key=str)


def test_overlap_totals_match_brute_force(spark):
    rng = random.Random(6)
    spans = [(rng.choice([1, 1, 2]), day(s := rng.randrange(100)), day(s + rng.randrange(20)), rng.randrange(9)) for _ in range(150)]
    spans.append((2, day(3), None, 4))
    cycles = [(k, day(i * 10), day(i * 10 + 9)) for k in (1, 2, 3) for i in range(10)]
    got = intervals.overlap_totals(
        spark.createDataFrame(spans, "k int, s date, e date, v int"), spark.createDataFrame(cycles, "k int, a date, b date"),
        ["k"], "s", "e", "v", "a", "b", open_end=True,
    )
    want = []
    for k, a, b in cycles:
        hit = [v for kk, s, e, v in spans if kk == k and s <= b and (e is None or e >= a)]
        want.append((k, a, len(hit), sum(hit)))
    assert rows(got, "k", "a", "overlapping", "overlapping_value") == sorted(want, key=str)


def test_earlier_link_matches_brute_force(spark):
    rng = random.Random(8)
    con = []
    for i in range(120):
        a = rng.randrange(200)
        con.append((i, rng.choice([1, 1, 2, 3]), day(a), day(a + rng.randrange(60)) if rng.random() < 0.5 else None))
    df = spark.createDataFrame(con, "id int, k int, opened date, closed date")
    got = linkage.earlier_link(df, ["k"], "id", "opened", "closed", 40, 5, "link")
    want = []
    for i, k, o, _ in con:
        ids = [j for j, kk, _, c in con if kk == k and j < i and c and -40 <= (c - o).days <= 5]
        want.append((i, min(ids) if ids else None))
    assert rows(got, "id", "link") == sorted(want, key=str)


def test_contains_join_equals_all_pairs(spark):
    texts = [(1, "abcabc xyz"), (2, "zz"), (3, ""), (4, None), (5, "a"), (6, "zz"), (7, "é🙂 abx")]
    needles = [("a", 1), ("abc", 2), ("cab", 3), ("xyz!", 4), ("zz", 5), ("", 6), (" x", 7), ("é🙂", 8), (None, 9), ("a", 10)]
    want = [(i, n) for i, t in texts for w, n in needles if t and w and w in t]
    got = joins.contains_join(
        spark.createDataFrame(texts, "id int, body string"), "body", spark.createDataFrame(needles, "word string, n int"), "word", ["n"]
    )
    assert rows(got, "id", "n") == sorted(want, key=str)


def test_null_keys_match_nothing(spark):
    t0 = datetime(2024, 1, 2)
    events = spark.createDataFrame([(1, None, t0), (2, 7, t0)], "id int, k int, ts timestamp")
    versions = spark.createDataFrame([(None, t0, 5, "x"), (7, None, 6, "y")], "k int, since timestamp, v int, name string")
    got = joins.asof_validity(events, versions, ["k"], "ts", "since", "v", {"name": "name"})
    assert rows(got, "id", "name") == [(1, None), (2, None)]
    grid = spark.createDataFrame([(None, date(2024, 1, 3)), (7, date(2024, 1, 3)), (8, date(2024, 1, 3))], "k int, ref date")
    seen = events.withColumn("day", F.to_date("ts"))
    counts = joins.lookback_counts(grid, seen, ["k"], "ref", "day", 10, {"n": F.lit(True)})
    assert rows(counts, "k", "n") == [(7, 1), (8, 0), (None, 0)]
    last = joins.asof_last(grid, events, ["k"], "ref", "ts", "last")
    assert rows(last, "k", "last") == [(7, t0), (8, None), (None, None)]
    again = joins.recurrence(seen, ["k"], "day", "id", 90)
    assert rows(again, "id", "previous") == [(1, 0), (2, 0)]


def test_bad_spans_cover_nothing(spark):
    d = lambda n: date(2024, 1, n)
    spans = spark.createDataFrame(
        [(1, d(9), d(4), 5), (2, None, d(4), 5), (3, d(4), None, 5), (4, d(4), d(5), 5), (None, d(4), d(5), 5)], "k int, a date, b date, v int"
    )
    cycles = spark.createDataFrame([(k, d(1), d(31)) for k in (1, 2, 3, 4, None)], "k int, lo date, hi date")
    got = intervals.overlap_totals(spans, cycles, ["k"], "a", "b", "v", "lo", "hi")
    assert rows(got, "k", "overlapping", "overlapping_value") == [(1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 5), (None, 0, 0)]
    got = intervals.clipped_days(spans, cycles, ["k"], "a", "b", "lo", "hi")
    assert rows(got, "k", "days") == [(1, 0), (2, 0), (3, 28), (4, 1), (None, 0)]


def test_exclude_null_meanings(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    plain = spark.createDataFrame([(1,)], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(joins.exclude(df, plain, "k"), "k") == [(2,), (None,)]
    assert rows(joins.exclude(df, plain, "k", null_aware=True), "k") == [(2,)]
    assert rows(joins.exclude(df, with_null, "k", null_aware=True), "k") == []
    assert rows(joins.exclude(df, with_null.limit(0), "k", null_aware=True), "k") == [(1,), (2,), (None,)]


def test_or_join_gives_all_matches_once(spark):
    left = spark.createDataFrame([(1, 10, None), (2, None, 20), (3, 10, 20), (4, 99, 99), (5, 50, 60)], "id int, a int, b int")
    right = spark.createDataFrame([(10, 30, "x"), (40, 20, "y"), (50, 60, "z"), (None, None, "w")], "p int, q int, name string")
    got = joins.or_join(left, right, [("a", "p"), ("b", "q")], {"name": "name"})
    assert rows(got, "id", "name") == [(1, "x"), (2, "y"), (3, "x"), (3, "y"), (4, None), (5, "z")]


def test_business_seconds_skip_closed_days(spark):
    cal = spark.createDataFrame([(day(i), i % 7 not in (5, 6)) for i in range(20)], "day date, is_open boolean")
    df = spark.sql(
        "SELECT 1 id, timestamp'2024-01-05 22:00:00' a, timestamp'2024-01-08 01:00:00' b "
        "UNION ALL SELECT 2, timestamp'2024-01-06 10:00:00', timestamp'2024-01-07 10:00:00' "
        "UNION ALL SELECT 3, timestamp'2024-01-02 10:00:00', timestamp'2024-01-02 10:00:05'"
    )
    got = intervals.business_seconds(df, "a", "b", cal, "day", "is_open")
    assert rows(got, "id", "business_seconds") == [(1, 3 * 3600), (2, 0), (3, 5)]


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_status_intervals_need_the_very_next_event(spark, hot_rows):
    log = [("s", 0), ("r", 1), ("s", 2), ("x", 3), ("r", 4), ("s", 5), ("s", 6), ("r", 7), ("s", 8)]
    df = spark.createDataFrame([(1, i, day(n), k) for i, (k, n) in enumerate(log)], "k int, id int, ts date, kind string")
    got = intervals.status_intervals(df, ["k"], "ts", "id", F.col("kind") == "s", F.col("kind") == "r", hot_rows=hot_rows)
    assert rows(got, "open_event", "close_event") == sorted([(0, 1), (2, None), (5, None), (6, 7), (8, None)], key=str)


def test_contains_join_shuffles_no_grams(spark):
    texts = spark.createDataFrame([(1, "the quick\nbrown fox"), (2, "no fox, quick"), (2, "no fox, quick"), (3, "fox")], "id int, body string")
    needles = spark.createDataFrame([("quick\nbrown",), ("fox",), ("the quick brown",), ("no fox, quick",)], "word string")
    got = joins.contains_join(texts, "body", needles, "word", ["word"])
    want = [(1, "fox"), (1, "quick\nbrown"), (2, "fox"), (2, "fox"), (2, "no fox, quick"), (2, "no fox, quick"), (3, "fox")]
    assert rows(got, "id", "word") == sorted(want, key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # a text is shuffled by its hash, not once for each of its grams
    assert not re.search(r"hashpartitioning\([^)]*_gram#", plan)
    assert rows(joins.contains_join(texts, "body", needles.limit(0), "word", ["word"]), "id") == []


def test_lookback_steps_work_in_parts_that_follow_the_rows(spark):
    rng, d0 = random.Random(8), date(2024, 1, 1)
    events = [(rng.choice([1, 1, 1, 2, 3, None]), d0 + timedelta(days=rng.randrange(90)), rng.randrange(3)) for _ in range(300)]
    grid = [(k, d0 + timedelta(days=d)) for k in (1, 2, 4, None) for d in (0, 20, 40, 89, 40)]
    seen, asked = spark.createDataFrame(events, "k int, day date, v int"), spark.createDataFrame(grid, "k int, ref date")
    spark.conf.set("spark.tidemark.partRows", "40")
    try:
        counts = joins.lookback_counts(asked, seen, ["k"], "ref", "day", 30, {"n": F.lit(True), "twos": F.col("v") == 2})
        last = joins.asof_last(asked, seen, ["k"], "ref", "day", "last")
        known = sum(k is not None for k, _, _ in events)
        for df, parts in ((counts, -(-(known + 2 * len(grid)) // 40)), (last, -(-(known + len(grid)) // 40))):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert len(re.findall(rf"hashpartitioning\(.*, {parts}\), REPARTITION_BY_NUM", plan)) == 2
        inside = lambda k, ref: [v for kk, d, v in events if k is not None and kk == k and 0 <= (ref - d).days <= 30]
        want = [(k, ref, len(inside(k, ref)), inside(k, ref).count(2)) for k, ref in {*grid}]
        assert rows(counts, "k", "ref", "n", "twos") == sorted(want, key=str)
        want = [(k, ref, max((d for kk, d, _ in events if k is not None and kk == k and d <= ref), default=None)) for k, ref in {*grid}]
        assert rows(last, "k", "ref", "last") == sorted(want, key=str)
    finally:
        spark.conf.unset("spark.tidemark.partRows")
