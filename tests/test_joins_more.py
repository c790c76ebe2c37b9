"""Forward as-of, newest inside, tiered matches, representatives and rules against brute force."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import intervals, joins
from tidemark.operators.latest import representative_or_fallback
from tidemark.operators.rules import Rule, first_rule, first_rule_per_key, rule_counts, rule_table

T0 = datetime(2024, 1, 1)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.mark.parametrize("hot_rows", [None, 15])
@pytest.mark.parametrize("days", [None, 0, 10])
def test_asof_first_matches_brute_force(spark, hot_rows, days):
    rng = random.Random(4)
    events = [(i, rng.choice([1, 1, 1, 2, None]), T0 + timedelta(hours=rng.randrange(2400))) for i in range(150)] + [(999, 1, None)]
    anchors = [(i, rng.choice([1, 1, 2, 3, None]), T0 + timedelta(hours=rng.randrange(2600))) for i in range(80)] + [(500, 1, None)]
    got = joins.asof_first(
        spark.createDataFrame(anchors, "a int, k int, at timestamp"), spark.createDataFrame(events, "id int, k int, ts timestamp"),
        ["k"], "at", "ts", "id", {"id": "event", "ts": "seen"}, days=days, hot_rows=hot_rows,
    )
    want = []
    for a, k, at in anchors:
        near = [
            (ts, i) for i, kk, ts in events
            if at and ts and k is not None and kk == k and 0 <= (ts.date() - at.date()).days <= (10**6 if days is None else days)
        ]
        first = min(near, default=(None, None))
        want.append((a, first[1], first[0]))
    assert rows(got, "a", "event", "seen") == sorted(want, key=str)


@pytest.mark.parametrize("hot_rows", [None, 15])
def test_newest_inside_matches_brute_force(spark, hot_rows):
    rng, d0 = random.Random(5), date(2024, 1, 1)
    day = lambda n: d0 + timedelta(days=n)
    events = [(i, rng.choice([1, 1, 2]), day(rng.randrange(90)), rng.randrange(9)) for i in range(120)]
    spans = [(i, rng.choice([1, 1, 2, 3]), day(s := rng.randrange(90)), day(s + rng.randrange(12))) for i in range(60)]
    spans += [(100, 1, day(5), None), (101, None, day(0), day(9))]
    got = joins.newest_inside(
        spark.createDataFrame(spans, "s int, k int, a date, b date"), spark.createDataFrame(events, "id int, k int, d date, v int"),
        ["k"], "a", "b", "d", "id", {"id": "event", "v": "value", "d": "on"}, hot_rows=hot_rows,
    )
    want = []
    for s, k, a, b in spans:
        inside = [(d, i, v) for i, kk, d, v in events if kk == k and b and a <= d <= b]
        d, i, v = max(inside, default=(None, None, None))
        want.append((s, i, v, d))
    assert rows(got, "s", "event", "value", "on") == sorted(want, key=str)


def test_tiers_disagree(spark):
    people = spark.createDataFrame(
        [(1, "a", "x@", "p"), (2, "a", "y@", "q"), (3, "b", "z@", "q"), (4, None, "z@", "r"), (5, "c", None, "s"), (6, "c", None, "s")],
        "id int, tax string, mail string, phone string",
    )
    bills = spark.createDataFrame(
        [
            (1, "a", "y@", "q"),  # tax id shared, mail decides
            (2, "b", "y@", "p"),  # tax id decides, though the mail says another
            (3, "a", "z@", "r"),  # tax id and mail shared, phone decides
            (4, "a", "z@", "q"),  # everything shared
            (5, None, None, None), (6, "d", "n@", "t"),
            (7, "c", None, "q"),
        ],
        "bill int, tax string, mail string, phone string",
    )
    tiers = [(n, [F.col(n)], [F.col(n)]) for n in ("tax", "mail", "phone")]
    got = joins.tiered_match(bills, people, tiers, {"id": "person"})
    assert rows(got, "bill", "person", "match_tier", "rivals") == [
        (1, 2, "mail", 2), (2, 3, "tax", 0), (3, 4, "phone", 2), (4, None, None, 2), (5, None, None, 0), (6, None, None, 0), (7, None, None, 2)
    ]
    assert got.count() == 7


def test_representative_or_fallback_matches_brute_force(spark):
    rng = random.Random(6)
    data = [(i, rng.randrange(40), rng.random() < 0.3, rng.choice([True, True, False, None])) for i in range(120)]
    df = spark.createDataFrame(data, "id int, k int, done boolean, ok boolean")
    got = representative_or_fallback(df, ["k"], ["id"], F.col("done"), F.col("ok"))
    want = []
    for k in {r[1] for r in data}:
        own = [r for r in data if r[1] == k]
        done = max((r for r in own if r[2]), default=None)
        row = (done if done[3] else None) if done else max((r for r in own if r[3]), default=None)
        want += [row] if row else []
    assert rows(got, "id", "k", "done", "ok") == sorted(want, key=str) and 5 < len(want) < 40
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and "Join" not in plan


def test_rules_in_order(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 50, "a"), (2, 50, "b"), (2, None, None), (3, None, None)], "k int, v int, c string")
    rules = rule_table([(20, "c = 'a'", "letter"), (10, "v < 10", "small"), (30, "v >= 10", "large")])
    assert [r.tag for r in rules] == ["small", "letter", "large"]
    got = df.select("k", "v", first_rule(rules, "none").alias("t"))
    assert rows(got, "k", "v", "t") == [(1, 5, "small"), (1, 50, "letter"), (2, 50, "large"), (2, None, "none"), (3, None, "none")]
    assert rows(first_rule_per_key(df, ["k"], rules, "t", "none"), "k", "t") == [(1, "small"), (2, "large"), (3, "none")]
    counts = rule_counts(df, rules)
    assert rows(counts, "rule", "tag", "taken", "shadowed") == [(1, "small", 1, 0), (2, "letter", 1, 1), (3, "large", 1, 1)]
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
    assert rows(first_rule_per_key(df.limit(0), ["k"], [Rule("x", F.lit(True))], "t"), "k") == []


def test_business_seconds_past_and_inside_a_short_calendar(spark):
    """Only days the calendar has count: before it, after it and in its gaps there is no working time."""
    day = lambda n: date(2024, 1, n)
    cal = spark.createDataFrame([(day(2), True), (day(3), False), (day(5), True)], "day date, is_open boolean")
    at = lambda n, h: datetime(2024, 1, n, h)
    spans = [(1, at(1, 0), at(9, 0)), (2, at(2, 6), at(4, 12)), (3, at(4, 1), at(4, 2)), (4, at(6, 0), at(8, 0)), (5, at(5, 20), at(7, 0)), (6, None, at(2, 0))]
    df = spark.createDataFrame(spans, "id int, a timestamp, b timestamp")
    got = intervals.business_seconds(df, "a", "b", cal, "day", "is_open")
    assert rows(got, "id", "business_seconds") == [(1, 2 * 86400), (2, 18 * 3600), (3, 0), (4, 0), (5, 4 * 3600), (6, None)]
    empty = intervals.business_seconds(df, "a", "b", cal.limit(0), "day", "is_open")
    assert {r.business_seconds for r in empty.collect()} == {None}
