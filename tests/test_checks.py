from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.operators import checks


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def n(df):
    return df.count()


def test_row_checks(spark):
    df = frame(spark, [(1, "a"), (2, " "), (None, None), (9, "")], "id int, s string")
    assert n(checks.accepted_range(df, "id", 1, 9)) == 0
    assert n(checks.accepted_range(df, "id", 1, 9, inclusive=False)) == 2
    assert n(checks.not_accepted_values(df, "id", [2, 3])) == 1
    assert n(checks.not_empty_string(df, "s")) == 2 and n(checks.not_empty_string(df, "s", trim=False)) == 1
    assert n(checks.expression_is_true(df, F.col("id") < 5)) == 1
    counts = checks.run_checks(df, {"small": F.col("id") < 5, "known": F.col("s") == "a"}).collect()
    assert sorted((r.rule, r.violations) for r in counts) == [("known", 2), ("small", 1)]
    both = checks.report({"a": checks.not_accepted_values(df, "id", [2]), "b": checks.not_accepted_values(df, "id", [77])})
    assert sorted((r.rule, r.violations) for r in both.collect()) == [("a", 1), ("b", 0)]


def test_table_checks(spark):
    df = frame(spark, [(1, 1), (1, 2), (2, None)], "g int, v int")
    assert n(checks.at_least_one(df, "v")) == 0 and n(checks.at_least_one(df, "v", ["g"])) == 1
    assert n(checks.not_constant(df, "g")) == 0 and n(checks.not_constant(df, "g", ["g"])) == 2
    assert n(checks.not_null_proportion(df, "v", 0.6)) == 0 and n(checks.not_null_proportion(df, "v", 0.7)) == 1
    assert n(checks.not_null_proportion(df, "v", 0.0, at_most=0.5)) == 1
    assert n(checks.unique_combination(df, ["g"])) == 1 and n(checks.unique_combination(df, ["g", "v"])) == 0


def test_two_table_checks(spark):
    a = frame(spark, [(1, 0.123), (2, 0.2), (2, 0.2)], "id int, x double")
    b = frame(spark, [(1, 0.1234), (2, 0.2), (3, 0.2)], "id int, x double")
    assert n(checks.equal_rowcount(a, b)) == 0 and n(checks.equal_rowcount(a, b, ["id"])) == 2
    assert n(checks.fewer_rows_than(a, b)) == 1 and n(checks.fewer_rows_than(a.limit(1), b)) == 0
    assert n(checks.equality(a, a)) == 0 and n(checks.equality(a, b)) == 4
    assert n(checks.equality(a, b, precision=2)) == 2 and n(checks.equality(a, b, exclude=["id"], precision=2)) == 0
    assert n(checks.cardinality_equality(a, "id", a, "id")) == 0 and n(checks.cardinality_equality(a, "id", b, "id")) == 3
    child = frame(spark, [(1,), (4,), (None,)], "fk int")
    assert n(checks.relationships_where(child, "fk", a, "id")) == 1
    assert n(checks.relationships_where(child, "fk", a, "id", F.col("fk") < 4, F.col("x") > 0.15)) == 1


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_ranges(spark, hot_rows):
    touching = frame(spark, [(0, 1), (1, 2), (2, 4)], "lo int, hi int")
    gapped = frame(spark, [(0, 1), (2, 4)], "lo int, hi int")
    overlapping = frame(spark, [(0, 3), (2, 4)], "lo int, hi int")
    empty_range = frame(spark, [(0, 0), (0, 4)], "lo int, hi int")
    check = lambda df, **k: n(checks.mutually_exclusive_ranges(df, "lo", "hi", hot_rows=hot_rows, **k))
    assert check(touching) == 0 and check(touching, gaps="not_allowed") == 0 and check(touching, gaps="required") == 2
    assert check(gapped) == 0 and check(gapped, gaps="not_allowed") == 1 and check(gapped, gaps="required") == 0
    assert check(overlapping) == 1
    assert check(empty_range) == 1 and check(empty_range, zero_length=True) == 0


@pytest.mark.parametrize("hot_rows", [None, 2])
def test_sequences(spark, hot_rows):
    even = frame(spark, [(2,), (4,), (6,), (8,)], "v int")
    assert n(checks.sequential_values(even, "v", interval=2, hot_rows=hot_rows)) == 0
    assert n(checks.sequential_values(even, "v", interval=1, hot_rows=hot_rows)) == 3
    days = frame(spark, [(date(2024, 1, 1),), (date(2024, 2, 1),), (date(2024, 4, 1),)], "v date")
    assert n(checks.sequential_values(days, "v", step=lambda p: F.add_months(p, 1), hot_rows=hot_rows)) == 1


def test_recency(spark):
    df = frame(spark, [(1, date(2024, 1, 1)), (2, date(2024, 1, 9))], "g int, d date")
    as_of = F.lit("2024-01-10").cast("date")
    assert n(checks.recency(df, "d", as_of, 3)) == 0 and n(checks.recency(df, "d", as_of, 3, ["g"])) == 1
