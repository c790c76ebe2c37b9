"""Column helpers on the edge cases of the macro library and the stage views."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, numbers, text
from tidemark.functions.staging import StageSpec, stage


def one(spark, column):
    return spark.range(1).select(column.alias("x")).collect()[0].x


def each(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", make(F.col("v")).alias("x")).orderBy("i").collect()]


def test_strip_accents_covers_both_cases_of_o_tilde(spark):
    assert each(spark, ["São João d'Água", "AÇÕES õ", None], text.strip_accents) == ["Sao Joao d'Agua", "ACOES o", None]


def test_clean_text_key(spark):
    assert each(spark, [" são\r\nd'oeste "], text.clean_text_key) == ["SAODOESTE"]


def test_hms_to_seconds(spark):
    values = ["24:01:00", "00:00:05", "99:59:59", "x", "1:2", None, ""]
    assert each(spark, values, text.hms_to_seconds) == [86460, 5, 359999, 0, 0, 0, 0]
    assert each(spark, ["x"], lambda c: text.hms_to_seconds(c, None)) == [None]
    assert each(spark, [86460, 5], text.seconds_to_hms, "int") == ["24:01:00", "00:00:05"]


def test_lenient_numbers_and_flags(spark):
    assert each(spark, ["12.0", "7", "abc", "", None, "16777217.0"], text.to_int_lenient) == [12, 7, None, None, None, 16777217]
    assert each(spark, ["9007199254740993", "9007199254740993.0", "-9223372036854775808", "1e3"], text.to_int_lenient) == [
        9007199254740993, 9007199254740993, -9223372036854775808, 1000
    ]
    assert each(spark, ["true", "F", "1", "0", "?", None], text.to_bool) == [True, False, True, False, None, None]
    assert each(spark, ["nan", " ", "[None]", "ok", None], text.null_markers) == [None, None, None, "ok", None]
    assert each(spark, ["123", "12a", ""], text.is_all_digits) == [True, False, False]


def test_phone_cleaning(spark):
    raw = ["(21) 98888-7777", "0218888-7777", "5521988887777", "(31)3222-1111", "abc123", "21999999999", None]
    clean = each(spark, raw, text.clean_phone)
    assert clean == ["21988887777", "21988887777", "21988887777", "3132221111", None, "21999999999", None]
    assert each(spark, clean, text.phone_class) == ["MOBILE", "MOBILE", "MOBILE", "FIXED", "UNKNOWN", "UNKNOWN", "UNKNOWN"]


def test_speed_and_extracts(spark):
    assert each(spark, ["100M/50M", "300 MBPS", "1 GB", "512 KBPS", "none"], text.speed_mbps) == [100, 300, 1000, 0.512, None]
    assert each(spark, ["fatura: 1234 x", "none"], lambda c: text.extract_after(c, "fatura: ", 4)) == ["1234", None]
    assert each(spark, ["Ana Maria", "Bob"], text.first_token) == ["Ana", "Bob"]


def test_rules_take_the_first_match(spark):
    rules = [("%store%", "A"), ("%web%", "B")]
    assert each(spark, ["Web Store", "WEB", "x", None], lambda c: text.first_match(c, rules, "Z")) == ["A", "B", "Z", "Z"]
    band = lambda c: text.bucketize(c, [0, 30], ["due", "1-30", "31+"], "none")
    assert each(spark, [-5, 0, 1, 30, 31, None], band, "int") == ["due", "due", "1-30", "1-30", "31+", "none"]
    assert each(spark, ["a", "b"], lambda c: text.code_map(c, {"a": "Alpha"}, "?")) == ["Alpha", "?"]


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", "1"), ("a", None), ("a", "")], "x string, y string")
    keys = [r.k for r in df.select(text.surrogate_key("x", "y").alias("k")).collect()]
    assert len(set(keys)) == 3
    import hashlib

    assert keys[0] == hashlib.md5(b"a-1").hexdigest()


def test_urls(spark):
    urls = [
        "http://example.com/a/b?utm_medium=cpc&utm_source=x", "https://www.example.org", "android-app://some.app/path",
        "example.net?x=1", "https://example.com/",
    ]
    assert each(spark, urls, text.url_host) == ["example.com", "www.example.org", "some.app", "example.net", "example.com"]
    assert each(spark, urls[:2] + urls[4:], text.url_path) == ["a/b", "", ""]
    assert each(spark, urls[:2], lambda c: text.url_parameter(c, "utm_source")) == ["x", None]


def test_empty_to_null_and_star(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, "")], "id int, x string, y string")
    assert [tuple(r) for r in text.empty_to_null(df).collect()] == [(1, None, "a"), (2, None, None)]
    assert text.star(df, exclude=["x"], prefix="p_", suffix="_s").columns == ["p_id_s", "p_y_s"]


def test_safe_arithmetic(spark):
    add = lambda a, b, c: one(spark, numbers.safe_add(F.lit(a).cast("int"), F.lit(b).cast("int"), F.lit(c).cast("int")))
    assert [add(1, 2, 3), add(1, None, 3), add(None, None, None)] == [6, 4, 0]
    assert one(spark, numbers.safe_subtract(F.lit(5), F.lit(None).cast("int"), F.lit(2))) == 3
    assert one(spark, numbers.safe_divide(F.lit(6), F.lit(0))) is None
    assert one(spark, numbers.safe_divide(F.lit(6), F.lit(4))) == 1.5
    assert one(spark, numbers.discounted_value(F.lit(50.0), F.lit(120))) == 0.0
    assert one(spark, numbers.weighted_ticket(F.lit(100.0), F.lit(50), F.lit(6))) == 75.0


@pytest.mark.parametrize("amount,bucket", [(-1.0, 0), (0.0, 1), (3.3, 2), (10.0, 5), (12.0, 5)])
def test_width_bucket_edges(spark, amount, bucket):
    assert one(spark, F.width_bucket(F.lit(amount), F.lit(0.0), F.lit(10.0), F.lit(4))) == bucket


def test_haversine(spark):
    lit = [F.lit(x) for x in (48.8566, 2.3522, 51.5074, -0.1278)]
    assert round(one(spark, numbers.haversine(*lit, unit="km"))) == 344
    assert round(one(spark, numbers.haversine(*lit))) == 214


def test_dates(spark):
    d = lambda s: F.lit(s).cast("date")
    assert one(spark, dates.period_key(d("2024-03-05"))) == "03/2024"
    assert one(spark, dates.days_between(F.lit("2024-01-01 23:00:00").cast("timestamp_ntz"), d("2024-01-02"))) == 1
    months = lambda a, b: one(spark, dates.whole_months_between(d(a), d(b)))
    assert [months("2024-01-31", "2024-02-29"), months("2024-01-15", "2024-03-14"), months("2024-01-15", "2024-03-15")] == [0, 1, 2]
    assert one(spark, dates.day_in_month(d("2024-02-11"), F.lit(31))) == date(2024, 2, 29)
    assert one(spark, dates.ts_from_parts(F.lit("2024-01-01"), F.lit("01:00:00"), -3)) == datetime(2023, 12, 31, 22)
    assert one(spark, dates.ts_from_parts(F.lit("2024-01-01"), F.lit("bad"))) is None


def test_anchor_dates_around_month_and_year_ends():
    a = dates.anchor_dates(date(2024, 1, 1))
    assert a["first_day_last_month"] == date(2023, 12, 1) and a["yesterday"] == date(2023, 12, 31)
    b = dates.anchor_dates(date(2024, 2, 29))
    assert b["last_day_month"] == date(2024, 2, 29) and b["first_day_next_month"] == date(2024, 3, 1)
    assert dates.anchor_dates(date(2023, 12, 31))["first_day_next_month"] == date(2024, 1, 1)


def test_stage_spec(spark):
    df = spark.createDataFrame(
        [(1, 1, "nan", " x "), (1, 2, "7.5", "  "), (2, 1, "oops", None)], "id int, ver int, price string, note string"
    )
    spec = StageSpec(
        columns={"id": ("client", "bigint"), "price": ("price", "double"), "note": ("note", None)},
        keys=["id"], newest_by=["ver"], marked_null=["price"], trimmed=["note"],
    )
    assert sorted(tuple(r) for r in stage(df, spec).collect()) == [(1, 7.5, None), (2, None, None)]
