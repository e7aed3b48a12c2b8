"""T-unit: scalar functions on literal rows with edge values."""

import datetime as dt

from pyspark.sql import functions as F

from tillpoint.functions import scalars as S


def col1(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_clean_text(spark):
    assert col1(spark, ["  a \t b  ", "", "   ", None, "x y"], S.clean_text) == \
        ["a b", None, None, None, "x y"]


def test_parse_sale_id(spark):
    assert col1(spark, ["S107", "S107 Edit", "none", "", None, " 42 "], S.parse_sale_id) == \
        [107, 107, None, None, None, 42]


def test_parse_money(spark):
    out = col1(spark, ["N5,000.00", "₦ 1,234.5", "-N2,000", "abc", "", None, "n5"], S.parse_money)
    assert [None if v is None else float(v) for v in out] == \
        [5000.0, 1234.5, -2000.0, None, None, None, None]


def test_parse_int_truncates_and_guards(spark):
    assert col1(spark, ["2.5", "-1", "abc", "", "1d", "3f", " 7 ", "-2.9", "1e2"], S.parse_int) == \
        [2, -1, None, None, None, None, 7, -2, 100]


def test_coerce_number(spark):
    assert col1(spark, ["2.5", "abc", None, "-3"], S.coerce_number) == [2.5, 0.0, 0.0, -3.0]


def test_sheet_datetime(spark):
    out = col1(spark, ["04/11/2026-02:30 PM", "4/1/2026-2:05 pm", "2026-04-11 10:00:00",
                       "garbage", "04/11/2026-14:30 PM"], S.parse_sheet_datetime)
    assert out[:2] == [dt.datetime(2026, 4, 11, 14, 30), dt.datetime(2026, 4, 1, 14, 5)]
    assert out[2:] == [None, None, None]


def test_multi_datetime(spark):
    out = col1(spark, ["04/11/2026-02:30 PM", "04/11/2026 02:30 PM", "04/11/2026 14:30",
                       "2026-04-11T10:00:00", "11/04/2026 10:00:00", "2026-04-11 10:00:00",
                       "garbage"], S.parse_datetime_multi)
    assert out == [dt.datetime(2026, 4, 11, 14, 30)] * 3 + [dt.datetime(2026, 4, 11, 10, 0)] * 3 + [None]


def test_payments_and_change_due(spark):
    df = spark.createDataFrame([("Cash: N5,000.00 Store Account: -N2,000",),
                                ("Moniepoint: - - 300",), ("",), (None,), ("Cash: --N35",)], "t string")
    rows = df.select(S.parse_payments("t").alias("p")).select(
        "p", S.change_due("p").alias("c")).collect()
    assert [(x.channel, x.amount) for x in rows[0].p] == [("CASH", "5,000.00"), ("STORE ACCOUNT", "-2,000")]
    assert rows[0].c == "2,000"
    assert [(x.channel, x.amount) for x in rows[1].p] == [("MONIEPOINT", "--300")] or \
        [(x.channel, x.amount) for x in rows[1].p] == [("MONIEPOINT", "-300")]
    assert rows[2].p == [] and rows[3].p == [] and rows[2].c == "0"
    assert [(x.channel, x.amount) for x in rows[4].p] == [("CASH", "-35")] and rows[4].c == "35"


def test_flags(spark):
    assert col1(spark, ["Online customers", "INDOOR", "Ali", None], S.is_anonymous) == \
        [True, True, False, False]
    assert col1(spark, ["Discount", "10% discount", "Lace", None], S.is_discount) == \
        [True, True, False, False]


def test_price_bands_edges(spark):
    vals = [0.0, 5000.0, 5000.01, 100000.0, 100000.01, 500000.0, 500001.0, -1.0]
    assert col1(spark, vals, lambda c: S.price_band(c), "double") == \
        [None, "<5k", "5-10k", "50-100k", ">100k", ">100k", ">100k", None]
    assert col1(spark, vals, lambda c: S.price_band(c, capped=True), "double") == \
        [None, "<5k", "5-10k", "50-100k", ">100k", ">100k", None, None]


def test_hour_buckets(spark):
    hours = [0, 6, 10, 11, 13, 17, 18, 21, 23]
    assert col1(spark, hours, S.hour_bucket, "int") == \
        ["Morning(<11)", "Morning(<11)", "Morning(<11)", "Midday(11-1)", "Afternoon(1-6)",
         "Afternoon(1-6)", "Evening(6-9)", "Evening(6-9)", "Evening(6-9)"]
    assert col1(spark, hours, S.hour_bucket_six, "int") == \
        [None, "Night(0-6)", "Morning(7-11)", "Morning(7-11)", "Midday(11-1)", "Afternoon(1-6)",
         "Afternoon(1-6)", "Evening(6-9)", "Late(9+)"]
    assert col1(spark, [0], lambda c: S.hour_bucket_six(c, include_midnight=True), "int") == \
        ["Night(0-6)"]


def test_stable_shard_matches_python(spark):
    import hashlib
    ids = [0, 1, 107, 16028, 2 ** 40 + 3]
    got = col1(spark, ids, lambda c: S.stable_shard(c, 7), "long")
    assert got == [int(hashlib.md5(str(i).encode()).hexdigest(), 16) % 7 for i in ids]


def test_stringify_and_iso(spark):
    assert col1(spark, [5000.0, 2.5, None], S.stringify_number, "double") == ["5000", "2.5", None]
    df = spark.createDataFrame([(dt.datetime(2026, 4, 11, 14, 30),),
                                (dt.datetime(2026, 4, 11, 14, 30, 0, 5),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(S.iso_text("t")).collect()] == \
        ["2026-04-11T14:30:00", "2026-04-11T14:30:00.000005"]


def test_conversion_status_and_band(spark):
    df = spark.createDataFrame([(True, dt.date(2026, 1, 1)), (False, dt.date(2026, 1, 1)),
                                (None, None)], "w boolean, d date")
    assert [r[0] for r in df.select(S.conversion_status("w", "d")).collect()] == \
        ["YES", "Delayed", "No Sale"]
    assert col1(spark, [0.1, 0.0, -0.2, -0.21], S.vs_avg_band, "double") == \
        ["up", "flat", "flat", "down"]
