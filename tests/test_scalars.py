import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.functions import classify as K
from tallyloom.functions import dates as D
from tallyloom.functions import scalars as X


def out(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_numbers(spark):
    texts = ["1,234", " 12 ", "12d", "12f", "1e3", "nan", "14%", "$5", "", None, "0x1p3", "5.", ".5", "-inf", "\t7\t"]
    assert out(spark, texts, X.to_num) == [
        None, 12.0, None, None, 1000.0, None, None, None, None, None, None, 5.0, 0.5, float("-inf"), 7.0,
    ]


def test_whole_numbers(spark):
    texts = ["5", "5.0", "5.5", "x", None]
    assert out(spark, texts, X.to_long) == [5, 5, None, None, None]
    assert out(spark, texts, X.not_whole) == [False, False, True, False, False]


def test_strip_knows_all_white_space(spark):
    texts = ["x\t", " x　", " x y ", None, " "]
    assert out(spark, texts, X.strip) == ["x", "x", "x y", None, ""]
    assert [t.strip() for t in texts if t] == ["x", "x", "x y", ""]


def test_lenient_dates(spark):
    texts = [
        "2026-04-01", "2026-04-01 00:00:00", "2026.4.13", "01/04/2026", "nan", "Total", None,
        "2026-13-45", " 2026-4-1 ", "2026-04-01 junk",
    ]
    day = dt.date(2026, 4, 1)
    assert out(spark, texts, D.date_lenient) == [
        day, day, dt.date(2026, 4, 13), dt.date(2026, 1, 4), None, None, None, None, day, None,
    ]


def test_strict_dates_report_only_what_is_not_empty(spark):
    texts = ["2026-04-01", "", "nan", None, "Total", "2026-13-45"]
    faults = out(spark, texts, lambda c: D.date_strict(c)[1])
    assert [f is not None for f in faults] == [False, False, False, False, True, True]


def test_day_first(spark):
    texts = ["01/04/2026", "13/4/2026 9:05", "2026-04-01", "13/04/2026, 10:15:30", "x", None]
    assert out(spark, texts, D.ts_dayfirst) == [
        dt.datetime(2026, 4, 1), dt.datetime(2026, 4, 13, 9, 5), dt.datetime(2026, 4, 1),
        dt.datetime(2026, 4, 13, 10, 15, 30), None, None,
    ]


def test_yymmdd(spark):
    assert out(spark, ["010426", "311225"], D.yymmdd) == ["260401", "251231"]


def test_ratios_and_money(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(X.ratio_or_null(F.col("a"), F.col("b"))).collect()] == [0.25, None, None, None]
    assert [r[0] for r in df.select(X.ratio_or_zero(F.col("a"), F.col("b"))).collect()] == [0.25, 0.0, 0.0, None]
    assert out(spark, ["$1,234.50 ", "x", None], X.money) == [1234.5, None, None]


def test_joined_text_shows_missing_cells(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    assert df.select(X.join_text(" | ", F.col("a"), F.col("b"))).first()[0] == "a | nan"
    assert df.select(X.join_text(" | ", F.col("a"), F.col("b"), null_text=None)).first()[0] == "a"


def test_ctr_auto(spark):
    df = spark.createDataFrame([("14.29%", True), ("0.5", True), ("0.5", False), ("5%", False)], "v string, p boolean")
    got = [r[0] for r in df.select(X.ctr_auto(F.col("v"), F.col("p"))).collect()]
    assert got == [pytest.approx(0.1429), 0.005, 0.5, None]


UTM = {
    None: ("Organic", "Organic"),
    "": ("Organic", "Organic"),
    " - ": ("Organic", "Organic"),
    "(Not Set)": ("Organic", "Organic"),
    "123-45_6": ("IB", "IB"),
    "--": ("--", "Others"),
    "Affiliate-9": ("Affiliates", "Affiliates"),
    "fb": ("Meta", "Meta"),
    "Facebook_ads": ("Meta", "Meta"),
    "instagram-organic-display": ("Meta", "Meta"),
    "google": ("Google", "Others"),
    "google-x": ("Google", "Google"),
    "youtube-video": ("youtube", "Others"),
    "youtube": ("YouTube", "YouTube"),
    "google-youtube": ("YouTube", "YouTube"),
    "chatgpt.com": ("chatgpt", "Others"),
    "ChatGPT": ("ChatGPT", "ChatGPT"),
    "ta-media-1": ("TA Media", "TA Media"),
    "bing-search-brand": ("Bing", "Bing"),
    " SomeThing ": ("SomeThing", "Others"),
}


def test_utm_rules_in_order(spark):
    got = out(spark, list(UTM), K.utm_class)
    assert [tuple(r) for r in got] == list(UTM.values())


def test_medium_overrules(spark):
    cases = [("google", " IB "), ("google", "Affiliates"), ("affiliate-1", "ib"), ("google", None), ("affiliate-1", "x")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, UTM string, Medium string")
    got = K.with_lead_class(df).withColumn("aff", K.from_affiliate(F.col("UTM"), F.col("Medium")))
    got = [(r.Channel, r.aff) for r in got.orderBy("i").collect()]
    assert got == [("IB", False), ("Affiliates", True), ("IB", False), ("Google", False), ("Affiliates", True)]


def test_channels_and_countries(spark):
    texts = ["[Pmax] Brand", "HK Brand", "INDIA x", "xHK", None]
    assert out(spark, texts, K.bing_channel) == [
        "Bing - PMax", "Bing - Brand", "Bing - Category", "Bing - Category", "Bing - Category",
    ]
    assert out(spark, texts, K.prefix_country) == [None, "HK", "IN", None, None]
    texts = ["x APAC_Hong Kong_y", "APAC_Laos_RETARGETING", "apac_Taiwan_", "CONTEXTUAL lookalike"]
    assert out(spark, texts, K.token_country) == ["HK", None, None, None]
    assert out(spark, texts, K.token_country_or_token) == ["HK", "Laos", None, None]
    assert out(spark, texts, K.adroll_channel) == [
        "AdRoll", "AdRoll - Retargeting", "AdRoll", "AdRoll - Lookalike",
    ]
    assert out(spark, ["Meta - Agency", "nobody", None], K.channel_group) == ["Meta", "Others", "Others"]
