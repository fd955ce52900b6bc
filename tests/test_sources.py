import datetime as dt

import pytest

from conftest import rows
from tallyloom.schema import FACT_COLUMNS, FAULT, SourceError
from tallyloom.settings import RunOptions
from tallyloom.sources import ads, api, leads

DAY = dt.date(2026, 4, 1)
ISO = "2026-04-01"


def test_bing(raw):
    heads = ["Campaign name", "ID", "Type", "Day", "Impr.", "Clicks", "CTR", "Spend"]
    df = raw(
        heads,
        [
            ("HK [Pmax] Brand", "1", "x", ISO, "100", "5", "0.05", "1.5"),
            ("SG Brand", "1", "x", ISO, "1,000", "5", "5%", "2"),
            ("xHK", "1", "x", ISO, "1", "1", "1", "1"),
            (None, "1", "x", ISO, "1", "1", "1", "1"),
            ("Total", None, None, None, "1", "1", "1", "1"),
            ("© HK", None, None, "junk", None, None, None, None),
        ],
    )
    out = ads.bing(df)
    assert out.columns[: len(FACT_COLUMNS)] == FACT_COLUMNS
    assert rows(out, "Date", "Country", "Channel", "Campaign", "Impressions", "CTR", "Spend_AUD", "Channel_Group", FAULT) == [
        (DAY, "HK", "Bing - PMax", "HK [Pmax] Brand", 100.0, 0.05, 1.5, "Bing", None),
        (DAY, "SG", "Bing - Brand", "SG Brand", None, None, 2.0, "Bing", None),
    ]
    with pytest.raises(SourceError, match="expected 8 columns, found 7"):
        ads.bing(df.drop("Spend"))


def test_bad_strict_date_is_a_fault(raw):
    heads = ["Campaign name", "ID", "Type", "Day", "Impr.", "Clicks", "CTR", "Spend"]
    df = raw(heads, [("HK", "1", "x", "soon", "1", "1", "1", "1"), ("HK", "1", "x", None, "1", "1", "1", "1")])
    assert rows(ads.bing(df), "Date", FAULT) == [(None, "unreadable date"), (None, None)]


def test_meta_variants(raw):
    df = raw(
        ["Campaign name", "Ad set name", "Day", "Country", "Impressions", "Clicks (all)", "CTR (all)", "Amount spent (AUD)"],
        [("c", None, ISO, "HK", "10", "2", "8.5", "3"), ("c", "s", ISO, "hk", "10", "2", "8.5", "3")],
    )
    assert rows(ads.meta(df), "Country", "Campaign", "CTR", "Clicks") == [("HK", "c | nan", 0.085, 2.0)]
    assert rows(ads.meta(df, RunOptions(null_text=None)), "Campaign") == [("c",)]
    bare = raw(["Campaign name", "Day", "Impressions", "Clicks (all)"], [("c", ISO, "8", "2"), (None, ISO, "0", "2")])
    assert rows(ads.meta(bare), "Country", "Campaign", "CTR", "Spend_AUD") == [
        (None, "c", 0.25, None), (None, None, None, None),
    ]
    with pytest.raises(SourceError, match="missing column Day"):
        ads.meta(bare.drop("Day"))


def test_meta_agency_drops_unreadable_dates(raw):
    df = raw(["Day", "Clicks", "CTR"], [(ISO, "2", "50"), ("x", "2", "50"), (None, "2", "50")])
    assert rows(ads.meta_agency(df), "Date", "Campaign", "Clicks", "CTR", FAULT) == [(DAY, "Meta - Agency", 2.0, 0.5, None)]


def test_adroll_keeps_unknown_countries(raw):
    df = raw(
        ["Day", "Campaign", "Impressions", "CTR", "Total Spend"],
        [(ISO, "APAC_Taiwan_Retargeting", "1", "0.1", "4"), (ISO, "APAC_Laos_x", "1", "0.1", "4"), ("Total", "x", "1", "1", "1")],
    )
    assert rows(ads.adroll(df), "Country", "Channel", "Clicks", "Spend_AUD") == [
        (None, "AdRoll", None, 4.0), ("TW", "AdRoll - Retargeting", None, 4.0),
    ]
    with pytest.raises(SourceError, match="Spend"):
        ads.adroll(df.drop("Total Spend"))


def test_bilibili_fuzzy_headers(raw):
    heads = ["Date", "Campaign Name", "Impression", "Click", "CTR", "Cost ( AUD )", "Cost per click"]
    df = raw(heads, [(ISO, "c", "10", "1", "0.1", "2.5", "9")])
    assert rows(ads.bilibili(df), "Country", "Campaign", "Creative", "Clicks", "Spend_AUD") == [("CN", "c", None, 1.0, 2.5)]
    more = raw([*heads, "Targeting approach", "Creative Type", "Country"], [(ISO, "c", "1", "1", "1", "1", "1", "t", None, " tw ")])
    assert rows(ads.bilibili(more), "Country", "Campaign", "Creative") == [("TW", "c | t | nan", "nan")]
    null = raw([*heads, "Country"], [(ISO, "c", "1", "1", "1", "1", "1", None)])
    assert rows(ads.bilibili(null), "Country") == [("NAN",)]
    with pytest.raises(SourceError, match="two columns"):
        ads.bilibili(raw([*heads, "Click-through"], [(ISO, "c", "1", "1", "1", "1", "1", "1")]))


PLACED = ["Date", "Main Account", "Placement", "Targeting Approach", "Impression", "Click", "Cost (AUD)"]


def test_rednote_numbers_repeats(raw):
    line = ("2026.4.1", "a", "p", "t", None, "3", "x")
    df = raw([*PLACED, "Creative"], [(*line, "k"), (*line, "k"), (*line, None), (*line, "k"), ("no", *line[1:], "k")])
    assert rows(ads.rednote(df), "Country", "Campaign", "Creative", "Impressions", "CTR", "Spend_AUD") == [
        (None, "a - p | t | k", "k", 0.0, 0.0, 0.0),
        (None, "a - p | t | k #2", "k", 0.0, 0.0, 0.0),
        (None, "a - p | t | k #3", "k", 0.0, 0.0, 0.0),
        (None, "a - p | t | nan", "nan", 0.0, 0.0, 0.0),
    ]


def test_kuaishou_without_creative(raw):
    df = raw(PLACED, [(ISO, "a", "p", "t", "4", "1", "2")])
    assert rows(ads.kuaishou(df), "Country", "Campaign", "Creative", "CTR") == [("CN", "a - p | t | None", None, 0.25)]


def test_tradingview_converts_dollars(raw):
    usd = raw(["Date", "Amount spent (USD)", "Clicks"], [(ISO, "10", "1"), ("Total", "10", "1")], sheet=" hk ")
    assert rows(ads.tradingview(usd), "Country", "Spend_AUD", "Impressions") == [("HK", pytest.approx(15.8), None)]
    assert rows(ads.tradingview(usd, RunOptions(usd_to_aud=2.0)), "Spend_AUD") == [(20.0,)]
    aud = raw(["Date", "Amount spent (AUD)"], [(ISO, "10")], sheet="AU")
    assert rows(ads.tradingview(aud)) == []


APPLE = ["Day ", "Campaign Name", " Country or Region", "CR (Tap-Through)", "Spend", "Impressions", "Taps"]


def test_apple_one_percent_sign_decides_for_the_file(raw):
    lines = [(ISO, "c", "Taiwan", r, "1", "10", "2") for r in ("0.5", "14.0%")]
    assert sorted(r.CTR for r in ads.apple(raw(APPLE, lines)).collect()) == [0.005, pytest.approx(0.14)]
    assert rows(ads.apple(raw(APPLE, lines[:1])), "Country", "CTR", "Clicks") == [("TW", 0.5, 2.0)]
    two = raw(APPLE, lines, path="a").unionByName(raw(APPLE, lines[:1], path="b"))
    assert sorted(r.CTR for r in ads.apple(two).collect() if r["_path"] == "b") == [0.5]
    abroad = [(ISO, "c", "Japan", "9%", "1", "10", "2")]
    assert rows(ads.apple(raw(APPLE, lines[:1] + abroad)), "CTR") == [(0.5,)]


def test_tiktok_daily(raw):
    df = raw(
        ["Date", "Country ", "Campaign name", "Ad name", "Impressions", "Clicks (all)", "Cost (AUD)"],
        [(ISO, " hk", "c", None, "4", "1", "2"), (ISO, "HK", "  ", "a", "4", "1", "2"), (ISO, "AU", "c", "a", "4", "1", "2")],
    )
    assert rows(ads.tiktok_daily(df), "Country", "Campaign", "Creative", "CTR", "Spend_AUD") == [("HK", "c", "nan", 0.25, 2.0)]


def test_tiktok_tabs_fill_before_totals_are_dropped(raw):
    heads = ["Week", "Campaign name", "Ad set name", "Impressions", "Clicks (all)", "Amount spent (AUD)", "CTR"]
    df = raw(
        heads,
        [
            (ISO, "c", "s1", "1", "1", "1", "0.1"),
            (None, None, "s2", "1", "1", "1", "0.1"),
            ("Total", None, None, "9", "9", "9", "9"),
            (None, None, "s3", "1", "1", "1", "0.1"),
            ("2026-04-08", "d", " ", "1", "1", "1", "0.1"),
            (None, None, "s4", "1", "1", "1", "0.1"),
        ],
        sheet="vn",
    )
    want = [(dt.date(2026, 4, 1), "VN", "c", "s1"), (dt.date(2026, 4, 1), "VN", "c", "s2"), (dt.date(2026, 4, 8), "VN", "d", "s4")]
    for block in (2, 1 << 20):
        out = ads.tiktok_tabs(df, RunOptions(block_rows=block))
        assert rows(out, "Date", "Country", "Campaign", "Creative") == want


def test_douyin(raw):
    df = raw(
        ["Date", " Campaign Name", "Targeting approach", "Creative Type", "Video Play", "Profile Views"],
        [(ISO, "c", None, "v", "0", "1"), (ISO, " ", "t", "v", "1", "1")],
    )
    assert rows(ads.douyin(df), "Country", "Campaign", "Creative", "CTR", "Spend_AUD") == [("CN", "c | nan | v", "v", None, None)]


def test_ta_media_trims_tabs(raw):
    df = raw(
        ["Date", "Country", "Ad group", "Creative", "Cost (AUD)", "Impression", "Clicks"],
        [("2026.4.13", "vn ", "g ", "k\t", "1", "4", "1"), ("x", "VN", "g", "k", "1", "4", "1")],
    )
    assert rows(ads.ta_media(df), "Date", "Country", "Campaign", "Creative", "CTR") == [
        (dt.date(2026, 4, 13), "VN", "g | k", "k", 0.25)
    ]
    with pytest.raises(SourceError, match="missing column Country"):
        ads.ta_media(df.drop("Country"))
    assert rows(ads.ta_media(df.drop("Ad group")), "Campaign") == [("TA Media",)]


def test_affiliates(raw):
    df = raw(
        ["a", "b", "c", "d", "e", "f"],
        [
            ("02/04/2026", "HK", "CPA", "$1,000.50", "2", None),
            (None, "Total", None, "$9", "9", "9"),
            (None, "AU", "CPA", "$9", "9", "9"),
            (None, "UK", "Rev", " 5 ", "x", "1"),
            ("Grand Total", "HK", None, "$9", "9", "9"),
            (None, "HK", None, "$9", "9", "9"),
        ],
    )
    assert rows(ads.affiliates(df), "Date", "Country", "Spend_AUD", "QL", "FT", "Impressions", FAULT) == [
        (dt.date(2026, 4, 2), "HK", 1000.5, 2, 0, None, None),
        (dt.date(2026, 4, 2), "UK", 5.0, 0, 1, None, None),
    ]


CRM = ["Billing Country", "Created Date", "Google UTM Source", "google utm medium", "Stage"]


def test_leads_are_counted_and_joined(raw):
    ql = raw(
        CRM,
        [
            (" HK ", "01/04/2026 9:00", "fb", None, "Open"),
            ("HK", "01/04/2026 10:00", "ig", "nan", "Open"),
            ("HK", "01/04/2026", "affiliate-1", "", "Open"),
            ("HK", "when", "fb", "", "Open"),
            ("hk", "01/04/2026", "fb", "", "Open"),
            ("Total", "3", None, None, None),
        ],
    )
    ft = raw(
        CRM,
        [
            ("HK", "1/4/2026", "nan", "", "Funded"),
            ("HK", "1/4/2026", "fb", "", "Active"),
            ("HK", "1/4/2026", "fb", "", "Lost"),
        ],
    )
    got = leads.lead_facts(leads.lead_rows(ql), leads.lead_rows(ft))
    assert rows(got, "Date", "Country", "Channel", "Campaign", "Channel_Group", "QL", "FT", "Spend_AUD") == [
        (DAY, "HK", "Meta", "Meta", "Meta", 2, 1, None),
        (DAY, "HK", "Organic", "Organic", "Organic", 0, 1, None),
    ]


def test_campaign_responses(spark):
    doc = (
        '{"data": {"advertisable": {"byEID": {"campaigns": ['
        '{"eid": "1", "name": "APAC_Laos_x", "status": "on", "metrics": {"byDate": ['
        '{"date": "2026-04-01", "impressions": 10, "clicks": 1, "cost": 2.5, "ctr": 0.1}, {"date": "2026-04-02"}]}},'
        '{"eid": "2", "name": "apac empty", "metrics": {"byDate": null}}, {"eid": "3", "name": "EU", "metrics": {"byDate": [{"date": "2026-04-01"}]}},'
        '{"eid": "4"}]}}}}'
    )
    df = spark.createDataFrame([(doc,), ("{}",)], "value string")
    out = api.adroll_api(df, extras=True)
    assert rows(out, "Date", "Country", "Channel", "Impressions", "Spend_AUD", "CTR", "Channel_Group", "Campaign_Status", "Conversions") == [
        (DAY, "Laos", "AdRoll", 10.0, 2.5, 0.1, "AdRoll", "on", 0.0),
        (dt.date(2026, 4, 2), "Laos", "AdRoll", 0.0, 0.0, None, "AdRoll", "on", 0.0),
    ]
    assert api.adroll_api(df).columns == FACT_COLUMNS


def test_insight_rows(spark, tmp_path):
    (tmp_path / "r.json").write_text(
        '{"campaign_name": "c", "country": "hk", "date_start": "2026-04-01", "impressions": "4", "clicks": "1", "spend": "2.5"}\n'
        '{"country": "AU", "date_start": "2026-04-01"}\n{"country": "VN", "date_start": "2026-04-01"}\n'
    )
    out = api.meta_api(api.read_insights(spark, str(tmp_path)), extras=True)
    assert rows(out, "Date", "Country", "Campaign", "Impressions", "CTR", "Spend_AUD", "Reach") == [
        (DAY, "HK", "c", 4.0, 0.25, 2.5, 0.0),
        (DAY, "VN", "", 0.0, None, 0.0, 0.0),
    ]


def test_lead_grid_rows_stay_where_they_are_read(spark):
    """Rows of a large lead file aren't brought together by file."""
    header = ["Stage", "Created Date", "Google UTM Source", "Google UTM Medium", "Billing Country"]
    grid = spark.range(400).selectExpr("concat('f', id % 2) AS path", "'s' AS sheet", "1 AS sheet_no", "id AS row_no", "IF(id < 2, array({}), array('Open', '1/2/2026', 'x', 'y', 'VN')) AS cells".format(", ".join(f"'{h}'" for h in header)))
    heads = spark.createDataFrame([(f"f{k}", "s", 1, k, header) for k in range(2)], "path string, sheet string, sheet_no int, header_row long, header array<string>")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = leads.lead_rows_from_grid(grid, heads)
        assert found.count() == 398
        assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
