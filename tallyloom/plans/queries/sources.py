"""Source readers: exports derived from every line item, read to fact rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.plans.queries.base import (
    APAC_SQL,
    EXPORT,
    LEAD_FACTS,
    LEAD_RAW,
    OPTIONS,
    RUN_DATE,
    plain,
    query,
    rounded,
    sql_day,
    sql_num,
    sql_text,
)
from tallyloom.schema import FACT_COLUMNS, stamp
from tallyloom.sources import ads, api, leads

EXP, LEADS = plain(EXPORT), plain(LEAD_RAW)

# A strict date column: readable in every row, in several layouts, empty in some.
STRICT = "CASE WHEN line IN (5, 6) THEN iso ELSE mixed_day END"


def table(t, columns, sheet="'Sheet1'"):
    """Raw table: export columns under the headers a source uses, with their origin."""
    df = t.sql(EXPORT).select(
        *[F.expr(text).alias(header) for header, text in columns.items()],
        F.col("pth").alias("_path"),
        F.expr(sheet).alias("_sheet"),
        F.lit(1).alias("_sheet_no"),
        F.col("rn").alias("_row_no"),
    )
    return df


def facts_sql(where="true", source=EXP, **columns):
    """SELECT of a fact row: what is not given is NULL."""
    kinds = {
        "Date": "DATE",
        "Impressions": "DOUBLE",
        "Clicks": "DOUBLE",
        "CTR": "DOUBLE",
        "Spend_AUD": "DOUBLE",
        "QL": "BIGINT",
        "FT": "BIGINT",
    }
    parts = []
    for c in FACT_COLUMNS:
        if c.startswith("Date_"):
            continue
        text = columns.get(c, "NULL")
        if c == "CTR":
            text = f"round({text}, 6)"
        if c == "Spend_AUD":
            text = f"round({text}, 2)"
        parts.append(f"CAST({text} AS {kinds.get(c, 'STRING')}) AS {c}")
    return f"SELECT {', '.join(parts)} FROM ({source}) WHERE {where}"


def shown(df):
    """Fact columns as read, without the audit dates that come later."""
    return rounded(df).select(*[c for c in FACT_COLUMNS if not c.startswith("Date_")])


def source_query(name, columns, reader, sql, sheet="'Sheet1'"):
    @query(name, sql)
    def _(t):
        return shown(reader(table(t, columns, sheet), OPTIONS))


IMP, CLK, AMT, RATE, PCT = (sql_num(c) for c in ("imp", "clk", "amount", "rate", "pct"))
RATIO = f"CASE WHEN {IMP} > 0 THEN {CLK} / {IMP} END"
DAY = sql_day(f"({STRICT})")
LOOSE_DAY = sql_day("mixed_day")
CODE = "upper(trim(loose_cc))"
CODE_TEXT = f"upper(trim({sql_text('loose_cc')}))"

source_query(
    "s01_bing",
    {
        "Campaign name": "camp",
        "Campaign ID": "clk",
        "Campaign type": "brand",
        "Day": STRICT,
        "Impr.": "imp",
        "Clicks": "clk",
        "CTR": "rate",
        "Spend": "amount",
    },
    ads.bing,
    facts_sql(
        "camp IS NOT NULL AND NOT starts_with(camp, '©') AND camp <> 'Total' AND "
        "regexp_extract(camp, '^(HK|TH|TW|VN|MY|SG|CN|IN|ID|PH|MN)', 1) <> ''",
        Date=DAY,
        Country="substr(camp, 1, 2)",
        Channel="CASE WHEN contains(camp, '[Pmax]') THEN 'Bing - PMax' "
        "WHEN contains(camp, 'Brand') THEN 'Bing - Brand' ELSE 'Bing - Category' END",
        Campaign="camp",
        Impressions=IMP,
        Clicks=CLK,
        CTR=RATE,
        Spend_AUD=AMT,
        Channel_Group="'Bing'",
    ),
)

source_query(
    "s02_meta",
    {
        "Campaign name": "camp",
        "Ad set name": "flag",
        "Country": "cc",
        "Day": STRICT,
        "Impressions": "imp",
        "Clicks (all)": "clk",
        "CTR (all)": "pct",
        "Amount spent (AUD)": "amount",
    },
    ads.meta,
    facts_sql(
        f"cc IN {APAC_SQL}",
        Date=DAY,
        Country="cc",
        Channel="'Meta'",
        Campaign=f"{sql_text('camp')} || ' | ' || {sql_text('flag')}",
        Impressions=IMP,
        Clicks=CLK,
        CTR=f"{PCT} / 100",
        Spend_AUD=AMT,
        Channel_Group="'Meta'",
    ),
)

source_query(
    "s03_meta_agency",
    {
        "Date": "mixed_day",
        "Country": "cc",
        "Campaign name": "camp",
        "Clicks": "clk",
        "Impressions": "imp",
    },
    ads.meta_agency,
    facts_sql(
        f"cc IN {APAC_SQL} AND {LOOSE_DAY} IS NOT NULL",
        Date=LOOSE_DAY,
        Country="cc",
        Channel="'Meta - Agency'",
        Campaign="camp",
        Impressions=IMP,
        Clicks=CLK,
        CTR=RATIO,
        Channel_Group="'Meta'",
    ),
)

source_query(
    "s04_adroll",
    {
        "Day": "mixed_day",
        "Campaign": "camp",
        "Impressions": "imp",
        "CTR": "rate",
        "Total spend": "amount",
    },
    ads.adroll,
    facts_sql(
        "regexp_matches(mixed_day, '^[0-9]{4}-[0-9]{2}-[0-9]{2}')",
        Date=LOOSE_DAY,
        Country="CASE WHEN camp LIKE 'APAC_Vietnam_%' THEN 'VN' END",
        Channel="CASE WHEN lower(camp) LIKE '%retargeting%' THEN 'AdRoll - Retargeting' "
        "WHEN lower(camp) LIKE '%lookalike%' THEN 'AdRoll - Lookalike' ELSE 'AdRoll' END",
        Campaign="camp",
        Impressions=IMP,
        CTR=RATE,
        Spend_AUD=AMT,
        Channel_Group="'AdRoll'",
    ),
)

source_query(
    "s05_bilibili",
    {
        "Date": STRICT,
        "Campaign Name": "camp",
        "Impression": "imp",
        "Click": "clk",
        "CTR": "rate",
        "Cost (AUD)": "amount",
        "Country": "loose_cc",
        "Targeting approach": "brand",
        "Creative Type": "flag",
    },
    ads.bilibili,
    facts_sql(
        Date=DAY,
        Country=CODE_TEXT,
        Channel="'BiliBili'",
        Campaign=f"{sql_text('camp')} || ' | ' || brand || ' | ' || {sql_text('flag')}",
        Creative=sql_text("flag"),
        Impressions=IMP,
        Clicks=CLK,
        CTR=RATE,
        Spend_AUD=AMT,
        Channel_Group="'BiliBili'",
    ),
)


def placements_sql(label, country, base):
    rows = f"""SELECT *, {base} AS base, row_number() OVER (PARTITION BY pth, {LOOSE_DAY}, {base}
 ORDER BY rn) AS n FROM ({EXP}) WHERE {LOOSE_DAY} IS NOT NULL"""
    return facts_sql(
        source=rows,
        Date=LOOSE_DAY,
        Country=country,
        Channel=f"'{label}'",
        Campaign="base || CASE WHEN n > 1 THEN ' #' || CAST(n AS STRING) ELSE '' END",
        Creative=sql_text("flag") if "flag" in base else "NULL",
        Impressions=f"coalesce({IMP}, 0)",
        Clicks=f"coalesce({CLK}, 0)",
        CTR=f"CASE WHEN {IMP} > 0 THEN coalesce({CLK}, 0) / {IMP} ELSE 0 END",
        Spend_AUD=f"coalesce({AMT}, 0)",
        Channel_Group=f"'{label}'",
    )


source_query(
    "s06_rednote",
    {
        "Date": "mixed_day",
        "Country": "loose_cc",
        "Main Account": "brand",
        "Placement": "'feed'",
        "Targeting Approach": "'wide'",
        "Creative": "flag",
        "Impression": "imp",
        "Click": "clk",
        "Cost (AUD)": "amount",
    },
    ads.rednote,
    placements_sql(
        "RedNote", CODE_TEXT, f"brand || ' - feed | wide | ' || {sql_text('flag')}"
    ),
)

source_query(
    "s07_tradingview",
    {
        "Date": "mixed_day",
        "Amount spent (USD)": "amount",
        "Impressions": "imp",
        "Clicks": "clk",
        "CTR": "rate",
    },
    ads.tradingview,
    facts_sql(
        f"{CODE} IN {APAC_SQL} AND regexp_matches(mixed_day, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')",
        Date=LOOSE_DAY,
        Country=CODE,
        Channel="'TradingView'",
        Campaign="'TradingView'",
        Impressions=IMP,
        Clicks=CLK,
        CTR=RATE,
        Spend_AUD=f"{AMT} * CAST(1.58 AS DOUBLE)",
        Channel_Group="'TradingView'",
    ),
    sheet="loose_cc",
)

APPLE_RATE = "CASE WHEN supp % 2 = 0 AND line = 3 THEN pct || '%' ELSE rate END"
BARE_RATE = "replace(r, '%', '')"
LAND = (
    "CASE land WHEN 'Hong Kong' THEN 'HK' WHEN 'Taiwan' THEN 'TW' WHEN 'China mainland' THEN 'CN' "
    "WHEN 'India' THEN 'IN' WHEN 'Malaysia' THEN 'MY' END"
)
source_query(
    "s08_apple",
    {
        " Day ": STRICT,
        "Campaign Name": "camp",
        "Country or Region ": "land",
        "CR (Tap-Through)": APPLE_RATE,
        "Spend": "amount",
        "Impressions": "imp",
        "Taps": "clk",
    },
    ads.apple,
    facts_sql(
        source=f"""SELECT *, {APPLE_RATE} AS r, bool_or(contains({APPLE_RATE}, '%'))
 OVER (PARTITION BY pth) AS has_pct FROM ({EXP}) WHERE {LAND} IS NOT NULL""",
        Date=DAY,
        Country=LAND,
        Channel="'Apple Search Ads'",
        Campaign=sql_text("camp"),
        Impressions=IMP,
        Clicks=CLK,
        CTR=f"CASE WHEN has_pct THEN {sql_num(BARE_RATE)} / 100 "
        f"ELSE {sql_num('r')} END",
        Spend_AUD=AMT,
        Channel_Group="'Apple Search Ads'",
    ),
)

source_query(
    "s09_tiktok_daily",
    {
        "Date": STRICT,
        " Country": "loose_cc",
        "Campaign name ": "camp",
        "Ad group name": "flag",
        "Impressions": "imp",
        "Clicks (all)": "clk",
        "Amount spent (AUD)": "amount",
    },
    ads.tiktok_daily,
    facts_sql(
        f"{CODE} IN {APAC_SQL} AND camp IS NOT NULL AND trim(camp) <> ''",
        Date=DAY,
        Country=CODE,
        Channel="'TikTok'",
        Campaign="camp",
        Creative=sql_text("flag"),
        Impressions=IMP,
        Clicks=CLK,
        CTR=RATIO,
        Spend_AUD=AMT,
        Channel_Group="'TikTok'",
    ),
)

# Merged cells: the week stands in some rows only, a total row has 'Total' for it.
WEEK = "CASE WHEN line = 1 THEN iso WHEN line = 6 AND part_no % 4 = 0 THEN 'Total' END"
MERGED = "CASE WHEN line IN (1, 3) THEN brand WHEN line = 7 AND part_no % 5 = 0 THEN 'Total' END"
# A file holds one supplier's lines, so one country: its sheet is the whole file.
source_query(
    "s09_tiktok_tabs",
    {
        "Week": WEEK,
        "Campaign name": MERGED,
        "Ad set name": "flag",
        "Impressions": "imp",
        "Clicks (all)": "clk",
        "Amount spent (AUD)": "amount",
        "CTR": "rate",
    },
    ads.tiktok_tabs,
    facts_sql(
        f"{CODE} IN {APAC_SQL} AND coalesce(c, '') <> 'Total' AND coalesce(w, '') <> 'Total' "
        "AND flag IS NOT NULL AND trim(flag) <> ''",
        source=f"""SELECT *, last_value({WEEK} IGNORE NULLS) OVER o AS w,
 last_value({MERGED} IGNORE NULLS) OVER o AS c FROM ({EXP}) WINDOW o AS (PARTITION BY pth
 ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        Date=sql_day("w"),
        Country=CODE,
        Channel="'TikTok'",
        Campaign=sql_text("c"),
        Creative="flag",
        Impressions=IMP,
        Clicks=CLK,
        CTR=RATE,
        Spend_AUD=AMT,
        Channel_Group="'TikTok'",
    ),
    sheet="loose_cc",
)

source_query(
    "s10_douyin",
    {
        "Date": STRICT,
        "Campaign Name": "camp",
        "Targeting approach": "brand",
        "Creative Type": "flag",
        "Video Play": "imp",
        "Profile Views": "clk",
        "Cost (AUD)": "amount",
    },
    ads.douyin,
    facts_sql(
        "camp IS NOT NULL AND trim(camp) <> ''",
        Date=DAY,
        Country="'CN'",
        Channel="'Douyin'",
        Campaign=f"camp || ' | ' || brand || ' | ' || {sql_text('flag')}",
        Creative=sql_text("flag"),
        Impressions=IMP,
        Clicks=CLK,
        CTR=RATIO,
        Spend_AUD=AMT,
        Channel_Group="'Douyin'",
    ),
)

source_query(
    "s11_kuaishou",
    {
        "Date": "mixed_day",
        "Main Account": "brand",
        "Placement": "'feed'",
        "Targeting Approach": "'wide'",
        "Impression": "imp",
        "Click": "clk",
        "Cost (AUD)": "amount",
    },
    ads.kuaishou,
    placements_sql("Kuaishou", "'CN'", "brand || ' - feed | wide | None'"),
)

source_query(
    "s12_ta_media",
    {
        "Date": "mixed_day",
        "Country": "loose_cc",
        "Ad group": "concat(camp, ' ')",
        "Creative": r"concat(flag, '\t')",
        "Cost (AUD)": "amount",
        "Impression": "imp",
        "Clicks": "clk",
    },
    ads.ta_media,
    facts_sql(
        f"{CODE} IN {APAC_SQL} AND {LOOSE_DAY} IS NOT NULL",
        Date=LOOSE_DAY,
        Country=CODE,
        Channel="'TA Media'",
        Campaign=f"trim({sql_text('camp')}) || ' | ' || {sql_text('flag')}",
        Creative=sql_text("flag"),
        Impressions=IMP,
        Clicks=CLK,
        CTR=RATIO,
        Spend_AUD=AMT,
        Channel_Group="'TA Media'",
    ),
)

PAID_DAY = (
    "CASE WHEN line IN (1, 2) THEN substr(iso, 9, 2) || '/' || substr(iso, 6, 2) || '/' "
    "|| substr(iso, 1, 4) WHEN line = 7 AND part_no % 4 = 0 THEN 'Grand Total' END"
)
PAID_LAND = "CASE WHEN line = 6 THEN 'Total' ELSE cc END"
source_query(
    "s13_affiliates",
    {
        "Day": PAID_DAY,
        "Land": PAID_LAND,
        "Kind": "brand",
        "Paid": "money",
        "Leads": "imp",
        "Funded": "clk",
    },
    ads.affiliates,
    facts_sql(
        "coalesce(d, '') <> 'Grand Total' AND c IS NOT NULL AND c NOT IN ('Total', 'AU', 'NZ')",
        source=f"""SELECT *, {PAID_LAND} AS c, last_value({PAID_DAY} IGNORE NULLS) OVER o AS d
 FROM ({EXP}) WINDOW o AS (PARTITION BY pth
 ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        Date="CASE WHEN d IS NOT NULL THEN make_date(CAST(substr(d, 7, 4) AS BIGINT), "
        "CAST(substr(d, 4, 2) AS BIGINT), CAST(substr(d, 1, 2) AS BIGINT)) END",
        Country="c",
        Channel="'Affiliates'",
        Campaign="'Affiliates'",
        Spend_AUD="CAST(substr(money, 2) AS DOUBLE)",
        QL=f"coalesce({IMP}, 0)",
        FT=f"coalesce({CLK}, 0)",
        Channel_Group="'Affiliates'",
    ),
)


def lead_export(t, feed):
    """A CRM export under its own headers."""
    return t.sql(LEAD_RAW).filter(F.col("feed") == feed).select(
        F.concat("Country", F.lit(" ")).alias("Billing Country"),
        F.to_date("Created").cast("string").alias("Created Date"),
        F.col("UTM").alias("Google UTM Source"),
        F.col("Medium").alias("google utm medium"),
        F.col("Stage").alias("Stage"),
    )


@query("s14_leads", LEAD_FACTS)
def _(t):
    ql, ft = (leads.lead_rows(lead_export(t, f)) for f in ("ql", "ft"))
    return stamp(leads.lead_facts(ql, ft), RUN_DATE).select(*FACT_COLUMNS)


# API responses: one campaign response per line item, with two campaigns of which one
# is outside the region, and two days of metrics, the second lacking some of them.
RESPONSES = """
SELECT concat('{{"data": {{"advertisable": {{"byEID": {{"campaigns": [',
 '{{"eid": "a', CAST(l_partkey AS STRING), '", "name": ',
 CASE l_linenumber WHEN 1 THEN '"APAC_Vietnam_Retargeting"' WHEN 2 THEN '"APAC_Laos_Lookalike"'
  WHEN 3 THEN '"x apac contextual"' ELSE 'null' END,
 ', "channel": "web", "startDate": "2026-01-01", "status": "on", "metrics": {{"byDate": [',
 '{{"date": "', CAST(CAST(l_shipdate AS DATE) AS STRING), '", "impressions": ',
 CAST(CAST(l_quantity * 100 AS BIGINT) AS STRING), ', "clicks": ',
 CAST(CAST(l_quantity AS BIGINT) AS STRING), ', "cost": ',
 CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING), ', "ctr": ',
 CAST(CAST(l_tax AS DECIMAL(9,4)) AS STRING), '}}, {{"date": "',
 CAST(CAST(l_shipdate AS DATE) AS STRING), '", "clicks": 3}}]}}}}, ',
 '{{"eid": "b", "name": "APAC_no_days", "metrics": {{"byDate": null}}}}]}}}}}}}}') AS value
FROM {lineitem}
"""
DAYS_SQL = """
SELECT l_linenumber AS line, CAST(l_shipdate AS DATE) AS Date,
 CASE l_linenumber WHEN 1 THEN 'APAC_Vietnam_Retargeting' WHEN 2 THEN 'APAC_Laos_Lookalike'
  WHEN 3 THEN 'x apac contextual' END AS Campaign,
 k, l_quantity AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS paid, l_tax
FROM lineitem, (VALUES (1), (2)) v(k)
"""


@query(
    "a06_campaign_json",
    f"""SELECT Campaign, 'web' AS api_channel, Date, sum(CASE WHEN k = 1 THEN q * 100 ELSE 0 END)
 AS shown, sum(CASE WHEN k = 1 THEN q ELSE 3 END) AS clicks, count(*) AS n
 FROM ({DAYS_SQL}) GROUP BY 1, 3""",
)
def _(t):
    days = api.campaign_days(t.sql(RESPONSES))
    return days.groupBy("Campaign", "api_channel", F.to_date("Date").alias("Date")).agg(
        F.sum("Impressions").alias("shown"),
        F.sum("Clicks").alias("clicks"),
        F.count(F.lit(1)).alias("n"),
    )


@query(
    "s15_adroll_api",
    facts_sql(
        "lower(Campaign) LIKE '%apac%'",
        source=DAYS_SQL,
        Date="Date",
        Country="CASE line WHEN 1 THEN 'VN' WHEN 2 THEN 'Laos' END",
        Channel="CASE line WHEN 1 THEN 'AdRoll - Retargeting' WHEN 2 THEN 'AdRoll - Lookalike' "
        "ELSE 'AdRoll - Contextual' END",
        Campaign="Campaign",
        Impressions="CASE WHEN k = 1 THEN q * 100 ELSE 0 END",
        Clicks="CASE WHEN k = 1 THEN q ELSE 3 END",
        CTR="CASE WHEN k = 1 THEN l_tax END",
        Spend_AUD="CASE WHEN k = 1 THEN paid ELSE 0 END",
        Channel_Group="'AdRoll'",
    ),
)
def _(t):
    return shown(api.adroll_api(t.sql(RESPONSES)))


INSIGHTS_SQL = f"""
SELECT 'c' || CAST(event_id % 7 AS STRING) AS campaign, Country,
 CAST(Created AS DATE) AS day, event_id, CAST(value AS DECIMAL(18,2)) AS spend
FROM ({LEADS}) JOIN (SELECT event_id, value FROM events) USING (event_id)
"""


def insights(t):
    """Insight rows from events: lower-case countries, a missing key in some rows."""
    rows = t.sql(LEAD_RAW).join(t.events.select("event_id", "value"), "event_id")
    text = lambda c: F.expr(c).cast("string")
    return rows.select(
        F.concat(F.lit("c"), text("event_id % 7")).alias("campaign_name"),
        F.lower("Country").alias("country"),
        F.to_date("Created").cast("string").alias("date_start"),
        F.to_date("Created").cast("string").alias("date_stop"),
        F.when(F.col("event_id") % 3 == 0, text("event_id % 50")).alias("reach"),
        F.when(F.col("event_id") % 4 != 0, text("event_id % 100")).alias("impressions"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("spend"),
        text("event_id % 10").alias("clicks"),
    )


SHOWN = "CASE WHEN event_id % 4 <> 0 THEN event_id % 100 ELSE 0 END"


@query(
    "s16_meta_api",
    facts_sql(
        f"Country IN {APAC_SQL}",
        source=INSIGHTS_SQL,
        Date="day",
        Country="Country",
        Channel="'Meta'",
        Campaign="campaign",
        Impressions=SHOWN,
        Clicks="event_id % 10",
        CTR=f"CASE WHEN {SHOWN} > 0 THEN (event_id % 10) / ({SHOWN})::DOUBLE END",
        Spend_AUD="spend",
        Channel_Group="'Meta'",
    ),
)
def _(t):
    return shown(api.meta_api(insights(t)))


@query(
    "b11_api_extras",
    f"""SELECT Country, day::STRING AS "Reporting starts", CAST(sum(CASE WHEN event_id % 3 = 0
 THEN event_id % 50 ELSE 0 END) AS DOUBLE) AS reach, count(*) AS n FROM ({INSIGHTS_SQL})
 WHERE Country IN {APAC_SQL} GROUP BY 1, 2""",
)
def _(t):
    rows = api.meta_api(insights(t), extras=True)
    return rows.groupBy("Country", "Reporting starts").agg(
        F.sum("Reach").alias("reach"), F.count(F.lit(1)).alias("n")
    )
