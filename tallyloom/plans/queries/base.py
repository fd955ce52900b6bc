"""Registry of the named queries and the inputs they share."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.classify import adroll_channel, bing_channel, channel_group
from tallyloom.functions.scalars import ratio_or_null
from tallyloom.settings import RunOptions

RUN_DATE = dt.date(2026, 4, 27)
OPTIONS = RunOptions(run_date=RUN_DATE)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The given tables of one folder, by name or inside SQL text as {name}."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def sql(self, text: str) -> DataFrame:
        used = set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", text))
        return self.spark.sql(text, **{u: getattr(self, u) for u in used})


def query(name: str, sql: str | None = None):
    """Register `fn(tables)` under a name, with the SQL of its result."""

    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def plain(feed: str) -> str:
    """A shared feed text as plain SQL."""
    return re.sub(r"(?<!\{)\{(\w+)\}(?!\})", r"\1", feed).replace("{{", "{").replace("}}", "}")


# Shared inputs: SQL that reads the same in both engines ---------------------------

AD_RAW = """
SELECT make_date(year(l_shipdate), month(l_shipdate), 1) AS Date,
 nullif(split_part('VN,TH,SG,MY,CN,HK,TW,ID,PH,IN,MN,-', ',', s_nationkey % 12 + 1), '-') AS Country,
 CASE p_type WHEN 'ECONOMY' THEN 'HK Brand core' WHEN 'SMALL' THEN '[Pmax] Brand x'
  WHEN 'MEDIUM' THEN 'APAC_Vietnam_Retargeting' WHEN 'PROMO' THEN 'APAC_Thailand_LookAlike'
  WHEN 'STANDARD' THEN 'SG generic' ELSE 'Total' END AS Campaign,
 CASE WHEN l_linenumber = 1 THEN NULL ELSE l_returnflag END AS Creative,
 CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_quantity * 100 END AS Impressions,
 l_quantity AS Clicks,
 CASE WHEN l_partkey % 17 = 0 AND l_suppkey % 2 = 0 THEN NULL
      ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS Spend_AUD,
 l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {part} ON l_partkey = p_partkey
"""

LEAD_RAW = """
SELECT event_id, ts AS Created,
 split_part('VN,TH,SG,MY,CN,HK,TW,ID,PH,IN,MN,AU,Total', ',', CAST(user_id % 13 AS INT) + 1) AS Country,
 nullif(split_part(', - ,123-45_6,Affiliate-9,fb,Facebook_ads,google,google-x,youtube-video,google-youtube,SomeThing ,bing-search-brand,TA-Media-1,NULL',
  ',', CAST(event_id % 14 AS INT) + 1), 'NULL') AS UTM,
 split_part('IB, affiliates ,,,', ',', CAST(event_id % 5 AS INT) + 1) AS Medium,
 CASE event_type WHEN 'purchase' THEN 'Funded' WHEN 'click' THEN 'Active'
  WHEN 'signup' THEN 'Funded NT' ELSE 'Open' END AS Stage,
 CASE WHEN event_id % 3 = 0 THEN 'ft' ELSE 'ql' END AS feed
FROM {events}
"""

# Every line item as one row of an export: all text, with gaps, junk and odd layouts.
EXPORT = """
SELECT 'drop/f' || CAST(l_suppkey AS STRING) AS pth,
 (l_orderkey * 8 + l_linenumber) * 1000000000 + l_partkey AS rn,
 CAST(CAST(l_shipdate AS DATE) AS STRING) AS iso,
 CASE WHEN l_linenumber <= 4 THEN replace(CAST(CAST(l_shipdate AS DATE) AS STRING), '-',
   split_part('-|-|.|/', '|', l_linenumber))
  WHEN l_linenumber <= 6 THEN split_part('nan|Total', '|', l_linenumber - 4) END AS mixed_day,
 nullif(split_part('VN,TH,SG,MY,CN,HK,TW,ID,PH,IN,MN,AU,-', ',', s_nationkey % 13 + 1), '-') AS cc,
 nullif(split_part(' vn ,Th,SG,cn ,NZ,-', ',', s_nationkey % 6 + 1), '-') AS loose_cc,
 nullif(split_part('Hong Kong,Taiwan,China mainland,India,Japan,Malaysia,-', ',', s_nationkey % 7 + 1), '-') AS land,
 CASE p_type WHEN 'ECONOMY' THEN 'HK Brand core' WHEN 'SMALL' THEN 'SG [Pmax] Brand x'
  WHEN 'MEDIUM' THEN 'APAC_Vietnam_Retargeting' WHEN 'PROMO' THEN 'APAC_Laos_LookAlike x'
  WHEN 'STANDARD' THEN 'TW generic' ELSE CASE WHEN l_linenumber = 1 THEN NULL
  WHEN l_linenumber = 2 THEN 'Total' WHEN l_linenumber = 3 THEN '  ' ELSE '© footer' END END AS camp,
 p_brand AS brand,
 CASE WHEN l_linenumber = 1 THEN NULL ELSE l_returnflag END AS flag,
 CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN '1,234'
  WHEN l_partkey % 23 = 0 THEN '0' ELSE CAST(CAST(l_quantity * 100 AS BIGINT) AS STRING) END AS imp,
 CAST(CAST(l_quantity AS BIGINT) AS STRING) AS clk,
 CASE WHEN l_partkey % 29 = 0 THEN '12d'
  ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END AS amount,
 '$' || CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) AS money,
 CAST(CAST(l_discount * 100 AS DECIMAL(9,2)) AS STRING) AS pct,
 CAST(CAST(l_tax AS DECIMAL(9,4)) AS STRING) AS rate,
 l_linenumber AS line, l_suppkey AS supp, l_partkey AS part_no
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {part} ON l_partkey = p_partkey
"""


def ad_facts(t: Tables) -> DataFrame:
    """Every line item as an ad row, with its place in order."""
    raw = t.sql(AD_RAW)
    campaign = F.col("Campaign")
    # Order, line, part and supplier as one number, in that order of weight.
    place = F.expr(
        "CAST(l_orderkey * 8 + l_linenumber AS DECIMAL(18,0)) * 10000000000000000"
        " + (shiftleft(l_partkey, 24) + l_suppkey)"
    )
    channel = F.when(campaign.startswith("APAC_"), adroll_channel(campaign)).otherwise(
        bing_channel(campaign)
    )
    return raw.select(
        "Date",
        "Country",
        channel.alias("Channel"),
        "Campaign",
        "Creative",
        "Impressions",
        "Clicks",
        ratio_or_null(F.col("Clicks"), F.col("Impressions")).alias("CTR"),
        F.col("Spend_AUD").cast("double").alias("Spend_AUD"),
        F.when(F.col("l_linenumber") == 2, F.col("Clicks").cast("bigint")).alias("QL"),
        F.lit(None).cast("bigint").alias("FT"),
        channel_group(channel).alias("Channel_Group"),
        F.lit(RUN_DATE).alias("Date_Added"),
        F.lit(RUN_DATE).alias("Date_Modified"),
        place.alias("place"),
    )


ORDER = ("place",)

AD_FACTS = f"""
SELECT Date, Country,
 CASE WHEN Campaign LIKE 'APAC\\_%' ESCAPE '\\' THEN
   CASE WHEN lower(Campaign) LIKE '%retargeting%' THEN 'AdRoll - Retargeting'
        WHEN lower(Campaign) LIKE '%lookalike%' THEN 'AdRoll - Lookalike'
        WHEN lower(Campaign) LIKE '%contextual%' THEN 'AdRoll - Contextual' ELSE 'AdRoll' END
  WHEN contains(Campaign, '[Pmax]') THEN 'Bing - PMax'
  WHEN contains(Campaign, 'Brand') THEN 'Bing - Brand' ELSE 'Bing - Category' END AS Channel,
 Campaign, Creative, Impressions, Clicks,
 CASE WHEN Impressions > 0 THEN Clicks / Impressions END AS CTR,
 CAST(Spend_AUD AS DOUBLE) AS Spend_AUD,
 CASE WHEN l_linenumber = 2 THEN CAST(Clicks AS BIGINT) END AS QL, CAST(NULL AS BIGINT) AS FT,
 CASE WHEN Campaign LIKE 'APAC\\_%' ESCAPE '\\' THEN 'AdRoll' ELSE 'Bing' END AS Channel_Group,
 DATE '2026-04-27' AS Date_Added, DATE '2026-04-27' AS Date_Modified,
 (l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ord
FROM ({plain(AD_RAW)})
"""


# Snippets for the SQL side ---------------------------------------------------------


def sql_num(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)"
        f"([eE][+-]?[0-9]+)?\\s*$') THEN TRY_CAST(trim({x}) AS DOUBLE) END"
    )


def sql_day(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '^[0-9]{{4}}[-./][0-9]{{2}}[-./][0-9]{{2}}') "
        f"THEN TRY_CAST(replace(replace(substr({x}, 1, 10), '.', '-'), '/', '-') AS DATE) END"
    )


def sql_text(x: str) -> str:
    return f"coalesce({x}, 'nan')"


APAC_SQL = "('VN','TH','SG','MY','CN','HK','TW','ID','PH','IN','MN')"


def sql_utm(utm: str) -> tuple[str, str]:
    """Channel and group of a UTM text, for the values the lead feed holds."""
    low = f"lower(trim({utm}))"
    head = (
        f"CASE WHEN {utm} IS NULL OR {low} IN ('', '-', 'nan', 'none', 'unknown', '(not set)') "
        "THEN 'Organic' "
        f"WHEN regexp_matches(replace(replace({low}, '-', ''), '_', ''), '^[0-9]+$') THEN 'IB' "
        f"WHEN {low} LIKE 'affiliate-%' THEN 'Affiliates' "
        f"WHEN {low} IN ('fb', 'ig') OR {low} LIKE 'facebook%' OR {low} LIKE 'instagram%' "
        "THEN 'Meta' "
    )
    channel = head + (
        f"WHEN {low} = 'google' THEN 'Google' WHEN {low} = 'youtube-video' THEN 'youtube' "
        f"WHEN {low} = 'bing-search-brand' THEN 'Bing' "
        f"WHEN {low} LIKE '%youtube%' THEN 'YouTube' WHEN {low} LIKE '%google%' THEN 'Google' "
        f"WHEN {low} LIKE '%bing%' THEN 'Bing' WHEN {low} LIKE '%ta-media%' THEN 'TA Media' "
        f"ELSE trim({utm}) END"
    )
    group = head + (
        f"WHEN {low} = 'google' THEN 'Others' WHEN {low} = 'youtube-video' THEN 'Others' "
        f"WHEN {low} = 'bing-search-brand' THEN 'Bing' "
        f"WHEN {low} LIKE '%youtube%' THEN 'YouTube' WHEN {low} LIKE '%google%' THEN 'Google' "
        f"WHEN {low} LIKE '%bing%' THEN 'Bing' WHEN {low} LIKE '%ta-media%' THEN 'TA Media' "
        "ELSE 'Others' END"
    )
    return channel, group


def sql_lead_class(utm: str, medium: str) -> tuple[str, str]:
    return tuple(
        f"CASE WHEN lower(trim({medium})) = 'ib' THEN 'IB' "
        f"WHEN lower(trim({medium})) = 'affiliates' THEN 'Affiliates' ELSE {x} END"
        for x in sql_utm(utm)
    )


_CH, _GRP = sql_lead_class("UTM", "Medium")
LEAD_CLASSED = f"""
SELECT event_id, CAST(Created AS DATE) AS Date, Country, {_CH} AS Channel,
 {_GRP} AS Channel_Group, Stage, feed
FROM ({plain(LEAD_RAW)}) WHERE Country IN {APAC_SQL}
"""
LEAD_COUNTS = f"""
SELECT Date, Country, Channel, Channel_Group,
 count(*) FILTER (WHERE feed = 'ql') AS QL,
 count(*) FILTER (WHERE feed = 'ft' AND Stage IN ('Active','Funded NT','Funded')) AS FT
FROM ({LEAD_CLASSED}) WHERE Channel_Group <> 'Affiliates'
GROUP BY 1, 2, 3, 4 HAVING count(*) FILTER (WHERE feed = 'ql') > 0
 OR count(*) FILTER (WHERE feed = 'ft' AND Stage IN ('Active','Funded NT','Funded')) > 0
"""
LEAD_FACTS = f"""
SELECT Date, Country, Channel, Channel AS Campaign, CAST(NULL AS STRING) AS Creative,
 CAST(NULL AS DOUBLE) AS Impressions, CAST(NULL AS DOUBLE) AS Clicks, CAST(NULL AS DOUBLE) AS CTR,
 CAST(NULL AS DOUBLE) AS Spend_AUD, QL, FT, Channel_Group,
 DATE '2026-04-27' AS Date_Added, DATE '2026-04-27' AS Date_Modified
FROM ({LEAD_COUNTS})
"""


def sql_first(x: str) -> str:
    return f"arg_min({x}, ord) FILTER (WHERE {x} IS NOT NULL)"


AD_DEDUP = f"""
SELECT Date, Country, Channel, Campaign, Creative,
 coalesce(sum(Impressions), 0) AS Impressions, coalesce(sum(Clicks), 0) AS Clicks,
 round({sql_first('CTR')}, 6) AS CTR, round(coalesce(sum(Spend_AUD), 0), 2) AS Spend_AUD,
 {sql_first('QL')} AS QL, {sql_first('FT')} AS FT,
 {sql_first('Channel_Group')} AS Channel_Group,
 {sql_first('Date_Added')} AS Date_Added, {sql_first('Date_Modified')} AS Date_Modified
FROM ads GROUP BY Date, Country, Channel, Campaign, Creative
"""


def rounded(df: DataFrame) -> DataFrame:
    """Ratios to 6 and money to 2 places, so that the order of additions cannot show."""
    have = [c for c in ("CTR", "Spend_AUD", "Spend") if c in df.columns]
    return df.withColumns({c: F.round(c, 6 if c == "CTR" else 2) for c in have})
