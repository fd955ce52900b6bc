"""Column expressions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import classify as K
from tallyloom.functions import dates as D
from tallyloom.functions import scalars as X
from tallyloom.operators.counts import flag_any
from tallyloom.plans.queries.base import (
    AD_RAW,
    EXPORT,
    LEAD_RAW,
    plain,
    query,
    sql_lead_class,
    sql_num,
    sql_utm,
)

RAW, EXP, LEADS = plain(AD_RAW), plain(EXPORT), plain(LEAD_RAW)


def tally(df, *keys):
    """Rows per combination of input and output values."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


NUMBERS = """
SELECT CASE l_linenumber WHEN 1 THEN CAST(CAST(l_quantity AS INT) AS STRING)
 WHEN 2 THEN ' ' || CAST(CAST(l_quantity AS INT) AS STRING) || ' '
 WHEN 3 THEN CAST(CAST(l_quantity AS INT) AS STRING) || 'd'
 WHEN 4 THEN '1,' || CAST(CAST(l_quantity AS INT) AS STRING)
 WHEN 5 THEN CAST(CAST(l_tax AS DECIMAL(9,2)) AS STRING) || '%'
 WHEN 6 THEN CASE WHEN l_partkey % 3 = 0 THEN 'nan' WHEN l_partkey % 3 = 1 THEN ''
   ELSE '$' || CAST(CAST(l_quantity AS INT) AS STRING) END
 WHEN 7 THEN CASE WHEN l_partkey % 2 = 0 THEN CAST(CAST(l_quantity AS INT) AS STRING) || 'e3'
   ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END END AS txt
FROM {lineitem}
"""


@query(
    "i01_to_num",
    f"SELECT txt, {sql_num('txt')} AS num, count(*) AS n FROM ({plain(NUMBERS)}) GROUP BY 1, 2",
)
def _(t):
    return tally(t.sql(NUMBERS).withColumn("num", X.to_num(F.col("txt"))), "txt", "num")


@query(
    "i02_to_long",
    f"""SELECT txt, CASE WHEN num = floor(num) THEN CAST(num AS BIGINT) END AS whole,
 coalesce(num <> floor(num), false) AS broken, count(*) AS n
 FROM (SELECT txt, {sql_num('txt')} AS num FROM ({plain(NUMBERS)})) GROUP BY 1, 2, 3""",
)
def _(t):
    txt = F.col("txt")
    df = t.sql(NUMBERS).withColumns({"whole": X.to_long(txt), "broken": X.not_whole(txt)})
    return tally(df, "txt", "whole", "broken")


@query(
    "i03_strip_upper_lower",
    f"""SELECT loose_cc, trim(loose_cc) AS stripped, upper(trim(loose_cc)) AS code,
 lower(camp) AS low, count(*) AS n FROM ({EXP}) GROUP BY 1, 2, 3, 4""",
)
def _(t):
    df = t.sql(EXPORT).withColumns(
        {
            "stripped": X.strip(F.col("loose_cc")),
            "code": X.code(F.col("loose_cc")),
            "low": F.lower("camp"),
        }
    )
    return tally(df, "loose_cc", "stripped", "code", "low")


@query(
    "i04_join_text",
    f"""SELECT coalesce(camp,'nan') || ' | ' || coalesce(brand,'nan') || ' | '
 || coalesce(flag,'nan') AS joined, count(*) AS n FROM ({EXP}) GROUP BY 1""",
)
def _(t):
    joined = X.join_text(" | ", *[F.col(c) for c in ("camp", "brand", "flag")])
    return tally(t.sql(EXPORT).withColumn("joined", joined), "joined")


@query(
    "i05_prefix_country",
    f"""SELECT camp, nullif(regexp_extract(camp, '^(HK|TH|TW|VN|MY|SG|CN|IN|ID|PH|MN)', 1), '')
 AS country, count(*) AS n FROM ({EXP}) GROUP BY 1, 2""",
)
def _(t):
    return tally(
        t.sql(EXPORT).withColumn("country", K.prefix_country(F.col("camp"))), "camp", "country"
    )


@query(
    "i06_token_country",
    f"""SELECT camp, CASE regexp_extract(camp, 'APAC_([^_]+)_', 1) WHEN 'Vietnam' THEN 'VN' END
 AS country, nullif(CASE regexp_extract(camp, 'APAC_([^_]+)_', 1) WHEN 'Vietnam' THEN 'VN'
 ELSE regexp_extract(camp, 'APAC_([^_]+)_', 1) END, '') AS or_token, count(*) AS n
 FROM ({EXP}) GROUP BY 1, 2, 3""",
)
def _(t):
    camp = F.col("camp")
    df = t.sql(EXPORT).withColumns(
        {"country": K.token_country(camp), "or_token": K.token_country_or_token(camp)}
    )
    return tally(df, "camp", "country", "or_token")


LABELS = """SELECT CASE l_linenumber WHEN 1 THEN 'Bing - PMax' WHEN 2 THEN 'Meta - Agency'
 WHEN 3 THEN 'TA Media' WHEN 4 THEN 'Apple Search Ads' WHEN 5 THEN 'unheard of'
 WHEN 6 THEN 'AdRoll - Lookalike' END AS channel, l_quantity FROM {lineitem}"""


@query(
    "i07_channel_group",
    f"""SELECT channel, CASE channel WHEN 'Bing - PMax' THEN 'Bing' WHEN 'Meta - Agency' THEN 'Meta'
 WHEN 'TA Media' THEN 'TA Media' WHEN 'Apple Search Ads' THEN 'Apple Search Ads'
 WHEN 'AdRoll - Lookalike' THEN 'AdRoll' ELSE 'Others' END AS grp, count(*) AS n
 FROM ({plain(LABELS)}) GROUP BY 1, 2""",
)
def _(t):
    return tally(
        t.sql(LABELS).withColumn("grp", K.channel_group(F.col("channel"))), "channel", "grp"
    )


_UC, _UG = sql_utm("UTM")
_LC, _LG = sql_lead_class("UTM", "Medium")


@query(
    "i08_utm_class",
    f"SELECT UTM, {_UC} AS channel, {_UG} AS grp, count(*) AS n FROM ({LEADS}) GROUP BY 1, 2, 3",
)
def _(t):
    df = t.sql(LEAD_RAW).withColumn("c", K.utm_class(F.col("UTM")))
    return tally(
        df.select("UTM", F.col("c.channel").alias("channel"), F.col("c.grp").alias("grp")),
        "UTM",
        "channel",
        "grp",
    )


@query(
    "i09_lead_class",
    f"""SELECT UTM, Medium, {_LC} AS "Channel", {_LG} AS "Channel_Group", count(*) AS n
 FROM ({LEADS}) GROUP BY 1, 2, 3, 4""",
)
def _(t):
    df = K.with_lead_class(t.sql(LEAD_RAW))
    return tally(df, "UTM", "Medium", "Channel", "Channel_Group")


@query(
    "i10_bing_channel",
    f"""SELECT camp, CASE WHEN contains(camp, '[Pmax]') THEN 'Bing - PMax'
 WHEN contains(camp, 'Brand') THEN 'Bing - Brand' ELSE 'Bing - Category' END AS channel,
 count(*) AS n FROM ({EXP}) GROUP BY 1, 2""",
)
def _(t):
    return tally(
        t.sql(EXPORT).withColumn("channel", K.bing_channel(F.col("camp"))), "camp", "channel"
    )


@query(
    "i11_adroll_channel",
    f"""SELECT camp, CASE WHEN lower(camp) LIKE '%retargeting%' THEN 'AdRoll - Retargeting'
 WHEN lower(camp) LIKE '%lookalike%' THEN 'AdRoll - Lookalike'
 WHEN lower(camp) LIKE '%contextual%' THEN 'AdRoll - Contextual' ELSE 'AdRoll' END AS channel,
 count(*) AS n FROM ({EXP}) GROUP BY 1, 2""",
)
def _(t):
    return tally(
        t.sql(EXPORT).withColumn("channel", K.adroll_channel(F.col("camp"))), "camp", "channel"
    )


RATIO = "SELECT l_discount AS part, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_tax END AS whole FROM {lineitem}"


@query(
    "i12_ratio_or_null",
    f"""SELECT part, whole, round(CASE WHEN whole > 0 THEN part / whole END, 6) AS ratio,
 count(*) AS n FROM ({plain(RATIO)}) GROUP BY 1, 2, 3""",
)
def _(t):
    ratio = F.round(X.ratio_or_null(F.col("part"), F.col("whole")), 6)
    return tally(t.sql(RATIO).withColumn("ratio", ratio), "part", "whole", "ratio")


@query(
    "i13_ratio_or_zero",
    f"""SELECT part, whole, round(CASE WHEN whole > 0 THEN part / whole ELSE 0 END, 6) AS ratio,
 count(*) AS n FROM ({plain(RATIO)}) GROUP BY 1, 2, 3""",
)
def _(t):
    ratio = F.round(X.ratio_or_zero(F.col("part"), F.col("whole")), 6)
    return tally(t.sql(RATIO).withColumn("ratio", ratio), "part", "whole", "ratio")


@query(
    "i14_pct_to_frac",
    f"""SELECT pct, round({sql_num('pct')} / 100, 6) AS frac, count(*) AS n
 FROM ({EXP}) GROUP BY 1, 2""",
)
def _(t):
    frac = F.round(X.pct_to_frac(X.to_num(F.col("pct"))), 6)
    return tally(t.sql(EXPORT).withColumn("frac", frac), "pct", "frac")


@query(
    "i15_fx",
    """SELECT l_suppkey AS supp, round(sum(round(l_extendedprice * 1.58::DOUBLE, 4)), 2) AS aud,
 count(*) AS n FROM lineitem GROUP BY 1""",
)
def _(t):
    aud = F.round(X.fx(F.col("l_extendedprice"), 1.58), 4)
    return (
        t.lineitem.groupBy(F.col("l_suppkey").alias("supp"))
        .agg(F.round(F.sum(aud), 2).alias("aud"), F.count(F.lit(1)).alias("n"))
    )


RATES = """SELECT 'f' || CAST(l_suppkey AS STRING) AS f,
 CASE WHEN l_suppkey % 2 = 0 AND l_linenumber = 1 THEN CAST(CAST(l_tax * 100 AS DECIMAL(9,2)) AS STRING) || '%'
 WHEN l_linenumber = 2 THEN NULL ELSE CAST(CAST(l_tax AS DECIMAL(9,2)) AS STRING) END AS rate
FROM {lineitem}"""


@query(
    "i16_ctr_auto",
    f"""SELECT f, rate, round(CASE WHEN has_pct THEN {sql_num("replace(rate, '%', '')")} / 100
 ELSE {sql_num('rate')} END, 6) AS ctr, count(*) AS n
 FROM (SELECT a.*, b.has_pct FROM ({plain(RATES)}) a JOIN
   (SELECT f, coalesce(bool_or(contains(rate, '%')), false) AS has_pct FROM ({plain(RATES)})
    GROUP BY f) b USING (f)) GROUP BY 1, 2, 3""",
)
def _(t):
    df = flag_any(t.sql(RATES), F.col("rate").contains("%"), "f", "has_pct")
    ctr = F.round(X.ctr_auto(F.col("rate"), F.col("has_pct")), 6)
    return tally(df.withColumn("ctr", ctr), "f", "rate", "ctr")


@query(
    "i17_money",
    """SELECT l_suppkey AS supp, round(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 2)::DOUBLE
 AS paid, count(*) AS n FROM lineitem GROUP BY 1""",
)
def _(t):
    written = "'$' || format_number(l_extendedprice, 2) || ' '"
    df = t.lineitem.select("l_suppkey", X.money(F.expr(written)).alias("paid"))
    return df.groupBy(F.col("l_suppkey").alias("supp")).agg(
        F.round(F.sum("paid"), 2).alias("paid"), F.count(F.lit(1)).alias("n")
    )


@query(
    "i18_fill0",
    f"""SELECT Country, sum(coalesce(Impressions, 0)) AS shown,
 count(*) FILTER (WHERE coalesce(Impressions, 0) = 0) AS zeros FROM ({RAW}) GROUP BY 1""",
)
def _(t):
    filled = X.fill0(F.col("Impressions"))
    return t.sql(AD_RAW).groupBy("Country").agg(
        F.sum(filled).alias("shown"), F.count_if(filled == 0).alias("zeros")
    )


# Ship dates in every layout a date column may have.
LAYOUTS = """
SELECT CAST(l_shipdate AS DATE) AS day, l_linenumber AS form, CASE l_linenumber
 WHEN 1 THEN CAST(CAST(l_shipdate AS DATE) AS STRING)
 WHEN 2 THEN CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 00:00:00'
 WHEN 3 THEN CAST(year(l_shipdate) AS STRING) || '.' || CAST(month(l_shipdate) AS STRING)
        || '.' || CAST(day(l_shipdate) AS STRING)
 WHEN 4 THEN CAST(month(l_shipdate) AS STRING) || '/' || CAST(day(l_shipdate) AS STRING)
        || '/' || CAST(year(l_shipdate) AS STRING)
 WHEN 5 THEN 'nan' WHEN 6 THEN 'Total' END AS txt
FROM {lineitem}
"""


@query(
    "i19_date_strict",
    f"""SELECT txt, CASE WHEN form <= 4 THEN day END AS parsed,
 CASE WHEN txt = 'Total' THEN 'unreadable date' END AS fault, count(*) AS n
 FROM ({plain(LAYOUTS)}) GROUP BY 1, 2, 3""",
)
def _(t):
    parsed, fault = D.date_strict(F.col("txt"))
    df = t.sql(LAYOUTS).withColumns({"parsed": parsed, "fault": fault})
    return tally(df, "txt", "parsed", "fault")


@query(
    "i20_date_lenient",
    f"""SELECT txt, CASE WHEN form <= 4 THEN day END AS parsed, count(*) AS n
 FROM ({plain(LAYOUTS)}) GROUP BY 1, 2""",
)
def _(t):
    df = t.sql(LAYOUTS).withColumn("parsed", D.date_lenient(F.col("txt")))
    return tally(df, "txt", "parsed")


DAYFIRST = """SELECT CASE l_linenumber % 3
 WHEN 0 THEN CAST(day(l_shipdate) AS STRING) || '/' || CAST(month(l_shipdate) AS STRING)
   || '/' || CAST(year(l_shipdate) AS STRING)
 WHEN 1 THEN CAST(day(l_shipdate) AS STRING) || '/' || CAST(month(l_shipdate) AS STRING)
   || '/' || CAST(year(l_shipdate) AS STRING) || ' 9:05'
 ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS txt,
 CAST(l_shipdate AS DATE) AS day, l_linenumber % 3 AS form FROM {lineitem}"""


@query(
    "i21_ts_dayfirst",
    f"""SELECT txt, CAST(day AS TIMESTAMP) + CASE WHEN form = 1 THEN INTERVAL '9 hours 5 minutes'
 ELSE INTERVAL '0 hours' END AS ts, count(*) AS n FROM ({plain(DAYFIRST)}) GROUP BY 1, 2""",
)
def _(t):
    ts = D.ts_dayfirst(F.col("txt")).cast("timestamp")
    return tally(t.sql(DAYFIRST).withColumn("ts", ts), "txt", "ts")


@query(
    "i22_is_lead",
    f"""SELECT (Impressions IS NULL AND Spend_AUD IS NULL) AS lead, count(*) AS n
 FROM ({RAW}) GROUP BY 1""",
)
def _(t):
    lead = X.is_lead(F.col("Impressions"), F.col("Spend_AUD"))
    return tally(t.sql(AD_RAW).withColumn("lead", lead), "lead")


@query(
    "i23_to_text",
    f"""SELECT coalesce(flag, 'nan') AS txt, coalesce(camp, 'nan') AS camp_txt, count(*) AS n
 FROM ({EXP}) GROUP BY 1, 2""",
)
def _(t):
    df = t.sql(EXPORT).withColumns(
        {"txt": X.to_text(F.col("flag")), "camp_txt": X.to_text(F.col("camp"))}
    )
    return tally(df, "txt", "camp_txt")


@query(
    "i24_to_day",
    "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1",
)
def _(t):
    return tally(t.events.withColumn("day", D.to_day(F.col("ts"))), "day")


@query(
    "i25_null_key",
    f"""SELECT coalesce(Country, '') AS country_key, coalesce(Creative, '') AS creative_key,
 count(*) AS n FROM ({RAW}) GROUP BY 1, 2""",
)
def _(t):
    df = t.sql(AD_RAW).withColumns(
        {
            "country_key": X.null_key(F.col("Country")),
            "creative_key": X.null_key(F.col("Creative")),
        }
    )
    return tally(df, "country_key", "creative_key")


@query(
    "i26_yymmdd",
    """SELECT strftime(o_orderdate, '%d%m%y') AS ddmmyy, strftime(o_orderdate, '%y%m%d') AS yymmdd,
 count(*) AS n FROM orders GROUP BY 1, 2""",
)
def _(t):
    df = t.orders.withColumn("ddmmyy", F.date_format("o_orderdate", "ddMMyy"))
    return tally(df.withColumn("yymmdd", D.yymmdd(F.col("ddmmyy"))), "ddmmyy", "yymmdd")


@query(
    "i27_field_or",
    """SELECT event_type, sum(coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0)) AS k,
 sum(-1) AS missing FROM events GROUP BY 1""",
)
def _(t):
    doc = F.from_json("props", "k BIGINT, deeper STRUCT<x: BIGINT>")
    return t.events.groupBy("event_type").agg(
        F.sum(X.field_or(doc, "k", 0)).alias("k"),
        F.sum(X.field_or(doc, "deeper.x", -1)).alias("missing"),
    )


@query(
    "d03_map_lookup",
    f"""SELECT land, CASE land WHEN 'Hong Kong' THEN 'HK' WHEN 'Taiwan' THEN 'TW'
 WHEN 'China mainland' THEN 'CN' WHEN 'India' THEN 'IN' WHEN 'Malaysia' THEN 'MY' END AS country,
 CASE land WHEN 'Hong Kong' THEN 'HK' WHEN 'Taiwan' THEN 'TW' ELSE 'Others' END AS listed,
 count(*) AS n FROM ({EXP}) GROUP BY 1, 2, 3""",
)
def _(t):
    from tallyloom.settings import ADROLL_COUNTRY, APPLE_COUNTRY

    df = t.sql(EXPORT).withColumns(
        {
            "country": K.lookup(F.col("land"), APPLE_COUNTRY),
            "listed": K.lookup(F.col("land"), ADROLL_COUNTRY, "Others"),
        }
    )
    return tally(df, "land", "country", "listed")
