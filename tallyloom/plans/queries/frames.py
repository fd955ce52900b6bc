"""Frame operators: projections, filters, joins, aggregates, windows, sets, upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions.scalars import is_lead, to_num
from tallyloom.functions.classify import bing_channel, channel_group, with_lead_class
from tallyloom.functions.dates import date_strict
from tallyloom.operators import columns as C
from tallyloom.operators import counts as N
from tallyloom.operators import dedup as U
from tallyloom.operators import order as O
from tallyloom.operators import predicates as P
from tallyloom.operators import sequence as Q
from tallyloom.operators import upsert as M
from tallyloom.plans.batch import gate, source_status
from tallyloom.plans.queries.base import (
    AD_DEDUP,
    AD_FACTS,
    AD_RAW,
    APAC_SQL,
    EXPORT,
    LEAD_CLASSED,
    LEAD_COUNTS,
    LEAD_FACTS,
    LEAD_RAW,
    OPTIONS,
    ORDER,
    RUN_DATE,
    ad_facts,
    plain,
    query,
    rounded,
    sql_day,
    sql_first,
    sql_num,
)
from tallyloom.schema import FACT_COLUMNS, FAULT, conform, empty_facts, stamp, warehouse_shape
from tallyloom.sources import leads as L

RAW, EXP, LEADS = plain(AD_RAW), plain(EXPORT), plain(LEAD_RAW)
FACTS = ", ".join(FACT_COLUMNS)


def size(df, *keys):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def lead_feeds(t):
    """The two CRM feeds with region filter, as the lead reader hands them on."""
    rows = t.sql(LEAD_RAW).filter(P.in_region("Country"))
    return rows.filter(F.col("feed") == "ql"), rows.filter(F.col("feed") == "ft")


def lead_facts(t):
    return stamp(L.lead_facts(*lead_feeds(t)), RUN_DATE).select(*FACT_COLUMNS)


def deduped(t):
    """Deduplicated ad facts: the shape batches have when they are merged."""
    return U.dedup(ad_facts(t), ORDER, group_from_channel=True)


# The flagship -----------------------------------------------------------------------


@query(
    "flagship_channel_summary",
    f"""WITH lines AS (SELECT Date, Country, Campaign, Creative, Impressions, Clicks,
  CAST(Spend_AUD AS DOUBLE) AS Spend_AUD,
  CASE WHEN contains(Campaign, '[Pmax]') THEN 'Bing - PMax'
   WHEN contains(Campaign, 'Brand') THEN 'Bing - Brand' ELSE 'Bing - Category' END AS Channel
  FROM ({RAW}) WHERE Campaign <> 'Total'),
 ads AS (SELECT Date, Country, Channel, Campaign, Creative, coalesce(sum(Impressions), 0) AS i,
  coalesce(sum(Clicks), 0) AS c, coalesce(sum(Spend_AUD), 0) AS s FROM lines
  WHERE NOT (Impressions IS NULL AND Spend_AUD IS NULL) GROUP BY 1, 2, 3, 4, 5)
 SELECT Channel, count(Date) AS "Rows", round(sum(s), 2) AS Spend, sum(c) AS Clicks,
  sum(i) AS Impressions FROM ads GROUP BY Channel""",
)
def _(t):
    raw = t.sql(AD_RAW).filter(P.not_footer("Campaign", ["Total"], prefix="©"))
    channel = bing_channel(F.col("Campaign"))
    facts = conform(
        stamp(
            raw.withColumns({"Channel": channel, "Channel_Group": channel_group(channel)}),
            RUN_DATE,
        ),
        ["l_orderkey"],
    )
    _, ads = P.split_rows(facts, is_lead(F.col("Impressions"), F.col("Spend_AUD")))
    ads = U.dedup_ads(ads, ["l_orderkey"], group_from_channel=True)
    return rounded(N.channel_summary(ads))


# Projections ------------------------------------------------------------------------


@query(
    "b01_conform",
    f"""SELECT Date, Country, CAST(NULL AS STRING) AS Channel, Campaign, Creative, Impressions,
 Clicks, CAST(NULL AS DOUBLE) AS CTR, CAST(Spend_AUD AS DOUBLE) AS Spend_AUD,
 CAST(NULL AS BIGINT) AS QL, CAST(NULL AS BIGINT) AS FT, CAST(NULL AS STRING) AS Channel_Group,
 CAST(NULL AS DATE) AS Date_Added, CAST(NULL AS DATE) AS Date_Modified FROM ({RAW})""",
)
def _(t):
    return conform(t.sql(AD_RAW))


@query(
    "b02_empty_facts",
    f"SELECT Country, count(*) AS n FROM ({RAW}) GROUP BY 1",
)
def _(t):
    facts = O.union_all([empty_facts(t.spark), conform(t.sql(AD_RAW))])
    return size(facts, "Country")


@query(
    "b03_rename_positional",
    f"SELECT cc AS Country, amount AS Commission, count(*) AS n FROM ({EXP}) GROUP BY 1, 2",
)
def _(t):
    df = C.rename_positional(t.sql(EXPORT).select("cc", "amount"), ("Country", "Commission"))
    return size(df, "Country", "Commission")


@query(
    "b04_trim_headers",
    f'SELECT cc AS "Country", count(*) AS n FROM ({EXP}) GROUP BY 1',
)
def _(t):
    df = t.sql(EXPORT).select(F.col("cc").alias("  Country\t"))
    return size(C.trim_headers(df), "Country")


@query(
    "b05_fuzzy_rename",
    f"""SELECT camp AS Campaign, sum({sql_num('imp')}) AS Impressions, sum({sql_num('clk')}) AS Clicks,
 round(sum({sql_num('amount')}), 2) AS Spend_AUD FROM ({EXP}) GROUP BY 1""",
)
def _(t):
    df = t.sql(EXPORT).select(
        F.col("camp").alias("Campaign full name"),
        F.col("imp").alias("Impression volume"),
        F.col("clk").alias("Click"),
        F.col("amount").alias("Cost ( AUD )"),
        F.col("rate").alias("Cost per click"),
    )
    sums = [F.sum(to_num(F.col(c))).alias(c) for c in ("Impressions", "Clicks", "Spend_AUD")]
    return rounded(C.fuzzy_rename(df).groupBy("Campaign").agg(*sums))


@query(
    "b06_fixed_rename",
    f"SELECT clk AS Clicks, count(*) AS n FROM ({EXP}) GROUP BY 1",
)
def _(t):
    return size(C.rename(t.sql(EXPORT), {"clk": "Clicks", "absent": "Ignored"}), "Clicks")


@query(
    "b07_pick_column",
    f"SELECT iso AS day, CAST(NULL AS STRING) AS missing, count(*) AS n FROM ({EXP}) GROUP BY 1, 2",
)
def _(t):
    df = t.sql(EXPORT)
    day, missing = C.pick(df, "Date", "Day", "iso"), C.or_null(C.pick(df, "Reach", "Views"))
    return size(df.select(day.alias("day"), missing.cast("string").alias("missing")), "day", "missing")


@query(
    "b08_constant_columns",
    f"""SELECT 'Meta' AS Channel, 'Meta' AS Channel_Group, CAST(NULL AS BIGINT) AS QL,
 cc AS Country, count(*) AS n FROM ({EXP}) GROUP BY 4""",
)
def _(t):
    df = C.fact_rows(
        t.sql(EXPORT), Country=F.col("cc"), Channel="Meta", Channel_Group="Meta", QL=None
    )
    return size(df, "Channel", "Channel_Group", "QL", "Country")


@query(
    "b09_warehouse_shape",
    f"""SELECT {sql_day('mixed_day')} AS Date, cc AS Country, {sql_num('imp')} AS Impressions,
 {sql_num('amount')} AS Spend_AUD, TRY_CAST(clk AS BIGINT) AS QL,
 DATE '2026-04-27' AS Date_Added, DATE '2026-04-27' AS Date_Modified FROM ({EXP})""",
)
def _(t):
    text = t.sql(EXPORT).select(
        F.col("mixed_day").alias("Date"),
        F.col("cc").alias("Country"),
        F.col("imp").alias("Impressions"),
        F.col("amount").alias("Spend (AUD)"),
        F.col("clk").alias("QL"),
    )
    return warehouse_shape(text, RUN_DATE).select(
        "Date", "Country", "Impressions", "Spend_AUD", "QL", "Date_Added", "Date_Modified"
    )


@query(
    "b10_audit_stamp",
    f"""SELECT DATE '2026-04-27' AS Date_Added, DATE '2026-04-27' AS Date_Modified, count(*) AS n
 FROM ({RAW})""",
)
def _(t):
    return size(stamp(t.sql(AD_RAW), RUN_DATE), "Date_Added", "Date_Modified")


@query(
    "b11_keep_extras",
    f"""SELECT Country, l_linenumber, count(*) AS n, count(*) FILTER (WHERE Creative IS NULL)
 AS no_creative FROM ({RAW}) GROUP BY 1, 2""",
)
def _(t):
    kept = conform(t.sql(AD_RAW), extras=["l_linenumber"])
    return kept.groupBy("Country", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("Creative").isNull()).alias("no_creative")
    )


# Filters ----------------------------------------------------------------------------


def filter_query(name, predicate, condition, column="camp"):
    """Rows left by a predicate, counted per value of its column."""

    @query(name, f"SELECT {column}, count(*) AS n FROM ({EXP}) WHERE {condition} GROUP BY 1")
    def _(t):
        return size(t.sql(EXPORT).filter(predicate()), column)


filter_query("c01_not_null", lambda: P.not_null("camp"), "camp IS NOT NULL")
filter_query("c02_not_blank", lambda: P.not_blank("camp"), "camp IS NULL OR trim(camp) <> ''")
filter_query(
    "c03_not_footer",
    lambda: P.not_footer("camp", ["Total", "Grand Total"], prefix="©"),
    "camp IS NULL OR (camp NOT IN ('Total', 'Grand Total') AND NOT starts_with(camp, '©'))",
)
filter_query("c04_in_region_exact", lambda: P.in_region("cc"), f"cc IN {APAC_SQL}", "cc")
filter_query(
    "c04_in_region_code",
    lambda: P.in_region("loose_cc", "code"),
    f"upper(trim(loose_cc)) IN {APAC_SQL}",
    "loose_cc",
)
filter_query(
    "c04_in_region_upper",
    lambda: P.in_region("loose_cc", "upper"),
    f"upper(loose_cc) IN {APAC_SQL}",
    "loose_cc",
)
filter_query(
    "c05_iso_shaped",
    lambda: P.iso_shaped("mixed_day"),
    "regexp_matches(mixed_day, '^\\d{4}-\\d{2}-\\d{2}')",
    "mixed_day",
)
filter_query(
    "c06_not_in", lambda: P.not_in("cc", ["AU", "NZ"]), "cc IS NULL OR cc NOT IN ('AU', 'NZ')", "cc"
)
filter_query("c11_valid_date", lambda: P.valid_date("mixed_day"), f"{sql_day('mixed_day')} IS NOT NULL", "mixed_day")
filter_query("c12_contains_ci", lambda: P.contains_ci("camp", "apac"), "lower(camp) LIKE '%apac%'")


@query(
    "c07_funded",
    f"""SELECT Stage, count(*) AS n FROM ({LEADS})
 WHERE Stage IN ('Active', 'Funded NT', 'Funded') GROUP BY 1""",
)
def _(t):
    return size(t.sql(LEAD_RAW).filter(P.funded("Stage")), "Stage")


@query(
    "c08_not_affiliate",
    f"""SELECT Channel, Channel_Group, count(*) AS n FROM ({LEAD_CLASSED})
 WHERE Channel_Group <> 'Affiliates' GROUP BY 1, 2""",
)
def _(t):
    counted = size(
        with_lead_class(t.sql(LEAD_RAW).filter(P.in_region("Country"))), "Channel", "Channel_Group"
    )
    return counted.filter(P.not_affiliate("Channel_Group"))


@query(
    "c09_row_not_blank",
    f"""SELECT supp, count(*) AS n FROM ({EXP}) WHERE NOT (coalesce(flag, '') = ''
 AND coalesce(mixed_day, '') IN ('', 'nan') AND trim(coalesce(camp, '')) = '') GROUP BY 1""",
)
def _(t):
    cells = F.array("flag", "mixed_day", "camp").alias("cells")
    return size(t.sql(EXPORT).select("supp", cells).filter(P.row_not_blank("cells")), "supp")


@query(
    "c10_not_label",
    f"SELECT Country, count(*) AS n FROM ({LEADS}) WHERE lower(trim(Country)) <> 'total' GROUP BY 1",
)
def _(t):
    return size(t.sql(LEAD_RAW).filter(P.not_label("Country")), "Country")


@query(
    "c13_split_rows",
    f"""SELECT CASE WHEN Impressions IS NULL AND Spend_AUD IS NULL THEN 'lead' ELSE 'ad' END AS part,
 count(*) AS n FROM ({RAW}) GROUP BY 1""",
)
def _(t):
    leads, ads = P.split_rows(
        t.sql(AD_RAW), is_lead(F.col("Impressions"), F.col("Spend_AUD"))
    )
    parts = [leads.withColumn("part", F.lit("lead")), ads.withColumn("part", F.lit("ad"))]
    return size(O.union_all(parts), "part")


@query(
    "c14_date_range",
    """SELECT o_orderstatus, count(*) AS n FROM orders
 WHERE o_orderdate BETWEEN TIMESTAMP '1996-02-03' AND TIMESTAMP '1999-11-30' GROUP BY 1""",
)
def _(t):
    return size(P.between(t.orders, "1996-02-03", "1999-11-30", "o_orderdate"), "o_orderstatus")


@query(
    "c14_last_days",
    """SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events
 WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-13' AND DATE '2024-01-19' GROUP BY 1""",
)
def _(t):
    df = t.events.withColumn("day", F.to_date("ts"))
    return size(P.last_days(df, 7, "2024-01-20", "day"), "day")


# Leads and joins --------------------------------------------------------------------


@query(
    "e01_group_size",
    f"""SELECT Date, Country, Channel, Channel_Group, count(*) AS n FROM ({LEAD_CLASSED})
 WHERE Channel_Group <> 'Affiliates' GROUP BY 1, 2, 3, 4""",
)
def _(t):
    return N.group_size(L.classified(t.sql(LEAD_RAW).filter(P.in_region("Country"))))


@query(
    "e01_group_size_null_keys",
    f"""SELECT Country, Campaign, Creative, count(*) AS n FROM ({RAW})
 WHERE Country IS NOT NULL AND Campaign IS NOT NULL AND Creative IS NOT NULL GROUP BY 1, 2, 3""",
)
def _(t):
    return N.group_size(t.sql(AD_RAW), ("Country", "Campaign", "Creative"))


@query("d01_full_outer_counts", LEAD_COUNTS)
def _(t):
    return L.count_leads(*lead_feeds(t))


BLEND_SQL = f"""
WITH a AS (SELECT Date, Country, sum(Impressions) AS Impressions, sum(Clicks) AS Clicks,
  CAST(sum(Spend_AUD) AS DOUBLE) AS Spend_AUD FROM (
   SELECT CAST(ts AS DATE) AS Date, replace(Country, 'VN', 'NZ') AS Country, value AS Impressions,
    value AS Clicks, CAST(value AS DECIMAL(18,2)) AS Spend_AUD
   FROM events JOIN ({LEADS}) USING (event_id)) GROUP BY 1, 2),
 l AS (SELECT Date, Country, sum(QL) AS QL, sum(FT) AS FT FROM ({LEAD_COUNTS}) GROUP BY 1, 2)
SELECT coalesce(a.Date, l.Date) AS Date, coalesce(a.Country, l.Country) AS Country,
 round(Impressions, 2) AS Impressions, round(Clicks, 2) AS Clicks, round(Spend_AUD, 2) AS Spend_AUD,
 CAST(QL AS BIGINT) AS QL, CAST(FT AS BIGINT) AS FT
FROM a FULL JOIN l ON a.Date = l.Date AND a.Country = l.Country
"""


@query("d04_blend", BLEND_SQL)
def _(t):
    values = t.events.select("event_id", "value")
    country = t.sql(LEAD_RAW).select("event_id", "Created", "Country")
    # Ads name one country otherwise than leads do, so each side has days of its own.
    ads = values.join(country, "event_id").select(
        F.to_date("Created").alias("Date"),
        F.replace("Country", F.lit("VN"), F.lit("NZ")).alias("Country"),
        *[F.col("value").alias(c) for c in ("Impressions", "Clicks", "Spend_AUD")],
    )
    out = N.blend(ads, L.count_leads(*lead_feeds(t)))
    return out.withColumns({c: F.round(c, 2) for c in ("Impressions", "Clicks", "Spend_AUD")})


# Aggregates -------------------------------------------------------------------------


@query(
    "e02_ad_dedup",
    f"""WITH ads AS (SELECT * FROM ({AD_FACTS})
 WHERE NOT (Impressions IS NULL AND Spend_AUD IS NULL)) {AD_DEDUP}""",
)
def _(t):
    _, ads = P.split_rows(ad_facts(t), is_lead(F.col("Impressions"), F.col("Spend_AUD")))
    return rounded(U.dedup_ads(ads, ORDER))


@query(
    "e02_ad_dedup_options",
    f"""WITH ads AS (SELECT * FROM ({AD_FACTS})
 WHERE NOT (Impressions IS NULL AND Spend_AUD IS NULL)),
 d AS (SELECT Date, Country, Channel, Campaign, Creative, sum(Impressions) AS i, sum(Clicks) AS c,
  sum(QL) AS QL FROM ads GROUP BY 1, 2, 3, 4, 5)
 SELECT Date, Country, Channel, Campaign, Creative, CAST(QL AS BIGINT) AS QL,
  round(CASE WHEN coalesce(i, 0) > 0 THEN c / i END, 6) AS CTR FROM d""",
)
def _(t):
    _, ads = P.split_rows(ad_facts(t), is_lead(F.col("Impressions"), F.col("Spend_AUD")))
    out = rounded(U.dedup_ads(ads, ORDER, ctr_mode="ratio", lead_agg="sum"))
    return out.select("Date", "Country", "Channel", "Campaign", "Creative", "QL", "CTR")


LEAD_DEDUP = f"""
SELECT Date, Country, Channel, {sql_first('Campaign')} AS Campaign,
 {sql_first('Creative')} AS Creative, CAST(NULL AS DOUBLE) AS Impressions,
 {sql_first('Clicks')} AS Clicks, round({sql_first('CTR')}, 6) AS CTR,
 CAST(NULL AS DOUBLE) AS Spend_AUD, CAST(coalesce(sum(QL), 0) AS BIGINT) AS QL,
 CAST(coalesce(sum(FT), 0) AS BIGINT) AS FT, Channel_Group,
 {sql_first('Date_Added')} AS Date_Added, {sql_first('Date_Modified')} AS Date_Modified
FROM leads GROUP BY Date, Country, Channel, Channel_Group
"""
DEDUPED = f"""
WITH facts AS ({AD_FACTS}),
 ads AS (SELECT * FROM facts WHERE NOT (Impressions IS NULL AND Spend_AUD IS NULL)),
 leads AS (SELECT * FROM facts WHERE Impressions IS NULL AND Spend_AUD IS NULL),
 deduped AS (({AD_DEDUP}) UNION ALL ({LEAD_DEDUP}))
"""


@query("e03_lead_dedup", f"{DEDUPED} {LEAD_DEDUP}")
def _(t):
    leads, _ = P.split_rows(ad_facts(t), is_lead(F.col("Impressions"), F.col("Spend_AUD")))
    return rounded(U.dedup_leads(leads, ORDER))


@query(
    "e04_grand_totals",
    f"""SELECT CAST(sum(QL) AS BIGINT) AS total_ql, CAST(sum(FT) AS BIGINT) AS total_ft,
 count(*) AS total_rows FROM ({LEAD_COUNTS})""",
)
def _(t):
    return N.grand_totals(L.count_leads(*lead_feeds(t)))


@query(
    "e05_channel_summary",
    f"""SELECT Channel, count(Date) AS "Rows", round(coalesce(sum(Spend_AUD), 0), 2) AS Spend,
 coalesce(sum(Clicks), 0) AS Clicks, coalesce(sum(Impressions), 0) AS Impressions
 FROM ({AD_FACTS}) GROUP BY 1""",
)
def _(t):
    return rounded(N.channel_summary(ad_facts(t)))


@query(
    "e06_kind_counts",
    f"""SELECT count(*) FILTER (WHERE QL IS NULL AND FT IS NULL) AS ad_rows,
 count(*) FILTER (WHERE NOT (QL IS NULL AND FT IS NULL)) AS lead_rows FROM ({AD_FACTS})""",
)
def _(t):
    return N.kind_counts(ad_facts(t))


@query(
    "e07_profile",
    f"""SELECT count(*) AS total_rows, min(Date) AS first_date, max(Date) AS last_date,
 count(DISTINCT Country) AS countries, count(DISTINCT Channel) AS channels,
 count(DISTINCT Campaign) AS campaigns, round(sum(Spend_AUD), 2) AS total_spend_aud,
 sum(Clicks) AS total_clicks, sum(Impressions) AS total_impressions FROM ({AD_FACTS})""",
)
def _(t):
    return N.profile(ad_facts(t)).withColumn("total_spend_aud", F.round("total_spend_aud", 2))


@query(
    "e07_distinct_values",
    f"SELECT DISTINCT Country FROM ({AD_FACTS}) WHERE Country IS NOT NULL",
)
def _(t):
    return N.distinct_values(ad_facts(t), "Country")


@query(
    "e08_any_per_file",
    f"""SELECT pth, line, bool_or(contains(money, '$') AND clk = '50') OVER (PARTITION BY pth)
 AS flagged, iso FROM ({EXP})""",
)
def _(t):
    df = t.sql(EXPORT).select("pth", "line", "iso", "money", "clk")
    flagged = N.flag_any(
        df, F.col("money").contains("$") & (F.col("clk") == "50"), "pth", "flagged"
    )
    return flagged.select("pth", "line", "flagged", "iso")


@query(
    "e10_seen_per_source",
    f"""SELECT Channel AS "_source", count(*) AS "rows",
 list_sort(list(DISTINCT land) FILTER (WHERE land IS NOT NULL)) AS countries
 FROM (SELECT *, CASE WHEN length(Channel) % 2 = 0 THEN 'far ' || Country ELSE Country END AS land
  FROM ({AD_FACTS})) GROUP BY 1""",
)
def _(t):
    far = F.when(F.length("Channel") % 2 == 0, F.concat(F.lit("far "), F.col("Country")))
    df = ad_facts(t).withColumn("_source", F.col("Channel"))
    return N.seen_per_source(df.withColumn("Country", F.coalesce(far, F.col("Country"))))


# Windows ----------------------------------------------------------------------------


@query(
    "f01_occurrence_number",
    f"""SELECT pth, rn, CASE WHEN n > 1 THEN base || ' #' || CAST(n AS STRING) ELSE base END AS base
 FROM (SELECT *, row_number() OVER (PARTITION BY pth, base ORDER BY rn) AS n
  FROM (SELECT pth, rn, brand || ' - ' || coalesce(flag, 'nan') AS base FROM ({EXP})))""",
)
def _(t):
    df = t.sql(EXPORT).select(
        "pth", "rn", F.concat("brand", F.lit(" - "), F.coalesce("flag", F.lit("nan"))).alias("base")
    )
    return Q.number_repeats(df, "base", ["pth"], "rn")


@query(
    "f02_forward_fill",
    f"""SELECT pth, rn, last_value(iso IGNORE NULLS) OVER w AS iso,
 last_value(camp IGNORE NULLS) OVER w AS camp
 FROM (SELECT pth, rn, CASE WHEN line = 1 AND part_no % 5 = 0 THEN iso END AS iso,
  CASE WHEN line = 2 THEN camp END AS camp FROM ({EXP}))
 WINDOW w AS (PARTITION BY pth ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def _(t):
    df = t.sql(EXPORT).select(
        "pth",
        "rn",
        F.when((F.col("line") == 1) & (F.col("part_no") % 5 == 0), F.col("iso")).alias("iso"),
        F.when(F.col("line") == 2, F.col("camp")).alias("camp"),
    )
    return Q.forward_fill(df, ["iso", "camp"], ["pth"], "rn")


@query(
    "f03_newest_per_group",
    """SELECT o_custkey AS c, arg_min(o_orderkey, (-epoch(o_orderdate), o_orderkey)) AS o_orderkey
 FROM orders GROUP BY 1""",
)
def _(t):
    df = t.orders.withColumn("c", F.col("o_custkey"))
    return Q.newest_per_group(df, "c", F.unix_timestamp("o_orderdate"), "o_orderkey")


# Order and sets ---------------------------------------------------------------------


@query("g01_total_order", f"{DEDUPED} SELECT * FROM deduped")
def _(t):
    return rounded(O.total_order(deduped(t), O.AD_ORDER))


@query("g02_lead_order", LEAD_FACTS)
def _(t):
    return O.total_order(lead_facts(t), O.LEAD_ORDER)


@query(
    "g03_first_names",
    "SELECT DISTINCT p_name FROM part ORDER BY p_name LIMIT 20",
)
def _(t):
    return O.first_names(t.part, "p_name", 20)


@query(
    "h01_union_all",
    f"""SELECT Channel_Group, count(*) AS n, CAST(coalesce(sum(QL), 0) AS BIGINT) AS ql FROM
 (SELECT {FACTS} FROM ({AD_FACTS}) UNION ALL SELECT {FACTS} FROM ({LEAD_FACTS})) GROUP BY 1""",
)
def _(t):
    both = O.union_all([ad_facts(t).select(*FACT_COLUMNS), lead_facts(t)])
    return both.groupBy("Channel_Group").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("QL"), F.lit(0)).alias("ql")
    )


@query("h02_split_dedup_union", f"{DEDUPED} SELECT * FROM deduped")
def _(t):
    return rounded(deduped(t))


# Upsert -----------------------------------------------------------------------------

# The table holds every ad row; the batch delivers every ad row again one month later
# with more clicks, so all months but the first are corrected and the last is new.
SHIFTED = """
 shifted AS (SELECT * REPLACE (CAST(Date + INTERVAL 1 MONTH AS DATE) AS Date, Clicks + 1 AS Clicks,
  DATE '2026-05-27' AS Date_Added, DATE '2026-05-27' AS Date_Modified) FROM deduped),
 keyed_t AS (SELECT *, (Impressions IS NULL AND Spend_AUD IS NULL) AS lead,
  coalesce(CASE WHEN Impressions IS NULL AND Spend_AUD IS NULL THEN Channel_Group ELSE Campaign END, '') AS k4,
  CASE WHEN Impressions IS NULL AND Spend_AUD IS NULL THEN '' ELSE coalesce(Creative, '') END AS k5,
  coalesce(Country, '') AS k2, coalesce(Channel, '') AS k3 FROM deduped),
 keyed_s AS (SELECT *, (Impressions IS NULL AND Spend_AUD IS NULL) AS lead,
  coalesce(CASE WHEN Impressions IS NULL AND Spend_AUD IS NULL THEN Channel_Group ELSE Campaign END, '') AS k4,
  CASE WHEN Impressions IS NULL AND Spend_AUD IS NULL THEN '' ELSE coalesce(Creative, '') END AS k5,
  coalesce(Country, '') AS k2, coalesce(Channel, '') AS k3 FROM shifted),
 matched AS (SELECT t.Date, t.Country, t.Channel, t.Campaign, t.Creative,
  CASE WHEN s.Date IS NULL THEN t.Impressions ELSE s.Impressions END AS Impressions,
  CASE WHEN s.Date IS NULL THEN t.Clicks ELSE s.Clicks END AS Clicks,
  CASE WHEN s.Date IS NULL THEN t.CTR ELSE s.CTR END AS CTR,
  CASE WHEN s.Date IS NULL THEN t.Spend_AUD ELSE s.Spend_AUD END AS Spend_AUD,
  CASE WHEN s.Date IS NULL THEN t.QL ELSE s.QL END AS QL,
  CASE WHEN s.Date IS NULL THEN t.FT ELSE s.FT END AS FT,
  CASE WHEN s.Date IS NULL THEN t.Channel_Group ELSE s.Channel_Group END AS Channel_Group,
  t.Date_Added, CASE WHEN s.Date IS NULL THEN t.Date_Modified ELSE s.Date_Modified END AS Date_Modified,
  CASE WHEN s.Date IS NULL THEN 'kept' ELSE 'updated' END AS change
  FROM keyed_t t LEFT JOIN keyed_s s USING (lead, Date, k2, k3, k4, k5)),
 added AS (SELECT * FROM keyed_s s WHERE NOT EXISTS (SELECT 1 FROM keyed_t t WHERE t.lead = s.lead
  AND t.Date = s.Date AND t.k2 = s.k2 AND t.k3 = s.k3 AND t.k4 = s.k4 AND t.k5 = s.k5)),
 merged AS (SELECT * FROM matched UNION ALL SELECT """ + FACTS + """, 'inserted' FROM added)
"""


def next_month(df):
    later = F.lit("2026-05-27").cast("date")
    return df.withColumns(
        {
            "Date": F.add_months("Date", 1),
            "Clicks": F.col("Clicks") + 1,
            "Date_Added": later,
            "Date_Modified": later,
        }
    )


@query("d02_upsert", f"{DEDUPED}, {SHIFTED} SELECT {FACTS} FROM merged")
def _(t):
    table = deduped(t)
    return rounded(M.merge(table, next_month(table)))


@query(
    "e09_change_counts",
    f"""{DEDUPED}, {SHIFTED} SELECT count(*) FILTER (WHERE change = 'updated') AS updated,
 count(*) FILTER (WHERE change = 'inserted') AS inserted,
 count(*) FILTER (WHERE change <> 'inserted') AS rows_before, count(*) AS rows_after FROM merged""",
)
def _(t):
    table = deduped(t)
    return M.change_counts(M.merge(table, next_month(table), mark=True))


@query(
    "j01_late_correction",
    f"""{DEDUPED}, {SHIFTED} SELECT Channel, Date_Added, Date_Modified, count(*) AS n,
 sum(Clicks) AS clicks FROM merged GROUP BY 1, 2, 3""",
)
def _(t):
    first = deduped(t)
    table = M.merge(empty_facts(t.spark), first)
    table = M.merge(table, next_month(first))
    return table.groupBy("Channel", "Date_Added", "Date_Modified").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Clicks").alias("clicks")
    )


# Source health ----------------------------------------------------------------------


def faulty(t):
    """Line items as sources by line number; those with unreadable dates are faulty."""
    raw = t.sql(EXPORT)
    day, fault = date_strict(F.col("mixed_day"))
    return raw.select(
        F.concat(F.lit("source "), "line").alias("_source"),
        day.alias("Date"),
        F.col("cc").alias("Country"),
        fault.alias(FAULT),
    )


@query(
    "l01_source_status",
    f"""SELECT 'source ' || CAST(line AS STRING) AS "_source", count(*) AS "rows",
 count(*) FILTER (WHERE mixed_day = 'Total') AS faults,
 CASE WHEN line = 6 THEN 'unreadable date' END AS reason FROM ({EXP}) GROUP BY line""",
)
def _(t):
    return source_status(faulty(t))


@query(
    "l01_gate",
    f"""SELECT 'source ' || CAST(line AS STRING) AS "_source", Country, count(*) AS n
 FROM (SELECT line, cc AS Country FROM ({EXP})) WHERE line <> 6 GROUP BY 1, 2""",
)
def _(t):
    good, _ = gate(faulty(t), [f"source {i}" for i in range(1, 9)])
    return size(good, "_source", "Country")
