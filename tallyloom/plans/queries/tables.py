"""The fact table on disk, whole runs, the stream, and the files written and read back."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from tallyloom import settings as S
from tallyloom.operators.counts import channel_summary
from tallyloom.operators.order import total_order, union_all
from tallyloom.plans.api_combine import combine
from tallyloom.plans.batch import deduplicated, parse_all
from tallyloom.plans.queries.base import (
    AD_FACTS,
    APAC_SQL,
    EXPORT,
    LEAD_FACTS,
    LEAD_RAW,
    OPTIONS,
    RUN_DATE,
    ad_facts,
    plain,
    query,
    rounded,
    sql_num,
)
from tallyloom.plans.queries.frames import DEDUPED, FACTS, SHIFTED, deduped, next_month
from tallyloom.plans.queries.reading import csv_line, write_exports
from tallyloom.plans.queries.sources import DAYS_SQL, INSIGHTS_SQL, LAND, RESPONSES, insights
from tallyloom.sources.api import read_insights
from tallyloom.sources.grids import GRID_SCHEMA, land_grid, scan_grid
from tallyloom.sources.storage import scratch
from tallyloom.sources.summaries import table_channels, table_profile
from tallyloom.sources.tables import (
    ensure_table,
    initial_load,
    read_facts,
    read_changes,
    read_days,
    read_last_days,
    read_table,
    replace_table,
    upsert,
)
from tallyloom.streaming.intake import intake, watch

EXP = plain(EXPORT)
PER_MONTH = """SELECT strftime(Date, '%Y-%m') AS ym, count(*) AS n, sum(Clicks) AS clicks
 FROM ({}) GROUP BY 1"""


def per_month(df):
    return df.groupBy("ym").agg(F.count(F.lit(1)).alias("n"), F.sum("Clicks").alias("clicks"))


@query("a08_ensure_table", PER_MONTH.format(AD_FACTS))
def _(t):
    path = scratch(t.spark, "table")
    assert not ensure_table(t.spark, path)
    replace_table(t.spark, path, ad_facts(t))
    assert ensure_table(t.spark, path)
    return per_month(read_table(t.spark, path))


@query("a09_staging_load", PER_MONTH.format(f"{DEDUPED} SELECT * FROM deduped"))
def _(t):
    path = scratch(t.spark, "staging")
    replace_table(t.spark, path, ad_facts(t))
    replace_table(t.spark, path, deduped(t))  # replaces what was there
    return per_month(read_table(t.spark, path))


@query(
    "a10_initial_load",
    f"""SELECT Channel, Date_Added, count(*) AS n, sum(Clicks) AS clicks, round(sum(Spend_AUD), 2) AS spend,
 CAST(sum(QL) AS BIGINT) AS ql FROM ({AD_FACTS}) GROUP BY 1, 2""",
)
def _(t):
    path = scratch(t.spark, "table")
    facts = ad_facts(t).withColumn("Spend (AUD)", F.col("Spend_AUD").cast("decimal(18,2)"))
    text = facts.select(
        *[F.col(f"`{c}`").cast("string").alias(c) for c in facts.columns if c != "Spend_AUD"]
    )
    initial_load(t.spark, path, text, RUN_DATE)
    return (
        read_facts(t.spark, path)
        .groupBy("Channel", "Date_Added")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("Clicks").alias("clicks"),
            F.round(F.sum("Spend_AUD"), 2).alias("spend"),
            F.sum("QL").alias("ql"),
        )
    )


@query(
    "a07_insight_json",
    f"""SELECT Country, count(*) AS n, count(*) FILTER (WHERE event_id % 4 = 0) AS no_impressions,
 sum(event_id % 10) AS clicks FROM ({INSIGHTS_SQL}) GROUP BY 1""",
)
def _(t):
    folder = scratch(t.spark, "responses")
    insights(t).write.json(folder)
    rows = read_insights(t.spark, folder)
    return rows.groupBy(F.initcap("country").alias("c"), F.upper("country").alias("u")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("impressions").isNull()).alias("no_impressions"),
        F.sum(F.col("clicks").cast("bigint")).alias("clicks"),
    ).select(
        F.when(F.col("c") == "Total", "Total").otherwise(F.col("u")).alias("Country"),
        "n",
        "no_impressions",
        "clicks",
    )


@query(
    "a12_raw_json_landing",
    f"SELECT count(*) / 2 AS responses, sum(CASE WHEN k = 1 THEN q * 100 END) AS shown FROM ({DAYS_SQL})",
)
def _(t):
    from tallyloom.sources.api import campaign_days

    folder = scratch(t.spark, "responses")
    # one response document per line, as received; a compressed file has one reader, so none is large
    t.sql(RESPONSES).write.option("maxRecordsPerFile", 1 << 18).text(folder, compression="gzip")
    kept = t.spark.read.text(folder)
    days = campaign_days(kept)
    return days.agg(
        (F.count(F.lit(1)) / 2).alias("responses"), F.sum("Impressions").alias("shown")
    )


@query("a13_report_file", f"{DEDUPED} SELECT {FACTS} FROM deduped")
def _(t):
    folder = scratch(t.spark, "report")
    total_order(deduped(t)).write.option("header", True).csv(folder)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in deduped(t).schema)
    return rounded(t.spark.read.option("header", True).schema(kinds).csv(folder))


@query("d02_upsert_table", f"{DEDUPED}, {SHIFTED} SELECT {FACTS} FROM merged")
def _(t):
    path = scratch(t.spark, "table")
    upsert(t.spark, path, deduped(t))
    # The batch is staged before the table changes, so it may be read from the table.
    upsert(t.spark, path, next_month(read_facts(t.spark, path)))
    return rounded(read_facts(t.spark, path))


@query(
    "d02_two_versions",
    f"""{DEDUPED}, {SHIFTED} SELECT 1 AS version, strftime(Date, '%Y-%m') AS ym, count(*) AS n, sum(Clicks) AS clicks
 FROM deduped GROUP BY ALL UNION ALL
 SELECT 2, strftime(Date, '%Y-%m'), count(*), sum(Clicks) FROM merged GROUP BY ALL""",
)
def _(t):
    """A version opened before a change reads the same after it, and can be opened again."""
    path = scratch(t.spark, "table")
    upsert(t.spark, path, deduped(t))
    before = read_table(t.spark, path)
    upsert(t.spark, path, next_month(read_facts(t.spark, path)))
    held, again = (per_month(df) for df in (before, read_table(t.spark, path, 1)))
    both = held.intersectAll(again).withColumn("version", F.lit(1))
    return both.unionByName(per_month(read_table(t.spark, path)).withColumn("version", F.lit(2)))


@query(
    "d02_change_feed",
    f"""{DEDUPED}, {SHIFTED} SELECT strftime(Date, '%Y-%m') AS ym, change, count(*) AS n, sum(Clicks) AS clicks
 FROM merged WHERE change <> 'kept' GROUP BY ALL""",
)
def _(t):
    path = scratch(t.spark, "table")
    upsert(t.spark, path, deduped(t))
    upsert(t.spark, path, next_month(read_facts(t.spark, path)))
    changed = read_changes(t.spark, path).withColumn("ym", F.date_format("Date", "yyyy-MM"))
    return changed.groupBy("ym", F.col("_change").alias("change")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("Clicks").alias("clicks")
    )


@query(
    "e05_kept_summary",
    f"""{DEDUPED}, {SHIFTED} SELECT version, Channel, count(Date) AS "Rows", round(coalesce(sum(Spend_AUD), 0), 2) AS Spend,
 coalesce(sum(Clicks), 0) AS Clicks, coalesce(sum(Impressions), 0) AS Impressions
 FROM (SELECT 1 AS version, Date, Channel, Spend_AUD, Clicks, Impressions FROM deduped
  UNION ALL SELECT 2, Date, Channel, Spend_AUD, Clicks, Impressions FROM merged) GROUP BY 1, 2""",
)
def _(t):
    """Channels of two versions, added up from the sums kept for each change."""
    path = scratch(t.spark, "table")
    upsert(t.spark, path, deduped(t))
    upsert(t.spark, path, next_month(read_facts(t.spark, path)))
    return rounded(
        union_all(table_channels(t.spark, path, v).withColumn("version", F.lit(v)) for v in (1, 2))
    )


@query(
    "e07_kept_profile",
    f"""{DEDUPED}, {SHIFTED} SELECT count(*) AS total_rows, min(Date) AS first_date, max(Date) AS last_date,
 count(DISTINCT Country) AS countries, count(DISTINCT Channel) AS channels, count(DISTINCT Campaign) AS campaigns,
 round(sum(Spend_AUD), 2) AS total_spend_aud, sum(Clicks) AS total_clicks, sum(Impressions) AS total_impressions FROM merged""",
)
def _(t):
    path = scratch(t.spark, "table")
    upsert(t.spark, path, deduped(t))
    table_profile(t.spark, path)
    upsert(t.spark, path, next_month(read_facts(t.spark, path)))
    return table_profile(t.spark, path).withColumn("total_spend_aud", F.round("total_spend_aud", 2))


@query("d02_two_writers", f"{DEDUPED}, {SHIFTED} SELECT {FACTS} FROM merged")
def _(t):
    """Two batches merged at the same time into the same months."""
    path = scratch(t.spark, "table")
    upsert(t.spark, path, deduped(t))
    batch = next_month(read_facts(t.spark, path))
    bing = F.col("Channel").startswith("Bing")
    with ThreadPoolExecutor(2) as pool:
        for done in [pool.submit(upsert, t.spark, path, batch.filter(p)) for p in (bing, ~bing)]:
            done.result()
    return rounded(read_facts(t.spark, path))


@query(
    "c14_days_of_table",
    f"""{DEDUPED} SELECT 'range' AS what, Date, Channel, count(*) AS n FROM deduped
 WHERE Date BETWEEN DATE '1995-02-01' AND DATE '1996-03-31' GROUP BY ALL UNION ALL
 SELECT 'look-back', Date, Channel, count(*) FROM deduped
 WHERE Date BETWEEN DATE '1996-02-27' AND DATE '1996-03-04' GROUP BY ALL""",
)
def _(t):
    """Days of the table: only the folders of their months are read."""
    path = scratch(t.spark, "table")
    replace_table(t.spark, path, deduped(t))
    parts = {
        "range": read_days(t.spark, path, "1995-02-01", "1996-03-31"),
        "look-back": read_last_days(t.spark, path, 7, "1996-03-05"),
    }
    return union_all(
        df.groupBy("Date", "Channel").agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "*")
        for what, df in parts.items()
    )


@query(
    "entry_api_combine",
    f"""SELECT Channel, count(Date) AS "Rows", round(sum(s), 2) AS Spend, sum(c) AS Clicks,
 sum(i) AS Impressions FROM (
  SELECT CASE line WHEN 1 THEN 'AdRoll - Retargeting' WHEN 2 THEN 'AdRoll - Lookalike'
   ELSE 'AdRoll - Contextual' END AS Channel, Date, CASE WHEN k = 1 THEN paid ELSE 0 END::DOUBLE AS s,
   CASE WHEN k = 1 THEN q ELSE 3 END AS c, CASE WHEN k = 1 THEN q * 100 ELSE 0 END AS i
  FROM ({DAYS_SQL}) WHERE line IN (1, 2, 3)
  UNION ALL SELECT 'Meta', day, spend::DOUBLE, event_id % 10,
   CASE WHEN event_id % 4 <> 0 THEN event_id % 100 ELSE 0 END
  FROM ({INSIGHTS_SQL}) WHERE Country IN {APAC_SQL}) GROUP BY 1""",
)
def _(t):
    return rounded(channel_summary(combine(t.sql(RESPONSES), insights(t), run_date=RUN_DATE)))


# A drop folder made of every line item and event: two ad exports, one with an
# unreadable date, and the two lead exports.
RUN_HEADERS = {
    "Bing_010426": ["Campaign name", "id", "type", "Day", "Impr.", "Clicks", "CTR", "Spend"],
    "Tiktok_010426": ["Date", "Country", "Campaign name", "Impressions", "Clicks (all)", "Cost (AUD)"],
    "Douyin_010426": ["Date", "Campaign Name", "Targeting approach", "Creative Type", "Video Play"],
    "QL_010426": ["Billing Country", "Created Date", "Google UTM Source", "Google UTM Medium", "Stage"],
    "FT_010426": ["Billing Country", "Created Date", "Google UTM Source", "Google UTM Medium", "Stage"],
}
RUN_CELLS = {
    "Bing_010426": "camp, clk, brand, iso, imp, clk, rate, amount",
    "Tiktok_010426": "iso, loose_cc, camp, imp, clk, amount",
    "Douyin_010426": "mixed_day, camp, brand, flag, imp",
}
LEAD_CELLS = "Country, date_format(Created, 'd/M/yyyy H:mm'), UTM, Medium, Stage"


def landed(t):
    """That folder's grids, landed split by source and scanned back."""
    folder = scratch(t.spark, "landing")
    land_grid(drop(t), folder)
    return scan_grid(t.spark, folder)


def drop(t):
    """The grids of that folder."""
    lines = t.sql(EXPORT)
    events = t.sql(LEAD_RAW)
    place = lambda name: [
        F.lit(name).alias("source"),
        F.lit(f"/drop/{name}.xlsx").alias("path"),
        F.lit("Daily").alias("sheet"),
        F.lit(1).alias("sheet_no"),
    ]
    frames = []
    for name, cells in RUN_CELLS.items():
        frames.append(
            lines.select(
                *place(name), F.col("rn").alias("row_no"), F.expr(f"array({cells})").alias("cells")
            )
        )
    for name in ("QL_010426", "FT_010426"):
        mine = events.filter(F.col("feed") == name[:2].lower())
        frames.append(
            mine.select(
                *place(name),
                (F.col("event_id") + 10).alias("row_no"),
                F.expr(f"array({LEAD_CELLS})").alias("cells"),
            )
        )
    tops = [
        t.spark.range(1).select(
            *place(name),
            F.lit(0).cast("bigint").alias("row_no"),
            F.array(*[F.lit(h) for h in header]).alias("cells"),
        )
        for name, header in RUN_HEADERS.items()
    ]
    return union_all([*frames, *tops])


IMP, CLK, AMT = (sql_num(c) for c in ("imp", "clk", "amount"))
RUN_FACTS = f"""
SELECT CAST(iso AS DATE) AS Date, substr(camp, 1, 2) AS Country,
 CASE WHEN contains(camp, '[Pmax]') THEN 'Bing - PMax' WHEN contains(camp, 'Brand')
  THEN 'Bing - Brand' ELSE 'Bing - Category' END AS Channel, camp AS Campaign,
 NULL AS Creative, {IMP} AS i, {CLK} AS c, {AMT} AS s, NULL AS QL, NULL AS FT
FROM ({EXP}) WHERE camp IS NOT NULL AND NOT starts_with(camp, '©') AND camp <> 'Total'
 AND regexp_extract(camp, '^(HK|TH|TW|VN|MY|SG|CN|IN|ID|PH|MN)', 1) <> ''
UNION ALL
SELECT CAST(iso AS DATE), upper(trim(loose_cc)), 'TikTok', camp, NULL, {IMP}, {CLK}, {AMT}, NULL, NULL
FROM ({EXP}) WHERE upper(trim(loose_cc)) IN {APAC_SQL} AND camp IS NOT NULL AND trim(camp) <> ''
UNION ALL
SELECT Date, Country, Channel, Campaign, NULL, NULL, NULL, NULL, QL, FT FROM ({LEAD_FACTS})
"""


@query(
    "s00_parse_all",
    f"""SELECT Date, Country, Channel, Campaign, count(*) AS n, sum(i) AS shown, sum(c) AS clicks,
 round(sum(s), 2) AS spend, CAST(sum(QL) AS BIGINT) AS ql, CAST(sum(FT) AS BIGINT) AS ft
 FROM ({RUN_FACTS}) GROUP BY 1, 2, 3, 4""",
)
def _(t):
    parsed = parse_all(landed(t), OPTIONS)
    assert ("Douyin", "unreadable date") in parsed.failed
    return by_campaign(parsed.facts)


def by_campaign(facts):
    return facts.groupBy("Date", "Country", "Channel", "Campaign").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("Impressions").alias("shown"),
        F.sum("Clicks").alias("clicks"),
        F.round(F.sum("Spend_AUD"), 2).alias("spend"),
        F.sum("QL").alias("ql"),
        F.sum("FT").alias("ft"),
    )


@query(
    "s00_mixed_formats",
    f"""SELECT Date, Country, Channel, Campaign, count(*) AS n, sum(i) AS shown, sum(c) AS clicks,
 round(sum(s), 2) AS spend, CAST(sum(QL) AS BIGINT) AS ql, CAST(sum(FT) AS BIGINT) AS ft
 FROM (SELECT * FROM ({RUN_FACTS}) UNION ALL
  SELECT CAST(iso AS DATE), {LAND}, 'Apple Search Ads', brand || chr(10) || 'core', NULL, {IMP}, {CLK}, {AMT}, NULL, NULL
  FROM ({EXP}) WHERE {LAND} IS NOT NULL) GROUP BY 1, 2, 3, 4""",
)
def _(t):
    """A delimited export dropped beside the landed grids: the run finds and reads it itself."""
    folder = scratch(t.spark, "drop")
    preamble = [f"report line {i}" for i in range(S.PREAMBLE_ROWS)]
    preamble.append("Day,Campaign Name,Country or Region,CR (Tap-Through),Spend,Impressions,Taps")
    lines = t.sql(EXPORT).withColumns({"name": F.concat("brand", F.lit("\ncore")), "cr": F.lit("14%")})
    cells = csv_line("iso", "name", "land", "cr", "amount", "imp", "clk")
    write_exports(lines.select(cells), preamble, f"{folder}/Apple_010426.csv")
    return by_campaign(parse_all(landed(t), OPTIONS, drop=folder).facts)


# After deduplication by the key of the row's type: lead rows are those without both
# impressions and spend.
RUN_DEDUPED = f"""
SELECT Date, Country, Channel, Campaign, coalesce(sum(i), 0) AS shown, coalesce(sum(c), 0) AS clicks,
 round(coalesce(sum(s), 0), 2) AS spend, NULL::BIGINT AS ql, NULL::BIGINT AS ft
FROM ({RUN_FACTS}) WHERE NOT (i IS NULL AND s IS NULL) GROUP BY 1, 2, 3, 4
UNION ALL
SELECT Date, Country, Channel, min(Campaign), NULL, NULL, NULL, CAST(coalesce(sum(QL), 0) AS BIGINT),
 CAST(coalesce(sum(FT), 0) AS BIGINT)
FROM (SELECT *, CASE WHEN Channel LIKE 'Bing%' THEN 'Bing' WHEN Channel = 'TikTok' THEN 'TikTok' END AS g
 FROM ({RUN_FACTS}) WHERE i IS NULL AND s IS NULL AND QL IS NULL) GROUP BY Date, Country, Channel, g
UNION ALL
SELECT Date, Country, Channel, Campaign, NULL, NULL, NULL, QL, FT FROM ({RUN_FACTS}) WHERE QL IS NOT NULL
"""


def outline(facts):
    lead = F.col("Impressions").isNull() & F.col("Spend_AUD").isNull()
    return facts.select(
        "Date",
        "Country",
        "Channel",
        "Campaign",
        F.col("Impressions").alias("shown"),
        F.when(~lead, F.col("Clicks")).alias("clicks"),
        F.round("Spend_AUD", 2).alias("spend"),
        F.col("QL").alias("ql"),
        F.col("FT").alias("ft"),
    )


@query("run_deduplicated", RUN_DEDUPED)
def _(t):
    return outline(deduplicated(parse_all(landed(t), OPTIONS).facts, RUN_DATE))


@query("j02_file_drop_stream", RUN_DEDUPED)
def _(t):
    root = scratch(t.spark, "stream")
    drop(t).write.parquet(f"{root}/drop")
    stream = intake(
        t.spark, f"{root}/drop", f"{root}/table", f"{root}/checkpoint", options=OPTIONS
    )
    stream.awaitTermination()
    return outline(read_facts(t.spark, f"{root}/table"))


@query(
    "a11_archive_inputs",
    f"""SELECT kind, country, count(*) AS n, moved FROM (
  SELECT 'lines' AS kind, cc AS country, true AS moved FROM ({EXP})
  UNION ALL SELECT 'events', Country, false FROM ({plain(LEAD_RAW)})) GROUP BY 1, 2, 4""",
)
def _(t):
    """Two drops read one after the other: reading the second moves the first away."""
    root = scratch(t.spark, "archive")
    drop, archive = f"{root}/drop", f"{root}/archive"
    batches = {"lines": t.sql(EXPORT).withColumn("c", F.col("cc"))}
    batches["events"] = t.sql(LEAD_RAW).withColumn("c", F.col("Country"))
    for kind, rows in batches.items():
        rows.select(
            F.lit(kind).alias("source"),
            F.lit(f"/{kind}.xlsx").alias("path"),
            F.lit("s").alias("sheet"),
            F.lit(1).alias("sheet_no"),
            F.lit(0).cast("bigint").alias("row_no"),
            F.array("c").alias("cells"),
        ).write.mode("append").parquet(drop)
        stream = (
            watch(t.spark, drop, archive)
            .writeStream.format("noop")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        stream.awaitTermination()
    read = t.spark.read.schema(GRID_SCHEMA).option("recursiveFileLookup", True)
    both = union_all(
        read.parquet(folder).withColumn("moved", F.lit(folder == archive))
        for folder in (archive, drop)
    )
    return both.groupBy(
        F.col("source").alias("kind"), F.get("cells", F.lit(0)).alias("country"), "moved"
    ).agg(F.count(F.lit(1)).alias("n"))
