"""API responses: nested campaign JSON and flat insight rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.classify import adroll_channel, token_country_or_token
from tallyloom.functions.dates import date_lenient, date_strict
from tallyloom.functions.scalars import field_or, ratio_or_null, to_num
from tallyloom.operators.columns import fact_rows
from tallyloom.operators.predicates import contains_ci, in_region
from tallyloom.schema import conform

CAMPAIGN_RESPONSE = """
    data STRUCT<advertisable: STRUCT<byEID: STRUCT<campaigns: ARRAY<STRUCT<
        eid: STRING, name: STRING, channel: STRING, startDate: STRING, endDate: STRING,
        status: STRING,
        metrics: STRUCT<byDate: ARRAY<STRUCT<
            date: STRING, impressions: DOUBLE, clicks: DOUBLE, cost: DOUBLE,
            conversions: DOUBLE, ctr: DOUBLE, cpa: DOUBLE>>>>>>>>
"""
INSIGHT_ROW = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            "campaign_name",
            "country",
            "date_start",
            "date_stop",
            "reach",
            "impressions",
            "spend",
            "clicks",
        )
    ]
)
CAMPAIGN_EXTRAS = (
    "api_channel",
    "Campaign_Start",
    "Campaign_End",
    "Campaign_Status",
    "Conversions",
    "CPA",
)
INSIGHT_EXTRAS = ("Reach", "Reporting starts", "Reporting ends")


def campaign_days(responses: DataFrame, column: str = "value") -> DataFrame:
    """One row per campaign and day of each response text; missing metrics are 0.

    A campaign without days yields no row.
    """
    doc = F.from_json(column, CAMPAIGN_RESPONSE)
    campaigns = responses.select(
        F.explode(field_or(doc, "data.advertisable.byEID.campaigns")).alias("c")
    )
    days = campaigns.select("c", F.explode("c.metrics.byDate").alias("d"))
    c, d = F.col("c"), F.col("d")
    return days.select(
        field_or(d, "date").alias("Date"),
        field_or(c, "name").alias("Campaign"),
        field_or(c, "channel").alias("api_channel"),
        field_or(c, "startDate").alias("Campaign_Start"),
        field_or(c, "endDate").alias("Campaign_End"),
        field_or(c, "status").alias("Campaign_Status"),
        field_or(d, "impressions", 0.0).alias("Impressions"),
        field_or(d, "clicks", 0.0).alias("Clicks"),
        field_or(d, "ctr").alias("CTR"),
        field_or(d, "conversions", 0.0).alias("Conversions"),
        field_or(d, "cost", 0.0).alias("Spend_AUD"),
        field_or(d, "cpa").alias("CPA"),
    )


def adroll_api(responses: DataFrame, column: str = "value", extras: bool = False) -> DataFrame:
    """Fact rows of the region's campaigns; `extras` keeps the diagnostic columns."""
    days = campaign_days(responses, column).filter(contains_ci("Campaign", "apac"))
    channel = adroll_channel(F.col("Campaign"))
    out = days.withColumns(
        {
            "Date": date_lenient(F.col("Date")),
            "Country": token_country_or_token(F.col("Campaign")),
            "Channel": channel,
            "Channel_Group": F.when(channel.contains("AdRoll"), F.lit("AdRoll")).otherwise(
                F.lit("Others")
            ),
        }
    )
    return conform(out, CAMPAIGN_EXTRAS if extras else ())


def read_insights(spark: SparkSession, paths) -> DataFrame:
    return spark.read.schema(INSIGHT_ROW).json(paths)


def insight_rows(rows: DataFrame) -> DataFrame:
    """Records with every key: missing texts are '', missing numbers '0'."""
    zero = ("reach", "impressions", "spend", "clicks")
    return rows.select(
        *[
            F.coalesce(F.col(f.name), F.lit("0" if f.name in zero else "")).alias(f.name)
            for f in INSIGHT_ROW
        ]
    )


def meta_api(rows: DataFrame, extras: bool = False) -> DataFrame:
    """Fact rows of the region's insights; `extras` keeps the diagnostic columns."""
    df = insight_rows(rows).filter(in_region("country", "upper"))
    clicks, shown = to_num(F.col("clicks")), to_num(F.col("impressions"))
    day, fault = date_strict(F.col("date_start"))
    facts = {
        "Date": day,
        "Country": F.upper("country"),
        "Channel": F.lit("Meta"),
        "Campaign": F.col("campaign_name"),
        "Impressions": shown,
        "Clicks": clicks,
        "CTR": ratio_or_null(clicks, shown),
        "Spend_AUD": to_num(F.col("spend")),
        "Channel_Group": F.lit("Meta"),
    }
    if not extras:
        return fact_rows(df, **facts, fault=fault)
    kept = {
        "Reach": to_num(F.col("reach")),
        "Reporting starts": F.col("date_start"),
        "Reporting ends": F.col("date_stop"),
    }
    flat = df.select(*[v.alias(k) for k, v in {**facts, **kept}.items()])
    return conform(flat, INSIGHT_EXTRAS)
