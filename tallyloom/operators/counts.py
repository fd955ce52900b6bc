"""Lead counting and joins, and the summaries over the fact table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.schema import LEAD_KEY, name


def group_size(df: DataFrame, keys: Sequence[str] = LEAD_KEY, out: str = "n") -> DataFrame:
    """Rows per key; a row with a NULL key part is not counted."""
    # One test per key: those on keys that cannot be NULL are optimised away.
    known = reduce(lambda d, k: d.filter(name(k).isNotNull()), keys, df)
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def join_counts(ql: DataFrame, ft: DataFrame, keys: Sequence[str] = LEAD_KEY) -> DataFrame:
    """Full outer join of the two count tables, a missing count being 0."""
    return (
        ql.join(ft, list(keys), "full_outer")
        .fillna(0, ["QL", "FT"])
        .select(*keys, F.col("QL").cast("bigint"), F.col("FT").cast("bigint"))
    )


def blend(
    ads: DataFrame,
    leads: DataFrame,
    keys: Sequence[str] = ("Date", "Country"),
    how: str = "full_outer",
) -> DataFrame:
    """Performance next to leads.  Each side is summed first, so nothing counts twice."""
    spend = ads.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("Impressions", "Clicks", "Spend_AUD")]
    )
    counts = leads.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("QL", "FT")])
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"a.{k}") == F.col(f"l.{k}"))
    return spend.alias("a").join(counts.alias("l"), cond, how).select(
        *[F.coalesce(F.col(f"a.{k}"), F.col(f"l.{k}")).alias(k) for k in keys],
        "Impressions",
        "Clicks",
        "Spend_AUD",
        "QL",
        "FT",
    )


def _totals() -> list[Column]:
    return [
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c.lower()}") for c in ("QL", "FT")],
        F.count(F.lit(1)).alias("total_rows"),
    ]


def _kinds() -> list[Column]:
    # Row kind of the run summary: an ad row has neither lead count.
    plain = F.col("QL").isNull() & F.col("FT").isNull()
    return [F.count_if(plain).alias("ad_rows"), F.count_if(~plain).alias("lead_rows")]


def grand_totals(df: DataFrame) -> DataFrame:
    return df.agg(*_totals())


def kind_counts(df: DataFrame) -> DataFrame:
    return df.agg(*_kinds())


def run_summary(df: DataFrame) -> DataFrame:
    """Totals and row kinds in one pass."""
    return df.agg(*_totals(), *_kinds())


def channel_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("Channel").agg(
        F.count("Date").alias("Rows"),
        *[
            F.coalesce(F.sum(c), F.lit(0).cast("double")).alias(out)
            for c, out in (
                ("Spend_AUD", "Spend"),
                ("Clicks", "Clicks"),
                ("Impressions", "Impressions"),
            )
        ],
    )


METRICS = ("Spend_AUD", "Clicks", "Impressions")


def partial_profile(df: DataFrame, *by: str) -> DataFrame:
    """Sums per country, channel and campaign, which can be added up further."""
    return df.groupBy(*by, "Country", "Channel", "Campaign").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("Date").alias("dated"),
        F.min("Date").alias("lo"),
        F.max("Date").alias("hi"),
        *[F.sum(c).alias(c) for c in METRICS],
    )


def profile_of_parts(parts: DataFrame) -> DataFrame:
    """One row out of partial profiles."""
    return parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.min("lo").alias("first_date"),
        F.max("hi").alias("last_date"),
        *[
            F.count_distinct(c).alias(out)
            for c, out in (
                ("Country", "countries"),
                ("Channel", "channels"),
                ("Campaign", "campaigns"),
            )
        ],
        *[
            F.coalesce(F.sum(c), F.lit(0).cast("double")).alias(f"total_{c.lower()}")
            for c in METRICS
        ],
    )


def profile(df: DataFrame) -> DataFrame:
    """One row describing a fact frame.

    Rows are first combined per country, channel and campaign, so the distinct
    counts expand that much smaller table and not the facts themselves.
    """
    return profile_of_parts(partial_profile(df))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The values of a column that occur, one per row and sorted, NULL left out."""
    return df.select(column).dropna().distinct().orderBy(column)


def flag_any(df: DataFrame, p: Column, by: str, out: str) -> DataFrame:
    """Add to every row whether `p` holds for any row of its group (a file, say).

    One small row per group where it holds is joined back; adaptive execution measures it
    and decides whether to broadcast it.
    """
    marked = df.filter(p).select(by).dropna().distinct().withColumn(out, F.lit(True))
    return df.join(marked, by, "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def seen_per_source(df: DataFrame, by: str = "_source") -> DataFrame:
    """Row count and all countries met, per source.

    Rows are counted per source and country first, so a large source is no hot group.
    """
    counts = df.groupBy(by, "Country").agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(by).agg(
        F.sum("_n").alias("rows"), F.sort_array(F.collect_list("Country")).alias("countries")
    )
