"""Collapse rows with the same key, each row type by its own key.

Sums and firsts are both partial aggregates: a key that holds a large share of
all rows shrinks to one row per task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalars import is_lead, ratio_or_null
from tallyloom.operators.predicates import split_rows
from tallyloom.schema import AD_KEY, FACT_COLUMNS, LEAD_KEY, conform, name


def sum0(c: Column) -> Column:
    """Sum that is 0, not NULL, when there is nothing to add."""
    total = F.sum(c)
    return F.coalesce(total, F.lit(0).cast("double"))


def first_known(c: Column, order: Column) -> Column:
    """The first value in `order` that is not NULL."""
    return F.min_by(c, F.when(c.isNotNull(), order))


def _ordering(order: Sequence[str]) -> Column:
    return name(order[0]) if len(order) == 1 else F.struct(*[name(o) for o in order])


def dedup_ads(
    ads: DataFrame,
    order: Sequence[str],
    ctr_mode: str = "first",
    lead_agg: str = "first",
    group_from_channel: bool = False,
) -> DataFrame:
    """One row per ad key (NULL key parts kept): metrics summed, the rest first known.

    order     columns that put rows in file order; a single number is far cheaper than
              several columns, as every aggregate then has a fixed width and is hashed
    ctr_mode  'first', or 'ratio' to recompute it from the summed metrics
    lead_agg  'first', or 'sum' so that several commission lines keep their counts
    group_from_channel  True if the channel alone decides the channel group, as it does
              in rows from the source readers: it may then stand among the keys
    """
    at = _ordering(order)
    leads = (lambda c: F.sum(c)) if lead_agg == "sum" else (lambda c: first_known(c, at))
    keys = [*AD_KEY, "Channel_Group"] if group_from_channel else list(AD_KEY)
    rest = [c for c in ("Channel_Group", "Date_Added", "Date_Modified") if c not in keys]
    out = ads.groupBy(*keys).agg(
        sum0(F.col("Impressions")).alias("Impressions"),
        sum0(F.col("Clicks")).alias("Clicks"),
        sum0(F.col("Spend_AUD")).alias("Spend_AUD"),
        first_known(F.col("CTR"), at).alias("CTR"),
        leads(F.col("QL")).alias("QL"),
        leads(F.col("FT")).alias("FT"),
        *[first_known(F.col(c), at).alias(c) for c in rest],
    )
    if ctr_mode == "ratio":
        out = out.withColumn("CTR", ratio_or_null(F.col("Clicks"), F.col("Impressions")))
    return out.select(*FACT_COLUMNS)


def dedup_leads(leads: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per lead key (NULL key parts kept): counts summed, the rest first known."""
    at = _ordering(order)
    firsts = ("Campaign", "Creative", "Clicks", "CTR", "Date_Added", "Date_Modified")
    out = leads.groupBy(*LEAD_KEY).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("QL", "FT")],
        *[first_known(F.col(c), at).alias(c) for c in firsts],
    )
    return conform(out)  # impressions and spend are NULL on every lead row


def dedup(
    df: DataFrame,
    order: Sequence[str],
    lead_order: Sequence[str] | None = None,
    **ad_options,
) -> DataFrame:
    """Split by row type, collapse each with its key, put them together again."""
    leads, ads = split_rows(df, is_lead(F.col("Impressions"), F.col("Spend_AUD")))
    return dedup_ads(ads, order, **ad_options).unionByName(
        dedup_leads(leads, lead_order or order)
    )
