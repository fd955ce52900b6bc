"""Row-type-aware upsert of one batch of facts into another frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.scalars import is_lead, null_key
from tallyloom.schema import FACT_COLUMNS

# Overwritten in a row that is hit; everything else of the row stays.
REPLACED = (
    "Impressions",
    "Clicks",
    "CTR",
    "Spend_AUD",
    "QL",
    "FT",
    "Channel_Group",
    "Date_Modified",
)
MATCH_KEY = ("_lead", "_date", "_country", "_channel", "_what", "_creative")


def with_match_key(df: DataFrame) -> DataFrame:
    """Add the key both row types are matched on.

    Lead rows match on the channel group, ad rows on campaign and creative; the row
    type is part of the key.  That makes the conditional match a plain equality.
    """
    lead = is_lead(F.col("Impressions"), F.col("Spend_AUD"))
    return df.withColumns(
        {
            "_lead": lead,
            "_date": F.col("Date"),
            "_country": null_key(F.col("Country")),
            "_channel": null_key(F.col("Channel")),
            "_what": null_key(F.when(lead, F.col("Channel_Group")).otherwise(F.col("Campaign"))),
            "_creative": F.when(lead, F.lit("")).otherwise(null_key(F.col("Creative"))),
        }
    )


def _on() -> Column:
    cond = F.lit(True)
    for k in MATCH_KEY:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    return cond


def _unique_source(source: DataFrame, strict: bool) -> DataFrame:
    """One row per match key, with the number of rows that had it.

    A deduplicated batch can still hold NULL and '' variants of one key.  Their
    number travels along, and the update raises if such a key hits a target row.
    """
    merged = source.groupBy(*MATCH_KEY).agg(
        F.count(F.lit(1)).alias("_rivals"),
        F.first(F.struct(*REPLACED)).alias("_new"),
    )
    if strict:
        merged = merged.withColumn("_rivals", _refuse(F.col("_rivals") > 1, F.col("_rivals")))
    return merged


def _refuse(when: Column, value: Column) -> Column:
    return F.when(
        when, F.raise_error(F.lit("several batch rows match one row of the table"))
    ).otherwise(value)


def update_rows(target: DataFrame, source: DataFrame, strict: bool = False) -> DataFrame:
    """The target's rows, with those the batch hits brought up to date; `_hit` marks them.

    Left join: a small batch is broadcast by its measured size and the target is not
    shuffled; for a large one a hot target key is split by the adaptive skew join.
    """
    t = with_match_key(target).alias("t")
    s = _unique_source(with_match_key(source), strict).alias("s")
    hit = F.col("s._rivals").isNotNull()
    checked = _refuse(F.col("s._rivals") > 1, hit)
    return (
        t.join(s, _on(), "left")
        .withColumn("_hit", checked)
        .select(
            *[
                F.when(F.col("_hit"), F.col(f"s._new.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
                if c in REPLACED
                else F.col(f"t.{c}").alias(c)
                for c in FACT_COLUMNS
            ],
            "_hit",
        )
    )


def insert_rows(target: DataFrame, source: DataFrame) -> DataFrame:
    """The batch's rows that hit nothing; a row without a date never hits.

    The target enters only as its distinct keys among those of the batch.
    """
    s = with_match_key(source)
    keys = s.select(*MATCH_KEY).distinct()
    t = with_match_key(target).select(*MATCH_KEY)
    present = t.alias("t").join(keys.alias("s"), _on(), "left_semi").distinct()
    return (
        s.alias("s").join(present.alias("t"), _on(), "left_anti").select(*FACT_COLUMNS)
    )


def mark_updates(target: DataFrame, source: DataFrame, strict: bool = False) -> DataFrame:
    """`update_rows` with column `_change`: 'updated' or 'kept'."""
    change = F.when(F.col("_hit"), F.lit("updated")).otherwise(F.lit("kept"))
    return update_rows(target, source, strict).withColumn("_change", change).drop("_hit")


def merge(
    target: DataFrame, source: DataFrame, strict: bool = False, mark: bool = False
) -> DataFrame:
    """Target after the batch: updated, untouched and inserted rows.

    With `mark`, column `_change` tells 'updated', 'kept' or 'inserted'.
    """
    inserted = insert_rows(target, source).withColumn("_change", F.lit("inserted"))
    out = mark_updates(target, source, strict).unionByName(inserted)
    return out if mark else out.drop("_change")


def change_counts(marked: DataFrame) -> DataFrame:
    """Rows before and after, updated and inserted, of a marked merge."""
    n = lambda kind: F.count_if(F.col("_change") == kind)
    return marked.agg(
        n("updated").alias("updated"),
        n("inserted").alias("inserted"),
        (n("updated") + n("kept")).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    )
