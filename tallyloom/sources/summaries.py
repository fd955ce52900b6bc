"""Summaries of the fact table kept per change: only what a change wrote is ever counted.

    <table>/summaries/change=<id>/   one row per month, country, channel and campaign

A change's months never alter, so its partial sums are computed once, when first asked for.
A version's summary adds up those of the changes that hold its months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.counts import METRICS, partial_profile, profile_of_parts
from tallyloom.sources.storage import exists, move_folder, remove
from tallyloom.sources.tables import read_change
from tallyloom.sources.versions import new_change, version


def _folder(path: str, change: str) -> str:
    return f"{path.rstrip('/')}/summaries/change={change}"


def _kept(spark: SparkSession, path: str, change: str) -> str:
    """Folder of a change's partial sums, computed if they aren't there yet."""
    folder = _folder(path, change)
    if not exists(spark, folder):
        waiting = f"{path.rstrip('/')}/summaries/.{new_change()}"  # same file system: moved by a rename
        rows = read_change(spark, path, change)
        partial_profile(rows, "ym").write.parquet(waiting)
        if not move_folder(spark, waiting, folder):
            remove(spark, waiting)  # another reader was first; both are the same
    return folder


def partial_sums(spark: SparkSession, path: str, at: int | None = None) -> DataFrame:
    """(ym, Country, Channel, Campaign, n, dated, lo, hi, sums) of a version, from kept summaries."""
    found = version(spark, path, at)
    if found is None:
        raise FileNotFoundError(f"no table in {path}")
    if not found.months:
        return partial_profile(read_change(spark, path, None), "ym")
    folders = [_kept(spark, path, c) for c in sorted(set(found.months.values()))]
    rows = spark.read.option("basePath", f"{path.rstrip('/')}/summaries").parquet(*folders)
    held = F.create_map(*[F.lit(x) for m, c in found.months.items() for x in (m, c)])
    # A later change may hold some of the months of an earlier one.
    return rows.filter(held[F.col("ym")] == F.col("change")).drop("change")


def table_channels(spark: SparkSession, path: str, at: int | None = None) -> DataFrame:
    """As `channel_summary` of the table's rows."""
    return partial_sums(spark, path, at).groupBy("Channel").agg(
        F.sum("dated").alias("Rows"),
        *[
            F.coalesce(F.sum(c), F.lit(0).cast("double")).alias(out)
            for c, out in zip(METRICS, ("Spend", "Clicks", "Impressions"), strict=True)
        ],
    )


def table_profile(spark: SparkSession, path: str, at: int | None = None) -> DataFrame:
    """As `profile` of the table's rows."""
    return profile_of_parts(partial_sums(spark, path, at))
