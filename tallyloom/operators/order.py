"""Union, presentation order and listing."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.schema import name

AD_ORDER = ("Date", "Country", "Channel", "Campaign")
LEAD_ORDER = ("Date", "Country", "Channel")


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name; repeats stay."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def total_order(
    df: DataFrame, keys: Sequence[str] = AD_ORDER, ties: Sequence[str] | None = None
) -> DataFrame:
    """Sort for presentation, NULLs last.

    The remaining columns break ties: the order is the same on every run, and the
    range partitioner can split a run of equal keys over several tasks.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys]
    return df.orderBy(*[name(c).asc_nulls_last() for c in (*keys, *ties)])


def first_names(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The first `n` distinct values, for a listing."""
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last()).limit(n)
