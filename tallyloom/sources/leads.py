"""CRM lead exports: qualified leads and funded accounts, counted and joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import settings as S
from tallyloom.functions.classify import from_affiliate, with_lead_class
from tallyloom.functions.dates import to_day, ts_dayfirst
from tallyloom.functions.scalars import strip
from tallyloom.operators.columns import need
from tallyloom.operators.counts import group_size, join_counts
from tallyloom.operators.predicates import funded, in_region, row_not_blank
from tallyloom.schema import LEAD_KEY, conform
from tallyloom.sources.grids import SHEET, position_of


def _blank_as_null(c):
    text = strip(c)
    return F.when(~text.isin("", "nan"), text)


def lead_rows(raw: DataFrame) -> DataFrame:
    """Country, Created, UTM, Medium, Stage of the region's leads; headers in any case."""
    by_name = {}
    for c in raw.columns:
        by_name.setdefault(c.strip().lower(), c)
    cells = [need(raw, by_name.get(c.lower(), c)) for c in S.LEAD_COLUMNS]
    return _region_leads(raw.select(*[x.alias(c) for x, c in zip(cells, S.LEAD_COLUMNS)]))


def lead_rows_from_grid(grid: DataFrame, heads: DataFrame) -> DataFrame:
    """As `lead_rows`, straight from cells, for files whose columns lie differently.

    `heads` has a row per file with its header; each field is read at its own place.  The rows of a file aren't shuffled by it.
    """
    places = heads.filter(F.col("header_row").isNotNull()).select(
        *SHEET, "header_row", *[position_of(c).alias(c) for c in S.LEAD_COLUMNS]
    )
    rows = grid.filter(row_not_blank("cells")).join(F.broadcast(places), list(SHEET))
    rows = rows.filter(F.col("row_no") > F.col("header_row"))
    return _region_leads(
        rows.select(*[F.get("cells", F.col(f"`{c}`")).alias(c) for c in S.LEAD_COLUMNS])
    )


def _region_leads(df: DataFrame) -> DataFrame:
    """Rows of the region with a readable date; label rows fall out with the region."""
    country, created, utm, medium, stage = (F.col(f"`{c}`") for c in S.LEAD_COLUMNS)
    out = df.select(
        strip(country).alias("Country"),
        ts_dayfirst(strip(created)).alias("Created"),
        _blank_as_null(utm).alias("UTM"),
        _blank_as_null(medium).alias("Medium"),
        strip(stage).alias("Stage"),
    )
    return out.filter(in_region("Country") & F.col("Created").isNotNull())


def classified(leads: DataFrame) -> DataFrame:
    """Leads with day, channel and group; affiliate leads are counted elsewhere."""
    own = leads.filter(~from_affiliate(F.col("UTM"), F.col("Medium")))
    return with_lead_class(own.withColumn("Date", to_day(F.col("Created"))))


def count_leads(ql: DataFrame, ft: DataFrame) -> DataFrame:
    """Both counts per day, country, channel and group."""
    return join_counts(
        group_size(classified(ql), LEAD_KEY, "QL"),
        group_size(classified(ft.filter(funded("Stage"))), LEAD_KEY, "FT"),
    )


def lead_facts(ql: DataFrame, ft: DataFrame) -> DataFrame:
    """Fact rows of the lead counts: the channel stands in for the campaign."""
    return conform(count_leads(ql, ft).withColumn("Campaign", F.col("Channel")))
