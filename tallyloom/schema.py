"""The fact schema and the operators that bring a frame into that shape."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FACT_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Country", T.StringType()),
        T.StructField("Channel", T.StringType()),
        T.StructField("Campaign", T.StringType()),
        T.StructField("Creative", T.StringType()),
        T.StructField("Impressions", T.DoubleType()),
        T.StructField("Clicks", T.DoubleType()),
        T.StructField("CTR", T.DoubleType()),
        T.StructField("Spend_AUD", T.DoubleType()),
        T.StructField("QL", T.LongType()),
        T.StructField("FT", T.LongType()),
        T.StructField("Channel_Group", T.StringType()),
        T.StructField("Date_Added", T.DateType()),
        T.StructField("Date_Modified", T.DateType()),
    ]
)
FACT_COLUMNS = FACT_SCHEMA.fieldNames()

# Where a raw row came from: file, sheet and position in it.
ORIGIN = ("_path", "_sheet", "_sheet_no", "_row_no")
# What a harmonised row carries besides the facts: its origin, and why it makes
# the whole source unusable (NULL for a good row).
FAULT = "_fault"

AD_KEY = ("Date", "Country", "Channel", "Campaign", "Creative")
LEAD_KEY = ("Date", "Country", "Channel", "Channel_Group")


class SourceError(Exception):
    """A source cannot be used; the message is the reason to report."""


def name(column: str) -> Column:
    """Column reference that survives dots, blanks and brackets in the name."""
    return F.col("`" + column.replace("`", "``") + "`")


def data_columns(df: DataFrame) -> list[str]:
    """Columns of a raw table without the origin columns."""
    return [c for c in df.columns if c not in ORIGIN]


def conform(df: DataFrame, extras: Sequence[str] = ()) -> DataFrame:
    """Fact columns in order: add the missing as NULL, cast the rest, keep only `extras`."""
    have = set(df.columns)
    facts = [
        (name(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in FACT_SCHEMA
    ]
    return df.select(*facts, *[name(c) for c in extras])


def empty_facts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FACT_SCHEMA)


def run_day(run_date=None) -> Column:
    return F.current_date() if run_date is None else F.lit(run_date).cast("date")


def stamp(df: DataFrame, run_date=None) -> DataFrame:
    """Set both audit dates to the run date."""
    day = run_day(run_date)
    return df.withColumns({"Date_Added": day, "Date_Modified": day})


def warehouse_shape(
    df: DataFrame, run_date=None, extras: Iterable[str] = ()
) -> DataFrame:
    """Typed and stamped fact rows out of loosely typed ones (all-text frames included)."""
    from tallyloom.functions.dates import date_lenient
    from tallyloom.functions.scalars import nan_to_null, to_long, to_num

    if "Spend (AUD)" in df.columns and "Spend_AUD" not in df.columns:
        df = df.withColumnRenamed("Spend (AUD)", "Spend_AUD")
    kinds = {f.name: f.dataType for f in df.schema}
    changes = {}
    for field in FACT_SCHEMA:
        kind = kinds.get(field.name)
        col = name(field.name)
        if kind is None:
            continue
        if isinstance(kind, T.StringType):
            if isinstance(field.dataType, T.DateType):
                changes[field.name] = date_lenient(col)
            elif isinstance(field.dataType, T.DoubleType):
                changes[field.name] = to_num(col)
            elif isinstance(field.dataType, T.LongType):
                changes[field.name] = to_long(col)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            changes[field.name] = nan_to_null(col)
    return conform(stamp(df.withColumns(changes), run_date), list(extras))
