"""Operators on the column list, decided when the plan is built."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.schema import FACT_SCHEMA, FAULT, ORIGIN, SourceError, data_columns, name


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the data columns new names by position; their number must agree."""
    old = data_columns(df)
    if len(old) != len(names):
        raise SourceError(f"expected {len(names)} columns, found {len(old)}")
    kept = [name(c) for c in df.columns if c in ORIGIN]
    return df.select(*[name(o).alias(n) for o, n in zip(old, names)], *kept)


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def fuzzy_target(header: str) -> str | None:
    """Fact column a header stands for, judged by the words in it; first rule wins."""
    low = header.lower()
    if "impression" in low:
        return "Impressions"
    if "click" in low and not ("cost" in low or "cpc" in low):
        return "Clicks"
    if "ctr" in low:
        return "CTR"
    if "cost" in low and "aud" in low.replace(" ", ""):
        return "Spend_AUD"
    if "campaign" in low and "name" in low:
        return "Campaign"
    return None


def fuzzy_rename(df: DataFrame) -> DataFrame:
    """Rename columns by `fuzzy_target`; two columns for one target are refused."""
    targets = {c: t for c in data_columns(df) if (t := fuzzy_target(c))}
    if len(set(targets.values())) < len(targets):
        raise SourceError(f"two columns for one field: {sorted(targets)}")
    return rename(df, targets)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def pick(df: DataFrame, *names: str) -> Column | None:
    """The first of `names` the table has; None if it has none of them."""
    return next((name(n) for n in names if n in df.columns), None)


def need(df: DataFrame, *names: str) -> Column:
    """As `pick`, but a source without any of them fails."""
    col = pick(df, *names)
    if col is None:
        raise SourceError("missing column " + " or ".join(names))
    return col


def or_null(col: Column | None, fn=lambda c: c) -> Column:
    """`fn(col)`, or NULL for an absent column."""
    return F.lit(None) if col is None else fn(col)


def fact_rows(df: DataFrame, **columns: Column | str | None) -> DataFrame:
    """One projection to fact rows: a text is a constant, an absent field NULL.

    Origin columns the input has, and the fault, ride along.
    """
    fault = columns.pop("fault", None)

    def value(v):
        return v if isinstance(v, Column) else F.lit(v)

    unknown = set(columns) - set(FACT_SCHEMA.fieldNames())
    if unknown:
        raise ValueError(f"not fact columns: {sorted(unknown)}")
    return df.select(
        *[value(columns.get(f.name)).cast(f.dataType).alias(f.name) for f in FACT_SCHEMA],
        *[name(c) for c in ORIGIN if c in df.columns],
        value(fault).cast("string").alias(FAULT),
    )
