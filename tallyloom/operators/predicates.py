"""Row filters, as column predicates that are never NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import settings as S
from tallyloom.functions.dates import date_lenient
from tallyloom.functions.scalars import code, strip
from tallyloom.schema import name


def _is(p: Column) -> Column:
    return F.coalesce(p, F.lit(False))


def not_null(c: str) -> Column:
    return name(c).isNotNull()


def not_blank(c: str) -> Column:
    """Something other than white space; a missing cell passes (pair with `not_null`)."""
    return ~strip(name(c)).eqNullSafe(F.lit(""))


def not_footer(c: str, labels: Iterable[str], prefix: str | None = None) -> Column:
    """Not one of the total labels, nor a line starting with `prefix`; NULL passes."""
    col = name(c)
    keep = F.lit(True)
    for label in labels:
        keep = keep & ~col.eqNullSafe(F.lit(label))
    return keep if prefix is None else keep & ~_is(col.startswith(prefix))


def in_region(c: str, mode: str = "exact", codes: Iterable[str] = S.APAC) -> Column:
    """Country in the region.  mode: exact, upper (case only) or code (trim and case)."""
    col = name(c)
    col = {"exact": lambda: col, "upper": lambda: F.upper(col), "code": lambda: code(col)}[
        mode
    ]()
    return _is(col.isin(*codes))


def not_in(c: str, codes: Iterable[str]) -> Column:
    return ~_is(name(c).isin(*codes))


def iso_shaped(c: str) -> Column:
    return _is(name(c).rlike(r"^\d{4}-\d{2}-\d{2}"))


def funded(stage: str) -> Column:
    return _is(name(stage).isin(*S.FUNDED_STAGES))


def not_affiliate(grp: str) -> Column:
    return ~_is(name(grp) == "Affiliates")


def row_not_blank(cells: str) -> Column:
    """Some cell of the row holds text."""
    return _is(
        F.exists(name(cells), lambda x: x.isNotNull() & ~strip(x).isin("", "nan"))
    )


def not_label(c: str) -> Column:
    """Not one of the label texts a lead export puts in its country column."""
    return ~F.coalesce(F.lower(strip(name(c))), F.lit("")).isin(*S.LABEL_COUNTRIES)


def valid_date(c: str) -> Column:
    return date_lenient(name(c)).isNotNull()


def contains_ci(c: str, text: str) -> Column:
    return _is(F.lower(name(c)).contains(text.lower()))


def split_rows(df: DataFrame, p: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where `p` holds, and all the others."""
    p = _is(p)
    return df.filter(p), df.filter(~p)


def between(df: DataFrame, start, end, column: str = "Date") -> DataFrame:
    """Rows of a closed date range; a plain comparison, so the scan can prune on it."""
    return df.filter(
        (name(column) >= F.lit(start).cast("date"))
        & (name(column) <= F.lit(end).cast("date"))
    )


def last_days(df: DataFrame, days: int = 7, today=None, column: str = "Date") -> DataFrame:
    """Rows from `days` days ago up to yesterday."""
    day = F.current_date() if today is None else F.lit(today).cast("date")
    return df.filter(
        (name(column) >= F.date_sub(day, days)) & (name(column) <= F.date_sub(day, 1))
    )
