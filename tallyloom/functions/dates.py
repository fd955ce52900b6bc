"""Date expressions.

Each value is read on its own by its shape, so a column may mix layouts.  A shape
test picks the one cast to make: no failed parse attempts, no exceptions per row, and
year-first text, by far the most common, costs a single test.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_CLOCK = r"(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?"
_YEAR_FIRST = rf"^\s*\d{{4}}[-./]\d{{1,2}}[-./]\d{{1,2}}{_CLOCK}\s*$"
_ISO = rf"^\s*\d{{4}}-\d{{1,2}}-\d{{1,2}}{_CLOCK}\s*$"
_YEAR_LAST = (
    r"^\s*(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})(?:,?\s+(\d{1,2}:\d{2}(?::\d{2})?))?\s*$"
)
_BLANK = ("", "nan", "nat", "none")


def date_lenient(c: Column) -> Column:
    """Text to DATE: year first, or month/day/year; NULL for anything else."""
    return F.when(
        c.rlike(_YEAR_FIRST), F.translate(F.trim(c), "./", "--").try_cast("date")
    ).when(c.rlike(_YEAR_LAST), F.regexp_replace(c, _YEAR_LAST, "$3-$1-$2").try_cast("date"))


def ts_dayfirst(c: Column) -> Column:
    """Text to timestamp without zone: day/month/year, or ISO read as ISO."""
    return F.when(c.rlike(_ISO), F.trim(c).try_cast("timestamp_ntz")).when(
        c.rlike(_YEAR_LAST),
        F.trim(F.regexp_replace(c, _YEAR_LAST, "$3-$2-$1 $4")).try_cast("timestamp_ntz"),
    )


def to_day(c: Column) -> Column:
    return F.to_date(c)


def bad_date(c: Column, parsed: Column) -> Column:
    """True where a cell holds something that is not a date; an empty cell is no fault."""
    return parsed.isNull() & ~F.coalesce(F.lower(F.trim(c)), F.lit("")).isin(*_BLANK)


def date_strict(c: Column) -> tuple[Column, Column]:
    """The date, and the fault text that makes its whole source unusable."""
    parsed = date_lenient(c)
    return parsed, F.when(bad_date(c, parsed), F.lit("unreadable date"))


def day_strict_dayfirst(c: Column) -> tuple[Column, Column]:
    parsed = to_day(ts_dayfirst(c))
    return parsed, F.when(bad_date(c, parsed), F.lit("unreadable date"))


def yymmdd(c: Column) -> Column:
    """DDMMYY text to sortable YYMMDD."""
    return F.concat(F.substring(c, 5, 2), F.substring(c, 3, 2), F.substring(c, 1, 2))
