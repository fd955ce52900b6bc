"""Number, text and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal text or infinity.  The test keeps out what a JVM cast would also
# accept: 'nan', type suffixes (12d, 12f) and hexadecimal floats.
_NUMBER = (
    r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
    r"|^\s*[+-]?(?i:inf|infinity)\s*$"
)


def to_num(c: Column) -> Column:
    """Text to DOUBLE, NULL where it is not a plain number."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def to_long(c: Column) -> Column:
    """Text to BIGINT, NULL where it is not a whole number."""
    number = to_num(c)
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def not_whole(c: Column) -> Column:
    """True for text that is a number but not a whole one."""
    number = to_num(c)
    return F.coalesce(number != F.floor(number), F.lit(False))


# Every character Unicode counts as white space; a plain trim knows only the blank.
WHITE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove white space of any kind at both ends, tabs and wide blanks included."""
    return F.btrim(c, F.lit(WHITE))


def code(c: Column) -> Column:
    """Trimmed upper-case text, as country codes are compared."""
    return F.upper(strip(c))


def to_text(c: Column, null_text: str | None = "nan") -> Column:
    """Text of a cell; a missing one reads `null_text` (stays NULL for None)."""
    text = c.cast("string")
    return text if null_text is None else F.coalesce(text, F.lit(null_text))


def join_text(sep: str, *cs: Column, null_text: str | None = "nan") -> Column:
    return F.concat_ws(sep, *[to_text(c, null_text) for c in cs])


def ratio_or_null(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def pct_to_frac(c: Column) -> Column:
    return c / F.lit(100.0)


def fx(c: Column, rate: float) -> Column:
    return c * F.lit(float(rate))


def ctr_auto(c: Column, has_pct: Column) -> Column:
    """Rate cell as a fraction; `has_pct` tells whether its file writes percentages."""
    as_pct = pct_to_frac(to_num(strip(F.replace(c, F.lit("%"), F.lit("")))))
    return F.when(has_pct, as_pct).otherwise(to_num(c))


def money(c: Column) -> Column:
    return to_num(strip(F.translate(c, "$,", "")))


def fill0(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def is_lead(impressions: Column, spend: Column) -> Column:
    """Row type of the fact table: a lead row has neither impressions nor spend."""
    return impressions.isNull() & spend.isNull()


def null_key(c: Column) -> Column:
    """Key text with NULL and '' made equal."""
    return F.coalesce(c, F.lit(""))


def field_or(c: Column, path: str, default=None) -> Column:
    """Nested field by dotted path, `default` where any step is missing."""
    for step in path.split("."):
        c = c.getField(step)
    return c if default is None else F.coalesce(c, F.lit(default))
