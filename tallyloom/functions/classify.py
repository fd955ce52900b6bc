"""Country, channel and lead-origin classifiers as CASE expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import settings as S
from tallyloom.functions.scalars import strip


def lookup(c: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """Value of a small fixed table for `c`, else `default`."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    hit = F.try_element_at(F.create_map(*pairs), c)
    return hit if default is None else F.coalesce(hit, F.lit(default))


def first_label(c: Column, labels, default: str) -> Column:
    """Label of the first listed text that `c` contains."""
    return F.coalesce(
        *[F.when(c.contains(text), F.lit(label)) for text, label in labels],
        F.lit(default),
    )


def channel_group(c: Column) -> Column:
    return lookup(c, S.CHANNEL_GROUP, S.OTHER_GROUP)


def prefix_country(c: Column) -> Column:
    return F.regexp_substr(c, F.lit("^(?:" + "|".join(S.BING_PREFIXES) + ")"))


def country_token(c: Column) -> Column:
    """The word between `APAC_` and the next underscore, NULL without one."""
    return F.nullif(F.regexp_extract(c, "APAC_([^_]+)_", 1), F.lit(""))


def token_country(c: Column, table: Mapping[str, str] = S.ADROLL_COUNTRY) -> Column:
    return lookup(country_token(c), table)


def token_country_or_token(
    c: Column, table: Mapping[str, str] = S.ADROLL_COUNTRY
) -> Column:
    """As `token_country`, but an unlisted word is kept as it is."""
    token = country_token(c)
    return F.coalesce(lookup(token, table), token)


def bing_channel(c: Column) -> Column:
    return first_label(c, S.BING_LABELS, S.BING_DEFAULT)


def adroll_channel(c: Column) -> Column:
    return first_label(F.lower(c), S.ADROLL_LABELS, S.ADROLL_DEFAULT)


# A lead's origin is first named by one short key, then looked up.  Rules that are
# not an exact UTM text get keys no UTM text can be, as those are in lower case.
_CLASSES = {
    "ORGANIC": ("Organic", "Organic"),
    "IB": ("IB", "IB"),
    "AFFILIATES": ("Affiliates", "Affiliates"),
    "META": ("Meta", "Meta"),
    **S.UTM_EXACT,
    **{f"HAS {text}": pair for text, pair in S.UTM_CONTAINS},
}
_CHANNELS = {key: pair[0] for key, pair in _CLASSES.items()}
_GROUPS = {key: pair[1] for key, pair in _CLASSES.items()}


def utm_key(low: Column) -> Column:
    """Key of the first rule a lower-case UTM text satisfies; NULL for none."""
    key = (
        F.when(low.isNull() | low.isin(*S.UTM_BLANK), "ORGANIC")
        .when(F.translate(low, "-_", "").rlike("^[0-9]+$"), "IB")
        .when(low.startswith("affiliate-"), "AFFILIATES")
        .when(
            low.isin("fb", "ig") | low.startswith("facebook") | low.startswith("instagram"),
            "META",
        )
        .when(low.isin(*S.UTM_EXACT), low)
    )
    for text, _ in S.UTM_CONTAINS:
        key = key.when(low.contains(text), f"HAS {text}")
    return key


def medium_key(kind: Column) -> Column:
    """Key of the two media that name an origin themselves; NULL for any other."""
    return F.when(kind == "ib", "IB").when(kind == "affiliates", "AFFILIATES")


def _class_of(key: Column, utm: Column) -> tuple[Column, Column]:
    """Channel and group; neither is ever NULL, so key filters on them cost nothing."""
    channel = F.coalesce(lookup(key, _CHANNELS), strip(utm), F.lit(""))
    return channel, lookup(key, _GROUPS, S.OTHER_GROUP)


def _struct(key: Column, utm: Column) -> Column:
    channel, group = _class_of(key, utm)
    return F.struct(channel.alias("channel"), group.alias("grp"))


def utm_class(utm: Column) -> Column:
    """Struct (channel, grp) of a lead's UTM source; unlisted text is its own channel."""
    return _struct(utm_key(F.lower(strip(utm))), utm)


def lead_class(utm: Column, medium: Column) -> Column:
    """UTM class, overruled by the two media that name an origin themselves."""
    kind = F.lower(strip(medium))
    return _struct(F.coalesce(medium_key(kind), utm_key(F.lower(strip(utm)))), utm)


def from_affiliate(utm: Column, medium: Column) -> Column:
    """True where `lead_class` says Affiliates: the test alone, to drop such leads early."""
    kind = F.coalesce(F.lower(strip(medium)), F.lit(""))
    named = F.coalesce(F.lower(strip(utm)).startswith("affiliate-"), F.lit(False))
    return (kind == "affiliates") | ((kind != "ib") & named)


def with_lead_class(df: DataFrame, utm: str = "UTM", medium: str = "Medium") -> DataFrame:
    """Add Channel and Channel_Group; texts are normalised and keyed once per row."""
    low, key = F.col("_low"), F.col("_key")
    channel, group = _class_of(key, F.col(utm))
    return (
        df.withColumn("_low", F.lower(strip(F.col(utm))))
        .withColumn(
            "_key",
            F.coalesce(medium_key(F.lower(strip(F.col(medium)))), utm_key(low)),
        )
        .withColumns({"Channel": channel, "Channel_Group": group})
        .drop("_low", "_key")
    )
