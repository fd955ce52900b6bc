"""Ad-channel exports to fact rows, one function per channel.

Each takes the raw text table of one or more exports and returns fact rows with
their origin and, where a cell makes the whole export unusable, the fault.  A
missing column raises `SourceError` while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import settings as S
from tallyloom.functions.classify import (
    adroll_channel,
    bing_channel,
    channel_group,
    lookup,
    prefix_country,
    token_country,
)
from tallyloom.functions.dates import date_lenient, date_strict, day_strict_dayfirst
from tallyloom.functions.scalars import (
    code,
    ctr_auto,
    fill0,
    fx,
    join_text,
    money,
    pct_to_frac,
    ratio_or_null,
    ratio_or_zero,
    strip,
    to_num,
    to_text,
)
from tallyloom.operators.columns import (
    fact_rows,
    fuzzy_rename,
    need,
    or_null,
    pick,
    rename_positional,
    trim_headers,
)
from tallyloom.operators.counts import flag_any
from tallyloom.operators.predicates import (
    in_region,
    iso_shaped,
    not_blank,
    not_footer,
    not_in,
    not_null,
)
from tallyloom.operators.sequence import forward_fill, number_repeats
from tallyloom.schema import name
from tallyloom.settings import RunOptions

DEFAULTS = RunOptions()


def _num(df: DataFrame, *names: str) -> Column:
    return or_null(pick(df, *names), to_num)


def _percent(df: DataFrame, *names: str) -> Column | None:
    col = pick(df, *names)
    return None if col is None else pct_to_frac(to_num(col))


def _country_or(df: DataFrame, options: RunOptions, default: str | None) -> Column:
    """Country column as a code where the table has one, else the default."""
    col = pick(df, "Country")
    return F.lit(default) if col is None else code(to_text(col, options.null_text))


def bing(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    df = rename_positional(
        raw,
        (
            "Campaign",
            "CampaignID",
            "CampaignType",
            "Date",
            "Impressions",
            "Clicks",
            "CTR",
            "Spend",
        ),
    )
    df = df.filter(not_null("Campaign") & not_footer("Campaign", ["Total"], prefix="©"))
    campaign = F.col("Campaign")
    df = df.withColumn("Country", prefix_country(campaign)).filter(not_null("Country"))
    day, fault = date_strict(F.col("Date"))
    channel = bing_channel(campaign)
    return fact_rows(
        df,
        Date=day,
        Country=F.col("Country"),
        Channel=channel,
        Campaign=campaign,
        Impressions=_num(df, "Impressions"),
        Clicks=_num(df, "Clicks"),
        CTR=_num(df, "CTR"),
        Spend_AUD=_num(df, "Spend"),
        Channel_Group=channel_group(channel),
        fault=fault,
    )


def meta(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    df = raw.filter(in_region("Country")) if "Country" in raw.columns else raw
    day, fault = date_strict(need(df, "Day"))
    clicks, shown = _num(df, "Clicks (all)"), _num(df, "Impressions")
    campaign, ad_set = pick(df, "Campaign name"), pick(df, "Ad set name")
    if ad_set is not None:
        campaign = join_text(
            " | ", need(df, "Campaign name"), ad_set, null_text=options.null_text
        )
    rate = _percent(df, "CTR (all)", "CTR")
    return fact_rows(
        df,
        Date=day,
        Country=pick(df, "Country"),
        Channel="Meta",
        Campaign=campaign,
        Impressions=shown,
        Clicks=clicks,
        CTR=ratio_or_null(clicks, shown) if rate is None else rate,
        Spend_AUD=_num(df, "Amount spent (AUD)"),
        Channel_Group="Meta",
        fault=fault,
    )


def meta_agency(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    label = "Meta - Agency"
    df = raw.filter(in_region("Country")) if "Country" in raw.columns else raw
    day = date_lenient(need(df, "Date", "Day"))
    clicks, shown = _num(df, "Clicks (all)", "Clicks"), _num(df, "Impressions")
    campaign, ad_set = pick(df, "Campaign name"), pick(df, "Ad set name")
    if campaign is None:
        campaign = label
    elif ad_set is not None:
        campaign = join_text(" | ", campaign, ad_set, null_text=options.null_text)
    rate = _percent(df, "CTR (all)", "CTR")
    return fact_rows(
        df.filter(day.isNotNull()),
        Date=day,
        Country=pick(df, "Country"),
        Channel=label,
        Campaign=campaign,
        Impressions=shown,
        Clicks=clicks,
        CTR=ratio_or_null(clicks, shown) if rate is None else rate,
        Spend_AUD=_num(df, "Amount spent (AUD)"),
        Channel_Group="Meta",
    )


def adroll(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    need(raw, "Day")
    campaign = need(raw, "Campaign")
    spend = pick(raw, "Spend")
    if spend is None:
        spend = need(raw, *[c for c in raw.columns if "spend" in c.lower()], "Spend")
    df = raw.filter(not_null("Day") & iso_shaped("Day"))
    day, fault = date_strict(F.col("Day"))
    channel = adroll_channel(campaign)
    return fact_rows(
        df,
        Date=day,
        Country=token_country(campaign),
        Channel=channel,
        Campaign=campaign,
        Impressions=_num(df, "Impressions"),
        Clicks=_num(df, "Clicks"),
        CTR=_num(df, "CTR"),
        Spend_AUD=to_num(spend),
        Channel_Group=channel_group(channel),
        fault=fault,
    )


def bilibili(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    df = fuzzy_rename(raw)
    day, fault = date_strict(need(df, "Date"))
    targeting, kind = pick(df, "Targeting approach"), pick(df, "Creative Type")
    campaign = pick(df, "Campaign")
    if targeting is not None:
        parts = [need(df, "Campaign"), targeting] + ([kind] if kind is not None else [])
        campaign = join_text(" | ", *parts, null_text=options.null_text)
    return fact_rows(
        df,
        Date=day,
        Country=_country_or(df, options, S.DEFAULT_CN),
        Channel="BiliBili",
        Campaign=campaign,
        Creative=or_null(kind, lambda c: to_text(c, options.null_text)),
        Impressions=_num(df, "Impressions"),
        Clicks=_num(df, "Clicks"),
        CTR=_num(df, "CTR"),
        Spend_AUD=_num(df, "Spend_AUD"),
        Channel_Group="BiliBili",
        fault=fault,
    )


def _placements(
    raw: DataFrame, options: RunOptions, label: str, default_country: str | None
) -> DataFrame:
    """Exports with a row per account, placement, targeting and creative, repeats numbered."""
    creative = pick(raw, "Creative")
    texts = [need(raw, c) for c in ("Placement", "Targeting Approach")]
    # Without a creative column the joined text still has its place, filled 'None'.
    last = (
        (F.lit("None") if options.null_text else F.lit(None).cast("string"))
        if creative is None
        else creative
    )
    account = join_text(
        " - ", need(raw, "Main Account"), texts[0], null_text=options.null_text
    )
    base = join_text(" | ", account, texts[1], last, null_text=options.null_text)
    day = date_lenient(need(raw, "Date"))
    clicks, shown, spend = (
        fill0(to_num(need(raw, c))) for c in ("Click", "Impression", "Cost (AUD)")
    )
    rows = fact_rows(
        raw.filter(day.isNotNull()),
        Date=day,
        Country=_country_or(raw, options, default_country),
        Channel=label,
        Campaign=base,
        Creative=or_null(creative, lambda c: to_text(c, options.null_text)),
        Impressions=shown,
        Clicks=clicks,
        CTR=ratio_or_zero(clicks, shown),
        Spend_AUD=spend,
        Channel_Group=label,
    )
    return number_repeats(
        rows, "Campaign", by=["_path", "Date"], block=options.block_rows
    )


def rednote(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    return _placements(raw, options, "RedNote", None)


def kuaishou(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    return _placements(raw, options, "Kuaishou", S.DEFAULT_CN)


def tradingview(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    """Country comes from the sheet's name; sheets may differ in currency."""
    need(raw, "Date")
    df = raw.filter(in_region("_sheet", "code") & iso_shaped("Date"))
    day, fault = date_strict(F.col("Date"))
    usd = pick(df, "Amount spent (USD)")
    if usd is None:
        spend = _num(df, "Amount spent (AUD)")
    else:
        spend = fx(to_num(usd), options.usd_to_aud)
    return fact_rows(
        df,
        Date=day,
        Country=code(F.col("_sheet")),
        Channel="TradingView",
        Campaign="TradingView",
        Impressions=_num(df, "Impressions"),
        Clicks=_num(df, "Clicks"),
        CTR=_num(df, "CTR"),
        Spend_AUD=spend,
        Channel_Group="TradingView",
        fault=fault,
    )


def apple(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    df = trim_headers(raw)
    country = lookup(need(df, "Country or Region"), S.APPLE_COUNTRY)
    df = df.withColumn("Country", country).filter(in_region("Country"))
    rate = need(df, "CR (Tap-Through)")
    df = flag_any(df, rate.contains("%"), "_path", "_has_pct")
    day, fault = date_strict(need(df, "Date", "Day"))
    return fact_rows(
        df,
        Date=day,
        Country=F.col("Country"),
        Channel="Apple Search Ads",
        Campaign=to_text(need(df, "Campaign Name"), options.null_text),
        Impressions=to_num(need(df, "Impressions")),
        Clicks=to_num(need(df, "Taps")),
        CTR=ctr_auto(rate, F.col("_has_pct")),
        Spend_AUD=to_num(need(df, "Spend")),
        Channel_Group="Apple Search Ads",
        fault=fault,
    )


def tiktok_daily(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    """Layout with one sheet for all countries."""
    df = trim_headers(raw)
    need(df, "Country"), need(df, "Campaign name")
    df = df.filter(
        in_region("Country", "code") & not_null("Campaign name") & not_blank("Campaign name")
    )
    day, fault = date_strict(need(df, "Date"))
    clicks, shown = _num(df, "Clicks (all)"), _num(df, "Impressions")
    rate = pick(df, "CTR")
    return fact_rows(
        df,
        Date=day,
        Country=code(F.col("Country")),
        Channel="TikTok",
        Campaign=name("Campaign name"),
        Creative=or_null(
            pick(df, "Ad name", "Ad group name"), lambda c: to_text(c, options.null_text)
        ),
        Impressions=shown,
        Clicks=clicks,
        CTR=ratio_or_null(clicks, shown) if rate is None else to_num(rate),
        Spend_AUD=_num(df, "Cost (AUD)", "Amount spent (AUD)"),
        Channel_Group="TikTok",
        fault=fault,
    )


def tiktok_tabs(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    """Layout with a sheet per country and merged week and campaign cells."""
    df = trim_headers(raw)
    need(df, "Week"), need(df, "Campaign name"), need(df, "Ad set name")
    df = df.filter(in_region("_sheet", "code"))
    df = forward_fill(df, ["Week", "Campaign name"], block=options.block_rows)
    df = df.filter(
        not_footer("Campaign name", ["Total"])
        & not_footer("Week", ["Total"])
        & not_null("Ad set name")
        & not_blank("Ad set name")
    )
    day, fault = date_strict(F.col("Week"))
    return fact_rows(
        df,
        Date=day,
        Country=code(F.col("_sheet")),
        Channel="TikTok",
        Campaign=to_text(name("Campaign name"), options.null_text),
        Creative=name("Ad set name"),
        Impressions=to_num(need(df, "Impressions")),
        Clicks=to_num(need(df, "Clicks (all)")),
        CTR=to_num(need(df, "CTR")),
        Spend_AUD=to_num(need(df, "Amount spent (AUD)")),
        Channel_Group="TikTok",
        fault=fault,
    )


def douyin(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    df = trim_headers(raw)
    campaign = need(df, "Campaign Name")
    df = df.filter(not_null("Campaign Name") & not_blank("Campaign Name"))
    kind = need(df, "Creative Type")
    day, fault = date_strict(need(df, "Date"))
    clicks, shown = _num(df, "Profile Views"), _num(df, "Video Play")
    return fact_rows(
        df,
        Date=day,
        Country=_country_or(df, options, S.DEFAULT_CN),
        Channel="Douyin",
        Campaign=join_text(
            " | ", campaign, need(df, "Targeting approach"), kind, null_text=options.null_text
        ),
        Creative=to_text(kind, options.null_text),
        Impressions=shown,
        Clicks=clicks,
        CTR=ratio_or_null(clicks, shown),
        Spend_AUD=_num(df, "Cost (AUD)"),
        Channel_Group="Douyin",
        fault=fault,
    )


def ta_media(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    need(raw, "Country")
    day = date_lenient(need(raw, "Date"))
    df = raw.filter(in_region("Country", "code") & day.isNotNull())
    creative, ad_group = pick(df, "Creative"), pick(df, "Ad group")
    if creative is not None:
        creative = strip(to_text(creative, options.null_text))
    campaign = "TA Media"
    if ad_group is not None:
        tail = (F.lit("None") if options.null_text else F.lit(None)) if creative is None else creative
        campaign = join_text(
            " | ",
            strip(to_text(ad_group, options.null_text)),
            tail,
            null_text=options.null_text,
        )
    clicks, shown = _num(df, "Clicks"), _num(df, "Impression")
    return fact_rows(
        df,
        Date=day,
        Country=code(F.col("Country")),
        Channel="TA Media",
        Campaign=campaign,
        Creative=creative,
        Impressions=shown,
        Clicks=clicks,
        CTR=ratio_or_null(clicks, shown),
        Spend_AUD=_num(df, "Cost (AUD)"),
        Channel_Group="TA Media",
    )


def affiliates(raw: DataFrame, options: RunOptions = DEFAULTS) -> DataFrame:
    df = rename_positional(raw, ("Date", "Country", "Type", "Commission", "QL", "FT"))
    df = forward_fill(df, ["Date"], block=options.block_rows)
    df = df.filter(
        not_footer("Date", ["Grand Total"])
        & not_footer("Country", ["Total"])
        & not_null("Country")
    )
    df = df.filter(not_in("Country", S.AFFILIATE_EXCLUDED))
    day, fault = day_strict_dayfirst(F.col("Date"))
    whole = lambda c: fill0(to_num(F.col(c))).try_cast("bigint")
    return fact_rows(
        df,
        Date=day,
        Country=F.col("Country"),
        Channel="Affiliates",
        Campaign="Affiliates",
        Spend_AUD=money(F.col("Commission")),
        QL=whole("QL"),
        FT=whole("FT"),
        Channel_Group="Affiliates",
        fault=fault,
    )
