"""The sources a run reads, as data: add an entry to add a source."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom import settings as S
from tallyloom.settings import RunOptions
from tallyloom.sources import ads
from tallyloom.sources import grids as G


@dataclass(frozen=True)
class SourceSpec:
    """How one source is found and read.

    key        entry of the file patterns
    harmonise  raw table to fact rows
    header     predicate on a grid row: this is the header
    sheet      which sheet to read; `fallback` if none fits, all fitting ones if `many`
    daily      reader for the fallback sheet, where its layout is another one
    preamble   lines above the header of a delimited export; None where only workbooks are read
    """

    label: str
    key: str
    harmonise: Callable[[DataFrame, RunOptions], DataFrame]
    header: Callable[[], Column] = G.first_row
    sheet: G.SheetRule = G.any_sheet
    fallback: G.SheetRule = G.any_sheet
    many: bool = False
    daily: Callable[[DataFrame, RunOptions], DataFrame] | None = None
    preamble: int | None = None

    def reader(self, sheets) -> Callable[[DataFrame, RunOptions], DataFrame]:
        """Reader for the sheets chosen in one workbook."""
        if self.daily and [s.sheet for s in sheets] == ["Daily"]:
            return self.daily
        return self.harmonise


def _below_preamble() -> Column:
    return F.col("row_no") >= S.PREAMBLE_ROWS  # rows are numbered from 0


SOURCES = (
    SourceSpec("Bing", "bing", ads.bing, header=lambda: G.some_cell_contains("Campaign name")),
    SourceSpec("Meta", "meta", ads.meta, sheet=G.has_word("raw", "data")),
    SourceSpec(
        "Meta - Agency", "meta_agency", ads.meta_agency, sheet=G.has_word("daily", "raw", "data")
    ),
    SourceSpec(
        "AdRoll",
        "adroll",
        ads.adroll,
        header=lambda: G.cells_equal("Day", "Campaign"),
        sheet=G.is_daily,
        fallback=G.no_sheet,
    ),
    SourceSpec("BiliBili", "bilibili", ads.bilibili, sheet=G.not_daily),
    SourceSpec("RedNote", "rednote", ads.rednote, sheet=G.is_daily_any_case),
    SourceSpec(
        "TradingView",
        "tradingview",
        ads.tradingview,
        sheet=G.country_sheet,
        fallback=G.no_sheet,
        many=True,
    ),
    SourceSpec("Apple Search Ads", "apple", ads.apple, header=_below_preamble, preamble=S.PREAMBLE_ROWS),
    SourceSpec(
        "TikTok",
        "tiktok",
        ads.tiktok_tabs,
        sheet=G.country_sheet,
        fallback=G.is_daily,
        many=True,
        daily=ads.tiktok_daily,
    ),
    SourceSpec("Douyin", "douyin", ads.douyin, sheet=G.is_daily),
    SourceSpec("Kuaishou", "kuaishou", ads.kuaishou, sheet=G.is_daily),
    SourceSpec("TA Media", "ta_media", ads.ta_media, sheet=G.is_daily),
    SourceSpec("Affiliates", "affiliates", ads.affiliates),
)

LEADS_LABEL = "QL/FT (CRM)"
LEAD_KEYS = ("ql", "ft")
LABELS = {s.key: s.label for s in SOURCES} | dict.fromkeys(LEAD_KEYS, LEADS_LABEL)


def lead_header() -> Column:
    return G.cells_cover(S.LEAD_COLUMNS)
