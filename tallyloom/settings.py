"""Labels, lookup tables and run options.

Everything here is data.  The classifiers and source readers take these values
as literals, so a deployment can swap a table without touching any logic.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# These must be exactly as written for results to agree.
# ---------------------------------------------------------------------------

APAC = ("VN", "TH", "SG", "MY", "CN", "HK", "TW", "ID", "PH", "IN", "MN")

FILE_PATTERNS = {
    "bing": "Bing_",
    "meta": "Meta_",
    "meta_agency": "Meta_Agency_",
    "adroll": "Adroll_",
    "bilibili": "Bilibili_",
    "rednote": "Rednote_",
    "tradingview": "TradingView_",
    "apple": "Apple_",
    "tiktok": "Tiktok_",
    "douyin": "Douyin_",
    "kuaishou": "Kuaishou_",
    "ta_media": "TA_Media_",
    "affiliates": "Affiliates_",
    "ql": "QL_",
    "ft": "FT_",
}

ADROLL_COUNTRY = {
    "Hong Kong": "HK",
    "Taiwan": "TW",
    "Thailand": "TH",
    "Vietnam": "VN",
    "Singapore": "SG",
    "Indonesia": "ID",
    "Philippines": "PH",
}

APPLE_COUNTRY = {
    "Hong Kong": "HK",
    "Taiwan": "TW",
    "Thailand": "TH",
    "Vietnam": "VN",
    "Singapore": "SG",
    "Malaysia": "MY",
    "Indonesia": "ID",
    "Philippines": "PH",
    "India": "IN",
    "China mainland": "CN",
}

BING_PREFIXES = ("HK", "TH", "TW", "VN", "MY", "SG", "CN", "IN", "ID", "PH", "MN")

# (text looked for, label); the last label applies when nothing is found.
BING_LABELS = (("[Pmax]", "Bing - PMax"), ("Brand", "Bing - Brand"))
BING_DEFAULT = "Bing - Category"
ADROLL_LABELS = (
    ("retargeting", "AdRoll - Retargeting"),
    ("lookalike", "AdRoll - Lookalike"),
    ("contextual", "AdRoll - Contextual"),
)
ADROLL_DEFAULT = "AdRoll"

UTM_BLANK = ("", "-", "nan", "none", "unknown", "(not set)")

# utm text -> (channel, group)
UTM_EXACT = {
    "direct-deal-followme": ("follow me", "Others"),
    "direct-deal-mt5": ("metaquotes", "Others"),
    "direct-deal-myfxbook": ("myfxbook", "Others"),
    "direct-deal-fxstreet": ("fxstreet", "Others"),
    "direct-deal-tradingview": ("TradingView", "TradingView"),
    "direct-deal-forexfactory": ("forexfactory", "Others"),
    "bing-search-category": ("Bing", "Bing"),
    "bing-search-brand": ("Bing", "Bing"),
    "bing-performance-max-category": ("Bing", "Bing"),
    "bing": ("Bing", "Bing"),
    "google": ("Google", "Others"),
    "google-search-brand": ("Google", "Google"),
    "google-search-category": ("Google", "Google"),
    "google-performance-max-brand": ("Google", "Google"),
    "google-performance-max-category": ("Google", "Google"),
    "google-video": ("Google", "Google"),
    "google-play": ("Google", "Others"),
    "tradingview": ("TradingView", "TradingView"),
    "ctrader-eu": ("ctrader", "Others"),
    "mt5": ("mt5 terminal app", "Others"),
    "mt4": ("mt4", "Others"),
    "chatgpt.com": ("chatgpt", "Others"),
    "perplexity": ("perplexity", "Others"),
    "youtube-video": ("youtube", "Others"),
    "fx110": ("fx110", "Others"),
    "zalo": ("zalo", "Others"),
    "line": ("line", "Others"),
    "email": ("email", "Others"),
    "sendgrid": ("email", "Others"),
    "sfmc": ("email", "Others"),
    "transactional": ("email", "Others"),
    "coccoc-display": ("coccoc", "Others"),
    "instagram-organic-display": ("Meta", "Meta"),
    "adroll-display": ("AdRoll", "AdRoll"),
}

# (text contained, (channel, group)); first hit wins.
UTM_CONTAINS = (
    ("youtube", ("YouTube", "YouTube")),
    ("google", ("Google", "Google")),
    ("bing", ("Bing", "Bing")),
    ("apple", ("Apple Search Ads", "Apple Search Ads")),
    ("tiktok", ("TikTok", "TikTok")),
    ("kuaishou", ("Kuaishou", "Kuaishou")),
    ("ta-media", ("TA Media", "TA Media")),
    ("chatgpt", ("ChatGPT", "ChatGPT")),
    ("coccoc", ("CocCoc", "CocCoc")),
    ("adroll", ("AdRoll", "AdRoll")),
    ("tradingview", ("TradingView", "TradingView")),
)

# channel label -> channel group
CHANNEL_GROUP = {
    "Bing - Brand": "Bing",
    "Bing - Category": "Bing",
    "Bing - PMax": "Bing",
    "Meta": "Meta",
    "Meta - Agency": "Meta",
    "AdRoll - Retargeting": "AdRoll",
    "AdRoll - Lookalike": "AdRoll",
    "AdRoll - Contextual": "AdRoll",
    "AdRoll": "AdRoll",
    "BiliBili": "BiliBili",
    "RedNote": "RedNote",
    "TradingView": "TradingView",
    "Apple Search Ads": "Apple Search Ads",
    "TikTok": "TikTok",
    "Douyin": "Douyin",
    "Kuaishou": "Kuaishou",
    "TA Media": "TA Media",
    "Affiliates": "Affiliates",
}
OTHER_GROUP = "Others"

FUNDED_STAGES = ("Active", "Funded NT", "Funded")
LABEL_COUNTRIES = ("", "nan", "total", "grand total", "subtotal", "count")
AFFILIATE_EXCLUDED = ("AU", "NZ")
LEAD_COLUMNS = (
    "Billing Country",
    "Created Date",
    "Google UTM Source",
    "Google UTM Medium",
    "Stage",
)
DEFAULT_CN = "CN"
USD_TO_AUD = 1.58
PREAMBLE_ROWS = 6

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class RunOptions:
    """What may change from one run to the next.

    run_date   audit date; None means the cluster's current date
    usd_to_aud rate applied to dollar-denominated spend
    null_text  what a missing cell becomes inside joined text; None leaves it out
    block_rows rows worked on together where file order matters, however they are numbered
    """

    run_date: dt.date | None = None
    usd_to_aud: float = USD_TO_AUD
    null_text: str | None = "nan"
    block_rows: int = 1 << 20
