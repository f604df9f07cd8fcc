"""Employer names (C4, C9) and company attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweave.functions import as_col, fold_replace
from jobweave.functions.keys import UNKNOWN_KEY

EMPLOYER_PASSES: list[tuple[str, str]] = [
    (r"[^\p{L}\p{N}]+", " "),
    (r"( +(inc|llc|ltd|limited|plc|corp|corporation|gmbh|co))+ *$", ""),
]

# Exact country spellings per market.
COMPANY_MARKETS: list[tuple[str, list[str]]] = [
    ("Kenya", ["KENYA", "KE"]),
    ("UK", ["UNITED KINGDOM", "UK", "GB"]),
    ("US", ["UNITED STATES", "US", "USA"]),
]

# Lower bound of postings and the band's label.
VOLUME_BANDS: list[tuple[int, str]] = [
    (50, "High (50+)"),
    (20, "Active (20–49)"),
    (5, "Moderate (5–19)"),
]
LOWEST_BAND = "Low (1–4)"


def employer_name_normalization(name: Column | str) -> Column:
    """Lower case, no punctuation, no trailing legal form."""
    return F.trim(fold_replace(F.lower(F.trim(as_col(name))), EMPLOYER_PASSES))


def company_key(raw_name: Column | str, clean_name: Column | str) -> Column:
    return F.when(as_col(raw_name).isNull(), F.lit(UNKNOWN_KEY)).otherwise(F.md5(as_col(clean_name)))


def company_market(country: Column | str) -> Column:
    value = as_col(country)
    upper = F.trim(F.upper(value))
    out = F
    for market, names in COMPANY_MARKETS:
        out = out.when(upper.isin(names), F.lit(market))
    return out.when(value.isNull(), F.lit("Unknown")).otherwise(F.lit("Other"))


def posting_volume_band(total: Column | str) -> Column:
    out = F
    for bound, label in VOLUME_BANDS:
        out = out.when(as_col(total) >= bound, F.lit(label))
    return out.otherwise(F.lit(LOWEST_BAND))
