"""Quality flags and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweave.functions import as_col
from jobweave.functions.keys import UNKNOWN_KEY, UNKNOWN_TITLE_KEY

# Employment type codes and labels.
EMPLOYMENT_LABELS = {
    "FULLTIME": "Full-Time",
    "PARTTIME": "Part-Time",
    "CONTRACTOR": "Contract",
    "INTERN": "Internship",
}


def is_unknown_title(key: Column | str) -> Column:
    return F.coalesce(as_col(key) == UNKNOWN_TITLE_KEY, F.lit(False))


def is_unknown_key(key: Column | str) -> Column:
    return F.coalesce(as_col(key) == UNKNOWN_KEY, F.lit(False))


def posting_quality(location_quality: Column | str, title_key: Column | str, company: Column | str) -> Column:
    place = as_col(location_quality)
    titled = as_col(title_key) != UNKNOWN_TITLE_KEY
    return (
        F.when((place == "located") & titled & (as_col(company) != UNKNOWN_KEY), F.lit("high"))
        .when(place.isin("remote", "partial") & titled, F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def estimate_quality(
    location: Column | str, title_key: Column | str, median: Column | str, reliability: Column | str
) -> Column:
    priced = as_col(median).isNotNull()
    reliability = as_col(reliability)
    placed = (as_col(location) != UNKNOWN_KEY) & (as_col(title_key) != UNKNOWN_TITLE_KEY)
    return (
        F.when(placed & priced & (reliability == "high"), F.lit("high"))
        .when(priced & (reliability != "low"), F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def employment_type(contract: Column | str) -> Column:
    value = as_col(contract)
    code = F.upper(F.trim(value))
    out = F
    for name, label in EMPLOYMENT_LABELS.items():
        out = out.when(code == name, F.lit(label))
    return out.otherwise(F.coalesce(F.initcap(F.trim(value)), F.lit("Unknown")))
