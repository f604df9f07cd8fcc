"""Surrogate keys (C14-C17)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweave.functions import as_col

UNKNOWN_KEY = "-1"
UNKNOWN_TITLE_KEY = -1


def hash_title(title: Column | str) -> Column:
    """First eight hex digits of the md5 as a bigint."""
    return F.conv(F.substring(F.md5(as_col(title)), 1, 8), 16, 10).cast("bigint")


def job_title_key(title_normalized: Column | str, raw_title: Column | str | None = None) -> Column:
    """-1 when unknown; with a raw title also -1 when that has at most two characters."""
    title = as_col(title_normalized)
    unknown = title.isNull()
    if raw_title is not None:
        raw = as_col(raw_title)
        unknown = unknown | raw.isNull() | (F.length(F.trim(raw)) <= 2)
    return F.when(unknown, F.lit(UNKNOWN_TITLE_KEY).cast("bigint")).otherwise(hash_title(title))


def salary_estimate_key(title: Column | str, location: Column | str, currency: Column | str, day: Column | str) -> Column:
    return F.md5(
        F.concat_ws(
            "||",
            F.coalesce(as_col(title), F.lit("unknown")),
            F.coalesce(as_col(location), F.lit(UNKNOWN_KEY)),
            F.coalesce(as_col(currency), F.lit("USD")),
            as_col(day).cast("string"),
        )
    )


def pair_key(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("||", *[as_col(p) for p in parts]))


def date_key(moment: Column | str) -> Column:
    """Day as a yyyyMMdd integer."""
    day = as_col(moment).cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
