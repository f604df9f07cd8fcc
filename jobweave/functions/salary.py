"""Pay: annualizing, midpoints, spreads, buckets, reliability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweave.functions import as_col

# Pay periods per year as postings and estimates spell them.
POSTING_PERIODS = {"YEARLY": 1, "MONTHLY": 12, "WEEKLY": 52, "DAILY": 260, "HOURLY": 2080}
ESTIMATE_PERIODS = {"HOUR": 2080, "DAY": 260, "WEEK": 52, "MONTH": 12}

# Currency, upper bounds and labels; the last label has no bound.
BUCKETS: dict[str, tuple[list[int], list[str]]] = {
    "USD": (
        [50000, 80000, 120000, 180000],
        ["Under $50K", "$50K–$80K", "$80K–$120K", "$120K–$180K", "Over $180K"],
    ),
    "GBP": (
        [35000, 60000, 90000, 130000],
        ["Under £35K", "£35K–£60K", "£60K–£90K", "£90K–£130K", "Over £130K"],
    ),
    "KES": (
        [600000, 1200000, 2400000, 4800000],
        ["Under KES 600K", "KES 600K–1.2M", "KES 1.2M–2.4M", "KES 2.4M–4.8M", "Over KES 4.8M"],
    ),
}
UNDISCLOSED = "Undisclosed"
DEFAULT_CURRENCY = "USD"


def annualize_posting(amount: Column | str, period: Column | str) -> Column:
    key = F.upper(F.trim(as_col(period)))
    out = F
    for name, factor in POSTING_PERIODS.items():
        out = out.when(key == name, as_col(amount) * F.lit(float(factor)))
    return out.otherwise(F.lit(None).cast("double"))


def annualize_estimate(amount: Column | str, period: Column | str) -> Column:
    """Scaled figures are rounded to whole units; yearly ones are left alone."""
    key = F.upper(as_col(period))
    amount = as_col(amount)
    out = F.when(key == "YEAR", amount)
    for name, factor in ESTIMATE_PERIODS.items():
        out = out.when(key == name, F.round(amount * F.lit(float(factor)), 0))
    return out.otherwise(F.lit(None).cast("double"))


def has_salary(low: Column | str, high: Column | str) -> Column:
    return as_col(low).isNotNull() & as_col(high).isNotNull()


def midpoint_strict(low: Column | str, high: Column | str) -> Column:
    low, high = as_col(low), as_col(high)
    return F.when(low.isNotNull() & high.isNotNull(), (low + high) / F.lit(2.0).cast("double"))


def midpoint_zero_filled(low: Column | str, high: Column | str) -> Column:
    zero = F.lit(0.0)
    return F.round((F.coalesce(as_col(low), zero) + F.coalesce(as_col(high), zero)) / F.lit(2.0), 0)


def range_width(low: Column | str, high: Column | str) -> Column:
    return as_col(high) - as_col(low)


def percent_of(part: Column | str, whole: Column | str, digits: int) -> Column:
    """Part as a percentage of a positive whole, else null."""
    whole = as_col(whole)
    return F.when(whole > 0, F.round(as_col(part) / whole * F.lit(100.0), digits))


def salary_bucket(amount: Column | str, currency: Column | str) -> Column:
    amount, currency = as_col(amount), as_col(currency)
    out = F.when(amount.isNull(), F.lit(UNDISCLOSED))
    for code, (bounds, labels) in BUCKETS.items():
        band = F
        for bound, label in zip(bounds, labels):
            band = band.when(amount < bound, F.lit(label))
        out = out.when(currency == code, band.otherwise(F.lit(labels[-1])))
    return out.otherwise(F.lit(UNDISCLOSED))


def estimate_reliability(
    confidence: Column | str, sample: Column | str, median: Column | str, range_pct: Column | str
) -> Column:
    """The order of the cases decides."""
    level = F.lower(as_col(confidence))
    sample = as_col(sample)
    return (
        F.when((level == "high") & (sample >= 30), F.lit("high"))
        .when((level == "high") & sample.isNotNull(), F.lit("medium"))
        .when((level == "medium") & (sample >= 10), F.lit("medium"))
        .when(level == "low", F.lit("low"))
        .when(sample < 5, F.lit("low"))
        .when(as_col(median).isNull(), F.lit("low"))
        .when(as_col(range_pct) > 100, F.lit("low"))
        .otherwise(F.lit("medium"))
    )


def salary_source(median: Column | str) -> Column:
    return F.when(as_col(median).isNotNull(), F.lit("estimated")).otherwise(F.lit("unavailable"))
