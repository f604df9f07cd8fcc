"""Trend and demand signals (C39-C41, C43) and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweave.functions import as_col
from jobweave.functions.keys import date_key

# Lower bound of the frequency and its label.
PROMINENCE = [(60, "core"), (30, "common"), (10, "emerging")]
# A move beyond two percent counts as a trend.
RISE, FALL = 1.02, 0.98


def skill_prominence(frequency_pct: Column | str) -> Column:
    out = F
    for bound, label in PROMINENCE:
        out = out.when(as_col(frequency_pct) >= bound, F.lit(label))
    return out.otherwise(F.lit("niche"))


def trend_direction(value: Column | str, previous: Column | str) -> Column:
    value, previous = as_col(value), as_col(previous)
    return (
        F.when(previous.isNull(), F.lit("first observation"))
        .when(value > previous * F.lit(RISE), F.lit("increasing"))
        .when(value < previous * F.lit(FALL), F.lit("decreasing"))
        .otherwise(F.lit("stable"))
    )


def change(value: Column | str, base: Column | str) -> Column:
    """Null when either side is null."""
    return as_col(value) - as_col(base)


def pct_change(value: Column | str, base: Column | str) -> Column:
    base = as_col(base)
    return F.when(base > 0, F.round((as_col(value) - base) / base * F.lit(100.0), 2))


def days_between(end: Column | str, start: Column | str) -> Column:
    return F.datediff(as_col(end).cast("date"), as_col(start).cast("date"))


def calendar_columns(day: Column | str) -> dict[str, Column]:
    """The attributes of one day. ``year_week`` joins calendar year and ISO week."""
    day = as_col(day)
    iso_day = F.weekday(day) + 1
    year, quarter, week = F.year(day), F.quarter(day), F.weekofyear(day)
    text = year.cast("string")
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": year,
        "quarter_num": quarter,
        "year_quarter": F.concat(text, F.lit("-Q"), quarter.cast("string")),
        "month_num": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_name_short": F.date_format(day, "MMM"),
        "year_month": F.date_format(day, "yyyy-MM"),
        "week_of_year": week,
        "year_week": F.concat(text, F.lit("-W"), F.lpad(week.cast("string"), 2, "0")),
        "day_of_month": F.dayofmonth(day),
        "day_of_week_num": iso_day,
        "day_of_week_name": F.date_format(day, "EEEE"),
        "day_of_week_name_short": F.date_format(day, "EEE"),
        "is_weekday": iso_day <= 5,
        "is_last_day_of_month": day == F.last_day(day),
        "is_first_day_of_month": F.dayofmonth(day) == 1,
    }
