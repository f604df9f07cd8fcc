"""Marts (N14-N17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.functions import keys, salary, signals
from jobweave.operators.dedup import latest_per_key
from jobweave.operators.joins import (
    benchmark_locations,
    combine_measures,
    max_per_company,
    scoped_titles,
    with_calendar,
)
from jobweave.operators.rates import disclosure, index_to_average, rank_in_segment, rate_pct
from jobweave.operators.trend import snapshot_windows

SERIES = ["job_title_key", "location_key", "salary_currency"]
PLACE = ["job_title_key", "location_key"]


def good_quality(df: DataFrame, qualities: list[str] | None) -> DataFrame:
    return df if qualities is None else df.filter(F.col("record_quality").isin(qualities))


def mart_job_market_benchmarks(
    postings: DataFrame,
    estimates: DataFrame,
    dim_job_title: DataFrame,
    dim_location: DataFrame,
    qualities: list[str] | None = None,
) -> DataFrame:
    """Demand and latest pay per title, place and currency in the benchmark markets.

    Both facts are reduced to the title and place first and then joined with
    each other, so pairs without data never arise. The unknown title carries no
    row in the mart and is dropped before the shuffle.
    """
    def known(df: DataFrame) -> DataFrame:
        return good_quality(df, qualities).filter(F.col("job_title_key") != keys.UNKNOWN_TITLE_KEY)

    demand = disclosure(known(postings), PLACE, "has_salary_disclosed")
    return benchmark_rows(demand, latest_pay(known(estimates)), dim_job_title, dim_location).drop(*PLACE)


def latest_pay(estimates: DataFrame) -> DataFrame:
    """The newest estimate per title, place and currency."""
    return latest_per_key(estimates, SERIES, "date_key", "salary_estimate_key").select(
        *SERIES,
        "salary_median_annual",
        "salary_min_annual",
        "salary_max_annual",
        "base_salary_median_annual",
        "additional_pay_pct",
        "salary_bucket",
        "base_salary_bucket",
        "estimate_reliability",
        F.col("salary_count").alias("estimate_sample_size"),
    )


def benchmark_rows(demand: DataFrame, latest: DataFrame, dim_job_title: DataFrame, dim_location: DataFrame) -> DataFrame:
    """The benchmark mart, with its keys, from demand per title and place and pay per title, place and currency."""
    both = combine_measures(demand, latest, PLACE).filter(
        F.col("total_postings").isNotNull() | F.col("salary_median_annual").isNotNull()
    )
    titles = scoped_titles(dim_job_title)
    places = benchmark_locations(dim_location)
    return both.join(titles, "job_title_key").join(places, "location_key").select(
        *PLACE,
        "title_normalized",
        "role_family",
        "is_management",
        "is_technical",
        "market",
        "country_clean",
        "city_clean",
        "is_benchmark_market",
        F.coalesce("total_postings", F.lit(0)).alias("total_postings"),
        F.coalesce("postings_with_salary", F.lit(0)).alias("postings_with_salary"),
        "salary_disclosure_rate_pct",
        "salary_currency",
        "salary_median_annual",
        "salary_min_annual",
        "salary_max_annual",
        "base_salary_median_annual",
        "additional_pay_pct",
        "salary_bucket",
        "base_salary_bucket",
        "estimate_reliability",
        "estimate_sample_size",
        salary.salary_source("salary_median_annual").alias("salary_source"),
    )


BENCHMARK_ORDER = ["market", "role_family", "title_normalized"]


def mart_salary_trends(
    estimates: DataFrame,
    dim_job_title: DataFrame,
    dim_location: DataFrame,
    dim_date: DataFrame,
    qualities: list[str] | None = None,
) -> DataFrame:
    """Every snapshot with its change against the previous and the first one.

    Titles the mart does not show are joined away before the windows: the join
    is on a partition key, so no series is cut. What is left has one snapshot
    per series and day, which bounds the window groups.
    """
    titles = scoped_titles(dim_job_title).select(
        "job_title_key", "title_normalized", "role_family", "is_management", "is_technical"
    )
    places = dim_location.select("location_key", "market", "country_clean", "city_clean")
    snapshots = good_quality(estimates, qualities).select(
        *SERIES,
        "date_key",
        "salary_estimate_key",
        "salary_median_annual",
        "salary_min_annual",
        "salary_max_annual",
        "base_salary_median_annual",
        "additional_pay_median_annual",
        "additional_pay_pct",
        "salary_bucket",
        "base_salary_bucket",
        "salary_range_width",
        "salary_range_pct",
        "salary_count",
        "ingestion_date",
    )
    snapshots = snapshots.join(titles, "job_title_key")
    value, base = "salary_median_annual", "base_salary_median_annual"
    trends = snapshot_windows(
        snapshots.withColumn("_order", F.struct("ingestion_date", "salary_estimate_key")),
        SERIES,
        "_order",
        lags={"prev_value": value, "prev_base": base, "prev_ingestion_date": "ingestion_date"},
        firsts={"first_salary_median_annual": value, "first_observation_date": "ingestion_date"},
    )
    number = F.col("snapshot_number")
    first = F.col("first_salary_median_annual")
    trends = trends.withColumns(
        {
            "days_since_prev_snapshot": signals.days_between("ingestion_date", "prev_ingestion_date"),
            "median_change_vs_prev": signals.change(value, "prev_value"),
            "median_pct_change_vs_prev": signals.pct_change(value, "prev_value"),
            "base_median_change_vs_prev": signals.change(base, "prev_base"),
            "days_since_first_observation": signals.days_between("ingestion_date", "first_observation_date"),
            "median_change_vs_first": F.when(number > 0, signals.change(value, first)),
            "median_pct_change_vs_first": F.when(number > 1, signals.pct_change(value, first)),
            "trend_direction": signals.trend_direction(value, "prev_value"),
        }
    )
    days = ["year", "month_num", "month_name_short", "year_month", "quarter_num", "year_quarter"]
    shown = with_calendar(trends.join(places, "location_key"), dim_date, days)
    return shown.select(
        "title_normalized",
        "role_family",
        "is_management",
        "is_technical",
        "market",
        "country_clean",
        "city_clean",
        "ingestion_date",
        *days,
        "salary_currency",
        value,
        "salary_min_annual",
        "salary_max_annual",
        base,
        "additional_pay_median_annual",
        "additional_pay_pct",
        "salary_bucket",
        "base_salary_bucket",
        "salary_range_width",
        "salary_range_pct",
        "prev_ingestion_date",
        "days_since_prev_snapshot",
        "median_change_vs_prev",
        "median_pct_change_vs_prev",
        "base_median_change_vs_prev",
        "first_observation_date",
        "first_salary_median_annual",
        "days_since_first_observation",
        "median_change_vs_first",
        "median_pct_change_vs_first",
        "trend_direction",
        "snapshot_number",
        "total_snapshots",
        F.col("salary_count").alias("estimate_sample_size"),
    )


TREND_ORDER = ["market", "role_family", "title_normalized", "ingestion_date"]


def mart_skill_demand(
    skills: DataFrame, postings: DataFrame, dim_job_title: DataFrame, dim_location: DataFrame, jobs: DataFrame
) -> DataFrame:
    """How often each skill is asked for, per role family, market and country.

    The bridge and the facts hold one row per (job, skill) and per job, so
    distinct jobs are plain counts and both sides shrink in the map tasks.
    """
    titles = scoped_titles(dim_job_title).select("job_title_key", "role_family")
    places = benchmark_locations(dim_location).select("location_key", "market", "country_clean")

    def segmented(df: DataFrame) -> DataFrame:
        return df.join(titles, "job_title_key").join(places, "location_key")

    segment = ["role_family", "market"]
    asked = (
        segmented(skills.select("job_id", "skill_name", "skill_category", "job_title_key", "location_key"))
        .groupBy("skill_name", "skill_category", *segment, "country_clean")
        .agg(F.count("*").alias("postings_requiring_skill"))
    )
    counted = postings.select("job_id", *PLACE).join(jobs.select("job_id", "skill_count"), "job_id")
    totals = (
        segmented(counted)
        .groupBy(*segment)
        .agg(
            F.count("*").alias("total_postings"),
            F.round(F.avg("skill_count"), 1).alias("avg_skills_per_posting"),
        )
    )
    rated = asked.join(totals, segment, "left").withColumn(
        "skill_frequency_pct", rate_pct(F.col("postings_requiring_skill"), F.col("total_postings"))
    )
    ranked = rank_in_segment(
        rated,
        segment,
        [
            F.col("postings_requiring_skill").desc(),
            F.col("skill_name").asc(),
            F.col("country_clean").asc_nulls_last(),
        ],
        "skill_rank_in_segment",
    )
    indexed = index_to_average(
        ranked, "skill_frequency_pct", ["skill_name", "role_family"], "market_demand_index"
    )
    return indexed.select(
        "skill_name",
        "skill_category",
        "role_family",
        "market",
        "country_clean",
        "postings_requiring_skill",
        "total_postings",
        "skill_frequency_pct",
        "skill_rank_in_segment",
        "avg_skills_per_posting",
        signals.skill_prominence("skill_frequency_pct").alias("skill_prominence"),
        "market_demand_index",
    )


def mart_company_hiring(
    postings: DataFrame, dim_company: DataFrame, dim_job_title: DataFrame, dim_location: DataFrame
) -> DataFrame:
    """Hiring per company, market and role family in the benchmark markets."""
    titles = scoped_titles(dim_job_title).select("job_title_key", "role_family")
    places = benchmark_locations(dim_location).select("location_key", "market", "country_clean")
    known = postings.filter(F.col("company_key") != keys.UNKNOWN_KEY)
    # The company's top rank counts all its postings, shown here or not.
    ranked = max_per_company(known, "company_key", "seniority_rank", "_top_rank")
    shown = (
        good_quality(ranked, ["high", "medium"])
        .join(titles, "job_title_key")
        .join(places, "location_key")
    )
    grain = ["company_key", "market", "role_family"]
    top = F.when(F.col("seniority_rank") == F.col("_top_rank"), F.col("seniority_level"))
    hiring = shown.groupBy(*grain).agg(
        F.count("*").alias("total_postings"),
        F.max(top).alias("most_senior_level_hired"),
        F.min("first_seen_at").alias("first_posting_seen"),
        F.max("last_seen_at").alias("last_posting_seen"),
    )
    return hiring_rows(hiring, dim_company).drop("company_key")


def hiring_rows(hiring: DataFrame, dim_company: DataFrame) -> DataFrame:
    """The hiring mart, with its key, from measures per company, market and role family."""
    companies = dim_company.filter(F.col("company_key") != keys.UNKNOWN_KEY).select(
        "company_key", "company_name_clean", "hq_market", "posting_volume_band"
    )
    spread = hiring.groupBy("company_key").agg(
        F.count_distinct("role_family").alias("distinct_role_families"),
        F.count_distinct("market").alias("markets_hiring_in"),
    )
    return hiring.join(spread, "company_key").join(companies, "company_key").select(
        "company_key",
        "company_name_clean",
        "hq_market",
        "posting_volume_band",
        "market",
        "role_family",
        "total_postings",
        "distinct_role_families",
        "markets_hiring_in",
        "most_senior_level_hired",
        "first_posting_seen",
        "last_posting_seen",
    )
