"""Facts (N11-N13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.functions import keys
from jobweave.functions.skills import STORED_SKILLS
from jobweave.operators.joins import validate_foreign_key
from jobweave.operators.reshape import unpivot_flags


def fct_job_postings(
    jobs: DataFrame, dim_job_title: DataFrame, dim_location: DataFrame, dim_company: DataFrame
) -> DataFrame:
    """One row per job whose keys all exist in the dimensions."""
    df = validate_foreign_key(jobs, dim_job_title, "job_title_key", keys.UNKNOWN_TITLE_KEY, "job_id")
    df = validate_foreign_key(df, dim_location, "location_key", keys.UNKNOWN_KEY, "job_id")
    df = validate_foreign_key(df, dim_company, "company_key", keys.UNKNOWN_KEY, "job_id")
    return df.select(
        "job_id",
        "job_title_key",
        "location_key",
        "company_key",
        "date_posted_key",
        "date_first_seen_key",
        keys.date_key("last_seen_at").alias("date_last_seen_key"),
        "employment_type",
        "work_arrangement",
        "seniority_level",
        "seniority_rank",
        "has_salary_disclosed",
        "salary_min_annualized",
        "salary_max_annualized",
        "salary_midpoint_annual",
        "days_active",
        "posting_count",
        "location_quality",
        "record_quality",
        "is_title_unknown",
        "is_company_unknown",
        "first_seen_at",
        "last_seen_at",
        "last_ingested_at",
    )


def fct_job_posting_skills(jobs: DataFrame) -> DataFrame:
    """One row per job and stored skill found in it."""
    source = jobs.select(
        "job_id",
        "job_title_key",
        "location_key",
        F.col("date_first_seen_key").alias("date_key"),
        "seniority_level",
        "work_arrangement",
        "record_quality",
        "skill_count",
        *[f"skill_{s}" for s in STORED_SKILLS],
    )
    return unpivot_flags(source, STORED_SKILLS).select(
        keys.pair_key("job_id", "skill_name").alias("job_skill_key"),
        "job_id",
        "job_title_key",
        "location_key",
        "date_key",
        "skill_name",
        "skill_category",
        "seniority_level",
        "work_arrangement",
        "record_quality",
        "skill_count",
    )


def fct_salary_estimates(estimates: DataFrame, dim_job_title: DataFrame, dim_location: DataFrame) -> DataFrame:
    df = validate_foreign_key(
        estimates, dim_job_title, "job_title_key", keys.UNKNOWN_TITLE_KEY, "salary_estimate_key"
    )
    df = validate_foreign_key(df, dim_location, "location_key", keys.UNKNOWN_KEY, "salary_estimate_key")
    return df.select(
        "salary_estimate_key",
        "job_title_key",
        "location_key",
        "date_key",
        "seniority_level",
        "salary_period",
        "salary_currency",
        "location_resolution",
        "publisher_name",
        "salary_min_annual",
        "salary_median_annual",
        "salary_max_annual",
        "salary_midpoint_annual",
        "salary_range_width",
        "salary_range_pct",
        "salary_bucket",
        "base_salary_min_annual",
        "base_salary_median_annual",
        "base_salary_max_annual",
        "base_salary_bucket",
        "additional_pay_median_annual",
        "additional_pay_pct",
        "salary_count",
        "confidence",
        "estimate_reliability",
        "record_quality",
        "is_title_unknown",
        "is_location_unknown",
        "salaries_updated_at",
        "ingestion_date",
        "_ingested_at",
    )
