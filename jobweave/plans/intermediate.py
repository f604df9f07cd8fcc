"""Intermediate models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.functions import company, keys, location, quality, salary, skills, title
from jobweave.functions.signals import days_between
from jobweave.operators.dedup import best_per_key, marks
from jobweave.operators.incremental import upsert_keeping_span
from jobweave.operators.similar import classify_pairs, similar_pairs
from jobweave.sources.tables import stage

ESTIMATE_GRAIN = ["title_normalized", "location_key", "salary_currency", "ingestion_date"]
STORED_FLAGS = [f"skill_{s}" for s in skills.STORED_SKILLS]
JOB_COLUMNS = [
    "job_id",
    "company_key",
    "location_key",
    "job_title_key",
    "date_posted_key",
    "date_first_seen_key",
    "title",
    "title_normalized",
    "company_name_clean",
    "company_website",
    "company_logo",
    "city_clean",
    "state_clean",
    "country_clean",
    "work_arrangement",
    "seniority_level",
    "seniority_rank",
    "employment_type",
    "has_salary_disclosed",
    "salary_min_annualized",
    "salary_max_annualized",
    "salary_midpoint_annual",
    *STORED_FLAGS,
    "skill_count",
    "days_active",
    "posting_count",
    "location_quality",
    "is_title_unknown",
    "is_company_unknown",
    "record_quality",
    "first_seen_at",
    "last_seen_at",
    "last_ingested_at",
]


def int_jobs_enriched(stg: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """One enriched row per job, or per job_id in ``among``: its newest version with the span over all its versions.

    Every derived column depends on its own row or on the span only. The newest
    versions are found on narrow columns; the scan then leaves out most others and
    searches the texts that pass, so no text is shuffled, and the exact choice
    is made from enriched rows.
    """
    newest = ["_ingested_at", "ingestion_date"]
    stg = stg.filter(F.col("job_id").isNotNull())
    spans = stg.groupBy("job_id").agg(
        F.min("_ingested_at").alias("first_seen_at"),
        F.max("_ingested_at").alias("last_seen_at"),
    )
    if among is not None:
        # The jobs of the result are those of the spans, so no version has to be joined to leave out the others.
        spans = spans.join(among, "job_id", "left_semi")
    spans = stage(spans, "job-spans")
    last = marks(spans.select("job_id", "last_seen_at"))
    rows = _enriched_versions(stg if last is None else stg.filter(last("job_id", "_ingested_at")))
    latest = best_per_key(rows, ["job_id"], [F.col(c).desc() for c in newest])
    return _with_span(latest.join(spans, "job_id"))


def _enriched_versions(stg: DataFrame) -> DataFrame:
    """What follows from a version of a job alone, and which version it is."""
    df = stg.withColumns(
        {
            "company_name_clean": company.employer_name_normalization("company_name"),
            "title_normalized": title.normalize_job_title("title"),
            "work_arrangement": location.work_arrangement("job_is_remote", "description"),
            "location_quality": location.location_quality("job_is_remote", "city", "country"),
            "location_key": location.location_key("city", "country"),
            "salary_min_annualized": salary.annualize_posting("salary_min", "salary_period"),
            "salary_max_annualized": salary.annualize_posting("salary_max", "salary_period"),
        }
    )
    df = df.withColumns(
        {
            "company_key": company.company_key("company_name", "company_name_clean"),
            "job_title_key": keys.job_title_key("title_normalized"),
            "seniority_level": title.derive_seniority_level("title_normalized"),
        }
    )
    df = skills.with_skill_flags(df, "description", keep=list(skills.STORED_SKILLS))
    return df.select(
        "job_id",
        "company_key",
        "location_key",
        "job_title_key",
        keys.date_key("posted_timestamp").alias("date_posted_key"),
        "title",
        "title_normalized",
        "company_name_clean",
        "company_website",
        "company_logo",
        location.tidy("city").alias("city_clean"),
        location.tidy("state").alias("state_clean"),
        location.tidy("country").alias("country_clean"),
        "work_arrangement",
        "seniority_level",
        title.derive_seniority_rank("seniority_level").alias("seniority_rank"),
        quality.employment_type("contract_type").alias("employment_type"),
        salary.has_salary("salary_min", "salary_max").alias("has_salary_disclosed"),
        "salary_min_annualized",
        "salary_max_annualized",
        salary.midpoint_zero_filled("salary_min_annualized", "salary_max_annualized").alias(
            "salary_midpoint_annual"
        ),
        *STORED_FLAGS,
        "skill_count",
        F.lit(1).alias("posting_count"),
        "location_quality",
        quality.is_unknown_title("job_title_key").alias("is_title_unknown"),
        quality.is_unknown_key("company_key").alias("is_company_unknown"),
        quality.posting_quality("location_quality", "job_title_key", "company_key").alias("record_quality"),
        "_ingested_at",
        "ingestion_date",
    )


def _with_span(jobs: DataFrame) -> DataFrame:
    """Enriched jobs in the order of their columns, with what follows from the span."""
    derived = {
        "date_first_seen_key": keys.date_key("first_seen_at"),
        "days_active": days_between("last_seen_at", "first_seen_at"),
        "last_ingested_at": F.col("_ingested_at"),
    }
    return jobs.withColumns(derived).select(*JOB_COLUMNS)


def merge_jobs(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored jobs with a newer batch merged in.

    A job seen before keeps its first sighting, and what is derived from the
    span is derived again.
    """
    merged = upsert_keeping_span(target, batch, ["job_id"], "first_seen_at", "last_seen_at")
    return merged.withColumns(
        {
            "days_active": days_between("last_seen_at", "first_seen_at"),
            "date_first_seen_key": keys.date_key("first_seen_at"),
        }
    ).select(*target.columns)


def int_job_titles_normalized(stg: DataFrame) -> DataFrame:
    """Distinct normalized titles with the least raw title as representative.

    Titles repeat a lot, so they are reduced before they are cleaned. Cleaning
    the ``min`` of each group, which is the title itself, keeps it that way:
    Spark would drop a plain distinct below a ``min`` and would push the test of
    the cleaned title below the grouping, cleaning every posting's title.
    """
    raw = stg.filter(title.is_valid_title("title")).groupBy("title").agg(F.min("title").alias("_raw"))
    cleaned = raw.select("_raw", title.normalize_job_title("_raw").alias("title_normalized"))
    return (
        cleaned.filter(F.length("title_normalized") > 2)
        .groupBy("title_normalized")
        .agg(F.min("_raw").alias("title_raw_representative"))
    )


def with_estimate_grain(stg: DataFrame) -> DataFrame:
    """Staged estimates with the columns of ``ESTIMATE_GRAIN`` and the parts of their location."""
    return stg.withColumns(
        {
            "title_normalized": title.normalize_job_title("job_title"),
            "_parts": location.split_location("location"),
            "salary_currency": F.coalesce("salary_currency", F.lit(salary.DEFAULT_CURRENCY)),
        }
    ).withColumn("location_key", location.parsed_location_key("_parts"))


def int_salary_estimates(stg: DataFrame) -> DataFrame:
    """Best estimate per title, location, currency and day.

    Only the grain and the ranking columns are needed to choose a row, so the
    measures are derived after the choice.
    """
    df = with_estimate_grain(stg)
    level = F.lower("confidence")
    rank = F.when(level == "high", 1).when(level == "medium", 2).otherwise(3)
    df = best_per_key(
        df,
        ESTIMATE_GRAIN,
        [
            rank.asc(),
            F.coalesce("salary_count", F.lit(0)).desc(),
            F.col("_ingested_at").desc(),
            F.col("publisher_name").asc_nulls_last(),
            F.col("job_title").asc(),
            F.col("location").asc(),
            F.col("salaries_updated_at").desc_nulls_last(),
        ],
    )

    def yearly(column: str) -> Column:
        return salary.annualize_estimate(column, "salary_period")

    df = df.withColumns(
        {
            "job_title_key": keys.job_title_key("title_normalized", "job_title"),
            "salary_min_annual": yearly("min_salary"),
            "salary_median_annual": yearly("median_salary"),
            "salary_max_annual": yearly("max_salary"),
            "base_salary_min_annual": yearly("min_base_salary"),
            "base_salary_median_annual": yearly("median_base_salary"),
            "base_salary_max_annual": yearly("max_base_salary"),
            "additional_pay_median_annual": yearly("median_additional_pay"),
        }
    )
    low, mid, high = "salary_min_annual", "salary_median_annual", "salary_max_annual"
    df = df.withColumn("salary_range_width", salary.range_width(low, high))
    df = df.withColumn("salary_range_pct", salary.percent_of("salary_range_width", mid, 1))
    df = df.withColumn(
        "estimate_reliability",
        salary.estimate_reliability("confidence", "salary_count", mid, "salary_range_pct"),
    )
    return df.select(
        keys.salary_estimate_key(*ESTIMATE_GRAIN).alias("salary_estimate_key"),
        "job_title_key",
        "location_key",
        keys.date_key("ingestion_date").alias("date_key"),
        "job_title",
        "title_normalized",
        title.derive_seniority_level("title_normalized").alias("seniority_level"),
        "location",
        location.parsed_city("_parts").alias("city"),
        location.parsed_region("_parts").alias("region"),
        location.parsed_country("_parts").alias("country"),
        location.location_resolution("_parts").alias("location_resolution"),
        "salary_period",
        "salary_currency",
        "publisher_name",
        "salaries_updated_at",
        low,
        mid,
        high,
        salary.midpoint_zero_filled(low, high).alias("salary_midpoint_annual"),
        "salary_range_width",
        "salary_range_pct",
        salary.salary_bucket(mid, "salary_currency").alias("salary_bucket"),
        "base_salary_min_annual",
        "base_salary_median_annual",
        "base_salary_max_annual",
        salary.salary_bucket("base_salary_median_annual", "salary_currency").alias("base_salary_bucket"),
        "additional_pay_median_annual",
        salary.percent_of("additional_pay_median_annual", mid, 1).alias("additional_pay_pct"),
        "salary_count",
        "confidence",
        "estimate_reliability",
        quality.is_unknown_title("job_title_key").alias("is_title_unknown"),
        quality.is_unknown_key("location_key").alias("is_location_unknown"),
        quality.estimate_quality("location_key", "job_title_key", mid, "estimate_reliability").alias(
            "record_quality"
        ),
        "ingestion_date",
        "_ingested_at",
    )


def int_company_duplicates(dim_company: DataFrame, min_postings: int = 2) -> DataFrame:
    """Probable duplicate companies among those with at least ``min_postings`` postings; 1 compares all."""
    companies = dim_company.filter(
        (F.col("company_key") != keys.UNKNOWN_KEY)
        & (F.col("company_name_clean") != "Unknown")
        & (F.col("total_postings") >= min_postings)
    )
    pairs = similar_pairs(companies, "company_key", "company_name_clean")
    return classify_pairs(pairs, companies)


def actionable_order() -> list[Column]:
    """Most actionable pairs first."""
    rank = F.when(F.col("match_confidence") == "high", 1).when(F.col("match_confidence") == "medium", 2).otherwise(3)
    return [
        rank.asc(),
        F.col("same_website").desc(),
        F.col("combined_postings").desc(),
        F.col("similarity_pct").desc(),
        F.col("key_a").asc(),
        F.col("key_b").asc(),
    ]
