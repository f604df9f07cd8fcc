"""Staging models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.functions.salary import midpoint_strict
from jobweave.operators.dedup import best_per_key, best_wide_per_key, newest_wide_per_key
from jobweave.sources.raw_zone import path_date

POSTING_GRAIN = ["job_id", "ingestion_date"]
SALARY_GRAIN = ["location", "job_title", "salaries_updated_at", "publisher_name"]


def content_hash(raw: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in sorted(raw.columns)])


def newest_record(raw: DataFrame) -> list[Column]:
    """Newest file first; records of one file that share a key are ordered by a hash of their content, not by chance."""
    return [F.col("_file_modified_at").desc_nulls_last(), F.col("_file_path").desc_nulls_last(), content_hash(raw).asc()]


# How stored staging rows are ordered, greatest first; the same order as ``newest_record``.
STORED_ORDER = ["_ingested_at", "_stored_path", "_stored_content"]


def with_stored_order(raw: DataFrame) -> DataFrame:
    """Raw rows with what a later batch needs to tell which record of a key is newer."""
    # The smallest hash comes first, so the greatest complement does.
    return raw.withColumns({"_stored_path": F.col("_file_path"), "_stored_content": F.bitwise_not(content_hash(raw))})


def canonical(column: str) -> Column:
    return F.lower(F.trim(column))


def _known_jobs(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("job_id").isNotNull()).withColumn("ingestion_date", path_date("_file_path"))


def stg_jobs(raw: DataFrame, extra: tuple[str, ...] = (), records: DataFrame | None = None) -> DataFrame:
    """Latest record per job and ingestion day, renamed and typed; ``extra`` columns of the raw record are kept.

    ``records``, if given, has the job_id and _file_path of each raw record, so that the texts are read less often.

    The posting time is UTC by contract, so it is kept without a zone and its
    day does not depend on the session.
    """
    latest = best_wide_per_key(
        _known_jobs(raw), POSTING_GRAIN, newest_record(raw), None if records is None else _known_jobs(records)
    )
    low, high = F.col("job_min_salary"), F.col("job_max_salary")
    posted = F.col("job_posted_at_datetime_utc").try_cast("timestamp_ntz")
    return latest.select(
        "job_id",
        "ingestion_date",
        canonical("job_title").alias("title"),
        F.col("job_description").alias("description"),
        canonical("employer_name").alias("company_name"),
        F.col("employer_website").alias("company_website"),
        F.col("employer_logo").alias("company_logo"),
        F.col("job_city").alias("city"),
        F.col("job_state").alias("state"),
        F.col("job_country").alias("country"),
        F.col("job_latitude").alias("latitude"),
        F.col("job_longitude").alias("longitude"),
        "job_benefits",
        "job_benefits_strings",
        F.lower(
            F.trim(F.coalesce(F.nullif("job_city", F.lit("")), "job_state", "job_country"))
        ).alias("location_name"),
        F.lower(F.coalesce("job_employment_type", F.lit("unknown"))).alias("contract_type"),
        F.col("job_employment_types").alias("contract_types"),
        "job_is_remote",
        low.alias("salary_min"),
        high.alias("salary_max"),
        F.trim(F.upper("job_salary_period")).alias("salary_period"),
        midpoint_strict(low, high).alias("salary_midpoint"),
        posted.cast("date").alias("posted_date"),
        posted.alias("posted_timestamp"),
        F.col("_file_modified_at").alias("_ingested_at"),
        *extra,
    )


def stg_salary_history(raw: DataFrame) -> DataFrame:
    """Latest estimate per place, title, update time and publisher."""
    # The missing-median filter comes after the choice of the latest record.
    return latest_estimates(raw, repeated=True).filter(F.col("median_salary").isNotNull())


def latest_estimates(raw: DataFrame, extra: tuple[str, ...] = (), repeated: bool = False) -> DataFrame:
    """The latest record of each key, also where it takes the median back; ``repeated`` says that ``raw`` is large and keys repeat in it."""
    typed = raw.withColumns(
        {
            "location": canonical("location"),
            "job_title": canonical("job_title"),
            "ingestion_date": path_date("_file_path"),
            "_ingested_at": F.col("_file_modified_at"),
        }
    )
    measures = [
        f"{bound}_{kind}"
        for kind in ("salary", "base_salary", "additional_pay")
        for bound in ("min", "max", "median")
    ]
    if repeated:
        latest = newest_wide_per_key(typed, SALARY_GRAIN, "_file_modified_at", newest_record(typed))
    else:
        latest = best_per_key(typed, SALARY_GRAIN, newest_record(typed))
    return latest.select(
        "job_title",
        "location",
        *measures,
        "salary_period",
        "salary_currency",
        "salary_count",
        "salaries_updated_at",
        "publisher_name",
        "confidence",
        "ingestion_date",
        "_ingested_at",
        *extra,
    )
