"""All models in dependency order."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from jobweave.plans import dimensions, facts, intermediate, marts, staging
from jobweave.sources.tables import materialize_table, stage


class Warehouse:
    """Models over one pair of raw inputs.

    ``keep`` stores the models with several readers: the enriched postings, the
    estimates and the dimensions. Everything else stays a plan until it is read.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw_postings: DataFrame,
        raw_estimates: DataFrame,
        keep: Callable[[DataFrame, str], DataFrame] = stage,
    ) -> None:
        self.spark = spark
        self.raw_postings = raw_postings
        self.raw_estimates = raw_estimates
        self._keep = keep

    @cached_property
    def stg_jobs(self) -> DataFrame:
        return staging.stg_jobs(self.raw_postings)

    @cached_property
    def stg_salary_history(self) -> DataFrame:
        return staging.stg_salary_history(self.raw_estimates)

    @cached_property
    def int_jobs_enriched(self) -> DataFrame:
        return self._keep(intermediate.int_jobs_enriched(self.stg_jobs), "int_jobs_enriched")

    @cached_property
    def int_salary_estimates(self) -> DataFrame:
        return self._keep(intermediate.int_salary_estimates(self.stg_salary_history), "int_salary_estimates")

    @cached_property
    def int_job_titles_normalized(self) -> DataFrame:
        return intermediate.int_job_titles_normalized(self.stg_jobs)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.spark)

    @cached_property
    def dim_job_title(self) -> DataFrame:
        return self._keep(dimensions.dim_job_title(self.int_job_titles_normalized), "dim_job_title")

    @cached_property
    def dim_location(self) -> DataFrame:
        return self._keep(
            dimensions.dim_location(self.int_jobs_enriched, self.int_salary_estimates), "dim_location"
        )

    @cached_property
    def dim_company(self) -> DataFrame:
        return self._keep(dimensions.dim_company(self.int_jobs_enriched), "dim_company")

    @cached_property
    def int_company_duplicates(self) -> DataFrame:
        return intermediate.int_company_duplicates(self.dim_company)

    @cached_property
    def fct_job_postings(self) -> DataFrame:
        return facts.fct_job_postings(
            self.int_jobs_enriched, self.dim_job_title, self.dim_location, self.dim_company
        )

    @cached_property
    def fct_job_posting_skills(self) -> DataFrame:
        return facts.fct_job_posting_skills(self.int_jobs_enriched)

    @cached_property
    def fct_salary_estimates(self) -> DataFrame:
        return facts.fct_salary_estimates(self.int_salary_estimates, self.dim_job_title, self.dim_location)

    @cached_property
    def mart_job_market_benchmarks(self) -> DataFrame:
        return marts.mart_job_market_benchmarks(
            self.fct_job_postings, self.fct_salary_estimates, self.dim_job_title, self.dim_location
        )

    @cached_property
    def mart_salary_trends(self) -> DataFrame:
        return marts.mart_salary_trends(
            self.fct_salary_estimates, self.dim_job_title, self.dim_location, self.dim_date
        )

    @cached_property
    def mart_skill_demand(self) -> DataFrame:
        return marts.mart_skill_demand(
            self.fct_job_posting_skills,
            self.fct_job_postings,
            self.dim_job_title,
            self.dim_location,
            self.int_jobs_enriched,
        )

    @cached_property
    def mart_company_hiring(self) -> DataFrame:
        return marts.mart_company_hiring(
            self.fct_job_postings, self.dim_company, self.dim_job_title, self.dim_location
        )


TABLES = [
    "stg_jobs",
    "stg_salary_history",
    "int_jobs_enriched",
    "int_job_titles_normalized",
    "int_salary_estimates",
    "dim_date",
    "dim_job_title",
    "dim_location",
    "dim_company",
    "int_company_duplicates",
    "fct_job_postings",
    "fct_job_posting_skills",
    "fct_salary_estimates",
    "mart_job_market_benchmarks",
    "mart_salary_trends",
    "mart_skill_demand",
    "mart_company_hiring",
]


def build_all(
    spark: SparkSession, raw_postings: DataFrame, raw_estimates: DataFrame, root: str
) -> dict[str, DataFrame]:
    """Write every model below ``root`` in order; later models read the stored ones."""
    warehouse = Warehouse(spark, raw_postings, raw_estimates, keep=lambda df, name: df)
    stored: dict[str, DataFrame] = {}
    for name in TABLES:
        stored[name] = materialize_table(getattr(warehouse, name), f"{root}/{name}")
        warehouse.__dict__[name] = stored[name]
    return stored
