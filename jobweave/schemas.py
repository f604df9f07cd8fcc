"""Explicit schemas; no source is ever inferred."""

from pyspark.sql import types as T

_STR = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


POSTING = _struct(
    job_id=_STR,
    job_title=_STR,
    job_description=_STR,
    employer_name=_STR,
    employer_website=_STR,
    employer_logo=_STR,
    job_publisher=_STR,
    job_employment_type=_STR,
    job_employment_types=T.ArrayType(_STR),
    job_is_remote=T.BooleanType(),
    job_posted_at_datetime_utc=_STR,
    job_city=_STR,
    job_state=_STR,
    job_country=_STR,
    job_latitude=T.DoubleType(),
    job_longitude=T.DoubleType(),
    job_benefits=T.ArrayType(_STR),
    job_benefits_strings=T.ArrayType(_STR),
    job_salary_period=_STR,
    job_min_salary=T.DoubleType(),
    job_max_salary=T.DoubleType(),
)

ESTIMATE = _struct(
    location=_STR,
    job_title=_STR,
    min_salary=T.DoubleType(),
    max_salary=T.DoubleType(),
    median_salary=T.DoubleType(),
    min_base_salary=T.DoubleType(),
    max_base_salary=T.DoubleType(),
    median_base_salary=T.DoubleType(),
    min_additional_pay=T.DoubleType(),
    max_additional_pay=T.DoubleType(),
    median_additional_pay=T.DoubleType(),
    salary_period=_STR,
    salary_currency=_STR,
    salary_count=T.LongType(),
    salaries_updated_at=_STR,
    publisher_name=_STR,
    confidence=_STR,
)

FETCH_LOG = _struct(
    endpoint=_STR,
    query=_STR,
    ingestion_date=T.DateType(),
    page=T.IntegerType(),
    records=T.LongType(),
    failed=T.BooleanType(),
    error=_STR,
    started_at=T.TimestampNTZType(),
    finished_at=T.TimestampNTZType(),
)

TITLE_FAMILY = _struct(
    title_normalized=_STR,
    role_family=_STR,
    role_subfamily=_STR,
    is_technical=T.BooleanType(),
    is_management=T.BooleanType(),
)

ENRICHMENT = _struct(
    job_id=_STR,
    content_hash=_STR,
    role_family=_STR,
    seniority=_STR,
    skills_required=T.ArrayType(_STR),
    skills_preferred=T.ArrayType(_STR),
    confidence=_STR,
    model_version=_STR,
    prompt_version=_STR,
    extracted_at=_STR,
    raw_response=_STR,
    parse_status=_STR,
)
