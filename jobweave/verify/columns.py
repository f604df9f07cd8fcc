"""Row filters and column operators (B, C, G4) as queries.

Each reads the derived postings or estimates as a whole and keeps
``ingest_seq``, which identifies a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.functions import company, keys, location, quality, roles, salary, signals, skills, title
from jobweave.functions.salary import midpoint_strict
from jobweave.operators.similar import classify_pairs, similar_pairs
from jobweave.operators.trend import sliced_windows
from jobweave.plans import marts, staging
from jobweave.plans.enrichment import MAX_DESCRIPTION, has_required_fields, prompt_text
from jobweave.sources.tables import stage
from jobweave.verify import dialect as d
from jobweave.verify import inputs
from jobweave.verify.inputs import INPUT_SQL, table
from jobweave.verify.models import duplicate_pairs
from jobweave.verify.registry import query


def _columns(
    name: str,
    source: str,
    columns: dict[str, tuple[Callable[[], Column], str]],
    where: tuple[Callable[[], Column], str] | None = None,
    first: dict[str, Callable[[], Column]] | None = None,
) -> None:
    """Register a projection of a derived input, in Spark and in SQL.

    Columns come as functions, since building one needs a running session.
    ``first`` names columns that several others use, so each is computed once.
    """
    selected = ", ".join(f"{sql} as {alias}" for alias, (_, sql) in columns.items())
    condition = f" where {where[1]}" if where else ""

    @query(name, f"{INPUT_SQL} select ingest_seq, {selected} from {source}{condition}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(inputs, source)(spark, sf_dir)
        for alias, make in (first or {}).items():
            df = df.withColumn(alias, make())
        if where:
            df = df.filter(where[0]())
        return df.select("ingest_seq", *[make().alias(alias) for alias, (make, _) in columns.items()])


c = F.col

# --- B: projections, filters, predicates -------------------------------------------------

_columns("b1_rename_cast", "estimates", {
    "salary_count_text": (lambda: c("salary_count").cast("string"), "cast(salary_count as varchar)"),
    "updated_on": (lambda: c("salaries_updated_at").try_cast("date"), "try_cast(salaries_updated_at as date)"),
    "salary_whole": (lambda: c("max_salary").cast("bigint"), "cast(trunc(max_salary) as bigint)"),
    "publisher": (lambda: c("publisher_name"), "publisher_name"),
})
_columns("b2_text_canonical", "postings", {
    "title": (lambda: staging.canonical("job_title"), "lower(trim(job_title))"),
    "company": (lambda: location.tidy("employer_name"), d.tidy("employer_name")),
    "period": (lambda: F.trim(F.upper("job_salary_period")), "trim(upper(job_salary_period))"),
})
_columns("b3_fallback_chain", "postings", {
    "location_name": (lambda: 
        F.lower(F.trim(F.coalesce(F.nullif("job_city", F.lit("")), "job_state", "job_country"))),
        "lower(trim(coalesce(nullif(job_city, ''), job_state, job_country)))",
    ),
})
_columns("b4_default_fill", "postings", {
    "contract_type": (lambda: 
        F.lower(F.coalesce("job_employment_type", F.lit("unknown"))), "lower(coalesce(job_employment_type, 'unknown'))"
    ),
    "min_salary": (lambda: F.coalesce("job_min_salary", F.lit(0.0)), "coalesce(job_min_salary, 0.0::double)"),
})


@query(
    "b5_drop_and_readd",
    f"{INPUT_SQL} select * exclude (salary_currency, salary_period, ingestion_date, seen_at), "
    "coalesce(salary_currency, 'USD') as salary_currency, lower(salary_period) as salary_period from estimates",
)
def b5(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = inputs.estimates(spark, sf_dir).drop(
        "min_additional_pay", "max_additional_pay", "_file_path", "_file_modified_at"
    )
    kept = df.drop("salary_currency", "salary_period").columns
    return df.select(
        *kept,
        F.coalesce("salary_currency", F.lit(salary.DEFAULT_CURRENCY)).alias("salary_currency"),
        F.lower("salary_period").alias("salary_period"),
    )


_columns("b6_not_null_filter", "estimates", {"median_salary": (lambda: c("median_salary"), "median_salary")},
         (lambda: c("median_salary").isNotNull(), "median_salary is not null"))

_code = lambda: (
    F.when(c("ingest_seq") % 17 == 0, F.concat(F.lit("req-"), c("ingest_seq").cast("string")))
    .when(c("ingest_seq") % 19 == 0, F.lit("vp"))
    .otherwise(F.lower("job_title"))
)
_code_sql = (
    "case when ingest_seq % 17 = 0 then 'req-' || cast(ingest_seq as varchar) "
    "when ingest_seq % 19 = 0 then 'vp' else lower(job_title) end"
)
_columns("b7_title_validity", "postings", {"title": (lambda: _code(), _code_sql)}, (lambda:
    title.is_valid_title(_code()),
    f"length(trim({_code_sql})) > 2 and not regexp_matches({_code_sql}, '(?i)^[A-Z]{{2,}}-[0-9]+')",
))
_columns("b8_like_any", "postings", {"job_id": (lambda: c("job_id"), "job_id")}, (lambda:
    F.lower("job_description").contains("hybrid") | F.lower("job_description").contains("on-site"),
    "lower(job_description) like '%hybrid%' or lower(job_description) like '%on-site%'",
))
_columns("b9_set_membership", "postings", {"period": (lambda: c("job_salary_period"), "job_salary_period")}, (lambda:
    c("job_country").isin("Kenya", "US") & ~c("job_salary_period").isin("HOURLY", "DAILY"),
    "job_country in ('Kenya', 'US') and job_salary_period not in ('HOURLY', 'DAILY')",
))
_columns("b10_prefix", "postings", {"country": (lambda: c("job_country"), "job_country")},
         (lambda: F.upper("job_country").startswith("UNITED"), "upper(job_country) like 'UNITED%'"))

_company_key = lambda: company.company_key("employer_name", company.employer_name_normalization("employer_name"))
_company_key_sql = f"case when employer_name is null then '-1' else md5({d.employer('employer_name')}) end"
_columns("b11_exclude_unknown", "postings", {"company_key": (lambda: _company_key(), _company_key_sql)},
         (lambda: _company_key() != keys.UNKNOWN_KEY, f"{_company_key_sql} <> '-1'"))


@query(
    "b12_one_side_exists",
    """select coalesce(p.k, s.k) as custkey, p.total as open_total, s.total as filled_total
       from (select o_custkey as k, count(*) as total from orders where o_orderstatus = 'O' group by 1) p
       full outer join (select o_custkey as k, count(*) as total from orders where o_orderstatus = 'F'
                        and o_totalprice > 300000 group by 1) s on p.k = s.k
       where p.total > 3 or s.total is not null""",
)
def b12(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "custkey")
    opened = orders.filter(c("o_orderstatus") == "O").groupBy("custkey").agg(F.count("*").alias("open_total"))
    filled = orders.filter((c("o_orderstatus") == "F") & (c("o_totalprice") > 300000))
    filled = filled.groupBy("custkey").agg(F.count("*").alias("filled_total"))
    both = opened.join(filled, "custkey", "full_outer")
    return both.filter((c("open_total") > 3) | c("filled_total").isNotNull())


_prepared = {
    "_place": lambda: location.location_quality("job_is_remote", "job_city", "job_country"),
    "_title_key": lambda: keys.job_title_key(title.normalize_job_title("job_title")),
    "_company": lambda: _company_key(),
}
_quality_col = lambda: quality.posting_quality("_place", "_title_key", "_company")
_quality_sql = d.posting_quality(
    f"({d.place_quality('job_is_remote', 'job_city', 'job_country')})",
    f"({d.title_key(d.norm_title('job_title'))})",
    f"({_company_key_sql})",
)


_plain_quality_sql = d.posting_quality(
    f"({d.place_quality('job_is_remote', 'job_city', 'job_country')})",
    f"({d.title_key('job_title')})",
    f"({_company_key_sql})",
)


@query(
    "b13_quality_gate",
    f"{INPUT_SQL} select ingest_seq, record_quality from (select ingest_seq, {_plain_quality_sql} as record_quality "
    "from postings) where record_quality in ('high', 'medium')",
)
def b13(spark: SparkSession, sf_dir: str) -> DataFrame:
    record_quality = quality.posting_quality(
        location.location_quality("job_is_remote", "job_city", "job_country"),
        keys.job_title_key("job_title"),
        _company_key(),
    )
    df = inputs.postings(spark, sf_dir).select("ingest_seq", record_quality.alias("record_quality"))
    return marts.good_quality(df, ["high", "medium"])


_columns("b15_required_fields", "postings", {"job_id": (lambda: c("job_id"), "job_id")}, (lambda:
    has_required_fields("job_id", "job_title", "job_description", "employer_name"),
    "job_id <> '' and job_title <> '' and job_description <> '' and employer_name <> ''",
))
_columns("b16_constants", "postings", {"posting_count": (lambda: F.lit(1), "1"), "source": (lambda: F.lit("jobs"), "'jobs'")})

# --- C: domain columns -------------------------------------------------------------------

_title = lambda: title.normalize_job_title("job_title")
_title_sql = d.norm_title("job_title")
_columns("c1_normalize_job_title", "postings", {"title_normalized": (lambda: _title(), _title_sql)})
_columns("c2_seniority_level", "postings",
         {"seniority_level": (lambda: title.derive_seniority_level("_t"), d.seniority(_title_sql))},
         first={"_t": lambda: _title()})
_columns("c3_seniority_rank", "postings", {
    "seniority_rank": (lambda: 
        title.derive_seniority_rank("_level"),
        d.seniority_rank(f"({d.seniority(_title_sql)})"),
    ),
}, first={"_t": lambda: _title(), "_level": lambda: title.derive_seniority_level("_t")})
_columns("c4_employer_name", "postings", {
    "company_name_clean": (lambda: company.employer_name_normalization("employer_name"), d.employer("employer_name")),
})

# Words that do occur in the documents, beside fixed skills with awkward spelling.
TEXT_TERMS = {
    "the": ["the"],
    "of_the": ["of the", "by the"],
    "french": ["le", "la", "les"],
    "german": ["der", "die", "und"],
    "r": skills.SKILL_TERMS["r"],
    "csharp": skills.SKILL_TERMS["csharp"],
    "cicd": skills.SKILL_TERMS["cicd"],
    "spark": skills.SKILL_TERMS["spark"],
    "sql": skills.SKILL_TERMS["sql"],
}
_columns("c5_skill_flag", "postings", {
    f"skill_{n}": (lambda t=t: skills.skill_flag("_low", t, lowered=True), d.skill("job_description", t))
    for n, t in TEXT_TERMS.items()
}, first={"_low": lambda: F.lower("job_description")})


@query(
    "c6_skill_count",
    f"{INPUT_SQL} select ingest_seq, {d.skill_count('job_description', skills.SKILL_TERMS)} as skill_count, "
    f"{d.skill_count('job_description', TEXT_TERMS)} as word_count from postings",
)
def c6(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = inputs.postings(spark, sf_dir).select("ingest_seq", "job_description")
    df = skills.with_found_skills(df, "job_description", "_skills", also={"_words_found": TEXT_TERMS})
    return df.select(
        "ingest_seq", F.size("_skills").alias("skill_count"), F.size("_words_found").alias("word_count")
    )


_columns("c7_work_arrangement", "postings", {
    "work_arrangement": (lambda: 
        location.work_arrangement("job_is_remote", "job_description"),
        d.arrangement("job_is_remote", "job_description"),
    ),
})
_columns("c8_location_quality", "postings", {
    "location_quality": (lambda: 
        location.location_quality("job_is_remote", "job_city", "job_country"),
        d.place_quality("job_is_remote", "job_city", "job_country"),
    ),
})
_columns("c9_company_key", "postings", {"company_key": (lambda: _company_key(), _company_key_sql)})
_columns("c10_location_key", "postings", {
    "location_key": (lambda: location.location_key("job_city", "job_country"), d.place_key("job_city", "job_country")),
})
_parts = lambda: location.split_location("location")
_place = d.parsed("location")
_columns("c11_location_parse", "estimates", {
    "city": (lambda: location.parsed_city(_parts()), _place["city"]),
    "region": (lambda: location.parsed_region(_parts()), _place["region"]),
    "country": (lambda: location.parsed_country(_parts()), _place["country"]),
})
_columns("c12_location_key_parsed", "estimates",
         {"location_key": (lambda: location.parsed_location_key(_parts()), _place["key"])})
_columns("c13_location_resolution", "estimates",
         {"location_resolution": (lambda: location.location_resolution(_parts()), _place["resolution"])})
_columns("c14_title_key", "estimates", {
    "job_title_key": (lambda: 
        keys.job_title_key(_title(), "job_title"),
        f"case when job_title is null or length(trim(job_title)) <= 2 then cast(-1 as bigint) "
        f"else {d.hash_title(_title_sql)} end",
    ),
})
_columns("c15_estimate_key", "estimates", {
    "salary_estimate_key": (lambda: 
        keys.salary_estimate_key(
            _title(), location.parsed_location_key(_parts()), "salary_currency", c("_file_modified_at").cast("date")
        ),
        f"md5(concat_ws('||', coalesce({_title_sql}, 'unknown'), {_place['key']}, "
        "coalesce(salary_currency, 'USD'), cast(ingestion_date as varchar)))",
    ),
})
_columns("c16_pair_key", "postings", {
    "job_skill_key": (lambda: keys.pair_key("job_id", "job_title"), "md5(concat_ws('||', job_id, job_title))"),
})
_columns("c17_date_key", "postings", {
    "date_key": (lambda: keys.date_key("_file_modified_at"), d.date_key("seen_at")),
})
_columns("c18_annualize_posting", "postings", {
    "salary_min_annualized": (lambda: 
        salary.annualize_posting("job_min_salary", "job_salary_period"),
        d.annual_posting("job_min_salary", "job_salary_period"),
    ),
    "salary_max_annualized": (lambda: 
        salary.annualize_posting("job_max_salary", "job_salary_period"),
        d.annual_posting("job_max_salary", "job_salary_period"),
    ),
})
MEASURES = [
    "min_salary", "median_salary", "max_salary", "min_base_salary", "median_base_salary", "max_base_salary",
    "median_additional_pay",
]
_columns("c19_annualize_estimate", "estimates", {
    f"{m}_annual": (lambda m=m: salary.annualize_estimate(m, "salary_period"), d.annual_estimate(m, "salary_period"))
    for m in MEASURES
})
_columns("c20_has_salary", "postings", {
    "has_salary_disclosed": (lambda: 
        salary.has_salary("job_min_salary", "job_max_salary"),
        "job_min_salary is not null and job_max_salary is not null",
    ),
})
_columns("c21_midpoint_strict", "postings", {
    "salary_midpoint": (lambda: 
        midpoint_strict("job_min_salary", "job_max_salary"),
        "case when job_min_salary is not null and job_max_salary is not null "
        "then (job_min_salary + job_max_salary) / 2.0::double end",
    ),
})
_columns("c22_midpoint_zero_filled", "postings", {
    "salary_midpoint_annual": (lambda: 
        salary.midpoint_zero_filled("job_min_salary", "job_max_salary"),
        d.midpoint("job_min_salary", "job_max_salary"),
    ),
})
_columns("c23_range", "estimates", {
    "salary_range_width": (lambda: salary.range_width("min_salary", "max_salary"), "max_salary - min_salary"),
    "salary_range_pct": (lambda: 
        salary.percent_of(salary.range_width("min_salary", "max_salary"), "median_salary", 1),
        d.percent("(max_salary - min_salary)", "median_salary", 1),
    ),
})
_columns("c24_additional_pay_pct", "estimates", {
    "additional_pay_pct": (lambda: 
        salary.percent_of("median_additional_pay", "median_salary", 1),
        d.percent("median_additional_pay", "median_salary", 1),
    ),
})
_money = "coalesce(salary_currency, 'USD')"
_yearly = lambda: salary.annualize_estimate("median_salary", "salary_period")
_yearly_sql = f"({d.annual_estimate('median_salary', 'salary_period')})"
_columns("c25_salary_bucket", "estimates", {
    "salary_bucket": (lambda: 
        salary.salary_bucket("median_salary", F.coalesce("salary_currency", F.lit("USD"))),
        d.bucket("median_salary", _money),
    ),
    "yearly_bucket": (lambda: salary.salary_bucket(_yearly(), "salary_currency"), d.bucket(_yearly_sql, "salary_currency")),
})
_spread = lambda: salary.percent_of(salary.range_width("min_salary", "max_salary"), "median_salary", 1)
_spread_sql = f"({d.percent('(max_salary - min_salary)', 'median_salary', 1)})"
_reliability = lambda: salary.estimate_reliability("confidence", "salary_count", "median_salary", _spread())
_reliability_sql = f"({d.reliability('confidence', 'salary_count', 'median_salary', _spread_sql)})"
_columns("c26_estimate_reliability", "estimates", {"estimate_reliability": (lambda: _reliability(), _reliability_sql)})
_columns("c27_posting_quality", "postings", {"record_quality": (lambda: _quality_col(), _quality_sql)},
         first=_prepared)
_key = lambda: keys.job_title_key(_title(), "job_title")
_key_sql = f"({d.title_key(_title_sql)})"
_columns("c28_estimate_quality", "estimates", {
    "record_quality": (lambda: 
        quality.estimate_quality("_place", "_title_key", "median_salary", "_level"),
        d.estimate_quality(f"({_place['key']})", _key_sql, "median_salary", _reliability_sql),
    ),
}, first={
    "_place": lambda: location.parsed_location_key(_parts()),
    "_title_key": lambda: _key(),
    "_level": lambda: _reliability(),
})
_columns("c29_unknown_flags", "postings", {
    "is_title_unknown": (lambda: quality.is_unknown_title(_key()), f"{_key_sql} = -1"),
    "is_company_unknown": (lambda: quality.is_unknown_key(_company_key()), "employer_name is null"),
    "is_location_unknown": (lambda: 
        quality.is_unknown_key(location.location_key("job_city", "job_country")),
        "job_city is null and job_country is null",
    ),
})
_columns("c30_employment_type", "postings", {
    "employment_type": (lambda: quality.employment_type("job_employment_type"), d.employment("job_employment_type")),
})
_country = lambda: location.parsed_country(_parts())
_country_sql = f"({_place['country']})"
_columns("c31_market", "estimates", {
    "company_market": (lambda: company.company_market(_country()), d.company_market(_country_sql)),
    "location_market": (lambda: location.location_market(_country()), d.location_market(_country_sql)),
})
_columns("c32_geo_region", "estimates", {"geo_region": (lambda: location.geo_region(_country()), d.geo_region(_country_sql))})
_columns("c33_benchmark_flag", "estimates", {
    "is_benchmark_market": (lambda: location.is_benchmark_market(_country()), d.benchmark(_country_sql)),
})
CITIES = ("ingest_seq % 6", {0: "Nairobi", 1: "London", 2: "New York", 3: "LEEDS", 4: "Paris"}, None)
_city = lambda: inputs._pick(*CITIES)
_city_sql = f"({inputs._sql_pick(*CITIES)})"
_columns("c34_tech_hub", "postings", {"tech_hub_label": (lambda: location.tech_hub_label(_city()), d.tech_hub(_city_sql))})
_columns("c35_location_completeness", "postings", {
    "location_completeness": (lambda: 
        location.location_completeness("job_city", "job_country"), d.completeness("job_city", "job_country")
    ),
})


@query(
    "c36_volume_band",
    f"{INPUT_SQL}, named as (select {_company_key_sql} as company_key, count(*) as total_postings from postings "
    f"group by 1) select *, {d.volume_band('total_postings')} as posting_volume_band from named",
)
def c36(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = inputs.postings(spark, sf_dir).groupBy(_company_key().alias("company_key")).agg(
        F.count("*").alias("total_postings")
    )
    return counted.withColumn("posting_volume_band", company.posting_volume_band("total_postings"))


ROLES = ("ingest_seq % 24", {
    0: "security architect", 1: "nlp engineer", 2: "edw architect", 3: "etl lead", 4: "applied scientist",
    5: "power bi expert", 6: "front-end engineer", 7: "software test engineer", 8: "sre", 9: "gis engineer",
    10: "pre-sales engineer", 11: "scrum master", 12: "vp of data", 13: "vp", 14: "tech lead",
    15: "civil engineer", 16: "civil engineer ai", 17: "hr partner", 18: "gardener", 19: "vp sales",
    20: "database engineer", 21: "software quality engineer", 22: "chief data officer",
}, None)
_role = lambda: inputs._pick(*ROLES)
_role_sql = f"({inputs._sql_pick(*ROLES)})"
_columns("c37_role_family", "postings", {
    "role_family": (lambda: roles.role_family("_t"), d.role_family(_title_sql)),
    "other_family": (lambda: roles.role_family("_r"), d.role_family(_role_sql)),
}, first={"_t": lambda: _title(), "_r": lambda: _role()})
_columns("c38_role_flags", "postings", {
    "is_management": (lambda: roles.is_management("_t"), d.is_management(_title_sql)),
    "is_technical": (lambda: roles.is_technical("_t"), d.is_technical(_title_sql)),
    "other_is_management": (lambda: roles.is_management("_r"), d.is_management(_role_sql)),
    "other_is_technical": (lambda: roles.is_technical("_r"), d.is_technical(_role_sql)),
}, first={"_t": lambda: _title(), "_r": lambda: _role()})


@query(
    "c39_skill_prominence",
    """select p_brand, pct, case when pct >= 60 then 'core' when pct >= 30 then 'common'
              when pct >= 10 then 'emerging' else 'niche' end as skill_prominence
       from (select p_brand, p_name, round(100.0::double * count(case when p_size > 25 then 1 end) / count(*), 1) as pct
             from part group by all)""",
)
def c39(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = F.count(F.when(c("p_size") > 25, 1))
    part = table(spark, sf_dir, "part").groupBy("p_brand", "p_name")
    shares = part.agg(F.round(F.lit(100.0) * large / F.count("*"), 1).alias("pct"))
    return shares.select("p_brand", "pct", signals.skill_prominence("pct").alias("skill_prominence"))


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer and priority as snapshots, for series of any length."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice", c("o_orderdate").cast("date").alias("day")
    )
    return sliced_windows(
        orders,
        ["o_custkey", "o_orderpriority"],
        ["day", "o_orderkey"],
        F.trunc("day", "quarter"),
        lags={"prev_value": "o_totalprice", "prev_day": "day"},
        firsts={"first_value": "o_totalprice", "first_day": "day"},
    )


SERIES_SQL = """
with series as (
    select o_custkey, o_orderpriority, o_orderkey, o_totalprice, cast(o_orderdate as date) as day,
           lag(o_totalprice) over w as prev_value, lag(cast(o_orderdate as date)) over w as prev_day,
           first_value(o_totalprice) over w as first_value, first_value(cast(o_orderdate as date)) over w as first_day,
           cast(row_number() over w as int) as snapshot_number,
           count(*) over (partition by o_custkey, o_orderpriority) as total_snapshots
    from orders
    window w as (partition by o_custkey, o_orderpriority order by cast(o_orderdate as date), o_orderkey)
)"""


@query(
    "c40_trend_direction",
    f"{SERIES_SQL} select o_orderkey, {d.trend('o_totalprice', 'prev_value')} as trend_direction from series",
)
def c40(spark: SparkSession, sf_dir: str) -> DataFrame:
    direction = signals.trend_direction("o_totalprice", "prev_value")
    return order_series(spark, sf_dir).select("o_orderkey", direction.alias("trend_direction"))


@query(
    "c41_changes",
    f"""{SERIES_SQL} select o_orderkey, o_totalprice - prev_value as change_vs_prev,
        {d.pct_change('o_totalprice', 'prev_value')} as pct_change_vs_prev,
        o_totalprice - first_value as change_vs_first,
        case when snapshot_number > 1 then {d.pct_change('o_totalprice', 'first_value')} end as pct_change_vs_first,
        cast(day - prev_day as int) as days_since_prev, cast(day - first_day as int) as days_since_first
        from series""",
)
def c41(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_series(spark, sf_dir).select(
        "o_orderkey",
        signals.change("o_totalprice", "prev_value").alias("change_vs_prev"),
        signals.pct_change("o_totalprice", "prev_value").alias("pct_change_vs_prev"),
        signals.change("o_totalprice", "first_value").alias("change_vs_first"),
        F.when(c("snapshot_number") > 1, signals.pct_change("o_totalprice", "first_value")).alias(
            "pct_change_vs_first"
        ),
        signals.days_between("day", "prev_day").alias("days_since_prev"),
        signals.days_between("day", "first_day").alias("days_since_first"),
    )


_columns("c42_salary_source", "estimates", {
    "salary_source": (lambda: 
        salary.salary_source("median_salary"),
        "case when median_salary is not null then 'estimated' else 'unavailable' end",
    ),
})


@query(
    "c43_days_active",
    f"{INPUT_SQL} select job_id, cast(cast(max(seen_at) as date) - cast(min(seen_at) as date) as int) as days_active "
    "from postings group by job_id",
)
def c43(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = inputs.postings(spark, sf_dir).groupBy("job_id").agg(
        F.min("_file_modified_at").alias("first"), F.max("_file_modified_at").alias("last")
    )
    return span.select("job_id", signals.days_between("last", "first").alias("days_active"))


@query(
    "c44_date_attributes",
    f"with days as (select distinct cast(o_orderdate as date) as day from orders) select {d.calendar('day')} from days",
)
def c44(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "orders").select(c("o_orderdate").cast("date").alias("day")).distinct()
    return days.select(*[col.alias(name) for name, col in signals.calendar_columns("day").items()])


# --- D6, C45: similar names --------------------------------------------------------------

PART_COMPANIES = f"""
with part_companies as (
    select md5(company_name_clean) as company_key, company_name_clean, count(*) as total_postings,
           min('https://' || replace(p_type, ' ', '') || cast(p_size % 7 as varchar)) as company_website,
           max(p_type) as hq_market
    from (select *, {d.employer("p_name || ' ' || p_brand")} as company_name_clean from part)
    group by company_name_clean
)"""


def part_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One company per part name and brand; stored, since pairing reads it several times."""
    name = company.employer_name_normalization(F.concat("p_name", F.lit(" "), "p_brand"))
    site = F.concat(F.lit("https://"), F.replace("p_type", F.lit(" "), F.lit("")), (c("p_size") % 7).cast("string"))
    companies = (
        table(spark, sf_dir, "part")
        .groupBy(name.alias("company_name_clean"))
        .agg(
            F.count("*").alias("total_postings"),
            F.min(site).alias("company_website"),
            F.max("p_type").alias("hq_market"),
        )
        .withColumn("company_key", F.md5("company_name_clean"))
    )
    return stage(companies, "companies")


@query(
    "d6_blocked_fuzzy_join",
    f"{PART_COMPANIES}, {duplicate_pairs('part_companies')} select key_a, key_b, name_a, name_b, edit_distance from duplicates",
)
def d6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_pairs(part_companies(spark, sf_dir), "company_key", "company_name_clean")


@query("c45_pair_classification", f"{PART_COMPANIES}, {duplicate_pairs('part_companies')} select * from duplicates")
def c45(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = part_companies(spark, sf_dir)
    return classify_pairs(similar_pairs(companies, "company_key", "company_name_clean"), companies)


# --- G4: cut for the prompt --------------------------------------------------------------

_columns("g4_text_truncation", "postings", {
    "prompt": (lambda: 
        prompt_text("job_title", F.coalesce("job_description", F.lit("")), MAX_DESCRIPTION),
        "'TITLE: ' || job_title || chr(10) || 'DESCRIPTION: ' || substr(coalesce(job_description, ''), 1, 8000)",
    ),
})
