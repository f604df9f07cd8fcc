"""Postings and estimates derived from the driver tables.

Each order becomes one posting record and one estimate record, so every query
grows with the tables. Titles, employers and descriptions come from all parts
and all documents, picked by order and customer number. The SQL forms give the
same rows on the oracle side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Moves 1995-01-01 to 2021-01-01, into the calendar of dim_date.
DAY_SHIFT = 9497


# Up to so many partitions hold 10,000 orders each. More orders make partitions of up to 50,000 (125 MB of text), since the
# driver keeps something of every task.
ORDERS_A_PARTITION, FEW_PARTITIONS, MOST_ORDERS = 10_000, 200, 50_000

_schemas: dict[tuple[str, str], StructType] = {}
_counts: dict[tuple[str, str], int] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is looked up once, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    if (sf_dir, name) not in _schemas:
        _schemas[sf_dir, name] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[sf_dir, name]).parquet(path)


def _pick(value: str, choices: dict[object, str | None], default: str | None) -> Column:
    out = F
    for key, text in choices.items():
        out = out.when(F.expr(value) == key, F.lit(text))
    return out.otherwise(F.lit(default).cast("string"))


def _sql_pick(value: str, choices: dict[object, str | None], default: str | None) -> str:
    def lit(x: object) -> str:
        if x is None:
            return "null"
        return str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"

    whens = " ".join(f"when {lit(k)} then {lit(v)}" for k, v in choices.items())
    return f"case {value} {whens} else {lit(default)} end"


PREFIX = ("o_orderkey % 6", {0: "Sr ", 1: "Lead ", 2: "Junior ", 3: "Head Of "}, "")
POSTED_ROLE = (
    "p_type",
    {
        "STANDARD": "Data Engineer",
        "ECONOMY": "Data Analyst",
        "MEDIUM": "Software/Engineer",
        "PROMO": "Machine Learning Engineer",
        "SMALL": "Product Manager",
    },
    "Civil Engineer",
)
ESTIMATED_ROLE = (POSTED_ROLE[0], {**POSTED_ROLE[1], "MEDIUM": "Software Engineer"}, POSTED_ROLE[2])
SUFFIX = ("o_orderkey % 5", {0: " III", 1: " 61096", 2: " Remote Contract", 3: " - Metamask"}, "")
LEGAL = ("o_custkey % 3", {0: " Inc.", 1: " Ltd"}, "")
EMPLOYMENT = ("o_orderkey % 4", {0: "CONTRACTOR", 1: "FULLTIME", 2: "INTERN"}, None)
POSTED_COUNTRY = ("r_name", {"AFRICA": "Kenya", "EUROPE": "United Kingdom", "AMERICA": "US"}, "India")
SHORT_COUNTRY = ("r_name", {"AFRICA": "kenya", "EUROPE": "uk", "AMERICA": "us"}, "india")
CURRENCY = ("r_name", {"AFRICA": "KES", "EUROPE": "GBP", "AMERICA": "USD"}, None)
POSTED_PERIOD = (
    "o_orderpriority",
    {"1-URGENT": "HOURLY", "2-HIGH": "DAILY", "3-MEDIUM": "WEEKLY", "4-NOT SPECIFIED": "MONTHLY"},
    "YEARLY",
)
ESTIMATED_PERIOD = (
    "o_orderpriority",
    {"1-URGENT": "HOUR", "2-HIGH": "DAY", "3-MEDIUM": "WEEK", "4-NOT SPECIFIED": "MONTH"},
    "YEAR",
)
CONFIDENCE = ("o_orderkey % 3", {0: "HIGH", 1: "medium"}, "low")
STACK = (
    "o_orderkey % 9",
    {
        0: "Python, SQL and Apache Spark on Databricks; dbt.",
        1: "You know C# and ci/cd. Hybrid role.",
        2: "AWS or Azure, Kafka and Airflow.",
        3: "BigQuery on Google Cloud Platform (GCP).",
        4: "Deep Learning, LLM and generative AI.",
        5: "R language, Power BI, Excel.",
        6: "Snowflake and SQL; on-site.",
        7: "",
    },
    "Git, GitHub Actions, Docker.",
)


def partitions_of(orders: int) -> int:
    """How many partitions so many orders are dealt to."""
    return max(1, min(FEW_PARTITIONS, -(-orders // ORDERS_A_PARTITION)), -(-orders // MOST_ORDERS))


def _deal(orders: DataFrame, sf_dir: str, *by: str) -> DataFrame:
    """As many partitions as there are data, not as there are cores: a driver table is one file with one row group and so one task."""
    if (sf_dir, "orders") not in _counts:
        _counts[sf_dir, "orders"] = table(orders.sparkSession, sf_dir, "orders").count()
    return orders.repartition(partitions_of(_counts[sf_dir, "orders"]), *by)


def _rows(df: DataFrame) -> Column:
    """The number of rows as a literal.

    As a subquery in a join key it fails where AQE broadcasts that side: the key
    is then evaluated before the subquery has ended.
    """
    return F.lit(df.count()).cast("bigint")


def _base(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Orders with place and part; unused joins carry few columns. What follows from an order alone comes after the joins (``_dated``)."""
    part = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    if dealt:
        orders = _deal(orders, sf_dir)
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(part.select("p_partkey", "p_type"), F.col("o_orderkey") % _rows(part) == F.col("p_partkey"))
    )


def _dated(orders: DataFrame) -> DataFrame:
    """Orders with their day and one instant each: the day plus a millisecond count."""
    orders = orders.withColumn("day", F.col("o_orderdate").cast("date") + F.expr(f"make_dt_interval({DAY_SHIFT})"))
    return orders.withColumns(
        {
            "seen": F.expr(
                "cast(day as timestamp_ntz) + make_dt_interval(0, 0, 0, cast(o_orderkey as decimal(12, 0)) * 0.001)"
            ),
            "day": F.col("day").cast("date"),
        }
    )


BASE_SQL = f"""
numbered as (
    select *,
           o_orderkey % (select count(*) from part) as part_no,
           o_custkey % (select count(*) from part) as employer_no,
           o_orderkey % (select count(*) from documents) as doc_no,
           cast(o_orderdate as date) + {DAY_SHIFT} as day
    from orders
),
base as (
    select n.*, cast(n.day as timestamp) as posted,
           cast(n.day as timestamp) + to_milliseconds(n.o_orderkey) as seen,
           na.n_name, na.n_regionkey, r.r_name, p.p_type
    from numbered n
    join customer c on c.c_custkey = n.o_custkey
    join nation na on na.n_nationkey = c.c_nationkey
    join region r on r.r_regionkey = na.n_regionkey
    join part p on p.p_partkey = n.part_no
)"""


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw posting records, one per order; ``job_id`` repeats per customer."""
    part = table(spark, sf_dir, "part")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    employer = part.select(
        F.col("p_partkey").alias("_employer_no"), F.col("p_name").alias("e_name"), F.col("p_brand").alias("e_brand")
    )
    employed = F.col("o_custkey") % _rows(part) == F.col("_employer_no")
    numbered = _base(spark, sf_dir).join(employer, employed)
    numbered = numbered.withColumn("_doc", F.col("o_orderkey") % _rows(documents))
    # Orders are narrow but become long texts, so they are dealt for the join that adds the texts: by its own
    # exchange they would come in few partitions, sized by what is shuffled and not by the texts.
    df = _dated(_deal(numbered, sf_dir, "_doc").join(documents, F.col("_doc") == F.col("doc_id")))
    key = F.col("o_orderkey")
    nothing = F.lit(None).cast("string")
    words = F.lit(None).cast("array<string>")
    stack = _pick(*STACK)
    return df.select(
        F.col("o_custkey").cast("string").alias("job_id"),
        F.concat(_pick(*PREFIX), _pick(*POSTED_ROLE), _pick(*SUFFIX)).alias("job_title"),
        F.when(key % 23 != 0, F.concat("text", F.lit(" "), stack)).alias("job_description"),
        F.when(key % 29 != 0, F.concat("e_name", F.lit(" "), "e_brand", _pick(*LEGAL))).alias("employer_name"),
        F.when(
            key % 2 == 0,
            F.concat(F.lit("https://"), F.replace("e_name", F.lit(" "), F.lit("-")), F.lit(".example.com")),
        ).alias("employer_website"),
        nothing.alias("employer_logo"),
        nothing.alias("job_publisher"),
        _pick(*EMPLOYMENT).alias("job_employment_type"),
        words.alias("job_employment_types"),
        (key % 7 == 0).alias("job_is_remote"),
        F.concat(F.date_format("day", "yyyy-MM-dd"), F.lit("T00:00:00.000Z")).alias("job_posted_at_datetime_utc"),
        F.when(key % 11 != 0, F.col("n_name")).alias("job_city"),
        nothing.alias("job_state"),
        F.when(~((key % 11 == 0) & (key % 2 == 0)), _pick(*POSTED_COUNTRY)).alias("job_country"),
        F.lit(None).cast("double").alias("job_latitude"),
        F.lit(None).cast("double").alias("job_longitude"),
        words.alias("job_benefits"),
        words.alias("job_benefits_strings"),
        _pick(*POSTED_PERIOD).alias("job_salary_period"),
        F.when(key % 3 != 0, F.col("o_totalprice")).alias("job_min_salary"),
        F.when(key % 5 != 0, F.col("o_totalprice") * 1.25).alias("job_max_salary"),
        _path("job_search", key % 8).alias("_file_path"),
        F.col("seen").alias("_file_modified_at"),
        key.alias("ingest_seq"),
    )


def _path(endpoint: str, query: Column) -> Column:
    return F.concat(
        F.lit(f"file:///raw/endpoint={endpoint}/ingestion_date="),
        F.date_format("day", "yyyy-MM-dd"),
        F.lit("/query=q%20"),
        query.cast("string"),
        F.lit("/data.json"),
    )


POSTINGS_SQL = f"""
postings as (
    select cast(b.o_custkey as varchar) as job_id,
           {_sql_pick(*PREFIX)} || {_sql_pick(*POSTED_ROLE)} || {_sql_pick(*SUFFIX)} as job_title,
           case when b.o_orderkey % 23 <> 0 then d.text || ' ' || {_sql_pick(*STACK)} end as job_description,
           case when b.o_orderkey % 29 <> 0
                then e.p_name || ' ' || e.p_brand || {_sql_pick(*LEGAL)} end as employer_name,
           case when b.o_orderkey % 2 = 0
                then 'https://' || replace(e.p_name, ' ', '-') || '.example.com' end as employer_website,
           cast(null as varchar) as employer_logo,
           {_sql_pick(*EMPLOYMENT)} as job_employment_type,
           b.o_orderkey % 7 = 0 as job_is_remote,
           case when b.o_orderkey % 11 <> 0 then b.n_name end as job_city,
           cast(null as varchar) as job_state,
           case when not (b.o_orderkey % 11 = 0 and b.o_orderkey % 2 = 0)
                then {_sql_pick(*POSTED_COUNTRY)} end as job_country,
           {_sql_pick(*POSTED_PERIOD)} as job_salary_period,
           case when b.o_orderkey % 3 <> 0 then b.o_totalprice end as job_min_salary,
           case when b.o_orderkey % 5 <> 0 then b.o_totalprice * 1.25 end as job_max_salary,
           b.posted as posted_timestamp,
           b.day as ingestion_date,
           b.seen as seen_at,
           b.o_orderkey as ingest_seq
    from base b
    join (select p_partkey, p_name, p_brand from part) e on e.p_partkey = b.employer_no
    join documents d on d.doc_id = b.doc_no
)"""


def estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw estimate records, one per order."""
    key, total = F.col("o_orderkey"), F.col("o_totalprice")
    city = F.lower("n_name")
    place = (
        F.when(key % 31 == 0, F.lit(None).cast("string"))
        .when(key % 13 == 0, F.lit("kenya"))
        .when(
            key % 4 == 0,
            F.concat(city, F.lit(", region "), F.col("n_regionkey").cast("string"), F.lit(", united kingdom")),
        )
        .otherwise(F.concat(city, F.lit(", "), _pick(*SHORT_COUNTRY)))
    )
    return _dated(_base(spark, sf_dir, dealt=True)).select(
        place.alias("location"),
        _pick(*ESTIMATED_ROLE).alias("job_title"),
        (total * 0.8).alias("min_salary"),
        (total * 1.4).alias("max_salary"),
        F.when(key % 37 != 0, total).alias("median_salary"),
        (total * 0.7).alias("min_base_salary"),
        (total * 1.1).alias("max_base_salary"),
        (total * 0.9).alias("median_base_salary"),
        F.lit(None).cast("double").alias("min_additional_pay"),
        F.lit(None).cast("double").alias("max_additional_pay"),
        (total * 0.1).alias("median_additional_pay"),
        _pick(*ESTIMATED_PERIOD).alias("salary_period"),
        _pick(*CURRENCY).alias("salary_currency"),
        (key % 40).cast("bigint").alias("salary_count"),
        F.date_format("day", "yyyy-MM-dd").alias("salaries_updated_at"),
        F.concat(F.lit("pub"), (key % 3).cast("string")).alias("publisher_name"),
        _pick(*CONFIDENCE).alias("confidence"),
        _path("salary_estimate", key % 8).alias("_file_path"),
        F.col("seen").alias("_file_modified_at"),
        key.alias("ingest_seq"),
    )


ESTIMATES_SQL = f"""
estimates as (
    select case when o_orderkey % 31 = 0 then null
                when o_orderkey % 13 = 0 then 'kenya'
                when o_orderkey % 4 = 0
                then lower(n_name) || ', region ' || cast(n_regionkey as varchar) || ', united kingdom'
                else lower(n_name) || ', ' || {_sql_pick(*SHORT_COUNTRY)} end as location,
           {_sql_pick(*ESTIMATED_ROLE)} as job_title,
           o_totalprice * 0.8 as min_salary,
           o_totalprice * 1.4 as max_salary,
           case when o_orderkey % 37 <> 0 then o_totalprice end as median_salary,
           o_totalprice * 0.7 as min_base_salary,
           o_totalprice * 1.1 as max_base_salary,
           o_totalprice * 0.9 as median_base_salary,
           o_totalprice * 0.1 as median_additional_pay,
           {_sql_pick(*ESTIMATED_PERIOD)} as salary_period,
           {_sql_pick(*CURRENCY)} as salary_currency,
           cast(o_orderkey % 40 as bigint) as salary_count,
           strftime(day, '%Y-%m-%d') as salaries_updated_at,
           'pub' || cast(o_orderkey % 3 as varchar) as publisher_name,
           {_sql_pick(*CONFIDENCE)} as confidence,
           day as ingestion_date,
           seen as seen_at,
           o_orderkey as ingest_seq
    from base
)"""

INPUT_SQL = f"with {BASE_SQL}, {POSTINGS_SQL}, {ESTIMATES_SQL}"
