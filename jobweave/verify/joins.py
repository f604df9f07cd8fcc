"""Joins, aggregations, windows, sorts, set operations (D, E, F, G, H) as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.functions import keys, title
from jobweave.operators import dedup, incremental, joins, rates, reshape
from jobweave.plans import dimensions, enrichment
from jobweave.plans.dashboard import summary as benchmark_totals
from jobweave.verify import dialect as d
from jobweave.verify import inputs
from jobweave.verify.columns import PART_COMPANIES, SERIES_SQL, order_series, part_companies
from jobweave.verify.inputs import INPUT_SQL, table
from jobweave.verify.models import DIM_DATE, duplicate_pairs
from jobweave.verify.registry import query
from jobweave.plans.intermediate import actionable_order
from jobweave.operators.ranking import ranked
from jobweave.operators.similar import classify_pairs, similar_pairs

c = F.col


# --- D: joins ----------------------------------------------------------------------------

@query(
    "d1_fk_validation",
    """select o.o_orderkey, coalesce(c.c_custkey, -1) as custkey, coalesce(m.segment_key, '-1') as segment_key
       from (select *, case when o_orderkey % 3 = 0 then -1 else o_custkey end as ck,
                    case when o_orderkey % 3 = 0 then '-1' else md5(o_orderpriority) end as pk from orders) o
       left join (select c_custkey from customer where c_acctbal > 2000) c on c.c_custkey = o.ck
       left join (select distinct md5(o_orderpriority) as segment_key from orders
                  where o_orderpriority <> '5-LOW') m on m.segment_key = o.pk""",
)
def d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the orders has unknown keys and never meets the dimensions."""
    orders = table(spark, sf_dir, "orders")
    unknown = c("o_orderkey") % 3 == 0
    fact = orders.select(
        "o_orderkey",
        F.when(unknown, F.lit(-1)).otherwise(c("o_custkey")).alias("custkey"),
        F.when(unknown, F.lit("-1")).otherwise(F.md5("o_orderpriority")).alias("segment_key"),
    )
    rich = table(spark, sf_dir, "customer").filter("c_acctbal > 2000").select(c("c_custkey").alias("custkey"))
    segments = orders.filter("o_orderpriority <> '5-LOW'").select(F.md5("o_orderpriority").alias("segment_key"))
    fact = joins.validate_foreign_key(fact, rich, "custkey", -1, "o_orderkey")
    return joins.validate_foreign_key(fact, segments.distinct(), "segment_key", "-1", "o_orderkey")


@query(
    "d2_star_enrichment",
    """select o.o_orderkey, c.c_mktsegment, n.n_name, r.r_name
       from orders o join customer c on c.c_custkey = o.o_custkey and c.c_mktsegment not in ('BUILDING')
       join nation n on n.n_nationkey = c.c_nationkey
       join region r on r.r_regionkey = n.n_regionkey and r.r_name in ('AFRICA', 'EUROPE')""",
)
def d2(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").filter(~c("c_mktsegment").isin("BUILDING"))
    regions = table(spark, sf_dir, "region").filter(c("r_name").isin("AFRICA", "EUROPE"))
    nations = table(spark, sf_dir, "nation").join(regions, c("n_regionkey") == c("r_regionkey"))
    return (
        table(spark, sf_dir, "orders")
        .join(customers, c("o_custkey") == c("c_custkey"))
        .join(nations, c("c_nationkey") == c("n_nationkey"))
        .select("o_orderkey", "c_mktsegment", "n_name", "r_name")
    )


MEASURES_SQL = """
demand as (
    select p_type as role, o_orderpriority as place, count(*) as total_postings
    from orders o join part p on p.p_partkey = o.o_orderkey % (select count(*) from part)
    where o_orderstatus = 'O' group by 1, 2
),
pay as (
    select p_type as role, o_orderpriority as place, o_orderstatus as currency, max(o_totalprice) as top_pay
    from orders o join part p on p.p_partkey = o.o_custkey % (select count(*) from part)
    where o_totalprice > 250000 group by 1, 2, 3
),
roles as (select distinct p_type as role from part where p_type <> 'LARGE'),
places as (select distinct o_orderpriority as place, o_orderpriority <> '5-LOW' as is_benchmark from orders)"""


def _measures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    parts = part.select(F.count("*")).scalar()
    numbered = orders.withColumns({"_open": c("o_orderkey") % parts, "_paid": c("o_custkey") % parts})

    def typed(number: str) -> DataFrame:
        joined = numbered.join(part.select("p_partkey", "p_type"), c(number) == c("p_partkey"))
        return joined.withColumns({"role": c("p_type"), "place": c("o_orderpriority")})

    demand = typed("_open").filter("o_orderstatus = 'O'").groupBy("role", "place")
    pay = typed("_paid").filter("o_totalprice > 250000").withColumnRenamed("o_orderstatus", "currency")
    roles = part.filter("p_type <> 'LARGE'").select(c("p_type").alias("role")).distinct()
    places = orders.select(
        c("o_orderpriority").alias("place"), (c("o_orderpriority") != "5-LOW").alias("is_benchmark")
    ).distinct()
    return (
        demand.agg(F.count("*").alias("total_postings")),
        pay.groupBy("role", "place", "currency").agg(F.max("o_totalprice").alias("top_pay")),
        roles,
        places.filter("is_benchmark").select("place"),
    )


def _with_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    demand, pay, roles, places = _measures(spark, sf_dir)
    both = joins.combine_measures(demand, pay, ["role", "place"])
    return both.join(roles, "role").join(places, "place")


@query(
    "d3_dimension_pairs",
    f"with {MEASURES_SQL} select distinct r.role, l.place from roles r join places l on l.is_benchmark "
    "left join demand p on p.role = r.role and p.place = l.place left join pay s on s.role = r.role and s.place = l.place "
    "where p.total_postings is not null or s.top_pay is not null",
)
def d3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with data, found from the data instead of from all pairs."""
    return _with_data(spark, sf_dir).select("role", "place").distinct()


@query(
    "d4_composite_left_joins",
    f"with {MEASURES_SQL} select r.role, l.place, p.total_postings, s.currency, s.top_pay "
    "from roles r join places l on l.is_benchmark "
    "left join demand p on p.role = r.role and p.place = l.place left join pay s on s.role = r.role and s.place = l.place "
    "where p.total_postings is not null or s.top_pay is not null",
)
def d4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both measures on (role, place), for every pair that has either."""
    demand, pay, roles, places = _measures(spark, sf_dir)
    keys_ = ["role", "place"]
    pairs = demand.select(*keys_).unionByName(pay.select(*keys_)).distinct()
    pairs = pairs.join(roles, "role").join(places, "place")
    return pairs.join(demand, keys_, "left").join(pay, keys_, "left")


@query(
    "d5_full_outer_measures",
    f"with {MEASURES_SQL} select coalesce(p.role, s.role) as role, coalesce(p.place, s.place) as place, "
    "p.total_postings, s.currency, s.top_pay from demand p full outer join pay s on p.role = s.role and p.place = s.place "
    "where coalesce(p.role, s.role) <> 'LARGE' and coalesce(p.place, s.place) <> '5-LOW'",
)
def d5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_data(spark, sf_dir)


@query(
    "d7_rate_denominator",
    """select a.o_custkey, a.o_orderstatus, a.n, t.total, round(100.0::double * a.n / nullif(t.total, 0), 1) as pct
       from (select o_custkey, o_orderstatus, o_orderpriority, count(*) as n from orders group by all) a
       left join (select o_custkey, o_orderpriority, count(*) as total from orders group by all) t
         on t.o_custkey = a.o_custkey and t.o_orderpriority = a.o_orderpriority""",
)
def d7(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    segment = ["o_custkey", "o_orderpriority"]
    part = orders.groupBy(*segment, "o_orderstatus").agg(F.count("*").alias("n"))
    whole = orders.groupBy(*segment).agg(F.count("*").alias("total"))
    return part.join(whole, segment, "left").select(
        "o_custkey", "o_orderstatus", "n", "total", rates.rate_pct(c("n"), c("total")).alias("pct")
    )


@query(
    "d8_bridge_average",
    """select o_orderpriority, count(*) as orders, round(avg(coalesce(n, 0)), 3) as avg_lines
       from orders left join (select l_orderkey, count(*) as n from lineitem group by 1) l on l.l_orderkey = o_orderkey
       group by 1""",
)
def d8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average number of lines per order, orders without lines included."""
    lines = table(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n")
    )
    joined = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left")
    return joined.groupBy("o_orderpriority").agg(
        F.count("*").alias("orders"), F.round(F.avg(F.coalesce("n", F.lit(0))), 3).alias("avg_lines")
    )


RANKED_SQL = "select *, cast(substr(o_orderpriority, 1, 1) as int) as rank from orders"


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("rank", F.substring("o_orderpriority", 1, 1).cast("int"))


@query(
    "d9_max_rank_per_company",
    f"with r as ({RANKED_SQL}) select o_orderkey, o_custkey, "
    "(select max(x.rank) from r x where x.o_custkey = r.o_custkey) as top_rank from r",
)
def d9(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = _ranked(spark, sf_dir)
    return joins.max_per_company(ranked, "o_custkey", "rank", "top_rank").select(
        "o_orderkey", "o_custkey", "top_rank"
    )


HASH_SQL = (
    "sha256(lower(regexp_replace(source, '^\\s+|\\s+$', '', 'g')) || chr(10) || "
    "lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g')))"
)


@query(
    "d10_unseen_hashes",
    f"""with h as (select doc_id, {HASH_SQL} as content_hash from documents)
        select doc_id, content_hash from h
        where content_hash not in (select h.content_hash from h join labels l on l.doc_id = h.doc_id)""",
)
def d10(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = table(spark, sf_dir, "documents").select(
        "doc_id", enrichment.content_hash("source", "text").alias("content_hash")
    )
    seen = hashed.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return joins.not_in(hashed, seen, ["content_hash"]).select("doc_id", "content_hash")


@query(
    "d11_join_back_by_hash",
    f"""with h as (select doc_id, {HASH_SQL} as content_hash from documents),
        done as (select content_hash, 'quality ' || cast(quality as varchar) as role_family, quality as q
                 from h join labels using (doc_id)
                 qualify row_number() over (partition by content_hash order by doc_id desc) = 1)
        select h.doc_id, h.content_hash, d.role_family from h left join done d on d.content_hash = h.content_hash""",
)
def d11(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = table(spark, sf_dir, "documents").select(
        "doc_id", enrichment.content_hash("source", "text").alias("content_hash")
    )
    enriched = hashed.join(table(spark, sf_dir, "labels"), "doc_id").select(
        "content_hash",
        F.concat(F.lit("quality "), c("quality").cast("string")).alias("role_family"),
        F.lpad(c("doc_id").cast("string"), 20, "0").alias("extracted_at"),
        c("doc_id").cast("string").alias("job_id"),
    )
    return enrichment.with_enrichment(hashed, enriched, ["role_family"]).select(
        "doc_id", "content_hash", "role_family"
    )


_TITLES_SQL = f"select distinct {d.norm_title('job_title')} as title_normalized from postings"


@query(
    "d12_mapping_override",
    f"""{INPUT_SQL}, titles as ({_TITLES_SQL}),
        mapping as (select initcap_title, family, tech, mgmt from (
            select title_normalized as initcap_title, 'Curated ' || cast(length(title_normalized) % 3 as varchar) as family,
                   length(title_normalized) % 2 = 0 as tech, length(title_normalized) % 5 = 0 as mgmt
            from titles where title_normalized like '%data%'))
        select t.title_normalized, coalesce(m.family, {d.role_family('t.title_normalized')}) as role_family,
               coalesce(m.tech, {d.is_technical('t.title_normalized')}) as is_technical,
               coalesce(m.mgmt, {d.is_management('t.title_normalized')}) as is_management
        from titles t left join mapping m on m.initcap_title = t.title_normalized""",
)
def d12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A curated mapping of some titles wins over the rules."""
    titles = inputs.postings(spark, sf_dir).select(
        title.normalize_job_title("job_title").alias("title_normalized")
    ).distinct().withColumn("title_raw_representative", c("title_normalized"))
    size = F.length("title_normalized")
    mapping = titles.filter(c("title_normalized").contains("data")).select(
        F.initcap("title_normalized").alias("title_normalized"),
        F.concat(F.lit("Curated "), (size % 3).cast("string")).alias("role_family"),
        (size % 2 == 0).alias("is_technical"),
        (size % 5 == 0).alias("is_management"),
    )
    return dimensions.dim_job_title(titles, mapping).select(
        "title_normalized", "role_family", "is_technical", "is_management"
    )


@query(
    "d13_orphans",
    """select l_orderkey as orphan_key, count(*) as child_rows from lineitem
       where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P') group by 1""",
)
def d13(spark: SparkSession, sf_dir: str) -> DataFrame:
    parents = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    return joins.orphans(table(spark, sf_dir, "lineitem"), "l_orderkey", parents, "o_orderkey")


@query(
    "d14_calendar_join",
    f"{INPUT_SQL}, {DIM_DATE} select p.ingest_seq, c.date_key, c.year_quarter, c.is_weekday "
    "from postings p join dim_date c on c.date_key = cast(strftime(p.ingestion_date, '%Y%m%d') as int)",
)
def d14(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = inputs.postings(spark, sf_dir).select(
        "ingest_seq", keys.date_key("_file_modified_at").alias("date_key")
    )
    return joins.with_calendar(fact, dimensions.dim_date(spark), ["year_quarter", "is_weekday"])


# --- E: aggregations ---------------------------------------------------------------------

@query("e1_distinct", "select distinct lang, source from documents")
def e1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("lang", "source").distinct()


@query(
    "e2_representative",
    f"{INPUT_SQL} select {d.norm_title('job_title')} as title_normalized, min(job_title) as title_raw_representative "
    "from postings group by 1",
)
def e2(spark: SparkSession, sf_dir: str) -> DataFrame:
    normalized = title.normalize_job_title("job_title").alias("title_normalized")
    return inputs.postings(spark, sf_dir).groupBy(normalized).agg(
        F.min("job_title").alias("title_raw_representative")
    )


@query(
    "e3_bool_or",
    "select o_custkey, bool_or(o_orderstatus = 'F') as in_filled, bool_or(o_totalprice > 450000) as in_large "
    "from orders group by 1",
)
def e3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.bool_or(c("o_orderstatus") == "F").alias("in_filled"),
        F.bool_or(c("o_totalprice") > 450000).alias("in_large"),
    )


@query(
    "e4_conditional_rate",
    """select o_custkey, o_orderpriority, count(*) as total_postings,
              count(case when o_totalprice > 250000 then 1 end) as postings_with_salary,
              round(count(case when o_totalprice > 250000 then 1 end) * 100.0::double / count(*), 1)
                  as salary_disclosure_rate_pct
       from orders group by 1, 2""",
)
def e4(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("shown", c("o_totalprice") > 250000)
    return rates.disclosure(orders, ["o_custkey", "o_orderpriority"], "shown")


@query(
    "e5_count_distinct",
    "select l_returnflag, l_linestatus, count(distinct l_orderkey) as orders, count(distinct l_partkey) as parts "
    "from lineitem group by 1, 2",
)
def e5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey").alias("parts")
    )


@query("e6_avg_rounded", "select l_suppkey, round(avg(l_quantity), 1) as avg_quantity from lineitem group by 1")
def e6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.round(F.avg("l_quantity"), 1).alias("avg_quantity")
    )


@query("e7_min_max_time", "select user_id, min(ts) as first_seen, max(ts) as last_seen from events group by 1")
def e7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")
    )


@query(
    "e8_conditional_max",
    f"""with r as ({RANKED_SQL}), t as (select o_custkey, max(rank) as top from r group by 1)
        select r.o_custkey, r.o_orderstatus, max(case when r.rank = t.top then r.o_orderpriority end) as most_senior
        from r join t on t.o_custkey = r.o_custkey group by 1, 2""",
)
def e8(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = joins.max_per_company(_ranked(spark, sf_dir), "o_custkey", "rank", "top")
    return ranked.groupBy("o_custkey", "o_orderstatus").agg(
        F.max(F.when(c("rank") == c("top"), c("o_orderpriority"))).alias("most_senior")
    )


@query(
    "e9_many_group_keys",
    """select o_orderstatus, o_orderpriority, c_mktsegment, c_nationkey, n_name, n_regionkey, r_name,
              cast(year(o_orderdate) as int) as y, cast(quarter(o_orderdate) as int) as q, o_totalprice > 250000 as large,
              count(*) as n
       from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
       join region on r_regionkey = n_regionkey group by 1, 2, 3, 4, 5, 6, 7, 8, 9, 10""",
)
def e9(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), c("o_custkey") == c("c_custkey"))
        .join(table(spark, sf_dir, "nation"), c("c_nationkey") == c("n_nationkey"))
        .join(table(spark, sf_dir, "region"), c("n_regionkey") == c("r_regionkey"))
    )
    return df.groupBy(
        "o_orderstatus", "o_orderpriority", "c_mktsegment", "c_nationkey", "n_name", "n_regionkey", "r_name",
        F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q"),
        (c("o_totalprice") > 250000).alias("large"),
    ).agg(F.count("*").alias("n"))


@query(
    "e10_global_kpis",
    """select count(distinct title) as total_roles, cast(sum(n) as bigint) as total_postings,
              round(avg(pct), 1) as avg_disclosure_rate_pct, count(distinct market) as markets
       from (select o_custkey as title, o_orderpriority as market, count(*) as n,
                    round(count(case when o_totalprice > 250000 then 1 end) * 100.0::double / count(*), 1) as pct
             from orders group by 1, 2)""",
)
def e10(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        c("o_custkey").alias("title_normalized"),
        c("o_orderpriority").alias("market"),
        (c("o_totalprice") > 250000).alias("shown"),
    )
    return benchmark_totals(rates.disclosure(orders, ["title_normalized", "market"], "shown"))


@query("e12_watermark", "select event_type, max(ts) as newest from events group by 1")
def e12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The watermark of each endpoint's table."""
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.max("ts").alias("newest"))


@query("e13_group_by_partition", "select 'q' || cast(user_id % 16 as varchar) as query, count(*) as records from events group by 1")
def e13(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("q"), (c("user_id") % 16).cast("string")).alias("query")
    return table(spark, sf_dir, "events").groupBy(name).agg(F.count("*").alias("records"))


# --- F: windows --------------------------------------------------------------------------

@query(
    "f1_latest_per_key",
    "select user_id, event_type, event_id, ts, value from events "
    "qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1",
)
def f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return dedup.latest_per_key(events, ["user_id", "event_type"], "ts", "event_id")


@query(
    "f2_latest_with_span",
    """select user_id, event_id, value, first_seen_at, last_seen_at from (
         select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn,
                min(ts) over (partition by user_id) as first_seen_at, max(ts) over (partition by user_id) as last_seen_at
         from events) where rn = 1""",
)
def f2(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")
    span = {"first_seen_at": F.min("ts"), "last_seen_at": F.max("ts")}
    best = dedup.best_with_span(events, ["user_id"], [c("ts").desc(), c("event_id").desc()], span)
    return best.drop("ts")


@query(
    "f3_best_by_expression",
    f"""{INPUT_SQL} select job_title, ingestion_date, ingest_seq, confidence, salary_count from estimates
        qualify row_number() over (partition by job_title, ingestion_date
            order by case lower(confidence) when 'high' then 1 when 'medium' then 2 else 3 end,
                     coalesce(salary_count, 0) desc, seen_at desc) = 1""",
)
def f3(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.lower("confidence")
    rank = F.when(level == "high", 1).when(level == "medium", 2).otherwise(3)
    df = inputs.estimates(spark, sf_dir).withColumn("ingestion_date", c("_file_modified_at").cast("date"))
    df = df.select("job_title", "ingestion_date", "ingest_seq", "confidence", "salary_count", "_file_modified_at")
    order = [rank.asc(), F.coalesce("salary_count", F.lit(0)).desc(), c("_file_modified_at").desc()]
    return dedup.best_per_key(df, ["job_title", "ingestion_date"], order).drop("_file_modified_at")


@query(
    "f4_most_complete",
    f"""{INPUT_SQL} select employer_name, ingest_seq, total_postings, first_seen_at, last_seen_at from (
          select *, count(*) over w as total_postings, min(seen_at) over w as first_seen_at,
                 max(seen_at) over w as last_seen_at,
                 row_number() over (partition by employer_name order by
                     case when employer_website is not null then 0 else 1 end,
                     case when job_city is not null then 0 else 1 end, seen_at desc, ingest_seq) as rn
          from postings where employer_name is not null window w as (partition by employer_name)) where rn = 1""",
)
def f4(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = inputs.postings(spark, sf_dir).filter("employer_name is not null").select(
        "employer_name", "employer_website", "job_city", "ingest_seq", "_file_modified_at"
    )
    order = [
        c("employer_website").isNull().asc(), c("job_city").isNull().asc(),
        c("_file_modified_at").desc(), c("ingest_seq").asc(),
    ]
    seen = c("_file_modified_at")
    aggregates = {"total_postings": F.count("*"), "first_seen_at": F.min(seen), "last_seen_at": F.max(seen)}
    best = dedup.best_with_span(df, ["employer_name"], order, aggregates)
    return best.select("employer_name", "ingest_seq", *aggregates)


@query(
    "f5_longest_value",
    """select distinct source, first_value(text) over (partition by source
           order by length(coalesce(text, '')) desc, coalesce(text, '') desc) as longest_text,
           first_value(lang) over (partition by source
           order by length(coalesce(lang, '')) desc, coalesce(lang, '') desc) as longest_lang from documents""",
)
def f5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(
        dedup.longest_value("text").alias("longest_text"), dedup.longest_value("lang").alias("longest_lang")
    )


@query(
    "f6_latest_snapshot",
    "select o_custkey, o_orderpriority, o_orderstatus, o_orderkey, o_totalprice from orders "
    "qualify row_number() over (partition by o_custkey, o_orderpriority, o_orderstatus "
    "order by strftime(o_orderdate, '%Y%m%d')::int desc, o_orderkey desc) = 1",
)
def f6(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").withColumn("date_key", keys.date_key("o_orderdate"))
    latest = dedup.latest_per_key(df, ["o_custkey", "o_orderpriority", "o_orderstatus"], "date_key", "o_orderkey")
    return latest.select("o_custkey", "o_orderpriority", "o_orderstatus", "o_orderkey", "o_totalprice")


@query("f7_lag", f"{SERIES_SQL} select o_orderkey, prev_value, prev_day from series")
def f7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_series(spark, sf_dir).select("o_orderkey", "prev_value", "prev_day")


@query("f8_first_observation", f"{SERIES_SQL} select o_orderkey, first_value, first_day from series")
def f8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_series(spark, sf_dir).select("o_orderkey", "first_value", "first_day")


@query("f9_snapshot_number", f"{SERIES_SQL} select o_orderkey, snapshot_number, total_snapshots from series")
def f9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_series(spark, sf_dir).select("o_orderkey", "snapshot_number", "total_snapshots")


SEGMENTS_SQL = """
counted as (select p_name, p_brand, p_type, count(*) as n from part group by all)"""


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_name", "p_brand", "p_type").agg(F.count("*").alias("n"))


@query(
    "f10_rank_in_segment",
    f"with {SEGMENTS_SQL} select *, cast(row_number() over (partition by p_type order by n desc, p_name, p_brand) as int) "
    "as segment_rank from counted",
)
def f10(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [c("n").desc(), c("p_name").asc(), c("p_brand").asc()]
    found = ranked(_segments(spark, sf_dir), ["p_type"], order, "segment_rank")
    return found.withColumn("segment_rank", c("segment_rank").cast("int"))


@query(
    "f11_ratio_to_average",
    f"with {SEGMENTS_SQL} select *, round(n / nullif(avg(n) over (partition by p_name, p_type), 0), 2) as demand_index "
    "from counted",
)
def f11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.index_to_average(_segments(spark, sf_dir), "n", ["p_name", "p_type"], "demand_index")


# --- G: sorts and top-k ------------------------------------------------------------------

@query("g1_global_order", f"{PART_COMPANIES}, {duplicate_pairs('part_companies')} select key_a, key_b, match_confidence, same_website, combined_postings, similarity_pct from duplicates")
def g1(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = part_companies(spark, sf_dir)
    pairs = classify_pairs(similar_pairs(companies, "company_key", "company_name_clean"), companies)
    return pairs.orderBy(*actionable_order()).select(
        "key_a", "key_b", "match_confidence", "same_website", "combined_postings", "similarity_pct"
    )


@query(
    "g2_top_n_per_segment",
    f"with {SEGMENTS_SQL} select * from (select *, cast(row_number() over (partition by p_type "
    "order by n desc, p_name, p_brand) as int) as segment_rank from counted) where segment_rank <= 5",
)
def g2(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [c("n").desc(), c("p_name").asc(), c("p_brand").asc()]
    ranked = rates.rank_in_segment(_segments(spark, sf_dir), ["p_type"], order, "segment_rank")
    return ranked.filter("segment_rank <= 5")


@query(
    "g3_global_cap",
    f"""with h as (select *, {HASH_SQL} as content_hash from documents)
        select cast(doc_id as varchar) as job_id, content_hash from h
        qualify row_number() over (partition by content_hash order by lang, source, doc_id) = 1
        order by lang, source, doc_id limit 100""",
)
def g3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cap is the feature: at most 100 pending texts, in partition order."""
    jobs = table(spark, sf_dir, "documents").select(
        c("doc_id").cast("string").alias("job_id"),
        c("source").alias("title"),
        c("text").alias("description"),
        c("lang").alias("query"),
        c("source").alias("_file_path"),
        c("doc_id").alias("_line_id"),
    )
    none = jobs.select(F.lit("").alias("content_hash")).filter(F.lit(False))
    return enrichment.capped(enrichment.pending(jobs, none), 100).select("job_id", "content_hash")


# --- H: set operations and reshaping -----------------------------------------------------

@query(
    "h1_tagged_union",
    "select c_custkey as id, c_nationkey as nation, 'customer' as source from customer "
    "union all select s_suppkey, s_nationkey, 'supplier' from supplier",
)
def h1(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(c("c_custkey").alias("id"), c("c_nationkey").alias("nation"))
    suppliers = table(spark, sf_dir, "supplier").select(c("s_suppkey").alias("id"), c("s_nationkey").alias("nation"))
    return reshape.union_tagged({"customer": customers, "supplier": suppliers})


@query(
    "h2_unknown_member",
    "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer "
    "union all select -1, 'Unknown', null, 0.0, null",
)
def h2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.with_unknown_member(table(spark, sf_dir, "customer"), c_custkey=-1, c_name="Unknown", c_acctbal=0.0)


FLAG_LABELS = {
    "returned": ("Returned", "Status"),
    "large": ("Large", "Size"),
    "cheap": ("Cheap", "Price"),
    "taxed": ("Taxed", "Price"),
}
FLAG_TESTS = {
    "returned": "l_returnflag = 'R'",
    "large": "l_quantity >= 30",
    "cheap": "l_discount > 0.05",
    "taxed": "l_tax > 0.02",
}


@query(
    "h3_unpivot_flags",
    " union all ".join(
        f"select l_orderkey, l_linenumber, l_partkey, {d.lit(FLAG_LABELS[n][0])} as skill_name, "
        f"{d.lit(FLAG_LABELS[n][1])} as skill_category from lineitem where {test}"
        for n, test in FLAG_TESTS.items()
    ),
)
def h3(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = [F.expr(test).cast("int").alias(f"skill_{n}") for n, test in FLAG_TESTS.items()]
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *flags)
    return reshape.unpivot_flags(lines, FLAG_LABELS)


@query(
    "h4_date_spine",
    """select s.date_day, count(o.o_orderkey) as orders
       from (select cast(unnest(range(lo, hi, interval 1 day)) as date) as date_day
             from (select min(o_orderdate) as lo, max(o_orderdate) as hi from orders)) s
       left join orders o on cast(o.o_orderdate as date) = s.date_day group by 1""",
)
def h4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day the orders span, the last one excluded, with that day's orders."""
    orders = table(spark, sf_dir, "orders").select(c("o_orderdate").cast("date").alias("date_day"))
    bounds = orders.agg(F.min("date_day").alias("start"), F.max("date_day").alias("end"))
    per_day = orders.groupBy("date_day").agg(F.count("*").alias("orders"))
    days = reshape.date_spine(bounds, "start", "end")
    return days.join(per_day, "date_day", "left").select(
        "date_day", F.coalesce("orders", F.lit(0)).alias("orders")
    )


# --- A14, A15: watermark and upsert ------------------------------------------------------

CUT = "2024-01-20"


@query("a14_since_watermark", f"select event_id, ts, value from events where ts > (select max(ts) from events where ts < timestamp '{CUT}')")
def a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    target = events.filter(c("ts") < F.lit(CUT).cast("timestamp_ntz"))
    return incremental.since_watermark(events, target, "ts")


@query(
    "a15_upsert",
    "select user_id, event_type, event_id, ts, value from events "
    "qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1",
)
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest rows before the cut, then merged with the latest rows after it."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    by = ["user_id", "event_type"]
    old = c("ts") < F.lit(CUT).cast("timestamp_ntz")
    target = dedup.latest_per_key(events.filter(old), by, "ts", "event_id")
    source = dedup.latest_per_key(events.filter(~old), by, "ts", "event_id")
    return incremental.upsert(target, source, by)
