"""Sources and sinks, enrichment, checks and streams (A, F12, J, K, L) as queries.

Queries about files first write driver rows into a raw zone below the shared
scratch folder and then read them back. Days are cut to years, so a run makes a
few dozen folders.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave import schemas
from jobweave.operators import audit, checks, dedup
from jobweave.plans import enrichment
from jobweave.session import scratch_path
from jobweave.sources.change_table import ChangeTable
from jobweave.sources import raw_zone, tables
from jobweave.streaming import incremental as streams
from jobweave.verify import dialect as d
from jobweave.verify import inputs
from jobweave.verify.inputs import INPUT_SQL, table
from jobweave.verify.registry import query

c = F.col

ESTIMATE_COLUMNS = [
    "job_title", "location", "median_salary", "salary_period", "salary_currency", "salary_count", "publisher_name",
]
_FILES = "*.json"


def _zone_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Estimates with raw-zone partition values."""
    df = inputs.estimates(spark, sf_dir)
    fields = [f.name for f in schemas.ESTIMATE.fields]
    return df.select(
        *fields,
        F.lit("salary_estimate").alias("endpoint"),
        F.trunc(c("_file_modified_at").cast("date"), "year").alias("ingestion_date"),
        # Two labels whose readable forms are equal: a blank and a slash, and what they are replaced by.
        F.when(c("ingest_seq") % 4 == 2, F.lit("pay_q-1"))
        .otherwise(F.concat(F.lit("pay q/"), (c("ingest_seq") % 4).cast("string")))
        .alias("query"),
    )


_ZONE_SQL = f"""{INPUT_SQL}, zone as (
    select *, 'salary_estimate' as endpoint, cast(date_trunc('year', ingestion_date) as date) as day,
           case when ingest_seq % 4 = 2 then 'pay_q-1'
                else 'pay_q-' || (ingest_seq % 4) || '-' || left(md5('pay q/' || (ingest_seq % 4)), 16) end as query
    from estimates
)"""
_RERUN_SQL = "(day = date '2023-01-01' and query = 'pay_q-1-' || left(md5('pay q/1'), 16))"


def _zone(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "zone")
    raw_zone.write_raw_zone(_zone_rows(spark, sf_dir), root)
    return root


@query("a1_jsonl_scan", f"{_ZONE_SQL} select {', '.join(ESTIMATE_COLUMNS)} from zone")
def a1(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = raw_zone.scan_jsonl(spark, _zone(spark, sf_dir), schemas.ESTIMATE, _FILES)
    return df.select(*ESTIMATE_COLUMNS)


@query(
    "a2_file_metadata",
    f"{_ZONE_SQL} select 'json' as kind, true as recent, count(*) as records, count(distinct (day, query)) as folders "
    "from zone",
)
def a2(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = raw_zone.scan_jsonl(spark, _zone(spark, sf_dir), schemas.ESTIMATE, _FILES)
    recent = c("_file_modified_at") > F.current_timestamp() - F.expr("interval 1 day")
    folder = F.regexp_extract("_file_path", "(.*)/[^/]+$", 1)
    return df.groupBy(F.regexp_extract("_file_path", "[.]([a-z]+)$", 1).alias("kind"), recent.alias("recent")).agg(
        F.count("*").alias("records"), F.count_distinct(folder).alias("folders")
    )


@query(
    "a3_path_partition_values",
    f"{_ZONE_SQL} select day as ingestion_date, query, 'none' as region, count(*) as records from zone group by all",
)
def a3(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = raw_zone.scan_jsonl(spark, _zone(spark, sf_dir), schemas.ESTIMATE, _FILES)
    return df.groupBy(
        raw_zone.path_date("_file_path").alias("ingestion_date"),
        raw_zone.path_part("_file_path", "query", "unknown").alias("query"),
        raw_zone.path_part("_file_path", "region", "none").alias("region"),
    ).agg(F.count("*").alias("records"))


@query(
    "a4_list_partitions",
    f"{_ZONE_SQL} select distinct endpoint, day as ingestion_date, query from zone where day = date '2023-01-01'",
)
def a4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_zone.list_partitions(
        spark, _zone(spark, sf_dir), "salary_estimate", "2023-01-01", _FILES
    )


_DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@query(
    "a5_tolerant_jsonl",
    "select case when doc_id % 7 = 0 then 'bad' else 'good' end as kind, count(*) as records, "
    "cast(sum(case when doc_id % 7 <> 0 then length(text) end) as bigint) as characters from documents group by 1",
)
def a5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document in seven becomes a broken line and every third is followed by a blank one."""
    docs = table(spark, sf_dir, "documents")
    line = F.to_json(F.struct("doc_id", "text"))
    broken = F.when(c("doc_id") % 7 == 0, F.concat(F.lit("{broken "), c("doc_id").cast("string"))).otherwise(line)
    root = scratch_path(spark, "tolerant")
    docs.select(F.concat(broken, F.when(c("doc_id") % 3 == 0, F.lit("\n")).otherwise(F.lit("")))).write.text(root)
    good, bad = raw_zone.scan_jsonl_tolerant(spark, root, _DOC, "*.txt")
    counted = good.agg(
        F.lit("good").alias("kind"), F.count("*").alias("records"), F.sum(F.length("text")).alias("characters")
    )
    return counted.unionByName(
        bad.agg(
            F.lit("bad").alias("kind"), F.count("line").alias("records"),
            F.lit(None).cast("bigint").alias("characters"),
        )
    )


@query(
    "a6_csv_scan",
    "select distinct p_type || ' ' || p_name as title_normalized, p_type as role_family, p_brand as role_subfamily, "
    "p_size > 25 as is_technical, p_size % 2 = 0 as is_management from part",
)
def a6(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = table(spark, sf_dir, "part").select(
        F.concat_ws(" ", "p_type", "p_name").alias("title_normalized"),
        c("p_type").alias("role_family"),
        c("p_brand").alias("role_subfamily"),
        (c("p_size") > 25).alias("is_technical"),
        (c("p_size") % 2 == 0).alias("is_management"),
    ).distinct()
    path = scratch_path(spark, "mapping")
    mapping.write.option("header", True).csv(path)
    return raw_zone.scan_csv(spark, path, schemas.TITLE_FAMILY)


@query(
    "a7_partition_overwrite",
    f"{_ZONE_SQL} select day as ingestion_date, query, count(*) as records, "
    "cast(count(case when publisher_name = 'rerun' then 1 end) as bigint) as rerun_records from ("
    f"select * replace ('rerun' as publisher_name) from zone where {_RERUN_SQL} and salary_count > 20 "
    f"union all select * from zone where not {_RERUN_SQL}) group by all",
)
def a7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run of one partition replaces it and leaves the rest."""
    root = _zone(spark, sf_dir)
    again = _zone_rows(spark, sf_dir).filter(
        (c("ingestion_date") == F.lit("2023-01-01").cast("date")) & (c("query") == "pay q/1") & (c("salary_count") > 20)
    )
    raw_zone.write_raw_zone(again.withColumn("publisher_name", F.lit("rerun")), root)
    df = raw_zone.read_partitioned(spark, root, schemas.ESTIMATE)
    return df.groupBy("ingestion_date", "query").agg(
        F.count("*").alias("records"), F.count(F.when(c("publisher_name") == "rerun", 1)).alias("rerun_records")
    )


@query(
    "a8_safe_partition_value",
    "select p_partkey, substr(translate(repeat(p_name || '/' || p_brand || ' ', 4), ' /', '_-'), 1, 80) as safe from part",
)
def a8(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_name = F.repeat(F.concat("p_name", F.lit("/"), "p_brand", F.lit(" ")), 4)
    return table(spark, sf_dir, "part").select("p_partkey", raw_zone.safe_partition_value(long_name).alias("safe"))


@query(
    "a9_query_label",
    f"""{INPUT_SQL} select ingest_seq, coalesce(
            case when ingest_seq % 3 = 0 then publisher_name when ingest_seq % 3 = 1 then null end,
            nullif(trim(coalesce(case when ingest_seq % 4 <> 0 then job_title end, '') || '_' ||
                        coalesce(case when ingest_seq % 5 <> 0 then location end, ''), '_'), ''),
            'salary_estimate') as label from estimates""",
)
def a9(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = c("ingest_seq")
    asked = F.when(key % 3 == 0, c("publisher_name")).when(key % 3 == 2, F.lit(""))
    label = raw_zone.query_label(
        asked, F.when(key % 4 != 0, c("job_title")), F.when(key % 5 != 0, c("location")), F.lit("salary_estimate")
    )
    return inputs.estimates(spark, sf_dir).select("ingest_seq", label.alias("label"))


def _fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a run, each of its lines a page; returned lines failed."""
    lines = table(spark, sf_dir, "lineitem")
    failed = c("l_returnflag") == "R"
    return lines.select(
        F.lit("job_search").alias("endpoint"),
        c("l_orderkey").cast("string").alias("query"),
        F.lit("2023-01-01").cast("date").alias("ingestion_date"),
        (c("l_linenumber") * 100000 + c("l_partkey")).cast("int").alias("page"),
        c("l_quantity").cast("bigint").alias("records"),
        failed.alias("failed"),
        F.when(failed, F.concat(F.lit("page "), c("l_linenumber").cast("string"))).alias("error"),
        c("l_shipdate").alias("started_at"),
        (c("l_shipdate") + F.expr("make_dt_interval(0, 1)")).alias("finished_at"),
    )


_AUDIT_SQL = """
with log as (
    select cast(l_orderkey as varchar) as query, l_linenumber * 100000 + l_partkey as page, l_returnflag = 'R' as failed,
           cast(l_quantity as bigint) as records, 'page ' || cast(l_linenumber as varchar) as error, l_shipdate as moment
    from lineitem
),
audit as (
    select query, count(case when not failed then 1 end) as pages_fetched, count(case when failed then 1 end) as pages_failed,
           cast(coalesce(sum(case when not failed then records end), 0) as bigint) as records_fetched,
           min(moment) as started_at, max(moment) + interval 1 hour as finished_at,
           coalesce(string_agg(case when failed then error end, '; ' order by page, error), '') as errors,
           case when count(case when failed then 1 end) = 0 then 'success'
                when coalesce(sum(case when not failed then records end), 0) > 0 then 'partial_failure'
                else 'failed' end as status
    from log group by query
)"""


@query("a10_run_audit", f"{_AUDIT_SQL} select * from audit")
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = audit.run_audit(_fetch_log(spark, sf_dir))
    return runs.drop("endpoint", "ingestion_date").withColumn(
        "errors", F.array_join("error_messages", "; ")
    ).drop("error_messages")


@query("a11_failed_runs", f"{_AUDIT_SQL} select query, pages_failed from audit where status = 'failed'")
def a11(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = audit.run_audit(_fetch_log(spark, sf_dir))
    return audit.failed_runs(runs).select("query", "pages_failed")


_RECORD = T.StructType([T.StructField("job_id", T.LongType()), T.StructField("part", T.LongType())])


@query("a12_envelope", "select o_custkey, l_orderkey as job_id, l_partkey as part from lineitem join orders on o_orderkey = l_orderkey")
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reply per order with its lines as records; an order has a few lines."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.collect_list(F.struct(c("l_orderkey").alias("job_id"), c("l_partkey").alias("part"))).alias("jobs")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    replies = orders.join(lines, c("o_orderkey") == c("l_orderkey"), "left")
    data = F.struct(F.coalesce("jobs", F.array().cast(lines.schema["jobs"].dataType)).alias("jobs"), F.lit("next").alias("cursor"))
    bodies = replies.select("o_custkey", F.to_json(F.struct(data.alias("data"))).alias("body"))
    return raw_zone.explode_envelope(bodies, "body", _RECORD, "data", "jobs").select("o_custkey", "record.*")


@query(
    "a13_dedup_keep_null_ids",
    """select case when o_orderkey % 3 <> 0 then o_custkey end as record_id, o_orderkey from orders
       qualify o_orderkey % 3 = 0 or row_number() over (
           partition by case when o_orderkey % 3 <> 0 then o_custkey end order by o_orderkey) = 1""",
)
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.when(c("o_orderkey") % 3 != 0, c("o_custkey")).alias("record_id"), "o_orderkey"
    )
    return dedup.dedup_keep_null_ids(orders, "record_id", [c("o_orderkey").asc()])


@query("a16_full_refresh", "select o_orderstatus, o_orderpriority, count(*) as n from orders group by 1, 2")
def a16(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "refresh")
    orders = table(spark, sf_dir, "orders")
    tables.materialize_table(orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")), path)
    counted = orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))
    return tables.materialize_table(counted, path)


@query("a17_view", "select o_orderstatus, count(*) as n from orders group by 1")
def a17(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return tables.materialize_view(counted, "orders_by_status")


_LABELED = "select cast(doc_id as varchar) as job_id, 'q' || cast(doc_id % 3 as varchar) as query, quality, toxic from labels"


@query("a18_append_enrichment", f"with l as ({_LABELED}) select job_id, query, 'first' as confidence from l union all select job_id, query, 'second' from l where toxic = 1")
def a18(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second append keeps what the first wrote."""
    labels = table(spark, sf_dir, "labels")
    root = scratch_path(spark, "append")

    def records(df: DataFrame, run: str) -> DataFrame:
        return df.select(
            c("doc_id").cast("string").alias("job_id"),
            F.lit(run).alias("confidence"),
            F.lit("job_search").alias("endpoint"),
            F.lit("2023-01-01").alias("ingestion_date"),
            F.concat(F.lit("q"), (c("doc_id") % 3).cast("string")).alias("query"),
        )

    raw_zone.append_enrichment(records(labels, "first"), root)
    raw_zone.append_enrichment(records(labels.filter("toxic = 1"), "second"), root)
    return raw_zone.read_partitioned(spark, root, schemas.ENRICHMENT).select("job_id", "query", "confidence")


@query("a19_mart_read", "select l_orderkey, l_linenumber, l_quantity from lineitem")
def a19(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "mart")
    table(spark, sf_dir, "lineitem").write.parquet(path)
    return tables.read_mart(spark, path, ["l_orderkey", "l_linenumber", "l_quantity"])


# --- F12, J: enrichment ------------------------------------------------------------------

_SWEPT = T.StructType([f for f in schemas.POSTING.fields if f.name in ("job_id", "job_title", "job_description")])


def _swept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as postings that recur under several queries, in a raw zone."""
    docs = table(spark, sf_dir, "documents")
    copies = docs.select("*", F.explode(F.array(F.lit(0), F.lit(3))).alias("shift"))
    rows = copies.select(
        c("doc_id").cast("string").alias("job_id"),
        F.when(c("doc_id") % 11 != 0, c("source")).otherwise(F.lit("")).alias("job_title"),
        c("text").alias("job_description"),
        F.lit("job_search").alias("endpoint"),
        F.lit("2023-01-01").cast("date").alias("ingestion_date"),
        F.concat(F.lit("q "), ((c("doc_id") + c("shift")) % 5).cast("string")).alias("query"),
    )
    root = scratch_path(spark, "sweep")
    raw_zone.write_raw_zone(rows, root)
    good, _bad = raw_zone.scan_jsonl_tolerant(spark, root, _SWEPT, _FILES)
    return good


_SWEPT_SQL = """
with swept as (
    select cast(doc_id as varchar) as job_id, source as title, text as description,
           least(doc_id % 5, (doc_id + 3) % 5) as label, doc_id % 11 = 0 as untitled,
           'q_' || label || '-' || left(md5('q ' || label), 16) as query
    from documents
),
hashed_all as (
    select *, sha256(lower(regexp_replace(title, '^\\s+|\\s+$', '', 'g')) || chr(10) ||
                     lower(regexp_replace(description, '^\\s+|\\s+$', '', 'g'))) as content_hash from swept
),
hashed as (
    select * from hashed_all where not untitled
),
seen as (
    select distinct content_hash from hashed_all join labels on cast(doc_id as varchar) = job_id where quality = 1
)"""


@query("f12_first_in_path_order", f"{_SWEPT_SQL} select job_id, query from swept where not untitled")
def f12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _swept(spark, sf_dir).filter(c("job_title") != "")
    return dedup.first_seen(rows, "job_id").select(
        "job_id", raw_zone.path_part("_file_path", "query", "unknown").alias("query")
    )


@query("j1_content_hash", f"{_SWEPT_SQL} select job_id, content_hash from hashed_all")
def j1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        c("doc_id").cast("string").alias("job_id"), enrichment.content_hash("source", "text").alias("content_hash")
    )


@query("j2_sweep", f"{_SWEPT_SQL} select job_id, title, description, query from swept where not untitled")
def j2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.sweep(_swept(spark, sf_dir)).select("job_id", "title", "description", "query")


MODEL, PROMPT = "stub-1", "v1"


def _stored(spark: SparkSession, sf_dir: str) -> str:
    """Enrichment records: good texts under this model, the others under an old one, and broken lines."""
    docs = table(spark, sf_dir, "documents")
    labeled = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    record = F.struct(
        c("doc_id").cast("string").alias("job_id"),
        enrichment.content_hash("source", "text").alias("content_hash"),
        F.when(c("quality") == 1, F.lit(MODEL)).otherwise(F.lit("old")).alias("model_version"),
        F.lit(PROMPT).alias("prompt_version"),
    )
    line = F.to_json(record)
    cut = F.concat(line, F.when(c("toxic") == 1, F.lit("\n{oops")).otherwise(F.lit("")))
    root = scratch_path(spark, "stored")
    labeled.select(cut).write.text(root)
    return root


def _seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _bad = raw_zone.scan_jsonl_tolerant(spark, _stored(spark, sf_dir), schemas.ENRICHMENT, "*.txt")
    return enrichment.seen_hashes(good, MODEL, PROMPT)


@query(
    "j3_pending",
    f"{_SWEPT_SQL} select content_hash, min(query) as query from hashed where content_hash not in (select content_hash from seen) group by 1",
)
def j3(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = enrichment.pending(enrichment.sweep(_swept(spark, sf_dir)), _seen(spark, sf_dir))
    return todo.select("content_hash", "query")


@query("j4_seen_hashes", f"{_SWEPT_SQL} select content_hash from seen")
def j4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seen(spark, sf_dir)


EXAMPLES = [("TITLE: Example One\nDESCRIPTION: Python and SQL.", '{"role_family": "data_engineer"}')]


@query(
    "j5_prompt",
    "select doc_id, 'TITLE: Example One' || chr(10) || 'DESCRIPTION: Python and SQL.' || chr(10) || "
    "'{\"role_family\": \"data_engineer\"}' || chr(10) || 'TITLE: ' || source || chr(10) || 'DESCRIPTION: ' || "
    "substr(text, 1, 8000) as prompt from documents",
)
def j5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", enrichment.full_prompt("source", "text", EXAMPLES, enrichment.MAX_DESCRIPTION).alias("prompt")
    )


# Reply texts a model may give; {n} is the document number.
REPLIES = [
    '{"role_family": "data_engineer", "seniority": "senior", "skills_required": [" SQL ", "n{n}"], '
    '"skills_preferred": [], "confidence": "high"}',
    '```json\n{"role_family": "ml_engineer", "seniority": "mid", "skills_required": ["a", " "], '
    '"skills_preferred": ["b"], "confidence": "low"}\n```',
    '{"role_family": "wizard", "seniority": "senior", "skills_required": ["x{n}"], "skills_preferred": [], '
    '"confidence": "high"}',
    '{"role_family": "data_analyst", "seniority": "lead", "skills_required": ["x"], "skills_preferred": []}',
    '{"role_family": "data_analyst", "seniority": "lead", "skills_required": ["x"], "skills_preferred": [], '
    '"confidence": "high", "note": "extra {n}"}',
    '{"role_family": "data_analyst", "seniority": "lead", "skills_required": "x, y", "skills_preferred": ["z"], '
    '"confidence": "medium"}',
    '{"role_family": "data_analyst", "seniority": "boss", "skills_required": ["q", 2, null, "  "], '
    '"skills_preferred": ["z{n}"], "confidence": "sure"}',
    "no json at all {n}",
    '["data_engineer", "senior"]',
    None,
    "API_ERROR: CallError: server {n}",
]


def _reply_case(number: str) -> str:
    whens = []
    for i, reply in enumerate(REPLIES):
        if reply is None:
            whens.append(f"when {i} then null")
            continue
        text = d.lit(reply).replace("\n", "' || chr(10) || '")
        whens.append(f"when {i} then replace({text}, '{{n}}', cast({number} as varchar))")
    return f"case {number} % {len(REPLIES)} {' '.join(whens)} end"


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = c("doc_id")
    out = F
    for i, reply in enumerate(REPLIES):
        text = F.lit(None).cast("string") if reply is None else F.replace(
            F.lit(reply), F.lit("{n}"), number.cast("string")
        )
        out = out.when(number % len(REPLIES) == i, text)
    return table(spark, sf_dir, "documents").select("doc_id", out.alias("raw_response"))


def _json_list(field: str) -> str:
    return (
        f"case when status <> 'failed' and json_type(js, '$.{field}') = 'ARRAY' then array_to_string(list_filter("
        f"list_transform(list_filter(from_json(json_extract(js, '$.{field}'), '[\"JSON\"]'), lambda v: json_type(v) = 'VARCHAR'), "
        f"lambda v: trim(json_extract_string(v, '$'))), lambda s: s <> ''), '|') else '' end"
    )


def _all_strings(field: str) -> str:
    return (
        f"(json_type(js, '$.{field}') = 'ARRAY' and len(list_filter(from_json(json_extract(js, '$.{field}'), '[\"JSON\"]'), "
        f"lambda v: json_type(v) <> 'VARCHAR')) = 0)"
    )


_PARSED_SQL = f"""
with raw as (select doc_id, {_reply_case('doc_id')} as raw_response from documents),
cleaned as (
    select *, trim(regexp_replace(regexp_replace(trim(raw_response, chr(10) || ' '), '^```json', ''), '```$', ''),
                   chr(10) || ' ') as txt from raw
),
typed as (
    select *, case when json_valid(txt) and json_type(txt) = 'OBJECT' then cast(txt as json) end as js from cleaned
),
graded as (
    select *, case when js is null then 'failed'
        when list_sort(json_keys(js)) = list_sort({enrichment.REPLY_FIELDS})
         and json_extract_string(js, '$.role_family') in {d.names(enrichment.ROLE_FAMILIES)}
         and json_extract_string(js, '$.seniority') in {d.names(enrichment.SENIORITIES)}
         and json_extract_string(js, '$.confidence') in {d.names(enrichment.CONFIDENCES)}
         and {_all_strings('skills_required')} and {_all_strings('skills_preferred')} then 'ok'
        else 'coerced' end as status
    from typed
),
parsed as (
    select doc_id, status as parse_status,
           case when json_extract_string(js, '$.role_family') in {d.names(enrichment.ROLE_FAMILIES)}
                then json_extract_string(js, '$.role_family') else 'other' end as role_family,
           case when json_extract_string(js, '$.seniority') in {d.names(enrichment.SENIORITIES)}
                then json_extract_string(js, '$.seniority') else 'unspecified' end as seniority,
           {_json_list('skills_required')} as skills_required, {_json_list('skills_preferred')} as skills_preferred,
           case when status = 'failed' then 'low' when json_exists(js, '$.confidence')
                then json_extract_string(js, '$.confidence') else 'medium' end as confidence
    from graded
)"""


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = enrichment.parse_reply(_replies(spark, sf_dir)).drop("raw_response")
    return df.withColumns(
        {n: F.array_join(n, "|") for n in ("skills_required", "skills_preferred")}
    )


def _status_query(name: str, status: str) -> None:
    @query(name, f"{_PARSED_SQL} select * from parsed where parse_status = '{status}'")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _parsed(spark, sf_dir).filter(c("parse_status") == status)


_status_query("j6_strict_parse", "ok")
_status_query("j7_lenient_parse", "coerced")
_status_query("j8_failed_parse", "failed")


def stub_model(prompt: str) -> str:
    """Stands in for a remote model: answers from the prompt's length alone."""
    size = len(prompt)
    if size % 5 == 0:
        raise enrichment.CallError(f"bad request {size}", status=400)
    if size % 5 == 1:
        raise enrichment.CallError(f"server {size}", status=503)
    family = enrichment.ROLE_FAMILIES[size % len(enrichment.ROLE_FAMILIES)]
    return json.dumps(
        {
            "role_family": family, "seniority": "mid", "skills_required": ["SQL"], "skills_preferred": [],
            "confidence": "high",
        }
    )


_STUB_SQL = """
asked as (
    select *, 'TITLE: ' || title || chr(10) || 'DESCRIPTION: ' || description as prompt
    from {source}
),
answered as (
    select *, length(prompt) as size from asked
)"""

_FAMILY_SQL = f"list_extract({enrichment.ROLE_FAMILIES}, size % {len(enrichment.ROLE_FAMILIES)} + 1)"


@query(
    "j9_call_failures",
    f"{_SWEPT_SQL}, {_STUB_SQL.format(source='hashed_all')} select job_id, 'API_ERROR: CallError: ' || "
    "case when size % 5 = 0 then 'bad request ' else 'server ' end || cast(size as varchar) as raw_response, "
    "'failed' as parse_status, 'other' as role_family from answered where size % 5 < 2",
)
def j9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    asked = docs.select(
        c("doc_id").cast("string").alias("job_id"),
        enrichment.content_hash("source", "text").alias("content_hash"),
        F.lit("q").alias("query"),
        enrichment.prompt_text("source", "text").alias("prompt"),
    )
    replies = enrichment.infer(asked, stub_model, first_wait=0.0)
    failed = enrichment.parse_reply(replies.filter(c("raw_response").startswith("API_ERROR: ")))
    return failed.select("job_id", "raw_response", "parse_status", "role_family")


@query(
    "j10_batch_inference",
    f"{_SWEPT_SQL}, {_STUB_SQL.format(source='hashed_all')} select job_id, content_hash, {_FAMILY_SQL} as role_family "
    "from answered where size % 5 >= 2",
)
def j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    asked = docs.select(
        c("doc_id").cast("string").alias("job_id"),
        enrichment.content_hash("source", "text").alias("content_hash"),
        F.lit("q").alias("query"),
        enrichment.prompt_text("source", "text").alias("prompt"),
    )
    replies = enrichment.infer(asked, stub_model, first_wait=0.0)
    family = F.get_json_object("raw_response", "$.role_family")
    return replies.filter(~c("raw_response").startswith("API_ERROR: ")).select(
        "job_id", "content_hash", family.alias("role_family")
    )


_BATCH_SQL = f"""{_SWEPT_SQL},
todo as (
    select * from hashed where content_hash not in (select content_hash from seen)
    qualify row_number() over (partition by content_hash order by query, job_id) = 1
), {_STUB_SQL.format(source='todo')}"""


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "batch")
    stored = _stored(spark, sf_dir)
    done, _bad = raw_zone.scan_jsonl_tolerant(spark, stored, schemas.ENRICHMENT, "*.txt")
    enrichment.run_batch(
        spark, _swept(spark, sf_dir), done, out, stub_model, "2023-01-02", MODEL, PROMPT, first_wait=0.0
    )
    return enrichment.read_enrichment(spark, out)


@query(
    "j11_batch_driver",
    f"{_BATCH_SQL} select content_hash, case when size % 5 < 2 then 'failed' else 'ok' end as parse_status, "
    f"case when size % 5 < 2 then 'other' else {_FAMILY_SQL} end as role_family, '{MODEL}' as model_version from answered",
)
def j11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch(spark, sf_dir).select("content_hash", "parse_status", "role_family", "model_version")


@query("j12_enrichment_summary", f"{_PARSED_SQL} select parse_status, role_family, seniority, count(*) as records from parsed group by all")
def j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.summary(enrichment.parse_reply(_replies(spark, sf_dir)))


# --- K: checks ---------------------------------------------------------------------------

def _report(name: str, column: str, check: str, failures: str) -> str:
    return f"select '{name}' as table_name, '{column}' as column_name, '{check}' as check_name, {failures} as failures"


@query(
    "k1_not_null",
    f"{INPUT_SQL} "
    + " union all ".join(
        _report("postings", col, "not_null", f"count(*) - count({col})") + " from postings"
        for col in ("job_id", "employer_name", "job_city", "job_min_salary")
    ),
)
def k1(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = checks.CheckSpec(not_null=["job_id", "employer_name", "job_city", "job_min_salary"])
    return checks.run_checks(inputs.postings(spark, sf_dir), "postings", spec)


@query(
    "k2_unique",
    " union all ".join(
        _report("orders", col, "unique", "count(*)") + f" from (select {col} from orders group by 1 having count(*) > 1)"
        for col in ("o_orderkey", "o_custkey")
    ),
)
def k2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.run_checks(
        table(spark, sf_dir, "orders"), "orders", checks.CheckSpec(unique=["o_orderkey", "o_custkey"])
    )


@query(
    "k3_relationships",
    _report("orders", "o_custkey", "relationships", "count(*)")
    + " from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)",
)
def k3(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    spec = checks.CheckSpec(parents={"o_custkey": (parent, "c_custkey")})
    return checks.run_checks(table(spark, sf_dir, "orders"), "orders", spec)


@query(
    "k4_between",
    " union all ".join(
        [
            _report("customer", "c_acctbal", "between", "count(*)") + " from customer where c_acctbal < 0 or c_acctbal > 9000",
            _report("customer", "c_custkey", "between", "count(*)") + " from customer where c_custkey < 1",
        ]
    ),
)
def k4(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = checks.CheckSpec(between={"c_acctbal": (0, 9000), "c_custkey": (1, None)})
    return checks.run_checks(table(spark, sf_dir, "customer"), "customer", spec)


# --- L: streams --------------------------------------------------------------------------

_EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines in several files, read as a stream."""
    root = scratch_path(spark, "events")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    events.repartition(4, "event_id").write.json(root)
    return streams.raw_stream(spark, root, _EVENT, _FILES, files_per_batch=2).drop("_file_path", "_file_modified_at")


@query("l1_stream_ingest", "select event_id, user_id, event_type, value from events")
def l1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "stream-out")
    streams.ingest(_event_stream(spark, sf_dir), out, scratch_path(spark, "stream-check")).awaitTermination()
    return spark.read.schema(_EVENT).parquet(out).select("event_id", "user_id", "event_type", "value")


@query("l2_stream_dedup", "select distinct user_id from events")
def l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user is kept once, however late its events and whatever the order of files."""
    out = scratch_path(spark, "stream-out")
    streams.dedup_stored(
        _event_stream(spark, sf_dir), out, "user_id", ["ts", "event_id"], scratch_path(spark, "stream-check")
    ).awaitTermination()
    return spark.read.parquet(out).select("user_id")


@query(
    "l3_stream_upsert",
    "select user_id, event_id, event_type, value from events "
    "qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1",
)
def l3(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = ChangeTable(spark, scratch_path(spark, "stream-table"), ["user_id"], ["ts", "event_id"])
    streams.upsert_changes(_event_stream(spark, sf_dir), users, scratch_path(spark, "stream-check")).awaitTermination()
    return users.read().select("user_id", "event_id", "event_type", "value")
