"""Enrichment of postings by a caller-supplied model.

No client is shipped: the caller passes a function from prompt to reply. The
pending set, the parsing of replies and the storage are DataFrame work; only the
call itself runs in Python workers.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave import schemas
from jobweave.functions import as_col
from jobweave.operators.dedup import best_per_key, first_seen
from jobweave.operators.joins import not_in
from jobweave.sources.raw_zone import append_enrichment, path_part, scan_jsonl_tolerant
from jobweave.session import scratch_path, ship_package
from jobweave.sources.tables import stage

# What a reply may contain.
ROLE_FAMILIES = [
    "data_engineer", "analytics_engineer", "data_analyst", "data_scientist",
    "ml_engineer", "ai_engineer", "platform_engineer", "software_engineer",
    "bi_developer", "data_architect", "database_administrator",
    "engineering_manager", "data_product_manager", "other",
]
SENIORITIES = ["intern", "junior", "mid", "senior", "staff", "lead", "manager", "director", "unspecified"]
CONFIDENCES = ["high", "medium", "low"]
REPLY_FIELDS = ["role_family", "seniority", "skills_required", "skills_preferred", "confidence"]

# Longest description sent, tries and first wait in seconds.
MAX_DESCRIPTION = 8000
TRIES = 3
FIRST_WAIT = 5.0
# A lost task repeats at most so many calls.
CALLS_PER_TASK = 200


class CallError(Exception):
    """A failed call; ``status`` is the HTTP status when there was one."""

    def __init__(self, message: str, status: int | None = None) -> None:
        super().__init__(message)
        self.status = status

    @property
    def retryable(self) -> bool:
        """Client errors fail the same way again, except too many requests."""
        return self.status is None or self.status == 429 or not 400 <= self.status < 500


def strip(text: Column | str) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(as_col(text), r"^\s+|\s+$", "")


def content_hash(title: Column | str, description: Column | str) -> Column:
    parts = [F.lower(strip(x)) for x in (title, description)]
    return F.sha2(F.concat(parts[0], F.lit("\n"), parts[1]), 256)


def has_required_fields(*fields: str) -> Column:
    test = F.lit(True)
    for name in fields:
        test = test & F.col(name).isNotNull() & (F.col(name) != "")
    return test


def sweep(postings: DataFrame) -> DataFrame:
    """Unique complete postings; the first partition in path order gives the query."""
    complete = postings.filter(has_required_fields("job_id", "job_title", "job_description"))
    return first_seen(complete, "job_id").select(
        "job_id",
        F.col("job_title").alias("title"),
        F.col("job_description").alias("description"),
        path_part("_file_path", "query", "unknown").alias("query"),
        "_file_path",
        "_line_id",
    )


def seen_hashes(enriched: DataFrame, model: str, prompt: str) -> DataFrame:
    """Hashes done under this model and prompt version; broken lines have none."""
    current = (F.col("model_version") == model) & (F.col("prompt_version") == prompt)
    return enriched.filter(current & F.col("content_hash").isNotNull()).select("content_hash").distinct()


def pending(jobs: DataFrame, seen: DataFrame) -> DataFrame:
    """One posting per text not enriched yet.

    Copies are reduced before the anti-join, so a text that makes up a third of
    all postings meets it once.
    """
    hashed = jobs.withColumn("content_hash", content_hash("title", "description"))
    single = best_per_key(
        hashed, ["content_hash"], [F.col("query").asc(), F.col("_file_path").asc(), F.col("_line_id").asc()]
    )
    return not_in(single, seen, ["content_hash"])


def capped(jobs: DataFrame, limit: int | None) -> DataFrame:
    """First ``limit`` postings in partition order, a cost control of the caller."""
    if limit is None:
        return jobs
    return jobs.orderBy("query", "_file_path", "_line_id").limit(limit)


def prompt_text(title: Column | str, description: Column | str, max_description: int | None = None) -> Column:
    """Question part of the prompt; the whole description, or its start where a model needs a limit."""
    text = as_col(description)
    if max_description is not None:
        text = F.substring(text, 1, max_description)
    return F.concat(F.lit("TITLE: "), as_col(title), F.lit("\nDESCRIPTION: "), text)


def full_prompt(
    title: Column | str,
    description: Column | str,
    examples: list[tuple[str, str]],
    max_description: int | None = None,
) -> Column:
    """Examples as question and answer, then the question."""
    shots = [F.lit(f"{question}\n{answer}\n") for question, answer in examples]
    return F.concat(*shots, prompt_text(title, description, max_description))


def _call_with_retries(call: Callable[[str], str], prompt: str, tries: int, first_wait: float) -> str:
    reason = "unknown"
    for attempt in range(tries):
        try:
            return call(prompt)
        except Exception as error:  # any fault of one call must not repeat the calls of a whole task
            reason = f"{type(error).__name__}: {error}"
            if not getattr(error, "retryable", True):
                break
            if attempt + 1 < tries:
                time.sleep(first_wait * 2**attempt)
    return f"API_ERROR: {reason}"


def infer(
    jobs: DataFrame,
    call: Callable[[str], str],
    parallelism: int | None = None,
    tries: int = TRIES,
    first_wait: float = FIRST_WAIT,
) -> DataFrame:
    """Ask the model once per row of (job_id, content_hash, query, prompt).

    Partitions hold about ``CALLS_PER_TASK`` rows, or there are ``parallelism`` of
    them; the cluster's task slots bound the calls in flight. A retried task
    repeats its calls, so the result is written once and read from there.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies = [_call_with_retries(call, p, tries, first_wait) for p in batch["prompt"]]
            yield batch[["job_id", "content_hash", "query"]].assign(raw_response=replies)

    ship_package(jobs.sparkSession)
    schema = "job_id string, content_hash string, query string, raw_response string"
    asked = jobs.select("job_id", "content_hash", "query", "prompt")
    tasks = parallelism or max(1, -(-jobs.count() // CALLS_PER_TASK))
    return asked.repartition(tasks, "content_hash").mapInPandas(run, schema)


def _string_items(items: Column) -> Column:
    """Trimmed non-blank strings of a list of JSON values; other items are dropped."""
    texts = F.filter(items, lambda v: F.schema_of_variant(v) == "STRING")
    trimmed = F.transform(texts, lambda v: strip(F.try_variant_get(v, "$", "string")))
    return F.coalesce(F.filter(trimmed, lambda s: s != ""), F.array().cast("array<string>"))


def parse_reply(df: DataFrame, raw: str = "raw_response") -> DataFrame:
    """Turn replies into records with ``parse_status`` ok, coerced or failed.

    ok: exactly the five fields, every value allowed. coerced: a JSON object
    whose bad values fall back. failed: anything else, including a null reply.
    """
    fenced = F.regexp_replace(F.regexp_replace(strip(raw), r"^```json", ""), r"```$", "")
    df = df.withColumn("_text", strip(fenced))
    df = df.withColumns({"_json": F.try_parse_json("_text"), "_keys": F.json_object_keys("_text")})

    def text(field: str) -> Column:
        return F.try_variant_get("_json", f"$.{field}", "string")

    def items(field: str) -> Column:
        return F.try_variant_get("_json", f"$.{field}", "array<variant>")

    df = df.withColumns(
        {
            "_role": text("role_family"),
            "_level": text("seniority"),
            "_sure": text("confidence"),
            "_required": items("skills_required"),
            "_preferred": items("skills_preferred"),
        }
    )

    def all_strings(field: str) -> Column:
        test = F.forall(F.col(field), lambda v: F.schema_of_variant(v) == "STRING")
        return F.coalesce(test, F.lit(False))

    expected = F.array(*[F.lit(f) for f in sorted(REPLY_FIELDS)])
    strict = (
        (F.array_sort(F.array_distinct("_keys")) == expected)
        & F.coalesce(F.col("_role").isin(ROLE_FAMILIES), F.lit(False))
        & F.coalesce(F.col("_level").isin(SENIORITIES), F.lit(False))
        & F.coalesce(F.col("_sure").isin(CONFIDENCES), F.lit(False))
        & all_strings("_required")
        & all_strings("_preferred")
    )
    is_object = F.col("_json").isNotNull() & F.col("_keys").isNotNull()
    df = df.withColumn(
        "parse_status",
        F.when(~is_object, F.lit("failed")).when(strict, F.lit("ok")).otherwise(F.lit("coerced")),
    )
    failed = F.col("parse_status") == "failed"
    given = F.when(F.array_contains("_keys", "confidence"), F.col("_sure")).otherwise(F.lit("medium"))
    empty = F.array().cast("array<string>")
    return df.withColumns(
        {
            "role_family": F.when(F.col("_role").isin(ROLE_FAMILIES) & ~failed, F.col("_role")).otherwise("other"),
            "seniority": F.when(F.col("_level").isin(SENIORITIES) & ~failed, F.col("_level")).otherwise(
                "unspecified"
            ),
            "skills_required": F.when(failed, empty).otherwise(_string_items(F.col("_required"))),
            "skills_preferred": F.when(failed, empty).otherwise(_string_items(F.col("_preferred"))),
            "confidence": F.when(failed, F.lit("low")).otherwise(given),
        }
    ).drop("_text", "_json", "_keys", "_role", "_level", "_sure", "_required", "_preferred")


def to_records(parsed: DataFrame, model: str, prompt: str) -> DataFrame:
    """Records in the stored layout, stamped with the versions and the time."""
    stamped = parsed.withColumns(
        {
            "model_version": F.lit(model),
            "prompt_version": F.lit(prompt),
            "extracted_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"),
        }
    )
    keep = [f.name for f in schemas.ENRICHMENT.fields]
    return stamped.select(*keep, "query")


def read_enrichment(spark: SparkSession, root: str) -> DataFrame:
    """Stored records; unparsable lines are left out."""
    good, _bad = scan_jsonl_tolerant(spark, root, schemas.ENRICHMENT, glob="*.json")
    return good.select(*[f.name for f in schemas.ENRICHMENT.fields])


def run_batch(
    spark: SparkSession,
    postings: DataFrame,
    enriched: DataFrame,
    out_root: str,
    call: Callable[[str], str],
    day: str,
    model: str,
    prompt: str,
    examples: list[tuple[str, str]] | None = None,
    limit: int | None = None,
    parallelism: int | None = None,
    first_wait: float = FIRST_WAIT,
    max_description: int | None = None,
) -> DataFrame:
    """Sweep, select, ask, parse and append; returns what was appended.

    Replies are written before they are parsed, so no later step repeats a call.
    """
    todo = capped(pending(sweep(postings), seen_hashes(enriched, model, prompt)), limit)
    # Stored, so counting the calls to make doesn't repeat the sweep.
    asked = stage(todo.withColumn("prompt", full_prompt("title", "description", examples or [], max_description)), "asked")
    replies = scratch_path(spark, "replies")
    infer(asked, call, parallelism, first_wait=first_wait).write.parquet(replies)
    # Stored once, so the returned rows carry the time that was appended.
    records = stage(to_records(parse_reply(spark.read.parquet(replies)), model, prompt), "records")
    append_enrichment(
        records.withColumns({"endpoint": F.lit("job_search"), "ingestion_date": F.lit(day)}), out_root
    )
    return records


def with_enrichment(postings: DataFrame, enriched: DataFrame, columns: list[str]) -> DataFrame:
    """Attach each text's enrichment to every posting with that text.

    The enrichment side has one row per text; a text shared by many postings is
    skew on the posting side, which the adaptive join splits.
    """
    single = best_per_key(enriched, ["content_hash"], [F.col("extracted_at").desc(), F.col("job_id").asc()])
    return postings.join(single.select("content_hash", *columns), "content_hash", "left")


def summary(records: DataFrame) -> DataFrame:
    return records.groupBy("parse_status", "role_family", "seniority").agg(F.count("*").alias("records"))
