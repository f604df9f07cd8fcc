"""Whole models: incremental against full, full outer against cross join, stored against planned."""

from pyspark.sql import functions as F

from jobweave.functions import keys
from jobweave.operators import incremental
from jobweave.plans import intermediate, staging
from jobweave.plans.warehouse import Warehouse, build_all
from jobweave.session import scratch_path
from jobweave.sources.raw_zone import write_raw_zone, scan_jsonl
from jobweave import schemas
from jobweave.verify import inputs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_incremental_equals_full_refresh(spark, sf_dir):
    raw = inputs.postings(spark, sf_dir)
    stg = staging.stg_jobs(raw).cache()
    cut = F.lit("2024-06-01").cast("timestamp_ntz")
    first = intermediate.int_jobs_enriched(stg.filter(F.col("_ingested_at") <= cut))
    fresh = incremental.since_watermark(
        stg, first.withColumnRenamed("last_ingested_at", "_ingested_at"), "_ingested_at"
    )
    batch = intermediate.int_jobs_enriched(fresh)
    assert 0 < batch.count() < stg.count()
    assert rows(intermediate.merge_jobs(first, batch)) == rows(intermediate.int_jobs_enriched(stg))
    stg.unpersist()


def test_benchmarks_equal_the_cross_join(spark, sf_dir):
    models = Warehouse(spark, inputs.postings(spark, sf_dir), inputs.estimates(spark, sf_dir))
    mart = models.mart_job_market_benchmarks.select("title_normalized", "city_clean", "country_clean", "salary_currency")
    titles = models.dim_job_title.filter("role_family not in ('Out Of Scope', 'Unmapped') and job_title_key <> -1")
    places = models.dim_location.filter("is_benchmark_market")
    posted = models.fct_job_postings.select("job_title_key", "location_key").distinct().withColumn("p", F.lit(1))
    paid = models.fct_salary_estimates.select("job_title_key", "location_key", "salary_currency").distinct()
    grid = titles.crossJoin(places).join(posted, ["job_title_key", "location_key"], "left")
    grid = grid.join(paid, ["job_title_key", "location_key"], "left").filter("p is not null or salary_currency is not null")
    assert rows(mart) == rows(grid.select(*mart.columns)) and mart.count() > 0


def test_quality_gate_narrows_the_mart(spark, sf_dir):
    from jobweave.plans import marts

    models = Warehouse(spark, inputs.postings(spark, sf_dir), inputs.estimates(spark, sf_dir))
    args = (models.fct_job_postings, models.fct_salary_estimates, models.dim_job_title, models.dim_location)
    every = marts.mart_job_market_benchmarks(*args).agg(F.sum("total_postings")).first()[0]
    good = marts.mart_job_market_benchmarks(*args, qualities=["high"]).agg(F.sum("total_postings")).first()[0]
    assert 0 < good < every


def test_build_all_stores_every_model(spark, sf_dir):
    root = scratch_path(spark, "warehouse")
    stored = build_all(spark, inputs.postings(spark, sf_dir), inputs.estimates(spark, sf_dir), root)
    counts = {name: df.count() for name, df in stored.items()}
    assert counts["dim_date"] == 4017
    assert all(counts[n] for n in counts if n != "int_company_duplicates")
    facts = stored["fct_job_postings"]
    assert facts.count() == facts.select("job_id").distinct().count()
    lost = facts.join(stored["dim_location"], "location_key", "left_anti")
    assert lost.count() == 0
    assert stored["dim_company"].filter(F.col("company_key") == keys.UNKNOWN_KEY).count() == 1


def test_staging_reads_the_raw_zone(spark, sf_dir):
    """From JSON lines to the staged rows: the newest record of a day wins."""
    raw = inputs.postings(spark, sf_dir)
    fields = [f.name for f in schemas.POSTING.fields]
    rows_ = raw.select(*fields, "ingest_seq").filter("ingest_seq < 200")
    zone = rows_.select(
        *fields,
        F.lit("job_search").alias("endpoint"),
        F.lit("2024-02-29").cast("date").alias("ingestion_date"),
        F.concat(F.lit("data engineer/"), (F.col("ingest_seq") % 2).cast("string")).alias("query"),
    )
    root = scratch_path(spark, "raw")
    write_raw_zone(zone, root)
    stg = staging.stg_jobs(scan_jsonl(spark, root, schemas.POSTING, "*.json"))
    assert stg.count() == rows_.select("job_id").distinct().count()
    assert [str(r[0]) for r in stg.select("ingestion_date").distinct().collect()] == ["2024-02-29"]


def test_ties_of_one_file_do_not_depend_on_chance(spark, sf_dir):
    """Records with one key, time and path: any order of rows gives the same winners."""
    raw = inputs.postings(spark, sf_dir).limit(300).withColumn("_file_modified_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    raw = raw.withColumn("_file_path", F.lit("/raw/ingestion_date=2024-01-01/query=q/data.json")).withColumn("job_id", F.lit("1"))
    both = [staging.stg_jobs(raw.repartition(n).sortWithinPartitions(F.rand(n))).collect() for n in (1, 7)]
    assert len(both[0]) == 1 and both[0] == both[1]


def _rows_of(spark, n):
    """Postings of n jobs on three days; every tenth job has a second record on the last day, the older one is other."""
    df = spark.range(n).select(
        F.col("id").cast("string").alias("job_id"),
        F.explode(F.expr("if(id % 10 = 0, array(1, 2, 3, 4), array(1, 2, 3))")).alias("v"),
    )
    day = F.concat(F.lit("/raw/ingestion_date=2024-01-0"), F.least("v", F.lit(3)).cast("string"), F.lit("/query=q/data.json"))
    known = {
        "job_description": F.concat(F.lit("Python "), F.when(F.col("v") >= 3, "and SQL "), F.repeat(F.md5("job_id"), 30)),
        "_file_path": day,
        "_file_modified_at": F.expr("timestamp_ntz'2024-01-05' + make_dt_interval(0, 0, v)"),
    }
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.POSTING.fields if f.name not in ("job_id", "job_description")]
    return df.withColumns(known).select("job_id", *known, *blank)


def test_staging_hands_on_rows_alone_with_their_key(spark):
    """Rows alone with their key are not shuffled for a choice; the others give what the window over all gives."""
    from jobweave.operators.dedup import best_per_key
    from jobweave.sources.raw_zone import path_date

    raw = _rows_of(spark, 500)
    stg = staging.stg_jobs(raw)
    whole = best_per_key(raw.withColumn("ingestion_date", path_date("_file_path")), staging.POSTING_GRAIN, staging.newest_record(raw))
    wanted = whole.select("job_id", "ingestion_date", F.col("_file_modified_at").alias("_ingested_at"))
    assert rows(stg.select("job_id", "ingestion_date", "_ingested_at")) == rows(wanted) and stg.count() == 1500
    assert "Union" in stg._jdf.queryExecution().optimizedPlan().toString()


def test_enriched_jobs_shuffle_no_text(spark):
    stg = staging.stg_jobs(_rows_of(spark, 500)).localCheckpoint()
    jobs = intermediate.int_jobs_enriched(stg)
    plan = jobs._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Window")]
    assert "description" not in above
    below = plan[plan.index("Window") :].splitlines()[1]
    assert "description" not in below.split("AS")[0]
    found = jobs.select("job_id", "skill_python", "skill_sql", "days_active", "first_seen_at", "last_seen_at").collect()
    assert len(found) == 500 and all(r.skill_python == 1 and r.skill_sql == 1 for r in found)
    assert all(r.last_seen_at.minute == (4 if int(r.job_id) % 10 == 0 else 3) for r in found)


def test_marks_hold_for_every_marked_key(spark):
    from jobweave.operators.dedup import marks

    keys_ = spark.range(0, 30000, 3).select(F.col("id").cast("string").alias("k"))
    marked = marks(keys_)
    assert keys_.filter(marked("k")).count() == 10000
    others = spark.range(20000).select(F.col("id").cast("string").alias("k")).join(keys_, "k", "left_anti")
    assert others.filter(marked("k")).count() < 0.2 * others.count()
    assert marks(keys_.limit(0)) is None
