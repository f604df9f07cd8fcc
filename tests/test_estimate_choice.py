"""The newest record of each key, found on narrow columns first."""

import itertools

import pyspark.sql.functions as F

from jobweave.operators.dedup import best_per_key, newest_wide_per_key
from jobweave.verify import inputs

ORDER = lambda: [F.col("t").desc_nulls_last(), F.col("path").desc_nulls_last(), F.col("id").asc()]


def test_newest_wide_per_key_is_best_per_key(spark):
    cells = itertools.product([None, "a", "b"], [None, "x", "y"], [None, 1, 2], [None, "p", "q"])
    rows = [(n, *c) for n, c in enumerate(list(cells) * 2)]
    df = spark.createDataFrame(rows, "id int, k string, l string, t int, path string")
    kept = newest_wide_per_key(df, ["k", "l"], "t", ORDER())
    assert sorted(kept.collect(), key=str) == sorted(best_per_key(df, ["k", "l"], ORDER()).collect(), key=str)
    assert newest_wide_per_key(df.limit(0), ["k", "l"], "t", ORDER()).collect() == []


def test_old_records_are_left_out_before_the_choice(spark):
    """Of 2,000 records of 20 keys few but the newest pass the scan."""
    df = spark.range(2000).selectExpr("id", "concat('k', id % 20) as k", "int(id) as t", "'p' as path")
    plan = newest_wide_per_key(df, ["k"], "t", ORDER())._jdf.queryExecution().optimizedPlan()
    while not plan.getClass().getSimpleName() == "Window":
        plan = plan.children().head()
    passed = plan.children().head()
    assert "getbit" in passed.toString().lower()
    kept = newest_wide_per_key(df, ["k"], "t", ORDER())
    assert sorted(r["t"] for r in kept.collect()) == list(range(1980, 2000))


def test_staged_estimates_leave_old_records_out(spark, tmp_path):
    from test_text_search import _tables

    from jobweave.plans.staging import latest_estimates, stg_salary_history

    raw = inputs.estimates(spark, _tables(spark, tmp_path)).persist()
    staged = stg_salary_history(raw)
    assert "getbit" in staged._jdf.queryExecution().optimizedPlan().toString().lower()
    plain = latest_estimates(raw).filter(F.col("median_salary").isNotNull())
    assert sorted(map(str, staged.collect())) == sorted(map(str, plain.collect()))
    raw.unpersist()


def test_orders_carry_no_derived_columns_through_the_joins(spark, tmp_path):
    """What follows from an order alone is made after the joins, so their exchanges don't carry it."""
    from test_text_search import _tables

    plan = inputs.estimates(spark, _tables(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    joins = plan[plan.index("Join"):]
    assert "make_dt_interval" not in joins and "INTERVAL" not in joins
