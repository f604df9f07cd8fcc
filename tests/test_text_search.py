"""Searching texts for terms, and how postings' texts are dealt to tasks."""

import re

import pyspark.sql.functions as F

from jobweave.functions import skills
from jobweave.verify import inputs

TEXTS = [
    "r", "c#", "c##", "xc#", "use c# now", "r language", "r-language", "or language", "ci/cd", "ci/cds", "aci/cd ci/cd",
    "spark sql", "sparks", "pyspark", "apache spark", "apache-spark", "sparkspark spark", "é spark é", "spark\nsql", "",
    "++r", "r+", "\U0001f600r\U0001f600", "rr r", "of the", "of  the", "roof theory", "by the\n", None,
]


def test_a_standing_term_is_found_where_the_bounded_pattern_finds_it(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    terms = [t for found in skills.SKILL_TERMS.values() for t in found] + ["of the", "by the", "c++"]
    patterns = [(skills.standing(t), skills.bounded([t])) for t in terms]
    rows = df.select(*[F.array(F.col("text").rlike(a), F.col("text").rlike(b)) for a, b in patterns]).collect()
    assert all(a == b for row in rows for a, b in row)


def test_terms_that_hold_another_term_are_not_searched(spark):
    assert skills.least_terms(skills.SKILL_TERMS["spark"]) == ["spark", "pyspark"]
    assert skills.least_terms(["c#", "c sharp"]) == ["c#", "c sharp"]
    for terms in skills.SKILL_TERMS.values():
        whole = re.compile(skills.bounded(terms))
        df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
        flags = df.select("text", skills.skill_flag("text", terms).alias("f")).collect()
        assert [f for _, f in flags] == [int(bool(t and whole.search(t))) for t, _ in flags]


def test_several_lists_are_found_in_one_split(spark):
    lists = {"a": {"spark": ["spark", "apache spark"], "r": ["r language"]}, "b": {"x": ["apache"], "r": ["r"], "sql": ["sql"]}}
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    both = skills.with_found_skills(df, "text", "a", lists["a"], also={"b": lists["b"]})
    plan = both._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
    for name, found in lists.items():
        alone = skills.with_found_skills(df, "text", name, found)
        assert both.select("text", name).collect() == alone.select("text", name).collect()


def test_c6_splits_each_text_once(spark, tmp_path):
    from jobweave.verify.columns import c6

    plan = c6(spark, _tables(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def _tables(spark, tmp_path, orders=40):
    rows = {
        "region": ("r_regionkey long, r_name string", [(0, "AFRICA")]),
        "nation": ("n_nationkey long, n_name string, n_regionkey long", [(0, "KENYA", 0)]),
        "customer": ("c_custkey long, c_nationkey long", [(k, 0) for k in range(3)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string", [(k, f"n{k}", "b", "PROMO") for k in range(5)]),
        "documents": ("doc_id long, text string", [(k, f"text {k}") for k in range(7)]),
        "orders": (
            "o_orderkey long, o_custkey long, o_orderdate date, o_totalprice double, o_orderpriority string",
            None,
        ),
    }
    for name, (schema, data) in rows.items():
        if data is None:
            df = spark.range(orders).selectExpr(
                "id as o_orderkey", "id % 3 as o_custkey", "date'1996-01-01' as o_orderdate", "1.0D as o_totalprice", "'x' as o_orderpriority"
            )
        else:
            df = spark.createDataFrame(data, schema)
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_texts_come_in_as_many_partitions_as_there_are_orders_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "ORDERS_A_PARTITION", 4)
    for threshold in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            df = inputs.postings(spark, _tables(spark, tmp_path / f"t{threshold}")).select("ingest_seq", "job_description")
            used = df.select("ingest_seq", "job_description", F.spark_partition_id().alias("p")).collect()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert sorted(r["ingest_seq"] for r in used) == list(range(40))
        # Seven documents are dealt by their hash, so some may meet; by size alone all would come in one partition.
        assert len({r["p"] for r in used}) >= 4
