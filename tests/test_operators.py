import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from jobweave.operators import audit, checks, dedup, incremental, joins, reshape, similar, trend
from jobweave.session import scratch_path
from jobweave.sources import raw_zone


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def edit_distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            last, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, last + (x != y))
    return line[-1]


def brute_pairs(names):
    out = set()
    for (ka, a), (kb, b) in itertools.combinations(sorted(names.items()), 2):
        if a[0].lower() == b[0].lower() and abs(len(a) - len(b)) <= 6:
            gap = edit_distance(a, b)
            if gap <= 4:
                out.add((ka, kb, a, b, gap))
    return out


def test_similar_pairs_match_brute_force(spark):
    """Short, long, repeated-letter and mixed-case names, and edits at both ends."""
    rng = random.Random(7)
    names = set()
    for size in list(range(1, 16)) * 8:
        names.add("".join(rng.choice("ab") + rng.choice("abc") * rng.randint(0, 1) for _ in range(size)))
    for seed in ["acme widgets", "bolt and nut", "Acme Tools", "aaaaaaaaaaaa"]:
        for _ in range(25):
            text = list(seed)
            for _ in range(rng.randint(0, 6)):
                at = rng.randrange(1, len(text) + 1)
                kind = rng.randrange(3)
                if kind == 0:
                    text.insert(at, rng.choice("abcx"))
                elif len(text) > 2 and at < len(text):
                    text[at:at + 1] = [] if kind == 1 else [rng.choice("abcx")]
            names.add("".join(text))
    keyed = {f"k{i:03d}": n for i, n in enumerate(sorted(names))}
    df = spark.createDataFrame(list(keyed.items()), "k string, n string")
    got = {tuple(r) for r in similar.similar_pairs(df, "k", "n").collect()}
    assert got == brute_pairs(keyed)


def test_pairs_are_classified(spark):
    companies = spark.createDataFrame(
        [
            ("a", "acme", "http://x ", "UK", 5), ("b", "acmee", "HTTP://X", "US", 3),
            ("c", "acmexy", None, "UK", 5), ("d", "acmewxyz", None, "US", 5),
        ],
        "company_key string, company_name_clean string, company_website string, hq_market string, total_postings int",
    )
    pairs = similar.similar_pairs(companies, "company_key", "company_name_clean")
    got = {(r.key_a, r.key_b): r for r in similar.classify_pairs(pairs, companies).collect()}
    assert got["a", "b"].match_confidence == "high" and got["a", "b"].same_website
    assert got["a", "b"].suggested_canonical == "acme" and got["a", "b"].combined_postings == 8
    assert got["a", "c"].match_confidence == "high" and got["a", "c"].suggested_canonical == "acmexy"
    assert got["b", "c"].match_confidence == "medium" and got["a", "d"].match_confidence == "low"


def test_sliced_windows_equal_plain_ones(spark):
    """One series holds a third of the rows and one has a null key."""
    rng = random.Random(3)
    data = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        day = dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(500))
        data.append((key, day, i, None if i % 17 == 0 else float(i)))
    df = spark.createDataFrame(data, "k string, day date, i int, v double")
    args = dict(lags={"prev": "v", "prev_day": "day"}, firsts={"first": "v", "first_day": "day"})
    sliced = trend.sliced_windows(df, ["k"], ["day", "i"], F.trunc("day", "month"), **args)
    plain = trend.snapshot_windows(df.withColumn("o", F.struct("day", "i")), ["k"], "o", **args).drop("o")
    assert rows(sliced) == rows(plain.select(*sliced.columns))


def test_upsert_matches_null_keys(spark):
    target = spark.createDataFrame([("a", None, 1), ("b", 1, 2)], "x string, y int, v int")
    source = spark.createDataFrame([("a", None, 10), ("c", 3, 30)], "x string, y int, v int")
    assert rows(incremental.upsert(target, source, ["x", "y"])) == [("a", None, 10), ("b", 1, 2), ("c", 3, 30)]


def test_upsert_keeps_the_span(spark):
    target = spark.createDataFrame([("a", 1, 5, "old"), ("b", 2, 3, "old")], "k string, f int, l int, v string")
    source = spark.createDataFrame([("a", 7, 9, "new"), ("c", 8, 8, "new")], "k string, f int, l int, v string")
    got = incremental.upsert_keeping_span(target, source, ["k"], "f", "l")
    assert rows(got) == [("a", 1, 9, "new"), ("b", 2, 3, "old"), ("c", 8, 8, "new")]


def test_watermark_on_empty_target_takes_all(spark):
    source = spark.createDataFrame([(1,), (2,), (3,)], "t int")
    assert incremental.since_watermark(source, source.filter("t > 5"), "t").count() == 3
    assert rows(incremental.since_watermark(source, source.filter("t < 3"), "t")) == [(3,)]
    assert incremental.since_watermark(source, source.filter("t < 3"), "t", inclusive=True).count() == 2


def test_upsert_partitions_touches_only_its_own(spark):
    path = scratch_path(spark, "table")
    schema = "k int, v string, p int"
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 2)], schema)
    incremental.upsert_partitions(spark, path, first, ["k"], "p")
    before = set(spark.read.parquet(f"{path}/p=1").inputFiles())
    incremental.upsert_partitions(spark, path, spark.createDataFrame([(2, "B", 2), (4, "d", 2)], schema), ["k"], "p")
    after = spark.read.parquet(path).select("k", "v", "p")
    assert rows(after) == [(1, "a", 1), (2, "B", 2), (3, "c", 2), (4, "d", 2)]
    assert set(spark.read.parquet(f"{path}/p=1").inputFiles()) == before


def test_null_ids_are_kept(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "id string, o int")
    got = dedup.dedup_keep_null_ids(df, "id", [F.col("o").asc()])
    assert sorted(r.o for r in got.collect()) == [1, 3, 4]


def test_foreign_keys(spark):
    fact = spark.createDataFrame([(1, 5, "x"), (2, -1, "-1"), (3, 6, None)], "id int, t bigint, c string")
    dim_t = spark.createDataFrame([(5,), (-1,)], "t bigint")
    dim_c = spark.createDataFrame([("x",), ("-1",)], "c string")
    out = joins.validate_foreign_key(fact, dim_t, "t", -1, "id")
    out = joins.validate_foreign_key(out, dim_c, "c", "-1", "id")
    assert rows(out) == [(1, 5, "x"), (2, -1, "-1"), (3, -1, "-1")]


def test_unpivot_equals_union(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 0)], "id int, skill_a int, skill_b int")
    labels = {"a": ("A", "one"), "b": ("B", "two")}
    union = None
    for name, (label, kind) in labels.items():
        part = df.filter(f"skill_{name} = 1").select("id", F.lit(label), F.lit(kind))
        union = part if union is None else union.union(part)
    assert rows(reshape.unpivot_flags(df, labels)) == rows(union)


def test_date_spine_excludes_the_end(spark):
    bounds = spark.createDataFrame([(dt.date(2020, 1, 1), dt.date(2030, 12, 31))], "s date, e date")
    days = reshape.date_spine(bounds, "s", "e")
    assert days.count() == 4017 and days.agg(F.max("date_day")).first()[0] == dt.date(2030, 12, 30)
    assert reshape.date_spine(spark.createDataFrame([(dt.date(2020, 1, 1),) * 2], "s date, e date"), "s", "e").count() == 0


def test_checks(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 99.0)], "k string, v double")
    parent = spark.createDataFrame([("b",)], "k string")
    spec = checks.CheckSpec(not_null=["k", "v"], unique=["k"], between={"v": (0, 10)}, parents={"k": (parent, "k")})
    got = {(r.column_name, r.check_name): r.failures for r in checks.run_checks(df, "t", spec).collect()}
    assert got == {
        ("k", "not_null"): 1, ("v", "not_null"): 1, ("v", "between"): 1, ("k", "unique"): 1, ("k", "relationships"): 2,
    }


def test_audit(spark):
    now = dt.datetime(2024, 1, 1)
    day = now.date()
    log = spark.createDataFrame(
        [
            ("e", "good", day, 1, 10, False, None, now, now), ("e", "part", day, 2, 5, False, None, now, now),
            ("e", "part", day, 1, None, True, "late", now, now), ("e", "bad", day, 1, None, True, "no", now, now),
        ],
        "endpoint string, query string, ingestion_date date, page int, records bigint, failed boolean, error string, "
        "started_at timestamp_ntz, finished_at timestamp_ntz",
    )
    runs = audit.run_audit(log)
    got = {r["query"]: (r.status, r.records_fetched, r.error_messages) for r in runs.collect()}
    assert got == {"good": ("success", 10, []), "part": ("partial_failure", 5, ["late"]), "bad": ("failed", 0, ["no"])}
    with pytest.raises(audit.FailedRunError, match="bad"):
        audit.assert_no_failed(runs)
    audit.assert_no_failed(runs.filter("query != 'bad'"))
    assert audit.without_failed_runs(log, runs).count() == 3


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "int"])
def test_watermark_reaches_the_scan(spark, kind):
    path = scratch_path(spark, "marks")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    value = F.col("id").cast("int") if kind == "int" else day.cast(kind)
    spark.range(10).select(value.alias("t")).write.parquet(path)
    source = spark.read.parquet(path)
    target = source.orderBy("t").limit(4)
    fresh = incremental.since_watermark(source, target, "t")
    assert fresh.count() == 6
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(t," in plan


def test_upsert_keeps_rows_of_the_null_partition(spark):
    path = scratch_path(spark, "nulls")
    schema = "k int, day string, v int"
    incremental.upsert_partitions(spark, path, spark.createDataFrame([(1, None, 1), (2, None, 1), (3, "a", 1)], schema), ["k"], "day")
    incremental.upsert_partitions(spark, path, spark.createDataFrame([(9, None, 2), (2, None, 2)], schema), ["k"], "day")
    got = spark.read.schema(schema).parquet(path).select("k", "day", "v")
    assert rows(got) == sorted([(1, None, 1), (2, None, 2), (3, "a", 1), (9, None, 2)], key=repr)


def test_a_shared_key_multiplies_no_fact(spark):
    facts = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "job_id int, k bigint")
    dim = spark.createDataFrame([(5, "x"), (5, "y")], "k bigint, title string")
    got = joins.validate_foreign_key(facts, dim, "k", -1, "job_id").select("job_id", "k")
    assert rows(got) == [(1, 5), (2, 5), (3, -1)]
    titles = dim.selectExpr("k as job_title_key", "title as title_normalized", "'data' as role_family")
    assert rows(joins.scoped_titles(titles).select("title_normalized")) == [("x",)]


def test_labels_that_look_alike_keep_their_folders(spark):
    labels = ["a b", "a_b", "a/b", "a-b", "x" * 90 + "1", "x" * 90 + "2"]
    df = spark.createDataFrame([(x,) for x in labels], "label string")
    folders = [r[0] for r in df.select(raw_zone.folder_label("label")).collect()]
    assert len(set(folders)) == len(labels) and folders[1] == "a_b" and folders[3] == "a-b"
    assert all(len(f) <= 80 and " " not in f and "/" not in f for f in folders)
