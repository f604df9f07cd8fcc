"""What the driver holds stays small: partitions, marks, join keys without subqueries, files known without another read."""

import datetime

from pyspark.sql import functions as F

from jobweave.operators import dedup
from jobweave.plans import update
from jobweave.sources.change_table import ChangeTable
from jobweave.verify import inputs


def test_many_orders_make_larger_partitions():
    assert [inputs.partitions_of(n) for n in (0, 1, 150_000, 2_000_000)] == [1, 1, 15, 200]
    assert inputs.partitions_of(54_000_000) == 1080


def test_marks_take_no_more_than_four_megabytes_and_are_put_together_by_pages(spark, monkeypatch):
    assert dedup.MOST_WORDS * 8 <= 4 << 20
    monkeypatch.setattr(dedup, "WORDS_A_PAGE", 16)
    keys = spark.range(0, 60000, 3).select(F.col("id").cast("string").alias("k"))
    marked = dedup.marks(keys)
    assert keys.filter(marked("k")).count() == 20000
    others = spark.range(1, 60000, 3).select(F.col("id").cast("string").alias("k"))
    assert others.filter(marked("k")).count() < 0.08 * 20000


def test_orders_may_be_the_side_that_is_broadcast(spark, tmp_path):
    day = datetime.datetime(1995, 5, 5)
    tables = {
        "orders": ([(7, 1, 10.0, day, "1-URGENT")], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "customer": ([(1, 0)], "c_custkey long, c_nationkey int"),
        "nation": ([(0, "KENYA", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "AFRICA")], "r_regionkey int, r_name string"),
        "part": ([(i, f"name {i}", "b", "PROMO") for i in range(5000)], "p_partkey long, p_name string, p_brand string, p_type string"),
        "documents": ([(i, f"text {i}") for i in range(3000)], "doc_id long, text string"),
    }
    for name, (rows, ddl) in tables.items():
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    (posting,) = inputs.postings(spark, str(tmp_path)).collect()
    assert posting.job_title == "Lead Machine Learning Engineer Remote Contract" and posting.job_description.startswith("text 7 ")
    assert inputs.estimates(spark, str(tmp_path)).count() == 1


def test_repeated_keys_are_counted_on_the_narrow_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    order = [F.col("v").desc()]
    assert sorted(map(tuple, dedup.best_wide_per_key(rows, ["k"], order, rows.select("k")).collect())) == [(1, "b"), (2, "c")]
    # Narrow rows without a repeated key: nothing is chosen, so they are what is counted.
    assert dedup.best_wide_per_key(rows, ["k"], order, rows.select("k").distinct()).count() == 3


def test_new_records_are_stored_once(spark, tmp_path):
    files = ChangeTable(spark, f"file://{tmp_path}/files", update.FILE)
    raw = spark.createDataFrame([("p", 1, "a"), ("p", 1, "b"), ("q", None, "c")], "_file_path string, _file_modified_at int, job_id string")
    first = update.new_records(raw, files, "job_id")
    assert first.count() == 3 and first.inputFiles()
    files.append(first.select(*update.FILE).filter("_file_path = 'p'").distinct())
    later = update.new_records(raw, files, "job_id")
    assert list(map(tuple, later.collect())) == [("q", None, "c")]
    assert list(map(tuple, update.unseen(raw, files, later).collect())) == [("q", None, "c")]
