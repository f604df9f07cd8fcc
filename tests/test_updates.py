"""Tables of change folders, and the warehouse updated by changes against a full build."""

import os

import pytest
from pyspark.sql import functions as F

from jobweave.plans import facts, update
from jobweave.plans.marts import PLACE
from jobweave.plans.update import update_all
from jobweave.plans.warehouse import Warehouse
from jobweave.sources.change_table import ChangeTable, Conflict
from jobweave.sources.tables import stage
from jobweave.verify import inputs


def rows(table):
    return sorted(map(tuple, table.read().collect()), key=str)


def make(spark, path, order=None):
    return ChangeTable(spark, f"file://{path}/t", ["k"], order)


def frame(spark, values, ddl="k int, t int, v string"):
    return spark.createDataFrame(values, ddl)


# Change folders


def test_later_appends_win_and_null_keys_match(spark, tmp_path):
    table = make(spark, tmp_path)
    table.append(frame(spark, [(1, 1, "a"), (2, 1, "b"), (None, 1, "n")]))
    table.append(frame(spark, [(2, 0, "B"), (None, 0, "N"), (3, 1, "c")]), gone=frame(spark, [(1,)], "k int"))
    want = [(2, 0, "B"), (3, 1, "c"), (None, 0, "N")]
    assert rows(table) == sorted(want, key=str)
    table.compact()
    assert rows(table) == sorted(want, key=str) and table.state()["changes"] == []
    table.append(frame(spark, [(1, 2, "again")]))
    assert rows(table) == sorted([*want, (1, 2, "again")], key=str)
    assert len(table.vacuum()) == 2 and rows(table) == sorted([*want, (1, 2, "again")], key=str)


def test_order_keeps_newer_rows_from_late_ones(spark, tmp_path):
    table = make(spark, tmp_path, ["t"])
    table.append(frame(spark, [(1, 5, "new"), (2, 1, "old")]))
    table.compact()
    table.append(frame(spark, [(1, 3, "late"), (2, 2, "newer"), (3, None, "x")]))
    assert rows(table) == [(1, 5, "new"), (2, 2, "newer"), (3, None, "x")]


def test_batch_without_commit_leaves_the_old_state(spark, tmp_path, monkeypatch):
    table = make(spark, tmp_path)
    table.append(frame(spark, [(1, 1, "a")]), batch=0)
    with monkeypatch.context() as patch:
        patch.setattr(ChangeTable, "_commit", lambda self, state: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            table.append(frame(spark, [(1, 2, "lost")]), batch=1)
    assert rows(table) == [(1, 1, "a")]
    table.append(frame(spark, [(1, 2, "b")]), batch=1)
    table.append(frame(spark, [(1, 3, "replayed")]), batch=1)
    assert rows(table) == [(1, 2, "b")] and len(table.vacuum()) == 1


def test_two_writers_of_one_state_conflict(spark, tmp_path):
    table = make(spark, tmp_path)
    table.append(frame(spark, [(1, 1, "a")]))
    before = table.state()
    table.append(frame(spark, [(2, 1, "b")]))
    with pytest.raises(Conflict):
        table._commit(before)
    assert rows(table) == [(1, 1, "a"), (2, 1, "b")]


def test_changes_since_a_state(spark, tmp_path):
    table = make(spark, tmp_path)
    table.append(frame(spark, [(1, 1, "a"), (2, 1, "b")]))
    number = table.state()["number"]
    table.append(frame(spark, [(1, 2, "A"), (3, 1, "c")]), gone=frame(spark, [(2,)], "k int"))
    new, old = (sorted(map(tuple, df.collect())) for df in table.since(number))
    assert (new, old) == ([(1, 2, "A"), (3, 1, "c")], [(1, 1, "a"), (2, 1, "b")])
    table.compact()
    assert [df.count() for df in table.since(number)] == [2, 2]
    assert [df.count() for df in table.since(table.state()["number"])] == [0, 0]
    with pytest.raises(ValueError):
        ChangeTable(spark, f"file://{tmp_path}/none", ["k"]).read()


def test_a_batch_of_one_key_writes_one_row(spark, tmp_path):
    table = make(spark, tmp_path)
    table.append(spark.range(100_000).selectExpr("cast(id as int) k", "1 t", "cast(id as string) v"))
    table.compact()
    data = f"{tmp_path}/t/data"
    before = set(os.listdir(data))
    table.append(frame(spark, [(7, 2, "x")]))
    (folder,) = set(os.listdir(data)) - before
    assert sum(e.stat().st_size for e in os.scandir(f"{data}/{folder}")) < 10_000
    assert table.read().count() == 100_000


# Updates


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    thin = lambda df: stage(df.filter(F.col("ingest_seq") % 5 == 0), "raw")
    return thin(inputs.postings(spark, sf_dir)), thin(inputs.estimates(spark, sf_dir))


def numbers(stored):
    return {name: table.state()["number"] for name, table in vars(stored).items()}


def same_rows(ours, theirs):
    theirs = theirs.select(ours.columns)
    return ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_update_equals_full_build(spark, raw, tmp_path, monkeypatch):
    root, late = f"file://{tmp_path}/w", F.col("ingest_seq") % 3 == 0
    postings, estimates = raw
    update_all(spark, postings.filter(~late), estimates.filter(~late), root)

    # Records of known keys come again: an estimate is taken back, a posting moves to another employer.
    newer = F.col("_file_modified_at") + F.expr("interval 400 days")
    again = F.col("ingest_seq") % 4 == 0
    moved = postings.filter(again).withColumns({"employer_name": F.lit("Moved Ltd"), "_file_modified_at": newer})
    retracted = estimates.filter(again).withColumns({"median_salary": F.lit(None).cast("double"), "_file_modified_at": newer})
    postings, estimates = postings.unionByName(moved), estimates.unionByName(retracted)

    def fail(*_):
        raise RuntimeError("killed")

    # The first try dies between the two facts, the second between a fact and the marts.
    for module, name in ((facts, "fct_salary_estimates"), (update, "_update_marts")):
        with monkeypatch.context() as patch:
            patch.setattr(module, name, fail)
            with pytest.raises(RuntimeError):
                update_all(spark, postings, estimates, root)
    stored = update_all(spark, postings, estimates, root)

    full = Warehouse(spark, postings, estimates)
    assert same_rows(stored.int_jobs_enriched.read(), full.int_jobs_enriched)
    assert same_rows(stored.int_salary_estimates.read(), full.int_salary_estimates)
    assert same_rows(stored.fct_job_postings.read(), full.fct_job_postings)
    assert same_rows(stored.fct_salary_estimates.read(), full.fct_salary_estimates)
    assert same_rows(stored.mart_job_market_benchmarks.read().drop(*PLACE), full.mart_job_market_benchmarks)
    assert same_rows(stored.mart_company_hiring.read().drop("company_key"), full.mart_company_hiring)

    # All files are known: nothing is written.
    before = numbers(stored)
    assert numbers(update_all(spark, postings, estimates, root)) == before

    # One more file: few rows are written anywhere.
    one = postings.filter("employer_name is not null").limit(1).withColumns(
        {"job_id": F.lit("only"), "_file_path": F.concat("_file_path", F.lit("x"))}
    )
    stored = update_all(spark, postings.unionByName(one), estimates, root)
    assert stored.fct_job_postings.read().filter("job_id = 'only'").count() == 1
    for name in ("int_jobs_enriched", "fct_job_postings", "demand", "hiring", "mart_company_hiring"):
        new, old = vars(stored)[name].since(before[name])
        assert new.count() <= 12 and old.count() <= 12, name
