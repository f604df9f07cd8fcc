"""Archives of many pages: payloads that come once stay where they are read, and batches are bounded by bytes."""

import io

import pytest
from pyspark.sql import functions as F

from jobweave.llm import warc


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("left", [0, 1, 2, 3])
def test_records_that_begin_at_the_end_of_the_buffer(packed, left):
    blank = dict.fromkeys(("target_uri", "payload_digest", "refers_to"))
    rows = [blank | {"record_id": f"r{i}", "record_type": "response", "payload_bytes": 9, "payload": b"payload %d" % i} for i in range(3)]
    first, *others = ((warc.member if packed else bytes)(warc.record_bytes(r)) for r in rows)
    for payload in (True, False):
        stream = io.BufferedReader(io.BytesIO(b"".join([first, *others])), len(first) + left)
        found = [*warc.read_records(stream, {}, payload)]
        assert [r["record_id"] for r in found] == ["r0", "r1", "r2"]
        assert not payload or [r["payload"] for r in found] == [r["payload"] for r in rows]


def test_payloads_that_come_once_are_not_joined(spark):
    alone = warc.page_records(_pages(spark, [(i, f"u{i}", f"page {i}") for i in range(40)]))
    assert "Join" not in _plan(alone)
    assert alone.filter("record_type = 'response' and refers_to is null").count() == 40


def test_repeated_payloads_revisit_the_smallest_id(spark):
    rows = [(i, f"u{i}", f"page {i % 30}") for i in range(40)] + [(None, "n", "page 1"), (50, None, None), (51, "e", "")]
    found = {r.record_id: r for r in warc.page_records(_pages(spark, rows)).collect()}
    assert len(found) == len(rows)
    revisits = {k: r.refers_to for k, r in found.items() if r.record_type == "revisit"}
    want = {f"urn:page:{i}": f"urn:page:{i - 30}" for i in range(30, 40)}
    assert revisits == want | {"urn:page:none": "urn:page:1", "urn:page:51": "urn:page:50"}


def test_batches_are_bounded_by_bytes_while_an_archive_is_written(spark, tmp_path, monkeypatch):
    setting, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before, records = spark.conf.get(setting, None), warc.page_records
    monkeypatch.setattr(warc, "page_records", lambda *a, **b: seen.append(spark.conf.get(setting)) or records(*a, **b))
    rows = [(i, f"u{i}", "x" * i) for i in range(200)]
    path = warc.write_pages(_pages(spark, rows), f"file://{tmp_path}/archive")
    assert seen == [str(warc.BATCH_BYTES)] and spark.conf.get(setting, None) == before
    back = warc.read_warc(spark, path).select(warc.page_of(F.col("record_id")), "target_uri", F.col("payload").cast("string"))
    assert sorted(map(tuple, back.collect())) == rows
