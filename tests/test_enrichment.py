import json

import pytest
from pyspark.sql import functions as F

from jobweave import schemas, session
from jobweave.plans import enrichment
from jobweave.session import scratch_path
from jobweave.sources import raw_zone
from jobweave.streaming import incremental as streams

VALID = {
    "role_family": "data_engineer", "seniority": "senior", "skills_required": ["SQL"], "skills_preferred": [],
    "confidence": "high",
}


def parse(spark, replies):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, raw_response string")
    return enrichment.parse_reply(df).orderBy("i").collect()


def test_reply_cases(spark):
    cases = [
        (json.dumps(VALID), "ok"),
        ("  ```json\n" + json.dumps(VALID) + "\n``` ", "ok"),
        (json.dumps({**VALID, "skills_required": [" a ", " "]}), "ok"),
        (json.dumps({**VALID, "role_family": "wizard"}), "coerced"),
        (json.dumps({k: v for k, v in VALID.items() if k != "confidence"}), "coerced"),
        (json.dumps({**VALID, "extra": 1}), "coerced"),
        (json.dumps({**VALID, "skills_required": "SQL"}), "coerced"),
        (json.dumps({**VALID, "skills_required": ["a", 2, None]}), "coerced"),
        (json.dumps({**VALID, "seniority": None}), "coerced"),
        ("nope", "failed"), ("[1, 2]", "failed"), ('"text"', "failed"), ("", "failed"), (None, "failed"),
    ]
    got = parse(spark, [c[0] for c in cases])
    assert [r.parse_status for r in got] == [c[1] for c in cases]
    assert got[2].skills_required == ["a"] and got[7].skills_required == ["a"] and got[6].skills_required == []
    assert got[3].role_family == "other" and got[8].seniority == "unspecified" and got[4].confidence == "medium"
    assert all(r.confidence == "low" and r.role_family == "other" for r in got[9:])


def test_calls_are_retried_as_far_as_it_helps():
    calls = []

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise enrichment.CallError("busy", status=429)
        return "fine"

    assert enrichment._call_with_retries(flaky, "p", 3, 0.0) == "fine" and len(calls) == 3

    def refuse(prompt):
        calls.append(prompt)
        raise enrichment.CallError("bad", status=400)

    calls.clear()
    assert enrichment._call_with_retries(refuse, "p", 3, 0.0) == "API_ERROR: CallError: bad" and len(calls) == 1
    assert enrichment._call_with_retries(lambda p: refuse(p), "p", 0, 0.0) == "API_ERROR: unknown"


def test_second_batch_asks_only_for_new_texts(spark):
    def posting(i, text, query="q"):
        return (f"j{i}", "Engineer", text, f"file:///r/query={query}/data.json", i)

    schema = "job_id string, job_title string, job_description string, _file_path string, _line_id bigint"
    first = spark.createDataFrame([posting(1, "a"), posting(2, " A "), posting(3, "b"), posting(4, "")], schema)
    out = scratch_path(spark, "enriched")
    none = spark.createDataFrame([], schemas.ENRICHMENT)

    def answer(_prompt):
        return json.dumps(VALID)

    run = dict(call=answer, day="2024-01-01", model="m", prompt="v1", first_wait=0.0)
    enrichment.run_batch(spark, first, none, out, **run)
    done = enrichment.read_enrichment(spark, out)
    assert done.count() == 2 and {r.parse_status for r in done.collect()} == {"ok"}
    second = first.unionByName(spark.createDataFrame([posting(5, "c"), posting(6, "d")], schema))
    enrichment.run_batch(spark, second, done, out, limit=1, **run)
    assert enrichment.read_enrichment(spark, out).count() == 3
    todo = enrichment.pending(enrichment.sweep(first), enrichment.seen_hashes(done, "m", "v2"))
    assert todo.count() == 2
    hashed = first.withColumn("content_hash", enrichment.content_hash("job_title", "job_description"))
    joined = enrichment.with_enrichment(hashed, done, ["role_family"])
    assert joined.count() == 4 and joined.filter("role_family is not null").count() == 3


def test_tolerant_scan(spark):
    root = scratch_path(spark, "lines")
    lines = ['{"job_id": "1", "job_is_remote": true}', "", "{broken", '{"job_id": "2", "job_is_remote": "x"}', "[1]", "   "]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(root)
    good, bad = raw_zone.scan_jsonl_tolerant(spark, root, schemas.POSTING, "*.txt")
    assert sorted(r.job_id for r in good.collect()) == ["1", "2"]
    assert sorted(r.line for r in bad.collect()) == ["[1]", "{broken"]


def test_envelope_and_labels(spark):
    body = ['{"data": {"jobs": [{"job_id": "1"}, {"job_id": "2"}], "cursor": "x"}}', '{"data": {}}', "{}"]
    df = spark.createDataFrame([(b,) for b in body], "body string")
    got = raw_zone.explode_envelope(df, "body", schemas.POSTING, "data", "jobs")
    assert sorted(r.record.job_id for r in got.collect()) == ["1", "2"]
    flat = spark.createDataFrame([('{"data": [{"job_id": "3"}]}',)], "body string")
    assert raw_zone.explode_envelope(flat, "body", schemas.POSTING).first().record.job_id == "3"
    df = spark.createDataFrame(
        [("q", "t", "l"), ("", "t", "l"), (None, None, "l"), (None, None, None)], "q string, t string, l string"
    )
    got = [r[0] for r in df.select(raw_zone.query_label("q", "t", "l", F.lit("end"))).collect()]
    assert got == ["q", "t_l", "l", "end"]


def test_stream_upsert_ignores_older_rows(spark):
    """A late file with an older version of a key leaves the newer row in place."""
    root, out, mark = (scratch_path(spark, n) for n in ("in", "out", "mark"))
    schema = "k int, t int, v string"

    def land(data):
        spark.createDataFrame(data, schema).write.mode("append").json(root)

    def run():
        stream = streams.raw_stream(spark, root, spark.createDataFrame([], schema).schema, "*.json")
        stream = stream.drop("_file_path", "_file_modified_at")
        streams.upsert_stream(stream, out, ["k"], ["t"], mark, buckets=4).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(out).select("k", "t", "v").collect())

    land([(1, 5, "a"), (2, 1, "b"), (2, 2, "c")])
    assert run() == [(1, 5, "a"), (2, 2, "c")]
    land([(1, 3, "old"), (3, 1, "d")])
    assert run() == [(1, 5, "a"), (2, 2, "c"), (3, 1, "d")]


class FakeSession:
    """Just what scratch_root asks a session for."""

    def __init__(self, folder, master):
        self.conf = self
        self.sparkContext = self
        self.folder, self.master, self.applicationId = folder, master, f"app-{master}"

    def get(self, _key, default=None):
        return self.folder or default


def test_scratch_needs_a_shared_folder():
    assert session.scratch_path(FakeSession("hdfs://x/y/", "yarn"), "t").startswith("hdfs://x/y/t-")
    assert session.scratch_root(FakeSession(None, "local[2]"))
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        session.scratch_root(FakeSession(None, "spark://host"))


@pytest.mark.parametrize("status, again", [(None, True), (429, True), (500, True), (404, False)])
def test_retryable(status, again):
    assert enrichment.CallError("x", status).retryable is again


def test_stream_dedup_loses_no_late_record(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batches = [[(1, 100), (2, 101)], [(3, 1), (1, 0)], [(2, 500), (None, 7), (None, 7)]]
    for batch in batches:
        spark.createDataFrame(batch, "id long, ts long").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id long, ts long").parquet(source)
        streams.dedup_stored(stream, out, "id", ["ts"], state).awaitTermination()
    got = sorted((tuple(r) for r in spark.read.parquet(out).select("id", "ts").collect()), key=repr)
    assert got == sorted([(1, 100), (2, 101), (3, 1), (None, 7), (None, 7)], key=repr)


def test_any_fault_of_a_call_is_a_failed_reply():
    def slow(prompt):
        raise TimeoutError("late")

    assert enrichment._call_with_retries(slow, "x", 2, 0.0) == "API_ERROR: TimeoutError: late"
