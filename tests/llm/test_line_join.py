"""Line dedup with joined chunks: whole copies go, whatever the cuts."""

import random

import corpus_pipeline
from jobweave.llm.line_dedup import joined_chunks, line_chunks


def text(seed, n):
    draw = random.Random(seed)
    return "\n".join(f"line {draw.randrange(10**9)}" if draw.random() > 0.1 else "" for _ in range(n)) + f"\nend {seed}\nend"


def test_joined_chunks_hold_every_line_once_and_are_long():
    for seed in range(200):
        lines = text(seed, seed % 17).encode().split(b"\n")
        chunks = joined_chunks(lines, line_chunks(lines, 2, 2), 2)
        assert [i for a, b in chunks for i in range(a, b)] == list(range(len(lines)))
        assert all(sum(1 for x in lines[a:b] if x.strip()) >= 2 for a, b in chunks)
    assert joined_chunks([b"one", b""], [(0, 1), (1, 2)], 2) == [(0, 2)]


def test_exact_copies_leave_nothing(spark):
    rows = [(k * 100 + i, text(i, i), "en", "s", 0) for k in range(2) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.line_chunks(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(r[:2] for r in rows[:60])
