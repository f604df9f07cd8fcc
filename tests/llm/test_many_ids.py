"""A third of all rows without an id, ids that repeat with different texts, and digests that could collide."""

import time

import corpus_pipeline
from jobweave.llm.byte_bpe import Vocabulary, encode
from jobweave.llm.line_dedup import line_dedup
from jobweave.llm.substring_dedup import substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_contamination_takes_only_the_row_that_has_it(spark, tmp_path):
    item = " ".join(f"item{i}" for i in range(20))
    halves = [" ".join(f"item{i}" for i in range(a, a + 12)) for a in (0, 8)]
    texts = [(None, "clean one " * 8), (None, "x " + item), (None, "clean two " * 9), (4, halves[0]), (4, halves[1]), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], SCHEMA)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted(str(r.text) for r in left) == sorted(str(t) for _, t in texts if t is None or item not in t)


def test_texts_of_one_id_keep_their_own_tokens(spark):
    vocabulary = Vocabulary({bytes([b]): b for b in range(256)} | {b"ab": 256})
    texts = [f"{i:x} rare{i} ab" for i in range(3_000)]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(7, texts[0]), (7, texts[0])], "doc_id long, text string")
    for common in (0, 100_000):
        out = encode(docs, vocabulary, r"\w+| ", common_words=common).collect()
        pieces = lambda ids: b"".join(b"ab" if i == 256 else bytes([i]) for i in ids).decode()
        assert sorted(pieces(r.ids) for r in out) == sorted([*texts, texts[0], texts[0]])


def test_many_rows_without_id_are_no_group(spark):
    def took(step, null_ids):
        n = 1_500
        body = [(None if null_ids else i, "\n".join(f"line {i} {k} with words" for k in range(30))) for i in range(n)]
        first = [(-1 - i, t) for i, (_, t) in enumerate(body)]
        docs = spark.createDataFrame(first + body, "doc_id long, text string").repartition(8)
        start = time.perf_counter()
        out = step(docs).collect()
        assert len(out) == 2 * n
        return time.perf_counter() - start, out

    for step in (line_dedup, substring_dedup):
        took(step, False)
        (single, _), (shared, out) = took(step, False), took(step, True)
        assert shared < 3 * single + 2
        gone = [r for r in out if r.doc_id is None]
        assert all((r.n_lines_removed if step is line_dedup else r.n_removed) > 0 for r in gone)
