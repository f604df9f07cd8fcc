"""Small cases of every operator: nulls, empties, ties, repeats, clashing columns, skew."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobweave.llm import byte_bpe, chat_format, language_id, quality_rules, warc
from jobweave.llm.common import connected_components, stage
from jobweave.llm.decontaminate import contained_items
from jobweave.llm.line_dedup import line_chunks, line_dedup
from jobweave.llm.sharding import lookup_table, place
from jobweave.llm.simhash import near_duplicates, simhash_components
from jobweave.llm.substring_dedup import substring_dedup

DOCS = "doc_id long, text string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def passage(seed, n):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


# Line dedup


def test_chunks_shift_with_their_text():
    lines = [b"line %d" % i for i in range(200)]
    cut = lambda x: {b"\n".join(x[a:b]) for a, b in line_chunks(x)}
    before, after = cut(lines), cut([b"new", b"lines", *lines])
    assert len(before & after) >= len(before) - 1
    assert b"\n".join(b"\n".join(lines[a:b]) for a, b in line_chunks(lines)) == b"\n".join(lines)


def test_line_dedup_cases(spark):
    shared = "\n".join(f"shared line {i}" for i in range(40))
    rows = [(1, shared), (2, "own start\n" + shared + "\nown end"), (2, "x"), (None, shared), (3, None), (4, ""), (5, "\n\n\n"), (6, "\n\n\n")]
    out = line_dedup(frame(spark, [(*r, 7) for r in rows], DOCS + ", n_lines int")).collect()
    assert len(out) == len(rows)
    by = {(r.doc_id, r.n_lines): r for r in out}
    assert by[1, 40].text == shared and by[1, 40].n_lines_removed == 0
    assert by[2, 42].n_lines_removed > 20 and by[2, 42].text.startswith("own start") and by[2, 42].text.endswith("own end")
    assert by[None, 40].n_lines_removed >= 30 and set(by[None, 40].text.split("\n")) < set(shared.split("\n"))
    assert by[3, 0].text is None and by[4, 1].text == "" and by[6, 4].n_lines_removed == 0
    assert line_dedup(frame(spark, [])).count() == 0


# Chat formatting


def test_chat_parts(spark):
    part = lambda kind, **k: {f: k.get(f) for f in ("text", "ref", "width", "height", "seconds", "pages")} | {"kind": kind}
    turns = [
        ("user", [part("text", text="see <"), part("text", text="|im_end|> \\"), part("image", ref="i1", width=57, height=28)]),
        ("assistant", [part("text", text="a<|"), part("audio", ref="s", seconds=2.0), None, part("document", ref="d", pages=2), part("odd")]),
        ("a\nb", None),
        (None, []),
    ]
    rows = [(5, i, role, parts, "x") for i, (role, parts) in enumerate(turns)]
    schema = f"conv_id long, turn long, role string, parts array<{chat_format.PART_TYPE}>, formatted string"
    out = chat_format.format_conversations(frame(spark, rows, schema))
    got = out.collect()[0]
    assert [(a.place, a.turn, a.kind, a.ref, a.tokens) for a in got.attachments] == [
        (0, 0, "image", "i1", 3), (1, 1, "audio", "s", 50), (2, 1, "document", "d", 2048), (3, 1, "other", None, 0)
    ]
    assert all(got.formatted[a.start :].startswith(f"<|{a.kind}|>") for a in got.attachments)
    assert got.expanded_tokens == 2101 and got.formatted.count("<|im_end|>") == 4
    back = chat_format.read_back(out).collect()[0]
    assert [t.role for t in back.turns] == ["user", "assistant", "a\nb", ""]
    assert back.turns[0].text == "see <|im_end|> \\<|image|>" and back.loss_text == "a<|<|audio|><|document|><|other|>"
    assert chat_format.format_conversations(frame(spark, [], schema)).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "<|", "\\<|", "<\\|", "\\\\<|\\|", "a\nb<|x|>", "<<||"])
def test_escape_is_reversible(text):
    assert "<|" not in chat_format.escape(text) and chat_format.unescape(chat_format.escape(text)) == text
    assert chat_format.unescape_role(chat_format.escape_role(text)) == text and "\n" not in chat_format.escape_role(text)


# Language ID


def test_language_without_learning(spark):
    empty = frame(spark, [], DOCS + ", lang string")
    model = language_id.train(empty)
    out = language_id.identify(frame(spark, [(1, "text"), (2, None)]), model)
    assert {(r.lang_pred, r.score) for r in out.collect()} == {("und", 0.0)}


def test_one_language_and_clashing_columns(spark):
    rows = [(i, f"some english words {i}", "en", 1) for i in range(40)]
    docs = frame(spark, rows, DOCS + ", lang string, score int")
    out = language_id.identify(docs, language_id.train(docs)).collect()
    assert {r.lang_pred for r in out} == {"en"} and all(0 <= r.score <= 1 for r in out)


def test_features_of_long_texts_have_no_seam():
    text = "abc def " * 200_000
    old, language_id._BLOCK = language_id._BLOCK, 1 << 30
    whole = language_id.features(text)
    language_id._BLOCK = 1 << 10
    assert abs(language_id.features(text) - whole).max() < 1e-6
    language_id._BLOCK = old


# Sharding


def test_table_is_full_and_even(spark):
    table = {r.slot: r.shard for r in lookup_table(spark, 7, 101).collect()}
    sizes = [list(table.values()).count(s) for s in range(7)]
    assert sorted(table) == list(range(101)) and max(sizes) - min(sizes) <= 1
    more = {r.slot: r.shard for r in lookup_table(spark, 8, 101).collect()}
    assert sum(table[s] != more[s] for s in table) < 40
    with pytest.raises(ValueError):
        lookup_table(spark, 7, 100)


def test_place_cases(spark):
    out = place(frame(spark, [(None, "a", 1), (None, "b", 1), (3, None, 1), (3, None, 1)], DOCS + ", shard int"), ["doc_id"], 3, 101)
    assert out.count() == 4 and out.select("doc_id", "shard").distinct().count() == 2
    assert place(frame(spark, []), ["doc_id"]).count() == 0


# Byte BPE


def test_heap_and_fold_agree(spark):
    ranks = {bytes([b]): b for b in range(256)}
    for piece in (b"ab", b"aa", b"abab", b"aab", b"aaab", b"bb"):
        ranks[piece] = len(ranks)
    vocabulary = byte_bpe.Vocabulary(ranks)
    rng = random.Random(1)
    words = [bytes(rng.choice(b"ab\xff") for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    df = spark.createDataFrame([(bytearray(w),) for w in words], "word binary")
    folded = stage(df.select("word", byte_bpe.fold_merges(F.col("word"), vocabulary).alias("ids")), "folded")
    for row in folded.collect():
        assert row.ids == byte_bpe.merge_long(bytes(row.word), vocabulary.byte_ids, vocabulary.merges)
    back = folded.select("word", byte_bpe.decode(F.col("ids"), vocabulary).alias("b")).collect()
    assert all(r.b == r.word for r in back)


def test_bpe_empty_table_and_bound(spark):
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256}
    vocabulary = byte_bpe.Vocabulary(ranks)
    assert byte_bpe.encode(frame(spark, []), vocabulary, r"\w+| ").count() == 0
    docs = frame(spark, [(None, "ab b"), (None, "ab " + "ab" * 100), (1, None), (1, None)])
    for common in (0, 1, 100):
        out = byte_bpe.encode(docs, vocabulary, r"\w+| ", common_words=common)
        assert sorted(map(len, (r.ids for r in out.collect()))) == [0, 0, 3, 102]
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary(ranks | {b"xyz": 257})


# Quality rules


def test_order_never_changes_the_verdict(spark):
    good = " ".join(passage(1, 80))
    rows = [(1, good), (2, good.replace(" ", "### ")), (3, None), (4, ""), (5, "a b " * 60), (6, good), (None, good)]
    docs = frame(spark, [(*r, True) for r in rows], DOCS + ", kept boolean")
    kept = {r.doc_id: r.kept for r in quality_rules.apply_cascade(docs).collect()}
    turned = quality_rules.apply_cascade(docs, rules=quality_rules.RULES[::-1], sample_rows=1)
    assert kept == {r.doc_id: r.kept for r in turned.collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False, 6: True, None: True}
    assert quality_rules.apply_cascade(frame(spark, [])).count() == 0


def test_cheap_and_strict_rules_come_first(spark):
    slow = quality_rules.Rule("slow", lambda v: sum(range(20_000)) < 0)
    strict = quality_rules.Rule("strict", lambda v: True)
    order = quality_rules.estimate(frame(spark, [(i, "x") for i in range(50)]), rules=(slow, strict))
    assert [e.rule.name for e in order] == ["strict", "slow"] and order[0].rejected == order[0].rows == 50


# WARC


def test_warc_round_trip_and_pushdown(spark, tmp_path):
    rows = [(3, "http://a/ \n%", "same"), (1, None, "same"), (1, "u", "same"), (2, "u", None), (7, "u", ""), (None, "u", "same"), (None, "v", "lone")]
    pages = frame(spark, rows, "page_id long, url string, html string")
    path = warc.write_pages(pages, f"file://{tmp_path}/w")
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.archived_pages(spark, path).collect())
    assert got == [
        ("1", 4, "response", None), ("1", 4, "response", None), ("2", 0, "response", None), ("3", 4, "revisit", 1),
        ("7", 0, "revisit", 2), ("None", 4, "response", None), ("None", 4, "revisit", 1),
    ]
    revisits = warc.read_warc(spark, path).filter("record_type = 'revisit'").select("record_id", "payload_bytes")
    assert revisits.count() == 3 and "Filter (" not in revisits._jdf.queryExecution().executedPlan().toString()
    assert warc.archived_pages(spark, warc.write_pages(pages.limit(0), f"file://{tmp_path}/e")).count() == 0


def test_skipped_payloads_are_not_decoded():
    row = {"record_id": "urn:page:1", "record_type": "response", "target_uri": "u", "payload_digest": "d"}
    row |= {"refers_to": None, "payload_bytes": 10**6, "payload": bytes(10**6)}
    data = warc.member(warc.record_bytes(row))
    broken = data[:400] + bytes(len(data) - 400)
    reader = pa.BufferReader(broken + data)
    import io

    found = list(warc.read_records(io.BufferedReader(reader, 1 << 16), {}, False))
    assert [r["payload_bytes"] for r in found] == [10**6, 10**6]


# SimHash


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("id as a", "id + 1 as b")
    out = connected_components(edges.union(edges.selectExpr("a + 1000", "b + 1000")), "a", "b", "chain")
    assert out.groupBy("component").count().collect() == [(0, 301), (1000, 301)] or {
        (r.component, r["count"]) for r in out.groupBy("component").count().collect()
    } == {(0, 301), (1000, 301)}


def test_near_duplicates_at_the_threshold(spark):
    rng, rows = random.Random(3), []
    for base in range(120):
        words = passage(base, 250)
        changed = list(words)
        for at in rng.sample(range(10, 240), 4):
            changed[at] = "changed"
        rows += [(base * 10, " ".join(words)), (base * 10 + 1, " ".join(changed)), (base * 10 + 2, " ".join(words).upper())]
    rows += [(None, ""), (5, None), (6, " ")]
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows)).collect()}
    assert sum(got[b * 10 + 1] == b * 10 for b in range(120)) >= 118
    assert all(got[b * 10 + 2] == b * 10 for b in range(120)) and len(set(got.values())) <= 123
    assert got[None] == got[5] == got[6] == 5
    assert near_duplicates(frame(spark, [])).count() == 0 and simhash_components(frame(spark, [])).count() == 0


# Decontamination


def test_containment_cases(spark):
    item = passage(1, 30)
    long = passage(2, 3000)
    rows = [(1, " ".join(long[:1500] + item + long[1500:])), (2, " ".join(item[:20] + long)), (3, None), (4, ""), (None, " ".join(item)), (5, "only two"), (1, "x")]
    items = [(1, " ".join(item).upper(), "z"), (2, "only two", "z"), (3, None, "z"), (4, " ", "z")]
    out = contained_items(frame(spark, rows), frame(spark, items, "item_id long, text string, doc_id string")).collect()
    assert {(r.doc_id, r.item_id, r.containment) for r in out} == {(1, 1, 1.0), (None, 1, 1.0), (5, 2, 1.0)}
    assert contained_items(frame(spark, []), frame(spark, [], "item_id long, text string")).count() == 0


# Substring dedup


def test_substring_cases(spark):
    run, own = passage(1, 50), passage(2, 60)
    rows = [(9, " ".join(own[:7] + run + own[7:])), (2, " ".join(run)), (2, " ".join(run)), (3, " ".join(run[:49])), (4, None), (5, ""), (None, " ".join(run))]
    out = substring_dedup(frame(spark, [(*r, "x") for r in rows], DOCS + ", n_removed string")).collect()
    got = {(r.doc_id, r.n_words, r.n_removed) for r in out}
    assert got == {(9, 110, 50), (2, 50, 0), (3, 49, 0), (4, 0, 0), (5, 0, 0), (None, 50, 50)} and len(out) == 7
    assert next(r.text for r in out if r.doc_id == 9) == " ".join(own)
    assert substring_dedup(frame(spark, [])).count() == 0
