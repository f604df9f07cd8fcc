"""Queries that SQL can't express, against plain versions over whole small tables."""

import base64
import hashlib
from collections import Counter

import duckdb
import pytest
import tiktoken
import xxhash

from jobweave.llm.byte_bpe import tokenizer_files
from jobweave.llm.queries import QUERIES

TRICKY = [
    (None, "a null id " * 30),
    (1, None),
    (2, ""),
    (3, " \t\r\n\x0b\x0c "),
    (4, "it's WE'LL don't  two   blanks\n\n \n\ttabs 12345 ١٢ café \U0001f600\U0001f600 x" + "=" * 500),
    (5, "naïve 你好世界 " * 40),
    (6, "word " * 20_000),
    (7, "word " * 20_000),
    (7, "word " * 20_000),
    (8, "b" * 5_000 + " " + "ab" * 3_000),
    (9, "\u0085  x 　 y\x1c z \x00 end"),
]


@pytest.fixture(scope="module")
def folder(spark, sf_dir, tmp_path_factory):
    """Documents of the small table with hard cases and a further column that clashes with results."""
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, "en", "s", 0, 7) for i, t in TRICKY]
    hard = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words int")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id + 100 as doc_id", "text", "lang", "source", "n_chars")
    docs.unionByName(hard, allowMissingColumns=True).repartition(4).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="module")
def documents(folder):
    return duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet/*.parquet'").fetchall()


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_byte_bpe(spark, folder, documents):
    files = tokenizer_files()
    with open(files.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    coder = tiktoken.Encoding("own", pat_str=files.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for doc, text in documents:
        ids = coder.encode_ordinary(text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want[doc, len(ids), sha(packed), sha((text or "").encode())] += 1
    got = QUERIES["op5_byte_bpe"](spark, folder)
    assert rows_of(got.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == want


def test_simhash_components(spark, folder, documents):
    def fingerprint(text):
        words = (text or "").encode().lower().split()
        runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [fingerprint(t) for _, t in documents]
    label = [10**9 if d is None else d for d, _ in documents]
    changed = True
    while changed:
        changed = False
        for i, p in enumerate(prints):
            low = min(label[j] for j, q in enumerate(prints) if (p ^ q).bit_count() <= 2)
            if low < label[i]:
                label[i], changed = low, True
    want = Counter((d, f"{p:016x}", None if c == 10**9 else c) for (d, _), p, c in zip(documents, prints, label))
    got = QUERIES["op8_simhash_near_dedup"](spark, folder)
    assert rows_of(got.select("doc_id", "fingerprint", "component_id")) == want


def test_substring_dedup(spark, folder, documents):
    first: dict[bytes, int] = {}
    split = [(2**63 - 1 if d is None else d, (t or "").encode().split()) for d, t in documents]
    for doc, words in split:
        for i in range(len(words) - 49):
            run = xxhash.xxh3_128_digest(b" ".join(words[i : i + 50]))
            first[run] = min(first.get(run, doc), doc)
    want = Counter()
    for (doc, _), (key, words) in zip(documents, split):
        gone = [False] * len(words)
        for i in range(len(words) - 49):
            if first[xxhash.xxh3_128_digest(b" ".join(words[i : i + 50]))] < key:
                gone[i : i + 50] = [True] * 50
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        want[doc, len(words), sum(gone), sha(kept)] += 1
    got = QUERIES["op10_substring_dedup"](spark, folder)
    assert sum(v for k, v in want.items() if k[2]) > 5
    assert rows_of(got.select("doc_id", "n_words", "n_removed", "kept_sha256")) == want


def test_language_id(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/documents.parquet").createOrReplaceTempView("lang_docs")
    got = QUERIES["op3_language_id"](spark, sf_dir)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    got.createOrReplaceTempView("lang_got")
    joined = spark.sql(
        "select g.*, d.lang, length(d.text) > 30 as long from lang_got g join lang_docs d using (doc_id)"
    ).collect()
    assert len(joined) == 200 and all(0 <= r.score <= 1 for r in joined)
    held = [r for r in joined if r.held_out and r.long]
    assert len(held) > 30 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_language_id_hard_cases(spark, folder):
    found = {r.doc_id: r for r in QUERIES["op3_language_id"](spark, folder).filter("doc_id < 100").collect()}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and found[1].score == 0.0
    assert found[6].lang_pred != "und"
