"""URL filter, vector codes and prefix trie: hard cases, skew and plain versions."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobweave.llm.prefix_trie import borrow_turns, numbered_turns, prefix_trie
from jobweave.llm.queries import QUERIES
from jobweave.llm.url_filter import blocks_for, bloom_filter, judge_urls, possibly_listed
from jobweave.llm.vector_codes import compress


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# URL filter

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def test_rules_and_list(spark):
    urls = {
        "http://a.NET/x": "block", "http://net/": "block", "http://net": "allow", "http://xnet/": "allow",
        "https://b.example.net/en/1?q": "allow", "https://b.example.net/enx": "block", "http://example.com/de/": "block",
        "ftp://x.org/fr/#f": "allow", "no scheme.net/": "allow", "": "allow", None: "allow", "http://": "allow",
        "http://WWW.Listed.com/P/?utm_source=x&b=2&a=1#top": "block", "https://listed.com/P?a=1&b=2&ref=q": "block",
        "https://listed.com/p?a=1&b=2": "allow", "https://listed.com/P": "allow", "a://x\n.net/\n": "block",
    }
    pages = frame(spark, [(i, u, "old", 3) for i, u in enumerate(urls)], "page_id long, url string, host string, rule int")
    listed = frame(spark, [("http://listed.com/P/?b=2&a=1",), (None,), ("nothing",)], "url string")
    out = {r.url: r for r in judge_urls(pages, listed, RULES).collect()}
    assert {u: r.verdict for u, r in out.items()} == urls
    assert out["http://a.NET/x"].host == "a.net" and out["http://a.NET/x"].rule == "net/"
    assert (out["ftp://x.org/fr/#f"].path, out["ftp://x.org/fr/#f"].rule) == ("/fr/", "org/fr/")
    assert (out[None].host, out[None].path, out[None].rule) == ("", "", None)
    assert judge_urls(pages.limit(0), listed, RULES).count() == 0
    assert {r.verdict for r in judge_urls(pages, listed.limit(0)).collect()} == {"allow"}


def test_filter_never_misses_and_join_removes_the_rest(spark):
    listed = spark.range(3_000).select(F.concat(F.lit("http://l.com/"), F.col("id")).alias("url"))
    pages = spark.range(9_000).select("id", F.concat(F.lit("http://l.com/"), F.col("id")).alias("url"))
    bloom = bloom_filter(listed, "url", blocks_for(3_000))
    passed = possibly_listed(pages, "url", bloom, blocks_for(3_000), "maybe").filter("maybe")
    assert passed.filter("id < 3000").count() == 3_000 and passed.count() < 3_200
    # One block for the whole list: nearly everything passes the filter, and still nothing else is blocked.
    for blocks in (1, 1 << 16):
        judged = judge_urls(pages, listed, max_blocks=blocks).filter("verdict = 'block'")
        assert judged.agg(F.count("*"), F.max("id")).first() == (3_000, 2_999)


def test_one_url_of_a_third_of_all_rows(spark):
    pages = spark.range(6_000).select("id", F.when(F.col("id") % 3 == 0, "http://hot.com/").otherwise(F.concat(F.lit("http://c.com/"), "id")).alias("url"))
    judged = judge_urls(pages, frame(spark, [("http://www.hot.com",)], "url string"))
    assert judged.groupBy("verdict").count().orderBy("verdict").collect() == [("allow", 4_000), ("block", 2_000)]


# Vector codes


def plain_codes(rows, entries=256, rounds=4):
    """The contract, vector by vector."""
    rows = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[[int(np.floor(1024 * x)) for x in v[p * len(v) // 4 : (p + 1) * len(v) // 4]] for p in range(4)] for _, v, _ in rows]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(4)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            members = defaultdict(list)
            for c in cut:
                members[best(c[p], books[p])[1]].append(c[p])
            for k, parts in members.items():
                books[p][k] = [sum(x) // len(parts) for x in zip(*parts)]
    found = [[best(c[p], books[p]) for p in range(4)] for c in cut]
    labels = Counter()
    for (_, _, label), f in zip(rows, found):
        labels[label] += sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), labels[l]) for (i, _, l), f in zip(rows, found)]
    return Counter(out), digest


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)], i % 3 if i % 7 else None) for i in range(400)]
    rows += [(400 + i, rows[5][1], 1) for i in range(200)]  # a third of all are one vector
    rows += [(5, rows[9][1], 2), (None, rows[8][1], None), (None, [0.0] * 8, 0)]
    bad = [None, [1.0, None] + [0.0] * 6, [float("nan")] * 8, [float("inf")] + [0.0] * 7, []]
    return rows + [(700 + i, v, 1) for i, v in enumerate(bad[:4])], rows


def test_codes_match_plain_version(spark, vectors):
    rows, _ = vectors
    df = frame(spark, [(*r, 9) for r in rows], "vec_id long, embedding array<float>, label int, error int").repartition(5)
    for entries, rounds in ((16, 4), (256, 1)):
        got, quantizer = compress(df, entries=entries, rounds=rounds)
        want, digest = plain_codes(rows, entries, rounds)
        assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got.collect()) == want
        assert quantizer.digest() == digest


def test_codes_of_few_empty_and_large_vectors(spark):
    schema = "vec_id long, embedding array<double>, label int"
    empty, quantizer = compress(frame(spark, [], schema))
    assert empty.count() == 0 and quantizer.digest() == hashlib.sha256(b"").hexdigest()
    rows = [(1, [1e4, -1e4, 3e3, 0.5], None), (2, [1e4, -1e4, 3e3, 0.25], None), (3, [-2.5e4, 1.0, 1.0, 1.0], 1), (4, [1.0] * 8, 1)]
    got, _ = compress(frame(spark, rows, schema))
    want, _ = plain_codes(rows[:3])
    # A vector of another length than that of the smallest id is left out.
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got.collect()) == want
    with pytest.raises(ValueError):
        compress(frame(spark, [(1, [1.0] * 6, 1)], schema))


# Prefix trie


def plain_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            convs[conv].append(((turn is not None, turn or 0), key, (role, text)))
    turns = {c: [t[2] for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = turns.get(c - c % 5, [])[:h] + own[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    kids = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in kids
            saved[n[:d]] += (len(m) - 1) * (len(n[-1][1].encode()) if n else 0)
    return Counter(
        (m[0], len(n), members[n[:-1]][0] if n else None, len(m), kids[n], leaves[n], saved[n],
         hashlib.sha256(",".join(str(c) for c in m if len(built[c]) == len(n)).encode()).hexdigest())
        for n, m in members.items()
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations():
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text é {c % 7} {t // 2}") for c in range(60) for t in range(c % 13)]
    rows += [(100 + c, t, "user", f"same {t}") for c in range(60) for t in range(6)]  # copies
    rows += [(200, 3, None, None), (200, None, "a", "first"), (200, 3, "b", "tie"), (200, 3, "a", "tie"), (None, 0, "user", "nobody")]
    return rows + [(301, 0, "user", "only")]


@pytest.mark.parametrize("shard_turns", [10, 100_000])
def test_trie_matches_plain_version(spark, shard_turns):
    rows = conversations()
    df = frame(spark, [(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(4)
    got = prefix_trie(borrow_turns(numbered_turns(df)), shard_turns=shard_turns)
    assert Counter(tuple(r) for r in got.select(COLUMNS).collect()) == plain_trie(rows)


def test_trie_of_long_and_no_conversations(spark):
    rows = [(c, t, "user", str(t)) for c in (0, 5) for t in range(1_500)]
    df = frame(spark, rows, "conv_id long, turn long, role string, text string")
    got = prefix_trie(borrow_turns(numbered_turns(df)), near=F.col("conv_id"), shard_turns=1_500)
    assert Counter(tuple(r) for r in got.select(COLUMNS).collect()) == plain_trie(rows)
    assert prefix_trie(borrow_turns(numbered_turns(df.limit(0)))).count() == 0


def test_queries_have_the_columns_asked_for(spark, sf_dir):
    kinds = dict(QUERIES["op12_vector_codes"](spark, sf_dir).dtypes)
    assert kinds == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
    kinds = dict(QUERIES["op13_prefix_trie"](spark, sf_dir).dtypes)
    assert list(kinds) == COLUMNS and set(kinds.values()) == {"bigint", "string"}
