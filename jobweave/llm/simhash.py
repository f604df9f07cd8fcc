"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits have a value within ``radius / 2`` bits
of both. Every fingerprint emits all values that near, rows meet on the value,
and what collides is verified. Only distinct fingerprints emit, so a third of
all documents being copies is one fingerprint; the fingerprints that can meet
on one value number at most the size of the ball (65 for 64 bits, radius 2),
whatever the size of the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweave.llm.common import LAST_ID, connected_components, flush_every, id_key, map_batches, ones, stage, unstage, words_of
from jobweave.session import ship_package

SEED = 42

# The near-duplicate search: parts of 40 bits each, searched within 2 bits.
PARTS, PART_BITS = 2, 40

# Shingles are counted in so many passes over their values, each of which frees its shuffle; so are low hashes.
PASSES, LOW_PASSES = 8, 4


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words joined by a space; fewer words: of the whole sequence; none: empty."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate(([0], ends[: len(words) - size])).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist())], dtype=np.uint64)


def fingerprint(text: str | None, size: int) -> int:
    """64 bits, each 1 if set in over half of the shingle hashes; no word: 0."""
    hashes = shingle_hashes([w.lower() for w in words_of(text)], size)
    if not len(hashes):
        return 0
    return int.from_bytes(np.packbits(ones(hashes) * 2 > len(hashes)).tobytes(), "big")


def ball(bits: int, reach: int) -> list[int]:
    """All masks of at most ``reach`` of ``bits`` bits, as signed 64-bit numbers."""
    masks = [sum(1 << b for b in c) for n in range(reach + 1) for c in combinations(range(bits), n)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def variants(fps: DataFrame, bits: int, radius: int, value: str = "fp") -> DataFrame:
    """Every row of ``fps`` once for each mask of half the radius, with ``variant``."""
    masks = F.array(*[F.lit(m).cast("long") for m in ball(bits, radius // 2)])
    spread = fps.select("*", F.explode(masks).alias("mask"))
    return spread.withColumn("variant", F.col(value).bitwiseXOR(F.col("mask"))).drop("mask")


def colliding_pairs(fps: DataFrame, bits: int, radius: int) -> DataFrame:
    """Distinct verified (low, high) of ``fp`` that meet: each with the next lower one of its value.

    All fingerprints that meet on a value lie within ``radius`` (even) of each
    other, so neighbours in their order already connect all of them.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    met = variants(fps.select("fp"), bits, radius)
    order = Window.partitionBy("variant").orderBy("fp")
    pairs = met.select(F.lag("fp").over(order).alias("low"), F.col("fp").alias("high")).filter("low is not null")
    return pairs.distinct().filter(F.bit_count(F.col("low").bitwiseXOR(F.col("high"))) <= radius)


def document_fingerprints(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(doc, fp): a row per row of ``docs``, the fingerprint as a signed 64-bit number."""
    schema = pa.schema([("doc", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, size) for t in batch["value"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch["doc"], pa.array(fps.view(np.int64))], schema=schema)

    return map_batches(docs.select(id_key(doc_id).alias("doc"), F.col(text).alias("value")), run, "doc long, fp long")


def real_id(column: Column) -> Column:
    return F.when(column != LAST_ID, column)


def simhash_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3, radius: int = 2
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    ``fingerprint`` is 16 lower-case hex digits; fingerprints link at ``radius``
    or fewer differing bits and the component is the smallest id reachable. A
    null or empty text has fingerprint 0, linked like any other. A null id
    stays null; a component of null ids only has a null component.
    """
    held = stage(document_fingerprints(docs, doc_id, text, size), "simhash-fps")
    fps = held.groupBy("fp").agg(F.min("doc").alias("low_doc"))
    roots = connected_components(colliding_pairs(fps, 64, radius), "low", "high", "simhash")
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low_doc", F.coalesce("component", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("low_doc").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return held.join(named, "fp").select(
        real_id(F.col("doc")).alias(doc_id),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        real_id(F.col("component_id")).alias("component_id"),
    )


def part_fingerprints(words: list[bytes], parts: int = PARTS, bits: int = PART_BITS) -> list[int]:
    """``parts`` SimHash values of ``bits`` bits over the distinct words, each tagged with its number above the bits."""
    distinct = sorted(set(words))
    base = np.array([xxhash.xxh64_intdigest(w, SEED) for w in distinct], dtype=np.uint64)
    whole = []
    for k in range(-(-parts * bits // 64)):
        # Further hash bits of a word: the finalizer of a multiply-xorshift generator over its hash.
        x = base + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        whole.append(ones(x ^ (x >> np.uint64(31))) * 2 > len(base))
    flags = np.concatenate(whole)[: parts * bits].reshape(parts, bits)
    return [int("".join("1" if f else "0" for f in row), 2) + (t << bits) for t, row in enumerate(flags)]


def body_digest(words: list[bytes]) -> bytes:
    """128 bits that stand for a word sequence in lower case."""
    return xxhash.xxh3_128_digest(b" ".join(words))


def with_body(docs: DataFrame, text: str, body: str) -> DataFrame:
    """``docs`` with the digest of each text's words; null and empty texts have that of no words."""

    @F.arrow_udf("binary")
    def digests(values: pa.Array) -> pa.Array:
        return pa.array([body_digest([w.lower() for w in words_of(t)]) for t in values.to_pylist()], pa.binary())

    ship_package(docs.sparkSession)
    return docs.withColumn(body, digests(F.col(text)))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **search: float) -> DataFrame:
    """(doc_id, component_id), one row per row of ``docs``: copies and near copies share a component.

    ``search`` goes to ``near_groups``. The component is the smallest id in it,
    null if all its ids are null.
    """
    groups = near_groups(docs, doc_id, text, **search)
    leads = groups.groupBy("component").agg(F.min("doc").alias("lead"))
    return groups.join(leads, "component").select(
        real_id(F.col("doc")).alias(doc_id), real_id(F.col("lead")).alias("component_id")
    )


def group_leads(groups: DataFrame) -> DataFrame:
    """(doc, body) of the document that stays of each group: the smallest id, of equal ids the smallest digest."""
    lead = F.min(F.struct("doc", "body")).alias("lead")
    return groups.groupBy("component").agg(lead).select("lead.doc", "lead.body")


def near_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 5,
    similarity: float = 0.8,
    parts: int = PARTS,
    bits: int = PART_BITS,
    radius: int = 2,
) -> DataFrame:
    """(doc, body, component), one row per row of ``docs``; ``doc`` is the id as a key, ``body`` the text's digest.

    Two texts are near copies if the Jaccard similarity of their sets of
    ``size``-word shingles (A-Z in lower case) is at least ``similarity``. The
    result is complete: texts that near copies connect share a component, and
    no others do, as every link is verified on the exact sets.

    Three rounds find the links. The first takes candidates from ``parts``
    fingerprints of ``bits`` bits over words by ball hashing: cheap, and it joins
    much of a large family, but it misses many texts that differ by a block. The
    others search by the rarest shingles of a text (``_rare_entries``), of which
    near copies always share one: first against one head of each shingle, then
    every pair that is still in different components.

    Texts are the nodes, known by a 128-bit digest of their words and numbered
    when they are stored, so ids may be null or repeat. Equal word sequences are one
    node: large groups of exact copies cost nothing. Null and empty texts are
    copies of each other. Stage tables go after their last reader.
    """
    read_schema = pa.schema(
        [("doc", pa.int64()), ("place", pa.int64()), ("mark", pa.binary()), ("body", pa.binary())]
        + [("fps", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc, place, mark, value in zip(*(batch[c].to_pylist() for c in ("doc", "place", "mark", "value"))):
                    words = [w.lower() for w in words_of(value)]
                    hashes = np.unique(shingle_hashes(words, size).view(np.int64))
                    low = hashes[: most_missed(len(hashes), similarity) + 1]
                    yield doc, place, mark, body_digest(words), part_fingerprints(words, parts, bits) if words else None, low

        yield from flush_every(1_000, read_schema)(rows())

    # Where a text can be fetched again: its id, or a hash of it where there is none, and the text's own digest.
    place = F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(text))
    mark = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    narrow = docs.select(id_key(doc_id).alias("doc"), place.alias("place"), mark.alias("mark"), F.col(text).alias("value"))
    read_type = "doc long, place long, mark binary, body binary, fps array<long>, low array<long>"
    held = stage(map_batches(narrow, read, read_type), "near-fps")
    rows = stage(held.select("doc", "body"), "near-rows")
    spot = F.min(F.struct("place", "mark")).alias("spot")
    prints = held.groupBy("body").agg(spot, F.first("fps").alias("fps"), F.first("low").alias("low"))
    # Numbers are shorter than digests, and as the table is written they stay what they are.
    prints = stage(prints.withColumn("rep", F.monotonically_increasing_id()), "near-prints")
    unstage(held)

    pairs = _ball_pairs(prints, parts, bits, radius)
    suspects = _suspects(prints)
    named = suspects.union(pairs.select("a")).union(pairs.select("b")).distinct()
    wanted = stage(prints.join(named, "rep", "left_semi").select("rep", "spot.*"), "near-wanted")
    bodies = stage(prints.select("body", "rep"), "near-bodies")
    unstage(suspects, prints)  # fingerprints and low hashes are several times the size of what is still needed
    sets = stage(_shingle_sets(narrow, wanted, size), "near-sets")
    unstage(wanted)
    entries = _rare_entries(sets, similarity)

    links = stage(_verified(pairs.groupBy("b").agg(F.min("a").alias("a")), sets, similarity), "near-links-1")
    known = connected_components(links, "a", "b", "near-1")
    placed = _with_component(entries, known)
    rest = _across(pairs, known).union(_head_pairs(placed, similarity)).distinct()
    more = stage(links.union(_verified(rest, sets, similarity).select("a", "b")), "near-links-2")
    unstage(placed, pairs, known, links)
    known = connected_components(more, "a", "b", "near-2")
    placed = _with_component(entries, known)
    last = _all_pairs(placed, similarity)
    links = stage(more.union(_verified(last, sets, similarity).select("a", "b")), "near-links-3")
    unstage(placed, last, entries, known, sets, more)
    roots = connected_components(links, "a", "b", "near-3")
    named = bodies.select("body", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    labels = named.select("body", F.coalesce("component", "rep").alias("component"))
    groups = stage(rows.join(labels, "body"), "near-groups")
    unstage(rows, bodies, roots, links)
    return groups


def _ball_pairs(bodies: DataFrame, parts: int, bits: int, radius: int) -> DataFrame:
    """(a, b): texts that ball hashing brings together, part by part, so that only one part's variants exist at a time."""
    prints = bodies.select("rep", "fps")
    distance = F.aggregate(
        F.arrays_zip(F.col("x.fps").alias("p"), F.col("y.fps").alias("q")),
        F.lit(0),
        lambda n, z: n + F.bit_count(z["p"].bitwiseXOR(z["q"])),
    )
    found = []
    for t in range(parts):
        part = prints.filter("fps is not null").select("rep", F.get("fps", F.lit(t)).alias("fp"))
        # Who stands for equal parts, and who is whose neighbour on a value, is drawn anew for every part and value:
        # within a large family each text so meets many others, though never all of them.
        heads = part.groupBy("fp").agg(F.min_by("rep", F.xxhash64("rep", "fp")).alias("head"))
        same = part.join(heads, "fp").select(F.col("head").alias("x"), F.col("rep").alias("y"))
        order = Window.partitionBy("variant").orderBy(F.xxhash64("head", "variant"), "head")
        near = variants(heads, bits, radius).select(F.lag("head").over(order).alias("x"), F.col("head").alias("y"))
        met = same.union(near).filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        # Far apart over all parts together: met by chance.
        close = (
            met.distinct()
            .join(prints.alias("x"), F.col("a") == F.col("x.rep"))
            .join(prints.alias("y"), F.col("b") == F.col("y.rep"))
            .filter(distance <= parts * bits // 4)
        )
        found.append(stage(close.select("a", "b"), f"near-ball-{t}"))
    pairs = stage(reduce(DataFrame.union, found).distinct(), "near-pairs")
    unstage(*found)
    return pairs


def _suspects(bodies: DataFrame) -> DataFrame:
    """(rep) of the texts that share one of their lowest hashes with another, as near copies do; repeats are possible."""
    low = bodies.select("rep", F.explode("low").alias("token"))
    found = []
    for k in range(LOW_PASSES):
        some = low.filter(F.pmod("token", F.lit(LOW_PASSES)) == k)
        shared = some.groupBy("token").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).filter("x < y").select("token")
        found.append(stage(some.join(shared, "token", "left_semi").select("rep").distinct(), f"near-low-{k}"))
    return reduce(DataFrame.union, found)


# Rounding in a bound must never lose a pair; a bound that is too low by one only adds a candidate.
_SLACK = 1e-6


def most_missed(n: int, similarity: float) -> int:
    """How many of its ``n`` shingles a text may not share with a near copy."""
    return n - math.ceil(similarity * n - _SLACK)


def _rare_entries(sets: DataFrame, similarity: float) -> DataFrame:
    """(rep, n, token, at): of each text that can have a near copy its rarest shared shingles and their places.

    Of ``n`` shingles a near copy lacks ``most_missed`` at most, so in one order
    for all texts, rarest first, one of the first ``most_missed + 1`` is shared:
    the prefix filter. Those that no other text has come first and need no
    entry; a text with more of them than it may miss has no near copy.
    """
    tokens = sets.select("rep", F.size("hashes").alias("n"), F.explode("hashes").alias("token"))
    passes = []
    for k in range(PASSES):
        some = tokens.filter(F.pmod("token", F.lit(PASSES)) == k)
        counts = some.groupBy("token").agg(F.count("*").alias("texts")).filter("texts > 1")
        passes.append(stage(some.join(counts, "token"), f"near-shared-{k}"))
    shared = reduce(DataFrame.union, passes)
    order = F.array_sort(F.collect_list(F.struct("texts", "token")))
    texts = shared.groupBy("rep", "n").agg(order.alias("shared"))
    missed = F.col("n") - F.ceil(F.col("n") * F.lit(similarity) - F.lit(_SLACK)).cast("int")
    own = F.col("n") - F.size("shared")
    able = texts.withColumns({"own": own, "length": missed + 1 - own}).filter("length > 0")
    found = able.select("rep", "n", "own", F.posexplode(F.slice("shared", F.lit(1), F.col("length"))).alias("k", "e"))
    entries = stage(found.select("rep", "n", F.col("e.token").alias("token"), (F.col("own") + F.col("k")).alias("at")), "near-entries")
    unstage(*passes)
    return entries


def _with_component(entries: DataFrame, known: DataFrame) -> DataFrame:
    """The entries with their text's component, without shingles all of whose texts are in one component."""
    placed = entries.join(known.withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.withColumn("component", F.coalesce("component", "rep"))
    mixed = placed.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    return stage(placed.join(mixed.select("token"), "token", "left_semi"), "near-placed")


def _reach(similarity: float) -> Column:
    """Whether x and y, sharing a shingle first at these places, can still share as many as near copies do."""
    least = F.ceil((F.col("x.n") + F.col("y.n")) * F.lit(similarity / (1 + similarity)) - F.lit(_SLACK))
    return (
        (F.col("x.component") != F.col("y.component"))
        & (F.col("x.n") - F.col("x.at") >= least)
        & (F.col("y.n") - F.col("y.at") >= least)
    )


def _named(met: DataFrame) -> DataFrame:
    return met.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))


def _head_pairs(placed: DataFrame, similarity: float) -> DataFrame:
    """(a, b): each text with one text for each of its entries, drawn anew for every shingle."""
    drawn = F.min_by(F.struct("rep", "n", "at", "component"), F.xxhash64("rep", "token")).alias("head")
    heads = placed.groupBy("token").agg(drawn).select("token", "head.*")
    return _named(heads.alias("x").join(placed.alias("y"), (F.col("x.token") == F.col("y.token")) & _reach(similarity)))


def _all_pairs(placed: DataFrame, similarity: float) -> DataFrame:
    """Distinct (a, b) in different components that can be near copies.

    The smaller text of a pair has the shingle among its first
    ``n - least(n, n) + 1``, so one side is always such an entry. The largest
    component of a shingle is not held against itself.
    """
    least = F.ceil(F.col("n") * F.lit(2 * similarity / (1 + similarity)) - F.lit(_SLACK))
    early = placed.withColumn("early", F.col("n") - F.col("at") >= least)
    sizes = early.groupBy("token", "component").agg(F.count("*").alias("texts"), F.max("early").alias("early"))
    main = sizes.groupBy("token").agg(F.max_by("component", F.struct("texts", "component")).alias("main"), F.max("early").alias("some"))
    dealt = early.join(main.filter("some").select("token", "main"), "token")
    dealt = stage(dealt.withColumn("main", F.col("main") == F.col("component")), "near-dealt")
    on = (F.col("x.token") == F.col("y.token")) & _reach(similarity)
    rest, large = dealt.filter("early and not main").alias("x"), dealt.filter("early and main").alias("x")
    one = _named(rest.join(dealt.alias("y"), on))
    other = _named(large.join(dealt.filter("not main").alias("y"), on))
    pairs = stage(one.union(other).distinct(), "near-pairs-3")
    unstage(dealt)
    return pairs


def _across(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs whose texts are in different components."""
    left, right = (known.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in")) for c in ("a", "b"))
    return (
        pairs.join(left, "a", "left")
        .join(right, "b", "left")
        .filter(F.coalesce("a_in", "a") != F.coalesce("b_in", "b"))
        .select("a", "b")
    )


def _shingle_sets(narrow: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(rep, hashes) of the wanted texts, one row each: their distinct shingle hashes in order.

    Rows may repeat, so one of each place and mark stays before sets are made:
    the grouping keeps the join's partitions, and no set is shuffled.
    """
    schema = pa.schema([("rep", pa.int64()), ("hashes", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for rep, value in zip(batch["rep"].to_pylist(), batch["value"].to_pylist()):
                    words = [w.lower() for w in words_of(value)]
                    yield rep, np.unique(shingle_hashes(words, size).view(np.int64))

        yield from flush_every(1_000, schema)(rows())

    keys = ["place", "mark"]
    texts = narrow.join(wanted, keys).groupBy(*keys).agg(F.first("rep").alias("rep"), F.first("value").alias("value"))
    return map_batches(texts.select("rep", "value"), run, "rep long, hashes array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets reach the similarity."""

    @F.arrow_udf("double")
    def jaccard(left: pa.Array, right: pa.Array) -> pa.Array:
        values = []
        for x, y in zip(left, right):
            a, b = x.values.to_numpy(zero_copy_only=False), y.values.to_numpy(zero_copy_only=False)
            both = len(np.intersect1d(a, b, assume_unique=True))
            values.append(both / (len(a) + len(b) - both))
        return pa.array(values, pa.float64())

    ship_package(pairs.sparkSession)
    x, y = sets.alias("x"), sets.alias("y")
    met = pairs.join(x, F.col("a") == F.col("x.rep")).join(y, F.col("b") == F.col("y.rep"))
    return met.filter(jaccard(F.col("x.hashes"), F.col("y.hashes")) >= similarity).select("a", "b")
