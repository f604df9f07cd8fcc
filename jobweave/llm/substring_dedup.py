"""Substring dedup by fixed-block anchors.

A repeat of ``window`` words holds a whole block of ``window / 2`` words at a
multiple of that length in the earlier document, wherever the repeat starts. So
an index of these non-overlapping blocks is probed with the rolling hash of
every run of block length; around each hit the runs of ``window`` words are
compared and join to maximal exact repeats.

Sending a probe for every word of a corpus would move several times its size.
A first pass therefore finds the places that can lie in a repeat at all: of
every ``window`` words each document sends the smallest hash (two texts that
share a window share it), about one word in thirteen. Only places whose
smallest hash several documents share are indexed and probed. This filter loses
nothing, and each later step moves repeated text only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import id_key, map_batches, stage, unstage, words_of
from jobweave.session import ship_package

WINDOW = 50
# A row is found by its id and a hash of its text: many rows of one id, or without one, form no group. What two
# texts of one id share by chance only adds places to look at.
ROW = ["doc", "part"]
_FLUSH = 200_000
# An odd multiplier of the rolling hash.
_BASE = 0x9E3779B97F4A7C15


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def rolling(hashes: np.ndarray, size: int, base: int = _BASE) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words, equal for equal runs wherever they start."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    powers, inverse = _powers(base, len(hashes)), _powers(pow(base, -1, 2**64), n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers, dtype=np.uint64)))
    x = (sums[size:] - sums[:n]) * inverse
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def smallest_hashes(runs: np.ndarray, window: int, block: int) -> np.ndarray:
    """The distinct smallest block hashes of all windows."""
    reach = window - block + 1
    if len(runs) < reach:
        return runs[:0]
    return np.unique(np.lib.stride_tricks.sliding_window_view(runs, reach).min(axis=1))


def around(hit: np.ndarray, before: int, after: int) -> np.ndarray:
    """True from ``before`` places before each hit to ``after`` places behind it."""
    edge = np.zeros(len(hit) + 1, dtype=np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, np.maximum(at - before, 0), 1)
    np.add.at(edge, np.minimum(at + after + 1, len(hit)), -1)
    return np.cumsum(edge[:-1]) > 0


def repeat_cover(starts: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """True for the words of all windows that start where ``starts`` is true."""
    padded = np.zeros(n_words, dtype=bool)
    padded[: len(starts)] = starts
    return around(padded, 0, window - 1)


def _emit(schema: pa.Schema, arrays: Iterator[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for columns in arrays:
        held.append(columns)
        size += len(columns[0])
        if size >= _FLUSH:
            yield _joined(schema, held)
            held, size = [], 0
    if held:
        yield _joined(schema, held)


def _joined(schema: pa.Schema, held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*held), schema)], schema=schema)


Spread = Callable[[list[bytes], np.ndarray, np.ndarray], tuple | None]


def _spread(df: DataFrame, run: Spread, schema: pa.Schema, ddl: str) -> DataFrame:
    """Rows of ``run(words, their hashes, known hashes)`` with doc and part for every row of ``df`` (doc, part, value, known)."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays() -> Iterator[tuple[np.ndarray, ...]]:
            for batch in source:
                columns = (*(batch[c].to_pylist() for c in ("doc", "part", "value")), batch["known"])
                for doc, part, value, known in zip(*columns):
                    hashes = known.values.to_numpy(zero_copy_only=False) if known.is_valid else np.zeros(0, np.int64)
                    words = words_of(value)
                    if found := run(words, word_hashes(words), hashes):
                        n = len(found[0])
                        yield (*found, np.full(n, doc), np.full(n, part))

        yield from _emit(schema, arrays())

    return map_batches(df.select("doc", "part", "value", "known"), batches, ddl)


def _shared(rows: DataFrame, keys: list[str], live: DataFrame) -> DataFrame:
    """(doc, part, known): per text the keys that ``live`` names. Both sides shrink; a hot key is split by the join."""
    return rows.join(live, keys).groupBy(*ROW).agg(F.collect_set(keys[0]).alias("known"))


def whole_copies(narrow: DataFrame) -> DataFrame:
    """(doc, part) of the texts that have the words of a text with a smaller id."""
    schema = pa.schema([("doc", pa.int64()), ("part", pa.int64()), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [xxhash.xxh3_128_digest(b" ".join(words_of(t))) for t in batch["value"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc"], batch["part"], pa.array(bodies, pa.binary())], schema=schema)

    bodies = stage(map_batches(narrow, run, "doc long, part long, body binary"), "sub-bodies")
    first = bodies.groupBy("body").agg(F.min("doc").alias("first"))
    copied = bodies.join(first, "body").groupBy(*ROW).agg(F.bool_and(F.col("first") < F.col("doc")).alias("copied"))
    copies = stage(copied.filter("copied").select(*ROW), "sub-copies")
    unstage(bodies)
    return copies


def repeated_windows(docs: DataFrame, doc_id: str, text: str, window: int = WINDOW) -> DataFrame:
    """(doc, part, gone, copied): per text the windows that also start in a document with a smaller id.

    ``gone`` holds a rolling hash of each window, which finds it, and a 128-bit digest of its words, which proves it. Of
    whole copies all windows go, so they are ``copied`` and send none: the first of them stands for all.
    """
    block = window // 2
    # A repeat of ``window`` words must hold a whole aligned block: 2 * block - 1 <= window.
    narrow = docs.select(id_key(doc_id).alias("doc"), F.xxhash64(text).alias("part"), F.col(text).alias("value"))
    copies = whole_copies(narrow)
    keyed = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("part", pa.int64())])

    def sketch(_: list[bytes], words: np.ndarray, known: np.ndarray):
        keys = smallest_hashes(rolling(words, block), window, block)
        return (keys,) if len(keys) else None

    nothing = F.lit(None).cast("array<bigint>").alias("known")
    sketches = stage(_spread(narrow.select("*", nothing), sketch, keyed, "key long, doc long, part long"), "sub-sketch")
    low_high = sketches.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    places = _shared(sketches, ["key"], low_high.filter("low < high").select("key"))
    places = stage(places.join(copies, ROW, "left_anti"), "sub-places")
    unstage(sketches)

    probe_schema = pa.schema([("key", pa.int64()), ("indexed", pa.bool_()), ("doc", pa.int64()), ("part", pa.int64())])

    def probe(_: list[bytes], words: np.ndarray, known: np.ndarray):
        runs = rolling(words, block)
        near = around(np.isin(runs, known), window - block, window - block)
        indexed = np.zeros(len(runs), dtype=bool)
        indexed[::block] = near[::block]
        keys, where = np.unique(runs[near], return_inverse=True)
        flags = np.bincount(where, weights=indexed[near], minlength=len(keys)) > 0
        return (keys, flags) if len(keys) else None

    probing = _spread(narrow.join(places, ROW), probe, probe_schema, "key long, indexed boolean, doc long, part long")
    probes = stage(probing, "sub-probes")
    hits = probes.groupBy("key").agg(F.min(F.when(F.col("indexed"), F.col("doc"))).alias("low"), F.max("doc").alias("high"))
    anchors = stage(_shared(probes, ["key"], hits.filter("low < high").select("key")), "sub-anchors")
    unstage(probes, places)

    window_schema = pa.schema([("key", pa.int64()), ("check", pa.binary()), ("doc", pa.int64()), ("part", pa.int64())])

    def extend(words: list[bytes], hashes: np.ndarray, known: np.ndarray):
        starts = len(words) - window + 1
        if starts <= 0:
            return None
        near = np.flatnonzero(around(np.isin(rolling(hashes, block), known), window - block, 0)[:starts])
        keys, first = np.unique(rolling(hashes, window)[near], return_index=True)
        return (keys, _digests(words, near[first], window)) if len(keys) else None

    extending = _spread(narrow.join(anchors, ROW), extend, window_schema, "key long, check binary, doc long, part long")
    windows = stage(extending, "sub-windows")
    earliest = windows.groupBy("key", "check").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    later = windows.join(earliest.filter("low < high"), ["key", "check"]).filter("low < doc")
    gone = later.groupBy(*ROW).agg(F.collect_set(F.struct("key", "check")).alias("gone"))
    gone = gone.withColumn("copied", F.lit(False))
    gone = stage(gone.unionByName(copies.withColumn("copied", F.lit(True)), allowMissingColumns=True), "sub-gone")
    unstage(windows, anchors, copies)
    return gone


def _digests(words: list[bytes], starts: np.ndarray, window: int) -> np.ndarray:
    """128 bits of the words of every window that starts at one of ``starts``, words joined by a space."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    begins = (ends[starts] - 1 - np.fromiter((len(words[i]) for i in starts), np.int64, len(starts))).tolist()
    digest = xxhash.xxh3_128_digest
    found = np.empty(len(starts), dtype=object)
    found[:] = [digest(joined[a:b]) for a, b in zip(begins, (ends[starts + window - 1] - 1).tolist())]
    return found


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    r"""All rows and columns of ``docs`` without the words of repeated windows.

    A word goes if it lies in a run of ``window`` words (even) of its document
    that also starts in a document with a smaller id, judged on the input. Adds
    ``n_words`` and ``n_removed`` (long), replacing columns of these names. A
    text that loses words becomes its kept words joined by a space; others stay
    as they are. Words are ``[^\x20\x09-\x0D]+``.

    Null text: stays null, counts 0. A null id is larger than all ids; rows that
    share an id don't remove each other's words.
    """
    if window < 2 or window % 2:
        raise ValueError("the window must be an even number of words")
    gone = repeated_windows(docs, doc_id, text, window)
    out = pa.struct([("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])

    @F.arrow_udf("struct<text: string, n_words: bigint, n_removed: bigint>")
    def kept(values: pa.Array, lists: pa.Array, copies: pa.Array) -> pa.Array:
        rows = []
        for value, drop, copied in zip(values.to_pylist(), lists, copies.to_pylist()):
            words = words_of(value)
            lost = 0
            if copied and len(words) >= window:
                value, lost = "", len(words)
            elif drop.is_valid and len(words) >= window:
                keys = drop.values.field("key").to_numpy(zero_copy_only=False)
                wanted = set(drop.values.field("check").to_pylist())
                starts = np.zeros(len(words) - window + 1, dtype=bool)
                found = np.flatnonzero(np.isin(rolling(word_hashes(words), window), keys))
                starts[found] = [check in wanted for check in _digests(words, found, window)]
                cover = repeat_cover(starts, len(words), window)
                lost = int(cover.sum())
                if lost:
                    value = b" ".join(w for w, c in zip(words, cover.tolist()) if not c).decode()
            rows.append({"text": value, "n_words": len(words), "n_removed": lost})
        return pa.array(rows, out)

    ship_package(docs.sparkSession)
    new = F.col("_sd_new")
    return (
        docs.withColumns({"_sd_doc": id_key(doc_id), "_sd_part": F.xxhash64(text)})
        .join(gone.toDF("_sd_doc", "_sd_part", "_sd_gone", "_sd_copied"), ["_sd_doc", "_sd_part"], "left")
        .withColumn("_sd_new", kept(F.col(text), F.col("_sd_gone"), F.col("_sd_copied")))
        .withColumns({text: new["text"], "n_words": new["n_words"], "n_removed": new["n_removed"]})
        .drop("_sd_doc", "_sd_part", "_sd_gone", "_sd_copied", "_sd_new")
    )
