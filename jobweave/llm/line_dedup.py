"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last ``window`` lines ends a chunk
wherever it is divisible by ``divisor``. Boundaries depend on the lines around
them only, so a passage inserted into a document shifts no boundary beyond it.
A chunk of several lines that an earlier document has too is removed, after its
bytes were compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import flush_every, id_key, map_batches, stage
from jobweave.session import ship_package

WINDOW, DIVISOR, MIN_LINES = 2, 4, 2

# Parameters of the rolling hash: a multiplier and a prime below 2**31, so that no product leaves 63 bits.
BASE, PRIME = 1_000_003, 2**31 - 1

Chunk = tuple[int, int]  # first line, line after the last


def line_chunks(lines: list[bytes], window: int = WINDOW, divisor: int = DIVISOR) -> list[Chunk]:
    """Cut a document's lines into chunks; together they hold every line once."""
    hashes = np.array([int(hashlib.md5(x).hexdigest()[:8], 16) for x in lines], dtype=np.int64)
    rolled = np.zeros(len(lines), dtype=np.int64)
    for back in range(window):
        rolled[back:] = (rolled[back:] + hashes[: len(lines) - back] * pow(BASE, back, PRIME) % PRIME) % PRIME
    ends = np.flatnonzero(rolled % divisor == 0)
    ends = ends[ends >= window - 1] + 1  # the window must be full
    cuts = [0, *ends.tolist()]
    if cuts[-1] != len(lines):
        cuts.append(len(lines))
    return list(zip(cuts[:-1], cuts[1:]))


def joined_chunks(lines: list[bytes], chunks: list[Chunk], min_lines: int) -> list[Chunk]:
    """The chunks with each that has fewer than ``min_lines`` lines with a word joined to the next, the last to the one before.

    A chunk that is long enough by itself ends what went before, so the cuts
    depend on the lines since the last such chunk only.
    """
    joined: list[Chunk] = []
    begin = 0
    for _, last in chunks:
        worded = sum(1 for x in lines[begin:last] if x.strip())
        if worded >= min_lines:
            joined.append((begin, last))
            begin = last
    if begin < len(lines):
        start = joined.pop()[0] if joined else begin
        joined.append((start, len(lines)))
    return joined


def _bodies(text: str, window: int, divisor: int, min_lines: int, join: bool) -> Iterator[tuple[Chunk, bytes | None]]:
    """Each chunk with its bytes, or None where it has fewer than ``min_lines`` lines with a word."""
    lines = text.encode().split(b"\n")
    chunks = line_chunks(lines, window, divisor)
    for first, last in joined_chunks(lines, chunks, min_lines) if join else chunks:
        worded = last - first >= min_lines and sum(1 for x in lines[first:last] if x.strip()) >= min_lines
        yield (first, last), b"\n".join(lines[first:last]) if worded else None


def _key(body: bytes) -> bytes:
    return xxhash.xxh3_128_digest(body)


def line_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    divisor: int = DIVISOR,
    min_lines: int = MIN_LINES,
    join: bool = False,
) -> DataFrame:
    """All rows and columns of ``docs`` with repeated chunks cut out of the text.

    Adds ``n_lines`` and ``n_lines_removed`` (long), replacing columns of these
    names. The first copy of a chunk, in the smallest id and there the highest
    up, stays. Chunks with fewer than ``min_lines`` lines that hold a word stay,
    or with ``join`` become part of a neighbour, so whole copies go entirely.

    Null text: stays null, counts 0. Empty text: one line, none removed. A null
    id sorts behind all ids; rows that share an id never remove each other's
    chunks, but each loses its own later copies. A text may become empty. What
    belongs to a row is found by its id and a hash of its text, so that many rows
    of one id, or without one, form no group; a list that two texts share says
    the same of both.

    Hashes travel first; bytes only of chunks that several ids share, where a
    chunk held by a third of all documents is reduced before its shuffle.
    """

    def cut(value: str) -> Iterator[tuple[Chunk, bytes | None]]:
        return _bodies(value, window, divisor, min_lines, join)

    key_schema = pa.schema([("key", pa.binary()), ("doc", pa.int64()), ("part", pa.int64())])
    body_schema = pa.schema([("key", pa.binary()), ("body", pa.binary()), ("doc", pa.int64()), ("part", pa.int64())])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc, part, value in zip(*(batch[c].to_pylist() for c in ("doc", "part", "value"))):
                    for key in {_key(body) for _, body in cut(value) if body is not None}:
                        yield key, doc, part

        yield from flush_every(20_000, key_schema)(rows())

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                columns = (batch[c].to_pylist() for c in ("doc", "part", "value", "shared"))
                for doc, part, value, shared in zip(*columns):
                    wanted = set(shared)
                    for _, body in cut(value):
                        if body is not None and (key := _key(body)) in wanted:
                            wanted.discard(key)
                            yield key, body, doc, part

        yield from flush_every(500, body_schema)(rows())

    row = {"doc": id_key(doc_id), "part": F.xxhash64(text)}
    lined = docs.select(*[c.alias(name) for name, c in row.items()], F.col(text).alias("value")).filter(F.col("value").contains("\n"))
    held = stage(map_batches(lined, keys, "key binary, doc long, part long"), "line-keys")
    shared = held.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high")
    wanted = held.join(shared.select("key"), "key").groupBy("doc", "part").agg(F.collect_set("key").alias("shared"))
    # Rows of one id may differ, so a document that shares a key with itself only is never asked for.
    asked = lined.join(wanted, ["doc", "part"])
    found = stage(map_batches(asked, bodies, "key binary, body binary, doc long, part long"), "line-bodies")
    owners = found.groupBy("key", "body").agg(F.min("doc").alias("owner"))
    dropped = (
        found.join(owners, ["key", "body"])
        .filter("owner < doc")
        .groupBy(F.col("doc").alias("_ld_doc"), F.col("part").alias("_ld_part"))
        .agg(F.collect_set("key").alias("_ld_keys"))
    )

    out_type = "struct<text: string, n_lines: bigint, n_removed: bigint>"
    out_schema = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_removed", pa.int64())])

    @F.arrow_udf(out_type)
    def kept(values: pa.Array, keys: pa.Array) -> pa.Array:
        rows = []
        for value, drop in zip(values.to_pylist(), keys.to_pylist()):
            if value is None:
                rows.append({"text": None, "n_lines": 0, "n_removed": 0})
                continue
            gone, seen, lost = set(drop or ()), set(), 0
            lines, stay = value.split("\n"), []
            for (first, last), body in cut(value):
                if body is not None and (body in seen or _key(body) in gone):
                    lost += last - first
                    continue
                if body is not None:
                    seen.add(body)
                stay.extend(lines[first:last])
            rows.append({"text": "\n".join(stay), "n_lines": len(lines), "n_removed": lost})
        return pa.array(rows, out_schema)

    ship_package(docs.sparkSession)
    new = F.col("_ld_new")
    return (
        docs.withColumns({f"_ld_{name}": c for name, c in row.items()})
        .join(dropped, ["_ld_doc", "_ld_part"], "left")
        .withColumn("_ld_new", kept(F.col(text), F.col("_ld_keys")))
        .withColumns({text: new["text"], "n_lines": new["n_lines"], "n_lines_removed": new["n_removed"]})
        .drop("_ld_doc", "_ld_part", "_ld_keys", "_ld_new")
    )
