"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so their Jaccard similarity says
nothing; containment, the share of the item's shingles that a document holds,
does. Only the item is sketched. Items are partitioned by size, and each
partition has its own sketch length: the ``k`` smallest hashes (bottom-k
MinHash) with ``k = floor((1 - threshold) * largest size) + 1``. An item whose
containment reaches the threshold lacks fewer shingles than that, so at least
one sketch entry is in the document: no candidate is lost. Candidates are
verified by exact containment of shingle texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import LAST_ID, ascii_words, id_key, stage

SHINGLE, THRESHOLD = 5, 0.8


def shingle_hashes(words: Column, size: int = SHINGLE) -> Column:
    """A 64-bit hash per shingle; fewer words than ``size``: one for the whole sequence; none: empty."""
    at = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)])
    return (
        F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), at))
        .when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " "))))
        .otherwise(F.array().cast("array<bigint>"))
    )


def shingle_texts(words: Column, size: int = SHINGLE) -> Column:
    """The shingles themselves, words joined by a space."""
    at = lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(size)])
    return (
        F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(0), F.size(words) - size), at))
        .when(F.size(words) > 0, F.array(F.array_join(words, " ")))
        .otherwise(F.array().cast("array<string>"))
    )


def item_sketches(items: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(item, n_shingles, hash) with the bottom-k hashes of every item, k by its size partition.

    ``items`` has (item, words). Partition p holds the sizes from 2^p to 2^(p+1) - 1.
    """
    hashed = items.select("item", F.array_distinct(shingle_hashes(F.col("words"), size)).alias("hashes"))
    n = F.size("hashes")
    largest = F.pow(F.lit(2.0), F.floor(F.log2(n)) + 1) - 1
    k = (F.floor(largest * F.lit(1 - threshold) + F.lit(1e-9)) + 1).cast("int")
    return hashed.filter(n > 0).select(
        "item", F.explode(F.slice(F.array_sort("hashes"), F.lit(1), F.least(k, n))).alias("hash")
    )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment): all pairs at or above the threshold.

    Words are cut at ASCII white space, in lower case. ``n_shingles``
    counts the item's distinct shingles, ``n_shared`` those in the document. An
    item of fewer than ``size`` words is one shingle, which only a document of
    just these words has. Items or documents without words match nothing, nor
    do null texts. Ids are numbers, or strings that are never null. Null ids are kept as null; rows that share an id are taken
    as one document or item with the shingles of all. Equal item texts are
    searched once each.

    The sketches are written to the shared folder first, so Spark knows their
    true size when it chooses between broadcast and shuffle.
    """
    tested = items.select(id_key(item_id).alias("item"), ascii_words(F.lower(F.col(item_text))).alias("words"))
    # A row's words stay one list: ids may repeat.
    full = stage(tested.filter(F.size("words") > 0), "bench-items")
    sketch = stage(item_sketches(full, size, threshold).distinct(), "bench-sketches")
    anchors = sketch.select("hash").distinct()

    # Numbers may be null; keys of another type are taken as they are.
    numbers = doc_id in {c for c, kind in docs.dtypes if kind != "string"}
    doc = id_key(doc_id) if numbers else F.col(doc_id)
    worded = docs.select(doc.alias("doc"), ascii_words(F.lower(F.col(text))).alias("words"))
    probes = worded.select("doc", F.explode(shingle_hashes(F.col("words"), size)).alias("hash"))
    # One row per (document, item) that share a sketch entry; few documents share any.
    hits = probes.join(anchors, "hash", "left_semi").distinct()
    pairs = stage(hits.join(sketch, "hash").select("doc", "item").distinct(), "bench-pairs")

    item_shingles = full.select("item", F.explode(shingle_texts(F.col("words"), size)).alias("shingle")).distinct()
    sizes = item_shingles.groupBy("item").agg(F.count("*").alias("n_shingles"))
    suspects = docs.select(doc.alias("doc"), F.lower(F.col(text)).alias("value")).join(
        pairs.select("doc").distinct(), "doc", "left_semi"
    )
    doc_words = suspects.select("doc", ascii_words(F.col("value")).alias("words"))
    doc_shingles = doc_words.select("doc", F.explode(shingle_texts(F.col("words"), size)).alias("shingle"))
    # Only shingles of items go on, so that what is shuffled stays as small as the benchmark part of a document.
    known = stage(item_shingles.select("shingle").distinct(), "bench-shingles")
    shared = stage(doc_shingles.join(known, "shingle", "left_semi").distinct(), "bench-shared")
    verified = (
        pairs.join(item_shingles, "item")
        .join(shared, ["doc", "shingle"])
        .groupBy("doc", "item")
        .agg(F.count("*").alias("n_shared"))
        .join(sizes, "item")
        # Whole numbers: the share is compared without rounding, in ten-thousandths.
        .filter(F.col("n_shared") * 10000 >= F.col("n_shingles") * F.lit(round(threshold * 10000)))
    )
    real = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return verified.select(
        (real("doc") if numbers else F.col("doc")).alias(doc_id),
        real("item").alias(item_id),
        "n_shingles",
        "n_shared",
        (F.col("n_shared") / F.col("n_shingles")).alias("containment"),
    )


def row_key(doc_id: str, text: str) -> Column:
    """A key of a row by its id and text, never null: rows that share it are equal in both."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.coalesce(F.md5(text), F.lit("null"))))
