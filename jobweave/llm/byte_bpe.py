"""Byte-level BPE encoding and decoding.

The distinct words of a corpus are merged once each, by a fold of Spark's
higher-order functions over their bytes with the ranked merges as a literal.
Documents then only look their words up. Decoding joins the pieces' bytes.

Looking up: a bounded set of common words goes to every task; the other words
of a document come by a join, by their order in the text. Both are the fold's
results. Which words are in that set is a choice of speed alone, so it is made on
a bounded sample of documents, and no pass over the corpus is spent on it.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave.llm.common import bound_batches, flush_every, map_batches, unstage
from jobweave.session import scratch_path, ship_package
from jobweave.sources.tables import stage, write_files

COMMON_WORDS = 1 << 17
# Documents whose words say which are common.
SAMPLE_ROWS = 20_000
# Words are looked up in so many passes.
PASSES = 4
# A stored row takes texts until it has so many words.
ROW_WORDS = 1 << 15
# Longer words are merged by a heap in a task: the fold's work grows with the square of the length.
FOLD_BYTES = 64
_RANKS = 1 << 20
_NONE = (1 << 31) - 1
_HELD_WORDS = 300_000


def tokenizer_files():
    """The module that knows the public rank files (``path``) and their split pattern (``PATTERN``)."""
    import public_tokenizers

    return public_tokenizers


class Vocabulary:
    """Ranks of byte pieces, as a rank file lists them; every piece must be a byte or a merge of two of lower rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        self.merges = {self._halves(p, r): r for p, r in ranks.items() if len(p) > 1}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as file:
            return cls({base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)})

    def _halves(self, piece: bytes, rank: int) -> tuple[int, int]:
        """The two pieces a piece is merged from: what the merges of lower rank make of its bytes."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 2:
            found = [(self.ranks.get(a + b, _NONE), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            low, i = min(found)
            if low >= rank:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) != 2:
            raise ValueError(f"rank {rank} isn't a merge of two pieces of lower rank")
        return self.ranks[parts[0]], self.ranks[parts[1]]


def merge_long(word: bytes, byte_ids: list[int], merges: dict[tuple[int, int], int]) -> list[int]:
    """The same merges with a heap of pairs and linked pieces, for long words: lowest rank first, leftmost of equals."""
    ids: list[int | None] = [byte_ids[b] for b in word]
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := merges.get((a, b))) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= len(ids) or ids[j] != b:
            continue
        ids[i], ids[j] = rank, None
        after[i] = after[j]
        if after[j] < len(ids):
            before[after[j]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right < len(ids) and (r := merges.get((ids[left], ids[right]))) is not None:
                heapq.heappush(heap, (r, left, ids[left], ids[right]))
    return [x for x in ids if x is not None]


def rank_table(vocabulary: Vocabulary) -> tuple[list[int], list[int | None]]:
    """(offsets, slots): the merges of all left pieces laid over each other in one array.

    The merge of a and b is at ``offsets[a] + b``; the slot there holds a, above
    the rank, so a slot that belongs to another left piece is told apart.
    """
    if len(vocabulary.pieces) > _RANKS:
        raise ValueError(f"ranks must be below {_RANKS}")
    rights: dict[int, dict[int, int]] = {}
    for (a, b), rank in vocabulary.merges.items():
        rights.setdefault(a, {})[b] = rank
    n = len(vocabulary.pieces)
    offsets, slots = [0] * n, [None] * (4 * n + 1)
    # The largest rows first; each is tried from a place of its own onwards, where a fifth of the slots is taken at most.
    for a, ranks in sorted(rights.items(), key=lambda x: -len(x[1])):
        start = a * 7919 % (3 * n)
        offset = next(o % (3 * n) for o in range(start, start + 3 * n) if all(slots[o % (3 * n) + b] is None for b in ranks))
        offsets[a] = offset
        for b, rank in ranks.items():
            slots[offset + b] = a * _RANKS + rank
    return offsets, slots


def _literal(numbers: list[int | None], kind: str) -> Column:
    """A constant array; what is missing takes no room in the plan and becomes null."""
    return F.split(F.lit(",".join("" if n is None else str(n) for n in numbers)), ",").try_cast(f"array<{kind}>")


def _let(value: Column, then) -> Column:
    """Bind a value once inside a higher-order function."""
    return F.element_at(F.transform(F.array(value), then), 1)


def fold_merges(word: Column, vocabulary: Vocabulary) -> Column:
    """Ids (array of int) of a binary word: merge the lowest-ranked pair, leftmost first, until none is left."""
    offsets, slots = rank_table(vocabulary)
    offsets, slots = _literal(offsets, "int"), _literal(slots, "bigint")
    byte_ids = _literal(vocabulary.byte_ids, "int")
    # Bytes as Latin-1 signs, whose codes are the bytes.
    start = F.transform(F.split(F.decode(word, "ISO-8859-1"), ""), lambda sign: F.get(byte_ids, F.ascii(sign)))

    def rank(a: Column, b: Column) -> Column:
        """The rank of the merge of two ids; without one a number above all ranks, or null."""
        slot = F.get(slots, F.get(offsets, a) + b)
        return slot.bitwiseXOR(F.shiftleft(a.cast("bigint"), _RANKS.bit_length() - 1))

    def step(state: Column, _: Column) -> Column:
        ids = state["ids"]

        def merged(ranks: Column) -> Column:
            def at_lowest(low: Column) -> Column:
                at = F.array_position(ranks, low).cast("int")
                joined = F.concat(F.slice(ids, F.lit(1), at - 1), F.array(low.cast("int")), F.slice(ids, at + 2, F.size(ids)))
                return F.when(low < _RANKS, F.struct(joined.alias("ids"), (F.size(ids) > 2).alias("open"))).otherwise(
                    F.struct(ids.alias("ids"), F.lit(False).alias("open"))
                )

            return _let(F.array_min(ranks), at_lowest)

        ranks = F.zip_with(ids, F.slice(ids, F.lit(2), F.size(ids)), rank)
        return F.when(state["open"], _let(ranks, merged)).otherwise(state)

    first = F.struct(start.alias("ids"), (F.octet_length(word) > 1).alias("open"))
    steps = F.sequence(F.lit(1), F.greatest(F.octet_length(word) - 1, F.lit(1)))
    return F.aggregate(steps, first, step, lambda state: state["ids"])


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """All matches of ``pattern`` in a text, in order.

    For the common split pattern of byte-level vocabularies the standard
    library's faster engine does the same with its own classes, unless a text
    has a number sign that isn't a decimal digit, which these tell apart.
    """
    find = regex.compile(pattern).findall
    if pattern != tokenizer_files().PATTERN:
        return find
    # The signs of the White_Space property.
    blank = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    numbers = {c for c in map(chr, range(0x110000)) if c.isnumeric() and not c.isdecimal()}
    # Up to U+00FF there are six of them; only texts with higher signs are looked through sign by sign.
    unclear = re.compile("[\xb2\xb3\xb9\xbc-\xbe\u0100-\U0010ffff]").search
    fast = re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:_|[^{blank}\w])+|[{blank}]+(?![^{blank}])|[{blank}]+"
    ).findall

    def found(text: str) -> list[str]:
        plain = text.isascii() or not unclear(text) or numbers.isdisjoint(text)
        return fast(text) if plain else find(text)

    return found


_splitters: dict[str, Callable[[str], list[str]]] = {}


def split(pattern: str) -> Callable[[str], list[str]]:
    """The pattern's splitter, made once in each task's process."""
    if pattern not in _splitters:
        _splitters[pattern] = splitter(pattern)
    return _splitters[pattern]


def word_counts(docs: DataFrame, text: str, pattern: str) -> DataFrame:
    """(word, n): the distinct words of all texts as bytes, counted in the tasks before the shuffle."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = split(pattern)

        def rows() -> Iterator[tuple]:
            counts: Counter[str] = Counter()
            for batch in batches:
                for value in batch["value"].to_pylist():
                    if value:
                        counts.update(find(value))
                    if len(counts) > _HELD_WORDS:
                        yield from ((w.encode(), n) for w, n in counts.items())
                        counts.clear()
            yield from ((w.encode(), n) for w, n in counts.items())

        yield from flush_every(50_000, schema)(rows())

    counted = map_batches(docs.select(F.col(text).alias("value")), run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def encoded_words(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, ids) for distinct words: folded, or by the heap where they are long; ids packed (see ``packed_words``)."""
    byte_ids, merges = vocabulary.byte_ids, vocabulary.merges
    schema = pa.schema([("word", pa.binary()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [merge_long(w, byte_ids, merges) for w in batch["word"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["word"], pa.array(ids, pa.list_(pa.int32()))], schema=schema)

    short = words.filter(F.octet_length("word") <= FOLD_BYTES)
    folded = short.select("word", fold_merges(F.col("word"), vocabulary).alias("ids"))
    long = words.filter(F.octet_length("word") > FOLD_BYTES).select("word")
    ids = folded.union(map_batches(long, run, "word binary, ids array<int>"))
    out_schema = pa.schema([("word", pa.binary()), ("ids", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["word"], packed_words(batch["ids"])], schema=out_schema)

    return map_batches(ids, pack, "word binary, ids binary")


def common_part(docs: DataFrame, text: str, pattern: str, limit: int, sample_rows: int) -> DataFrame:
    """(word, n): at most ``limit`` of the commonest short words of about ``sample_rows`` documents.

    Counts are sorted into classes, of which there are a few hundred at most;
    whole classes are taken from the top while they fit. So this is bounded by
    ``limit`` words of ``FOLD_BYTES`` bytes whatever the corpus.
    """
    sample = docs.sample(min(1.0, sample_rows / max(1, docs.count())), seed=1)
    counts = word_counts(sample, text, pattern).filter(F.octet_length("word") <= FOLD_BYTES)
    short = stage(counts.withColumn("class", F.floor(F.log2("n") * 8).cast("int")), "bpe-sample")
    sizes = sorted(((r["class"], r["count"]) for r in short.groupBy("class").count().collect()), reverse=True)
    total, lowest = 0, _NONE
    for cls, count in sizes:
        total += count
        if total > limit:
            break
        lowest = cls
    common = stage(short.filter(F.col("class") >= lowest).select("word", "n"), "bpe-common")
    unstage(short)
    return common


class CommonWords:
    """What every task gets of the common words: Arrow columns, made what a step needs in the task's process."""

    def __init__(self, table: pa.Table):
        self.columns = {c: table[c].combine_chunks() if table.num_rows else pa.array([], pa.binary()) for c in table.column_names}

    @cached_property
    def codes(self) -> Codes:
        return Codes({w.decode(): k for k, w in enumerate(self.columns["word"].to_pylist())})

    @cached_property
    def ids(self) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, where each word's begin and the last one's end)."""
        pieces = self.columns["ids"].to_pylist()
        ends = np.cumsum([0, *(len(p) // 4 for p in pieces)])
        return np.frombuffer(b"".join(pieces), "<u4") & ~_LAST, ends


class Codes(dict):
    """Numbers of words: the common ones, and for a stored row's other words new ones from ``_OWN`` upwards."""

    def __init__(self, common: dict[str, int]):
        super().__init__(common)
        self.own: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = code = _OWN + len(self.own)
        self.own.append(word)
        return code

    def of(self, words: list[str]) -> tuple[np.ndarray, list[str]]:
        """The code of each word of a stored row, and its own words in the order of their codes."""
        codes = np.array(list(map(self.__getitem__, words)), dtype=np.uint32)
        own, self.own = self.own, []
        for word in own:
            del self[word]
        return codes, own


def as_planes(codes: np.ndarray) -> bytes:
    """The codes' lowest bytes, then their second bytes and so on, which compress far better than whole codes."""
    return codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def gathered(flat: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``which`` in a row, and where each ends; piece k is ``flat[ends[k] : ends[k + 1]]``."""
    sizes = (ends[1:] - ends[:-1])[which]
    behind = np.cumsum(sizes)
    shift = ends[which] - (behind - sizes)
    return flat[np.repeat(shift, sizes) + np.arange(behind[-1] if len(behind) else 0)], behind


def binaries(data: pa.Buffer, ends: np.ndarray) -> pa.Array:
    """Cuts of a buffer as binary values; value k is ``data[ends[k] : ends[k + 1]]``."""
    if ends[-1] >= 1 << 31:
        raise ValueError("a batch of binary values must be below 2 GB")
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), data])


# Codes of a stored row's own words start here.
_OWN = 1 << 31
# Marks the last id of a word.
_LAST = np.uint32(1 << 31)


def packed_lists(lists: pa.Array, marked: bool = False) -> pa.Array:
    """Lists of ids as little-endian unsigned 32-bit integers in a row, the last of each marked if asked for."""
    ends = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
    if marked:
        flat[ends[1:][np.diff(ends) > 0] - 1] |= _LAST
    data, ends = flat.tobytes(), ends.tolist()
    return pa.array([data[4 * a : 4 * b] for a, b in zip(ends, ends[1:])], pa.binary())


def packed_words(lists: pa.Array) -> pa.Array:
    return packed_lists(lists, marked=True)


def packed(ids: Column) -> Column:
    """An array of ids as little-endian unsigned 32-bit integers in a row; null is empty."""

    @F.arrow_udf("binary")
    def to_bytes(lists: pa.Array) -> pa.Array:
        return packed_lists(lists)

    return to_bytes(F.coalesce(ids, F.array().cast("array<int>")))


def unpacked(ids: Column) -> Column:
    """Packed ids as an array of int."""

    @F.arrow_udf("array<int>")
    def to_lists(values: pa.Array) -> pa.Array:
        rows = values.to_pylist()
        flat = np.frombuffer(b"".join(rows), "<i4")
        ends = np.cumsum([0, *(len(r) // 4 for r in rows)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

    return to_lists(ids)


def joined_pieces(pieces: Column) -> Column:
    """The binary pieces of each array in one; pieces are not null."""

    @F.arrow_udf("binary")
    def joined(lists: pa.Array) -> pa.Array:
        ends, pieces = lists.offsets.to_pylist(), lists.values.to_pylist()
        return pa.array([b"".join(pieces[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())

    return joined(pieces)


def encode(docs: DataFrame, vocabulary: Vocabulary, pattern: str, text: str = "text", ids: str = "ids", **search) -> DataFrame:
    """``encode_packed`` with ``ids`` as an array of int."""
    return encode_packed(docs, vocabulary, pattern, text, ids, **search).withColumn(ids, unpacked(F.col(ids)))


def stage_parts(numbered: DataFrame, label: str, parts: int) -> dict[int, DataFrame]:
    """The rows of ``numbered`` by ``_row`` modulo ``parts``, written at once; each part is a stage table of its own."""
    spark, path = numbered.sparkSession, scratch_path(numbered.sparkSession, label)
    dealt = numbered.withColumn("_part", F.pmod("_row", F.lit(parts)))
    write_files(dealt, path, partition_by=["_part"])
    stored = spark.read.schema(dealt.schema).parquet(path)
    present = {r["_part"] for r in stored.select("_part").distinct().collect()}
    return {k: spark.read.schema(numbered.schema).parquet(f"{path}/_part={k}") for k in sorted(present)} or {0: stored.drop("_part")}


def encode_packed(
    docs: DataFrame,
    vocabulary: Vocabulary,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    keep: list[str] | None = None,
    common_words: int = COMMON_WORDS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """All rows of ``docs`` with the columns ``keep``, all by default, and ``ids``, replacing a column of this name.

    ``ids`` is binary: little-endian unsigned 32-bit integers, which ``unpacked``
    makes an array of. Every match of ``pattern`` in the text is merged
    separately; no special tokens. Null and empty texts have no ids. Whole texts
    are encoded, words of any length exactly.

    A text is split once. Texts are stored several to a row, as codes of their
    words, with the row's own words, those that aren't common, beside them. Rows are
    numbered when they are stored, so ids of documents play no part: they may be
    null or repeat.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bound_batches(spark)
    keep = docs.columns if keep is None else keep
    named = common_part(docs, text, pattern, common_words, sample_rows)
    # The commonest words get the smallest codes.
    common = named.toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    named = named.select("word")
    split_words = spark.sparkContext.broadcast(CommonWords(common))
    fields = [T.StructField(f"_k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    rows_type = T.ArrayType(T.StructType([*fields, T.StructField("_words", T.IntegerType())]))
    coded_type = T.StructType().add("rows", rows_type).add("codes", "binary").add("own", T.ArrayType(T.BinaryType()))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, table, pack = split(pattern), split_words.value.codes, zstandard.ZstdCompressor(1).compress
        for batch in batches:
            words, sizes, first, *kept = [], [], 0, *batch.columns[:-1]
            for i, value in enumerate(batch.columns[-1]):  # one text at a time: some are very long
                found = find(value.as_py()) if value.is_valid else []
                words += found
                sizes.append(len(found))
                if len(words) < ROW_WORDS and i + 1 < batch.num_rows:
                    continue
                rows = [*(c.slice(first, len(sizes)) for c in kept), pa.array(sizes, pa.int32())]
                rows = pa.StructArray.from_arrays(rows, names=rows_type.elementType.names)
                codes, own = table.of(words)
                columns = [
                    pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), rows),
                    pa.array([pack(as_planes(codes))], pa.binary()),
                    pa.array([[w.encode() for w in own]], pa.list_(pa.binary())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=coded_type.names)
                words, sizes, first = [], [], i + 1

    given = docs.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(text).alias("_text"))
    numbered = map_batches(given, coded, coded_type).withColumn("_row", F.monotonically_increasing_id())
    # One folder for each pass, so that a pass's rows go when its texts have their words' ids.
    parts = stage_parts(numbered, "bpe-coded", PASSES)

    asked = reduce(DataFrame.union, parts.values()).select("_row", F.posexplode("own").alias("slot", "word"))
    encoded = stage(encoded_words(asked.select("word").union(named).distinct(), vocabulary), "bpe-words")
    # In the order of their codes, which is that of ``common``.
    table = encoded.join(named, "word", "left_semi").toArrow()
    table = table.select(["ids"]).take(pc.index_in(common["word"], value_set=table["word"].combine_chunks()))
    shared = spark.sparkContext.broadcast(CommonWords(table))
    del common, table
    found = []
    for k in range(PASSES):  # each pass frees its shuffle
        some = asked.filter(F.pmod(F.xxhash64("word"), F.lit(PASSES)) == k).join(encoded, "word")
        found.append(stage(some.select("_row", "slot", "ids"), f"bpe-found-{k}"))
    unstage(encoded, named)
    texts = []
    for k, part in parts.items():
        some = reduce(DataFrame.union, found).filter(F.pmod("_row", F.lit(PASSES)) == k)
        own = some.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("slot", "ids"))).alias("own"))
        lists = own.select("_row", joined_pieces(F.col("own.ids")).alias("own_ids"))
        joined = part.select("_row", "rows", "codes").join(lists, "_row", "left")
        texts.append(stage(joined.select("rows", "codes", "own_ids"), f"bpe-texts-{k}"))
        unstage(part)
    unstage(*found)

    left = [i for i, c in enumerate(keep) if c != ids]
    names = [*(keep[i] for i in left), ids]

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, ends, unpack = *shared.value.ids, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for i in range(batch.num_rows):
                rows, codes, own = batch["rows"].slice(i, 1).flatten().flatten(), batch["codes"][i], batch["own_ids"][i]
                which = from_planes(unpack(codes.as_py())).astype(np.int64)
                if own.is_valid:
                    rest = np.frombuffer(own.as_py(), "<u4")
                    cuts = np.flatnonzero(rest & _LAST) + 1
                    which = np.where(which >= _OWN, which - _OWN + len(ends) - 1, which)
                    found, behind = gathered(np.concatenate((flat, rest & ~_LAST)), np.concatenate((ends, ends[-1] + cuts)), which)
                else:
                    found, behind = gathered(flat, ends, which)
                # Where the ids of each text end follows from how many words it has.
                text_ends = np.concatenate(([0], behind))[np.cumsum([0, *rows[-1].to_pylist()])]
                columns = [*(rows[k] for k in left), binaries(pa.py_buffer(found.astype("<u4")), 4 * text_ends)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    out_type = T.StructType([T.StructField(keep[i], fields[i].dataType) for i in left]).add(ids, "binary")
    return map_batches(reduce(DataFrame.union, texts), looked_up, out_type)


def decode_packed(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes of packed ids: the pieces joined."""
    pieces = vocabulary.pieces

    @F.arrow_udf("binary")
    def joined(rows: pa.Array) -> pa.Array:
        ends = np.cumsum([0, *pc.binary_length(rows).to_pylist()]) // 4
        flat = np.frombuffer(b"".join(rows.to_pylist()), "<u4")
        taken = pa.array(pieces, pa.large_binary()).take(pa.array(flat))
        if not len(taken):
            return binaries(pa.py_buffer(b""), ends)
        _, starts, data = taken.buffers()
        return binaries(data, np.frombuffer(starts, np.int64)[ends])

    return joined(ids)


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes of an array of ids; those of null are empty."""
    return decode_packed(packed(ids), vocabulary)


def ids_digest(packed_ids: Column) -> Column:
    """SHA-256 (lower-case hex) of the ids as little-endian unsigned 32-bit integers."""
    return F.sha2(packed_ids, 256)
