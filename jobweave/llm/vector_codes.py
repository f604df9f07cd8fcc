"""Vector code compression by a member-resident Lloyd iteration.

Vectors are cut into parts, and each part position has a codebook of entries.
Parts live with the entry they are assigned to: rows are dealt by (position,
entry, salt) once, and an owner updates its entry from the members that reside
with it. A round judges residents where they are. Those that keep their entry
stay in place; only those that change it move, in the next shuffle, to the
owner of their new entry. Salts split an entry that a third of all parts have.

Components are whole numbers and every sum and distance is exact, so neither
the order of rows nor their partitions change a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobweave.llm.common import map_batches, stage
from jobweave.session import ship_package

POSITIONS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
SALTS = 32
# Of larger components 64-bit distances could overflow; they count as this.
LARGEST = 1 << 28
# Up to here double arithmetic on squares and their sums is exact.
_EXACT = 1 << 20
_BLOCK = 8192

Codebooks = np.ndarray  # (positions, entries, part length), int64


def usable(vector: Column) -> Column:
    """True for a vector without null or non-finite components; false for null."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce(~F.exists(vector, bad), F.lit(False))


def whole_numbers(vectors: pa.Array, length: int, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` of every component, a row per vector; all vectors have ``length`` components."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(flat * scale), -LARGEST, LARGEST).astype(np.int64).reshape(len(vectors), length)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of the nearest row of ``book`` for every row of ``parts``; ties to the lower index."""
    entries, errors = np.empty(len(parts), np.int32), np.empty(len(parts), np.int64)
    for start in range(0, len(parts), _BLOCK):
        x = parts[start : start + _BLOCK]
        if max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)) <= _EXACT:
            y, z = x.astype(np.float64), book.astype(np.float64)
            # |x - c|^2 without |x|^2, which is the same for all entries.
            rest = (z * z).sum(axis=1) - 2 * (y @ z.T)
            best = rest.argmin(axis=1)
        else:
            best = np.array([((book - row) ** 2).sum(axis=1).argmin() for row in x], dtype=np.int64)
        entries[start : start + _BLOCK] = best
        errors[start : start + _BLOCK] = ((x - book[best]) ** 2).sum(axis=1)
    return entries, errors


class Quantizer:
    """Trained codebooks: at most ``POSITIONS * ENTRIES`` entries, so they fit any task."""

    def __init__(self, books: Codebooks, scale: int = SCALE):
        self.books, self.scale = books, scale

    @property
    def length(self) -> int:
        return self.books.shape[0] * self.books.shape[2]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by position, entry and place, with commas between."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def first_vectors(kept: DataFrame, vec_id: str, vector: str, entries: int) -> DataFrame:
    """The ``entries`` vectors that the codebooks start as: the smallest ids, null last, equal ids by their vectors."""
    order = [F.col(vec_id).asc_nulls_last(), F.col(vector)]
    return kept.select(vec_id, vector).orderBy(*order).limit(entries)


def dealt_by_owner(parts: DataFrame) -> DataFrame:
    return parts.repartition("position", "entry", "salt")


def train(
    kept: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    positions: int = POSITIONS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Quantizer:
    """Codebooks after ``rounds`` of assignment and update over all of ``kept``, usable vectors of one length.

    The length must be divisible by ``positions``. An entry becomes the floor of
    the mean of its parts, an entry without parts stays. With fewer vectors than
    ``entries`` there are fewer entries; with none the codebooks are empty. The
    driver holds the codebooks and, each round, one row of sums per entry.
    """
    spark = kept.sparkSession
    first = first_vectors(kept, vec_id, vector, entries).select(vector).toArrow()[vector].combine_chunks()
    length = len(first[0]) if len(first) else 0
    if length % positions:
        raise ValueError(f"{length} components can't be cut into {positions} equal parts")
    width = length // positions
    start = whole_numbers(first, length, scale).reshape(len(first), positions, width)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))
    if not len(first):
        return Quantizer(books, scale)

    state = _placed(kept, vector, books, scale)
    for step in range(rounds):
        books = _updated(state, books)
        if step < rounds - 1:
            state = _reassigned(state, books, step)
    return Quantizer(books, scale)


_STATE = "position int, entry int, salt int, part array<bigint>"
_STATE_SCHEMA = pa.schema(
    [("position", pa.int32()), ("entry", pa.int32()), ("salt", pa.int32()), ("part", pa.list_(pa.int64()))]
)


def _rows(numbers: np.ndarray) -> pa.ListArray:
    n, width = numbers.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width), pa.int32()), pa.array(numbers.ravel()))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def _placed(kept: DataFrame, vector: str, books: Codebooks, scale: int) -> DataFrame:
    """The parts of all vectors with their first owners, dealt to them and stored."""
    positions, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = whole_numbers(batch["vector"], positions * width, scale)
            for position in range(positions):
                parts = np.ascontiguousarray(numbers[:, position * width : (position + 1) * width])
                found, _ = nearest(parts, books[position])
                columns = [np.full(len(parts), position, np.int32), found]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), batch["salt"], _rows(parts)], schema=_STATE_SCHEMA
                )

    # The salt comes from the row's place in its partition, so copies of one vector get many.
    salted = kept.select(F.col(vector).alias("vector"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"))
    return stage(dealt_by_owner(map_batches(salted, run, _STATE)), "codes-0")


def _updated(state: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry the floor of the mean of its members; partial sums come from where the members reside."""
    positions, entries, width = books.shape
    schema = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((positions * entries, width), np.int64), np.zeros(positions * entries, np.int64)
        for batch in batches:
            owner = batch["position"].to_numpy() * entries + batch["entry"].to_numpy()
            np.add.at(sums, owner, _matrix(batch["part"], width))
            counts += np.bincount(owner, minlength=positions * entries)
        held = np.flatnonzero(counts)
        place = [(held // entries).astype(np.int32), (held % entries).astype(np.int32)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, place), pa.array(counts[held]), _rows(sums[held])], schema=schema)

    partial = map_batches(state, run, "position int, entry int, n bigint, sums array<bigint>")
    totals = partial.groupBy("position", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[k]) for k in range(width)]).alias("sums")
    )
    new = books.copy()
    for row in totals.collect():  # one row per entry
        new[row["position"], row["entry"]] = [total // row["n"] for total in row["sums"]]
    return new


def _reassigned(state: DataFrame, books: Codebooks, step: int) -> DataFrame:
    """The state with every part at its new owner: judged in place, and only what changes its entry is shuffled."""
    width = books.shape[2]
    schema = _STATE_SCHEMA.append(pa.field("moved", pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            position, before = batch["position"].to_numpy(), batch["entry"].to_numpy()
            parts, after = _matrix(batch["part"], width), before.copy()
            for one in np.unique(position):
                at = position == one
                after[at], _ = nearest(parts[at], books[one])
            columns = [batch["position"], pa.array(after), batch["salt"], batch["part"], pa.array(before != after)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    judged = stage(map_batches(state, run, f"{_STATE}, moved boolean"), f"codes-judged-{step}")
    columns = _STATE_SCHEMA.names
    movers = stage(dealt_by_owner(judged.filter("moved").select(columns)), f"codes-moved-{step}")
    return judged.filter("not moved").select(columns).union(movers)


def encode(kept: DataFrame, quantizer: Quantizer, vector: str = "embedding", code: str = "code", error: str = "error") -> DataFrame:
    """All rows and columns of ``kept`` with ``code`` (two hex digits per part) and ``error`` (long), replacing such columns.

    Every vector is usable and as long as those trained on. Rows stay where they are.
    """
    books, scale, length = quantizer.books, quantizer.scale, quantizer.length
    positions, _, width = books.shape
    out = pa.struct([("code", pa.string()), ("error", pa.int64())])

    @F.arrow_udf("struct<code: string, error: bigint>")
    def coded(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], out)
        numbers = whole_numbers(vectors, length, scale)
        total, digits = np.zeros(len(vectors), np.int64), np.empty((len(vectors), positions), np.uint8)
        for position in range(positions):
            found, errors = nearest(np.ascontiguousarray(numbers[:, position * width : (position + 1) * width]), books[position])
            digits[:, position] = found
            total += errors
        codes = [row.tobytes().hex() for row in digits]
        return pa.StructArray.from_arrays([pa.array(codes, pa.string()), pa.array(total)], fields=list(out))

    ship_package(kept.sparkSession)
    new = F.col("_vc_new")
    return kept.withColumn("_vc_new", coded(F.col(vector))).withColumns({code: new["code"], error: new["error"]}).drop("_vc_new")


def usable_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", positions: int = POSITIONS) -> DataFrame:
    """The rows of ``df`` that can be coded: usable vectors as long as that of the smallest id among them.

    A table has vectors of one length; should others be among them, they are left out like null ones.
    """
    good = df.filter(usable(F.col(vector)))
    lead = first_vectors(good, vec_id, vector, 1).select(F.size(vector).alias("n")).collect()
    return good.filter(F.size(vector) == lead[0]["n"]) if lead else good


def sums_by_label(df: DataFrame, label: str, value: str, total: str) -> DataFrame:
    """``df`` with ``total``, the sum of ``value`` over the rows of equal labels; null is a label of its own.

    Labels are summed before the shuffle, and the sums come back by a salted join,
    so a label of a third of all rows is many keys if the sums are too many to send to every task.
    """
    keys = [F.col(label).isNull().alias("_vc_null"), F.coalesce(F.col(label).cast("string"), F.lit("")).alias("_vc_label")]
    totals = stage(df.groupBy(*keys).agg(F.sum(value).alias(total)), "codes-labels")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_vc_salt")
    salted = df.select("*", *keys, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("_vc_salt"))
    on = ["_vc_null", "_vc_label", "_vc_salt"]
    return salted.drop(total).join(totals.select("*", salts), on).drop(*on)


def compress(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positions: int = POSITIONS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Quantizer]:
    """All usable rows and all columns of ``df`` with ``code``, ``error`` and ``label_error``, and the quantizer.

    Rows with a null vector, or null or non-finite components, are left out. A
    null id is behind all others when the codebooks start; ids may repeat. Null
    labels are one label. Empty tables give no rows.
    """
    kept = usable_vectors(df, vec_id, vector, positions)
    quantizer = train(kept, vec_id, vector, positions, entries, rounds)
    coded = encode(kept, quantizer, vector)
    return sums_by_label(coded, label, "error", "label_error"), quantizer
