"""What several operators share: words, row keys, batch mapping and components."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobweave.session import scratch_path, ship_package
from jobweave.sources import tables
from jobweave.sources.tables import unstage  # noqa: F401

# A null id sorts behind all ids; as a number it can be a join key.
LAST_ID = 2**63 - 1


def stage(df: DataFrame, label: str) -> DataFrame:
    """A written table in the shared folder, which cuts the lineage; the shuffles behind it are freed at once."""
    path = scratch_path(df.sparkSession, label)
    tables.write_files(df, path, codec="snappy")
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows a batch between the JVM and Python, for operators that hold several forms of a batch's texts at once.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's batches to ``BATCH_ROWS`` rows; a smaller setting stays. Only speed and memory depend on it.

    The setting is read when a plan is made, after the operator has returned, so it stays set.
    """
    rows = int(spark.conf.get(_BATCH_SETTING))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def id_key(column: str) -> Column:
    """The id as a key that is never null."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def ascii_words(column: Column) -> Column:
    r"""Words ``[^\x20\x09-\x0D]+`` as an array; null text has none."""
    trimmed = F.btrim(F.coalesce(column, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    # Between two words there is no empty part, so only a text without words needs a look.
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def words_of(text: str | None) -> list[bytes]:
    r"""The same words in a task: ``bytes.split`` cuts at exactly \x20 and \x09-\x0D."""
    return text.encode().split() if text else []


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` with this package at hand in the Python workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def flush_every(rows: int, schema: pa.Schema) -> Callable[[Iterator[tuple]], Iterator[pa.RecordBatch]]:
    """Turn tuples into record batches of at most ``rows`` rows."""

    def batches(tuples: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in tuples:
            held.append(row)
            if len(held) >= rows:
                yield _batch(held, schema)
                held = []
        if held:
            yield _batch(held, schema)

    return batches


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def ones(values: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set in an array of unsigned 64-bit values, highest bit first."""
    total = np.zeros(64, dtype=np.int64)
    for start in range(0, len(values), 1 << 16):
        block = values[start : start + (1 << 16)].astype(">u8").view(np.uint8)
        bits = np.unpackbits(block).reshape(-1, 64)
        # Sums of at most 255 rows fit a byte, which keeps the addition narrow.
        for low in range(0, len(bits), 255 * 64):
            part = bits[low : low + 255 * 64]
            whole = len(part) // 255 * 255
            if whole:
                total += part[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
            if whole < len(part):
                total += part[whole:].sum(axis=0, dtype=np.uint8)
    return total


def connected_components(edges: DataFrame, a: str, b: str, label: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges; the component is its smallest node.

    Each round sends every node the smallest label among its neighbours and then
    follows the label one step further, so the distance covered doubles. State
    is two narrow tables, written to the shared folder after each round; the
    driver sees one count a round. Hot nodes are pre-aggregated by ``min``.
    """
    links = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x <> y")
    both = stage(links.union(links.select("y", "x")).distinct(), f"{label}-links")
    state = both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("node")).alias("component"))
    state = stage(state, f"{label}-0")
    for step in range(1, max_rounds + 1):
        near = (
            both.join(state.select(F.col("node").alias("y"), "component"), "y")
            .groupBy(F.col("x").alias("node"))
            .agg(F.min("component").alias("nearest"))
        )
        lower = state.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "nearest").alias("next")
        )
        # Follow the new label: the label of the label is never larger.
        jump = state.select(F.col("node").alias("next"), F.col("component").alias("further"))
        moved = lower.join(jump, "next", "left").select(
            "node", F.least("next", F.coalesce("further", "next")).alias("component"), "before"
        )
        moved = stage(moved, f"{label}-{step}")
        unstage(state)
        state = moved.select("node", "component")
        if not moved.filter("component <> before").limit(1).count():
            unstage(both)
            return state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
