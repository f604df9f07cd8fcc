"""Incremental models as streams (L1-L3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from jobweave.operators.dedup import dedup_keep_null_ids, latest_per_key
from jobweave.operators.incremental import read_or_empty, upsert_newest, upsert_partitions
from jobweave.sources.change_table import ChangeTable
from jobweave.sources.raw_zone import with_file_meta

BUCKET = "bucket"


def raw_stream(
    spark: SparkSession, root: str, schema: T.StructType, glob: str = "data.json", files_per_batch: int = 1000
) -> DataFrame:
    """New raw files as a stream; the checkpoint replaces the watermark query."""
    reader = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    return with_file_meta(reader.json(root))


def ingest(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything not yet seen to a parquet table, then stop."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def dedup(stream: DataFrame, record_id: str, event_time: str, delay: str) -> DataFrame:
    """Keep the first record per id seen within the delay.

    A stream cannot wait for the latest version, so unlike the batch model the
    first one wins; state older than the delay is dropped, and records later
    than the delay with it. Use ``dedup_stored`` where none may be lost.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([record_id])


def dedup_stored(
    stream: DataFrame, path: str, record_id: str, first: list[str], checkpoint: str
) -> StreamingQuery:
    """Keep the first record per id however late it comes: batches are held against the stored ids.

    State is the table itself, so nothing is dropped for being late and nothing
    grows in memory. Each micro-batch writes a folder of its own, which a
    replayed batch replaces. ``first`` orders the records of one batch; records
    without an id are all kept.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        new = dedup_keep_null_ids(batch, record_id, [F.col(c).asc() for c in first])
        schema = T.StructType([*batch.schema.fields, T.StructField("_batch", T.LongType())])
        stored = read_or_empty(batch.sparkSession, path, schema).filter(F.col("_batch") != batch_id)
        unseen = new.join(stored.select(record_id), record_id, "left_anti").select(*batch.columns)
        unseen.write.mode("overwrite").parquet(f"{path}/_batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_changes(
    stream: DataFrame, table: ChangeTable, checkpoint: str, compact_after: int = 50
) -> StreamingQuery:
    """Keep one current row per key in a table of change folders; its ``order`` says which row is newer.

    A micro-batch is reduced to one row per key and written as it is: nothing
    stored is read or rewritten, so a batch of one key costs one row. A batch
    counts from its commit on; one that is replayed after it is left out.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        latest = latest_per_key(batch, table.keys, *table.order)
        table.append(latest, batch=batch_id)
        if len(table.state()["changes"]) > compact_after:
            table.compact()

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(
    stream: DataFrame,
    path: str,
    keys: list[str],
    newest_first: list[str],
    checkpoint: str,
    buckets: int = 64,
) -> StreamingQuery:
    """Keep one current row per key in a table of key buckets.

    Each micro-batch is reduced to one row per key and rewrites only the
    buckets it touches. The newest row wins, so a replayed batch changes nothing.
    """
    bucketed = stream.withColumn(
        BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    )
    merge = upsert_newest(newest_first)

    def apply(batch: DataFrame, _batch_id: int) -> None:
        latest = latest_per_key(batch, keys, *newest_first)
        upsert_partitions(batch.sparkSession, path, latest, keys, BUCKET, merge)

    return (
        bucketed.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
