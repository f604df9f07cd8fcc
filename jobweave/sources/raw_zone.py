"""The raw zone: JSON lines in ``endpoint=/ingestion_date=/query=`` folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobweave.functions import as_col

PARTITIONS = ["endpoint", "ingestion_date", "query"]
_PARTITION_FIELDS = [
    T.StructField("endpoint", T.StringType()),
    T.StructField("ingestion_date", T.DateType()),
    T.StructField("query", T.StringType()),
]
CORRUPT = "_corrupt_record"


def scan_jsonl(
    spark: SparkSession, root: str, schema: T.StructType, glob: str = "data.json"
) -> DataFrame:
    """All matching files at any depth, with path and modification time.

    Only files named by the glob are read, so audit records beside the data are
    skipped. A filter on ``_file_modified_at`` against a literal skips files.
    """
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return with_file_meta(reader.json(root))


def with_file_meta(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file_path"),
        F.col("_metadata.file_modification_time").alias("_file_modified_at"),
    )


def path_part(path: Column | str, key: str, default: str | None = None) -> Column:
    """Value of ``key=value`` in a path, decoded; the default when absent."""
    raw = F.regexp_extract(as_col(path), f"(^|/){key}=([^/]+)", 2)
    return F.coalesce(F.url_decode(F.nullif(raw, F.lit(""))), F.lit(default))


def path_date(path: Column | str, key: str = "ingestion_date") -> Column:
    return path_part(path, key).try_cast("date")


def read_partitioned(
    spark: SparkSession, root: str, schema: T.StructType, endpoint: str | None = None, day: str | None = None
) -> DataFrame:
    """The tree with its partition columns; the filters prune folders."""
    full = T.StructType([*schema.fields, *_PARTITION_FIELDS])
    df = spark.read.schema(full).option("basePath", root).json(root)
    if endpoint is not None:
        df = df.filter(F.col("endpoint") == endpoint)
    if day is not None:
        df = df.filter(F.col("ingestion_date") == F.lit(day).cast("date"))
    return df


def list_partitions(
    spark: SparkSession, root: str, endpoint: str, day: str | None = None, glob: str = "data.json"
) -> DataFrame:
    """Folders of one endpoint that hold data, in path order.

    The binary-file source yields one row per file and opens none of them as
    long as the content is not asked for; the filters prune folders.
    """
    files = T.StructType(
        [
            T.StructField("path", T.StringType()),
            T.StructField("modificationTime", T.TimestampType()),
            T.StructField("length", T.LongType()),
            T.StructField("content", T.BinaryType()),
            *_PARTITION_FIELDS,
        ]
    )
    reader = spark.read.format("binaryFile").schema(files).option("pathGlobFilter", glob)
    found = reader.option("basePath", root).load(root).filter(F.col("endpoint") == endpoint)
    if day is not None:
        found = found.filter(F.col("ingestion_date") == F.lit(day).cast("date"))
    return found.select(*PARTITIONS).distinct().orderBy("ingestion_date", "query")


def scan_jsonl_tolerant(
    spark: SparkSession, root: str, schema: T.StructType, glob: str = "data.json"
) -> tuple[DataFrame, DataFrame]:
    """Rows that parse, and the lines that do not.

    Blank lines give no row. A line that is valid JSON but has a value of an
    unexpected type is kept with that value null; only text that is no JSON
    object counts as bad.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .text(root)
        .select(
            "value",
            F.col("_metadata.file_path").alias("_file_path"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("_line_id"),
        )
        .filter(F.trim("value") != "")
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.withColumn("_row", F.from_json("value", full, options))
    bad = F.col(f"_row.{CORRUPT}").isNotNull() & F.json_object_keys("value").isNull()
    marked = parsed.withColumn("_bad", bad)
    good = marked.filter(~F.col("_bad")).select(
        *[F.col(f"_row.{f.name}") for f in schema.fields], "_file_path", "_line_id"
    )
    return good, marked.filter("_bad").select("_file_path", F.col("value").alias("line"))


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def safe_partition_value(value: Column | str) -> Column:
    """Blank to underscore, slash to dash, at most 80 characters."""
    return F.substring(F.translate(as_col(value), " /", "_-"), 1, 80)


def folder_label(value: Column | str) -> Column:
    """Folder name of a query label: different labels never share a folder.

    A label that is safe as it is names its folder. Any other keeps the start
    of its readable form and gets a hash of the whole label.
    """
    label = as_col(value)
    hashed = F.concat(
        F.substring(safe_partition_value(label), 1, 63), F.lit("-"), F.substring(F.md5(label), 1, 16)
    )
    return F.when(safe_partition_value(label) == label, label).otherwise(hashed)


def query_label(
    query: Column | str, job_title: Column | str, location: Column | str, endpoint: Column | str
) -> Column:
    """The query, else title and location, else the endpoint."""
    blank = F.lit("")
    pair = F.concat(
        F.coalesce(as_col(job_title), blank), F.lit("_"), F.coalesce(as_col(location), blank)
    )
    stripped = F.nullif(F.regexp_replace(pair, "^_+|_+$", ""), blank)
    return F.coalesce(F.nullif(as_col(query), blank), stripped, as_col(endpoint))


def write_raw_zone(df: DataFrame, root: str) -> None:
    """Replace the partitions present in the frame, leave all others.

    The rebalance groups rows by folder, so no task keeps a file open for every
    folder, and splits a folder larger than the advisory size over more tasks.
    """
    safe = df.withColumn("query", folder_label("query"))
    (
        safe.hint("rebalance", *[F.col(c) for c in PARTITIONS])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .json(root)
    )


def append_enrichment(df: DataFrame, root: str) -> None:
    """Add records and keep those already there."""
    df.write.mode("append").partitionBy(*PARTITIONS).json(root)


def explode_envelope(
    df: DataFrame, body: str, record: T.StructType, key: str | None = "data", subkey: str | None = None
) -> DataFrame:
    """One row per record of an API reply; a missing list gives no rows.

    Without a results key the whole reply is the record.
    """
    if key is None:
        return df.select("*", F.from_json(body, record).alias("record")).drop(body)
    kind: T.DataType = T.ArrayType(record)
    for level in [subkey, key]:
        if level:
            kind = T.StructType([T.StructField(level, kind)])
    path = ".".join(["_reply", *[k for k in (key, subkey) if k]])
    parsed = df.withColumn("_reply", F.from_json(body, kind))
    return parsed.select(*[c for c in df.columns if c != body], F.explode(path).alias("record"))
