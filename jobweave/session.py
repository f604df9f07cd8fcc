"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Broadcasts are left to Spark's own size checks (static threshold and AQE), so
# nothing that grows with the data is ever broadcast by hand.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Static, so it goes to the builder: recording the call site of every Column call costs more than building it.
STATIC_DEFAULTS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

_local_scratch: dict[str, tempfile.TemporaryDirectory] = {}
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def build_session(
    app_name: str = "jobweave",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with our defaults; cluster settings already present win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in STATIC_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    given = session.sparkContext.getConf()
    for key, value in SESSION_DEFAULTS.items():
        if not given.contains(key):
            session.conf.set(key, value)
    return session


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for stage tables.

    ``spark.checkpoint.dir`` names it. A machine-local folder is used only when
    that is unset and the master is local, since one machine then holds it all.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc.applicationId not in _local_scratch:
        _local_scratch[sc.applicationId] = tempfile.TemporaryDirectory(
            prefix="jobweave-", ignore_cleanup_errors=True
        )
    return _local_scratch[sc.applicationId].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root; nothing is created yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package, once per application.

    Only the calls to an enrichment model run in Python workers; they import
    the package by name. ``spark-submit --py-files`` does the same.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.TemporaryDirectory(prefix="jobweave-", ignore_cleanup_errors=True)
    archive = shutil.make_archive(
        os.path.join(folder.name, "jobweave"), "zip", os.path.dirname(package), os.path.basename(package)
    )
    sc.addPyFile(archive)
    _shipped[sc.applicationId] = folder
