"""Compare registered queries with their oracle SQL on one data folder."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from jobweave.verify.registry import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]", "float": "FLOAT",
}


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> tuple[str, float]:
    """``ok`` or what differs, and the seconds the Spark side took."""
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    took = time.time() - start
    if name not in ORACLE:
        return ("ok, rows only" if rows else "no rows"), took
    rel = con.sql(ORACLE[name])
    columns = sorted(df.columns)
    if columns != sorted(rel.columns):
        return f"columns {sorted(set(columns) ^ set(rel.columns))}", took
    kinds = dict(zip(rel.columns, [str(t) for t in rel.types]))
    odd = [
        f"{f.name} {f.dataType.simpleString()}/{kinds[f.name]}"
        for f in df.schema.fields
        if TYPES.get(f.dataType.simpleString()) != kinds[f.name]
    ]
    order = [rel.columns.index(c) for c in columns]
    theirs = Counter(tuple(_plain(r[i]) for i in order) for r in rel.fetchall())
    ours = Counter(tuple(_plain(r[c]) for c in columns) for r in rows)
    if ours != theirs:
        extra, lost = ours - theirs, theirs - ours
        sample = [dict(zip(columns, next(iter(x)))) if x else None for x in (extra, lost)]
        return f"rows {sum(ours.values())}/{sum(theirs.values())} differ {sum(extra.values())} {sample}", took
    if odd:
        return f"types {odd}", took
    return ("ok" if rows else "ok but empty"), took


def main(sf_dir: str, only: list[str]) -> int:
    from jobweave.session import build_session

    spark = build_session(
        "check", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    bad = 0
    for name in QUERIES:
        if only and not any(name.startswith(o) for o in only):
            continue
        try:
            result, took = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            result, took = f"error {type(error).__name__}: {str(error)[:1500]}", 0.0
        bad += not result.startswith("ok") or "empty" in result
        print(f"{name:36s} {took:6.2f}s {result[:3000]}", flush=True)
    print("not ok:", bad)
    return bad


if __name__ == "__main__":
    import jobweave.verify.all_queries  # noqa: F401

    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
