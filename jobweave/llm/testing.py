"""Compare a frame with a DuckDB relation, for tests."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame

from jobweave.verify.check import TYPES


def _plain(value: object) -> object:
    return float(f"{value:.9g}") if isinstance(value, float) else value


def compare_rows(ours: DataFrame, theirs) -> str:
    """Empty if columns, types and rows agree, otherwise what differs."""
    columns = sorted(ours.columns)
    if columns != sorted(theirs.columns):
        return f"columns {columns} {sorted(theirs.columns)}"
    kinds = dict(zip(theirs.columns, map(str, theirs.types)))
    odd = {f.name: kinds[f.name] for f in ours.schema if TYPES.get(f.dataType.simpleString()) != kinds[f.name]}
    if odd:
        return f"types {odd}"
    order = [theirs.columns.index(c) for c in columns]
    mine = Counter(tuple(_plain(r[c]) for c in columns) for r in ours.collect())
    want = Counter(tuple(_plain(r[i]) for i in order) for r in theirs.fetchall())
    if mine == want:
        return ""
    return f"{sum(mine.values())}/{sum(want.values())} {list((mine - want).items())[:2]} {list((want - mine).items())[:2]}"
