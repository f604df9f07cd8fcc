"""Column builders. Every one stays inside Spark's own expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def fold_replace(text: Column, passes: list[tuple[str, str]]) -> Column:
    """Apply (pattern, replacement) passes left to right."""
    return reduce(lambda acc, p: F.regexp_replace(acc, p[0], p[1]), passes, text)
