"""Unions, unpivot and the date spine (H1-H4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_tagged(sources: dict[str, DataFrame], tag: str = "source") -> DataFrame:
    """Union of same-shaped frames, each row marked with where it came from."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in sources.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def with_unknown_member(dim: DataFrame, **values: object) -> DataFrame:
    """Add the unknown member; columns not named are null."""
    row = [
        F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields
    ]
    return dim.unionByName(dim.sparkSession.range(1).select(*row))


def unpivot_flags(
    df: DataFrame, labels: dict[str, tuple[str, str]], prefix: str = "skill_"
) -> DataFrame:
    """Long form of 0/1 flag columns: one row per flag that is 1.

    Flags become one array that is filtered before it is exploded, so the
    source is read once however many flags there are.
    """
    entries = [
        F.when(
            F.col(prefix + name) == 1,
            F.struct(F.lit(label).alias("skill_name"), F.lit(category).alias("skill_category")),
        )
        for name, (label, category) in labels.items()
    ]
    keep = [c for c in df.columns if c not in {prefix + n for n in labels}]
    exploded = df.select(*keep, F.explode(F.array_compact(F.array(*entries))).alias("_skill"))
    return exploded.select(*keep, "_skill.skill_name", "_skill.skill_category")


def date_spine(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Every day from start to the day before end, for each row of bounds."""
    days = F.sequence(F.col(start), F.date_sub(F.col(end), 1))
    return bounds.filter(F.col(start) < F.col(end)).select(F.explode(days).alias("date_day"))
