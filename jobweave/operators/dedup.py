"""One row per key: latest, first, best, longest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweave.sources.tables import stage

# Bits for each marked key, and the most 64-bit words of all marks (4 MB): beyond that more rows pass in vain. The driver puts
# the words into the tasks of every stage that tests them, so they are few; two bits a key let as few rows pass in half the words.
BITS_A_KEY, MOST_WORDS = 8, 1 << 19
# Words are put together by pages, so no task holds a row for each word.
WORDS_A_PAGE = 1 << 12


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under a total order.

    ``row_number() = 1`` lets Spark put a group limit in front of the shuffle,
    so a key holding a third of all rows sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], *newest_first: str) -> DataFrame:
    return best_per_key(df, keys, [F.col(c).desc_nulls_last() for c in newest_first])


def best_with_span(
    df: DataFrame, keys: list[str], order: list[Column], aggregates: dict[str, Column]
) -> DataFrame:
    """Best row per key plus aggregates over all rows of that key.

    The aggregates come from their own ``groupBy`` rather than from whole
    partition windows: both sides then shrink before the shuffle, and both are
    hashed on the same keys, so the join adds no exchange. Keys are not null.
    """
    spans = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggregates.items()])
    return best_per_key(df, keys, order).join(spans, keys)


def _spot(hashed: Column, words: int) -> tuple[Column, Column]:
    """Word of a hash, and the two bits that it has there."""
    first = hashed.bitwiseAND(63).cast("int")
    second = (first + 1 + F.pmod(F.shiftright(hashed, 6), F.lit(63)).cast("int")).bitwiseAND(63)
    one, other = (F.call_function("shiftleft", F.lit(1).cast("long"), bit) for bit in (first, second))
    return F.pmod(F.shiftright(hashed, 12), F.lit(words)).cast("int"), one.bitwiseOR(other)


def marks(df: DataFrame) -> Callable[..., Column] | None:
    """A test that holds for every row of ``df``, and for few others; None without rows.

    The keys' hashes set bits of one array, which every task gets as the value
    of a scalar subquery. So a scan of wide rows can leave out most rows that
    aren't wanted before anything is shuffled; an exact choice has to follow.
    """
    hashes = stage(df.select(F.xxhash64(*df.columns).alias("_h")), "marks")
    count = hashes.count()
    if not count:
        return None
    words = min(MOST_WORDS, 1 << (count * BITS_A_KEY // 64).bit_length())
    word, mask = _spot(F.col("_h"), words)
    masks = hashes.select(word.alias("_word"), mask.alias("_mask"))
    # Every word is there, so a word's number is its place in the array.
    every = masks.union(df.sparkSession.range(words).selectExpr("cast(id as int)", "0L")).groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    sorted_by = lambda at, value: F.sort_array(F.collect_list(F.struct(at, value)))[value]
    pages = every.groupBy(F.floor(F.col("_word") / WORDS_A_PAGE).alias("_page")).agg(sorted_by("_word", "_mask").alias("_masks"))
    array = pages.agg(F.flatten(sorted_by("_page", "_masks"))).scalar()

    def marked(*columns: Column | str) -> Column:
        place, asked = _spot(F.xxhash64(*columns), words)
        # Both bits are there if two are counted. The array is named once: each mention would be a copy in the task.
        both = F.getbit(F.bit_count(F.get(array, place).bitwiseAND(asked)), F.lit(1))
        # Never null: for a test that may be null Spark infers a second test of the same cost.
        return F.coalesce(both, F.lit(0)) == 1

    return marked


def best_wide_per_key(df: DataFrame, keys: list[str], order: list[Column], narrow: DataFrame | None = None) -> DataFrame:
    """``best_per_key`` for wide rows of which most are alone with their key.

    Rows surely alone with their key are handed on by the scan; all others,
    also those that only look repeated, reach the choice. The frame is read
    twice more, or once more where ``narrow`` has the keys of all its rows. Where
    most keys repeat, as much is shuffled as by ``best_per_key``.
    """
    counted = df if narrow is None else narrow
    repeated = stage(counted.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(*keys), "repeated")
    first, every = marks(repeated.select(keys[0])), marks(repeated)
    if first is None or every is None:
        return df
    # The first key alone settles most rows, and later keys may cost more to make.
    contested = first(keys[0]) & every(*keys)
    return df.filter(~contested).unionByName(best_per_key(df.filter(contested), keys, order))


def newest_wide_per_key(df: DataFrame, keys: list[str], newest: str, order: list[Column]) -> DataFrame:
    """``best_per_key`` for wide rows of keys that repeat; ``order`` begins with ``newest``, greatest first and nulls last.

    The newest value of each key is found on narrow columns. The scan then leaves
    out most other rows, and the exact choice is made among the rest. The frame is
    read once more. Where few keys repeat, as much is shuffled as by ``best_per_key``.
    """
    last = marks(df.groupBy(*keys).agg(F.max(newest).alias(newest)))
    return best_per_key(df if last is None else df.filter(last(*keys, newest)), keys, order)


def dedup_keep_null_ids(df: DataFrame, record_id: str, order: list[Column]) -> DataFrame:
    """First record per id; every record without an id stays."""
    known = best_per_key(df.filter(F.col(record_id).isNotNull()), [record_id], order)
    return known.unionByName(df.filter(F.col(record_id).isNull()))


def longest_value(value: str) -> Column:
    """Aggregate: longest value of a group, the greater text on equal length."""
    text = F.col(value)
    return F.max_by(text, F.struct(F.length(F.coalesce(text, F.lit(""))), F.coalesce(text, F.lit(""))))


def first_seen(df: DataFrame, record_id: str, path: str = "_file_path", line: str = "_line_id") -> DataFrame:
    """First occurrence of each id in path order, then line order."""
    return best_per_key(df, [record_id], [F.col(path).asc(), F.col(line).asc()])
