"""Near-duplicate company names.

Names within edit distance four are found without comparing whole blocks. A
name cut into five pieces keeps at least one piece unchanged through four edits,
so the pieces of the shorter name are looked up among the substrings of the
longer one at the few positions an alignment allows. The lookup is an equi-join
on (first letter, length, piece number, piece); the bounded edit distance is
computed only for rows that meet there. Pieces are cut from the name without its
first letter: dropping one letter on both sides never raises the distance, and
the letter itself is equal in the whole block, so a piece holding it would say
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest distance, largest length gap.
MAX_DISTANCE = 4
MAX_LENGTH_GAP = 6


def _cut(length: str, piece: str, pieces: int) -> tuple[Column, Column]:
    """1-based start and size of a piece of an even cut."""
    start = F.expr(f"cast({piece} * {length} div {pieces} + 1 as int)")
    size = F.expr(f"cast(({piece} + 1) * {length} div {pieces} - {piece} * {length} div {pieces} as int)")
    return start, size


def _index_pieces(names: DataFrame, tau: int) -> DataFrame:
    """The pieces of each name long enough to cut."""
    start, size = _cut("_n", "piece", tau + 1)
    numbered = names.filter(F.col("_n") > tau).select("*", F.explode(F.sequence(F.lit(0), F.lit(tau))).alias("piece"))
    return numbered.withColumn("text", F.substring("_rest", start, size))


def _probe_pieces(names: DataFrame, tau: int) -> DataFrame:
    """Substrings of each name that may equal a piece of a name ``_m`` long."""
    steps = F.sequence(F.lit(0), F.lit(tau))
    cases = (
        names.select("*", F.explode(steps).alias("_gap"))
        .withColumn("_m", F.col("_n") - F.col("_gap"))
        .filter(F.col("_m") > tau)
        .select("*", F.explode(steps).alias("piece"))
    )
    start, size = _cut("_m", "piece", tau + 1)
    cases = cases.withColumns({"_start": start, "_size": size})
    # Of all alignments only those remain that leave at most ``piece`` edits to
    # the left of the piece and at most ``tau - piece`` to its right.
    right = F.lit(tau) - F.col("piece")
    low = F.greatest(
        F.lit(1), F.col("_start") - F.col("piece"), F.col("_start") + F.col("_gap") - right
    )
    high = F.least(
        F.col("_n") - F.col("_size") + 1,
        F.col("_start") + F.col("piece"),
        F.col("_start") + F.col("_gap") + right,
    )
    cases = cases.withColumns({"_low": low, "_high": high}).filter(F.col("_low") <= F.col("_high"))
    spots = cases.select("*", F.explode(F.sequence("_low", "_high")).alias("_at"))
    return spots.withColumn("text", F.substring("_rest", F.col("_at"), F.col("_size"))).drop(
        "_gap", "_start", "_size", "_low", "_high", "_at"
    )


def _side(df: DataFrame, suffix: str, extra: list[str] | None = None) -> DataFrame:
    extra = extra or []
    keep = [c for c in df.columns if c not in extra]
    return df.select(*[F.col(c).alias(c + suffix) for c in keep], *extra)


def similar_pairs(names: DataFrame, key: str, name: str, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """All pairs (key_a < key_b) of names with the same first letter, lengths
    within six and edit distance within four, with the distance.

    ``names`` has one row per key. A length gap above the distance bound cannot
    occur, so the gap of six needs no test of its own.
    """
    tau = min(max_distance, MAX_LENGTH_GAP)
    base = names.select(F.col(key).alias("key"), F.col(name).alias("name")).filter(
        F.col("name").isNotNull() & (F.length("name") > 0)
    )
    base = base.withColumns(
        {
            "_first": F.lower(F.substring("name", 1, 1)),
            "_rest": F.expr("substring(name, 2)"),
            "_n": F.length("name") - 1,
        }
    )
    distance = F.levenshtein("name_a", "name_b", tau)

    index = _side(_index_pieces(base, tau), "_a", ["piece", "text"]).withColumnRenamed("_n_a", "_m")
    probe = _side(_probe_pieces(base, tau), "_b", ["_m", "piece", "text"])
    long_pairs = index.join(
        probe,
        (F.col("_first_a") == F.col("_first_b"))
        & (index["_m"] == probe["_m"])
        & (index["piece"] == probe["piece"])
        & (index["text"] == probe["text"])
        & (F.col("key_a") != F.col("key_b"))
        # equal lengths meet from both sides; one direction is enough
        & ((F.col("_n_b") > index["_m"]) | (F.col("key_a") < F.col("key_b"))),
    )

    # Names too short to cut: the shorter rest has at most four letters. Its
    # partners have at most four more, so the block is small by nature; it is
    # joined on the exact pair of lengths.
    short = _side(base.filter(F.col("_n") <= tau), "_a")
    gaps = F.explode(F.sequence(F.lit(0), F.lit(tau))).alias("_gap")
    partner = base.filter(F.col("_n") <= 2 * tau).select("*", gaps).filter(F.col("_n") >= F.col("_gap"))
    partner = _side(partner.withColumn("_m", F.col("_n") - F.col("_gap")), "_b", ["_m", "_gap"])
    short_pairs = short.join(
        partner,
        (F.col("_first_a") == F.col("_first_b"))
        & (F.col("_n_a") == F.col("_m"))
        & (F.col("key_a") != F.col("key_b"))
        & ((F.col("_gap") > 0) | (F.col("key_a") < F.col("key_b"))),
    )
    columns = ["key_a", "name_a", "key_b", "name_b"]
    met = long_pairs.select(*columns).unionByName(short_pairs.select(*columns))
    close = met.withColumn("edit_distance", distance).filter(F.col("edit_distance") >= 0)
    swap = F.col("key_a") > F.col("key_b")
    ordered = close.select(
        F.when(swap, F.col("key_b")).otherwise(F.col("key_a")).alias("key_a"),
        F.when(swap, F.col("key_a")).otherwise(F.col("key_b")).alias("key_b"),
        F.when(swap, F.col("name_b")).otherwise(F.col("name_a")).alias("name_a"),
        F.when(swap, F.col("name_a")).otherwise(F.col("name_b")).alias("name_b"),
        "edit_distance",
    )
    # the other columns follow from the two keys, so this is one row per pair
    return ordered.distinct()


def same_site(a: Column, b: Column) -> Column:
    return F.coalesce(F.lower(F.trim(a)) == F.lower(F.trim(b)), F.lit(False))


def classify_pairs(pairs: DataFrame, companies: DataFrame) -> DataFrame:
    """Confidence, canonical name and combined size of each pair.

    ``companies``: company_key, company_website, hq_market, total_postings.
    """
    def side(s: str) -> DataFrame:
        return companies.select(
            F.col("company_key").alias(f"key_{s}"),
            F.col("company_website").alias(f"website_{s}"),
            F.col("hq_market").alias(f"market_{s}"),
            F.col("total_postings").alias(f"postings_{s}"),
        )

    df = pairs.join(side("a"), "key_a").join(side("b"), "key_b")
    distance = F.col("edit_distance")
    longest = F.greatest(F.length("name_a"), F.length("name_b")).cast("double")
    same_market = F.col("market_a") == F.col("market_b")
    a_wins = (
        F.when(F.col("postings_a") > F.col("postings_b"), F.lit(True))
        .when(F.col("postings_b") > F.col("postings_a"), F.lit(False))
        .otherwise(F.length("name_a") > F.length("name_b"))
    )
    df = df.withColumns(
        {
            "similarity_pct": F.round((1 - distance / longest) * 100, 1),
            "same_website": same_site(F.col("website_a"), F.col("website_b")),
            "_a_wins": a_wins,
            "combined_postings": F.col("postings_a") + F.col("postings_b"),
        }
    )
    return df.select(
        "key_a",
        "key_b",
        "name_a",
        "name_b",
        "edit_distance",
        "similarity_pct",
        "same_website",
        F.when(F.col("same_website") | ((distance <= 2) & same_market), F.lit("high"))
        .when((distance <= 2) | ((distance <= MAX_DISTANCE) & same_market), F.lit("medium"))
        .otherwise(F.lit("low"))
        .alias("match_confidence"),
        F.when(F.col("_a_wins"), F.col("name_a")).otherwise(F.col("name_b")).alias("suggested_canonical"),
        F.when(F.col("_a_wins"), F.col("name_b")).otherwise(F.col("name_a")).alias("suggested_alias"),
        "postings_a",
        "postings_b",
        "combined_postings",
        "website_a",
        "website_b",
        "market_a",
        "market_b",
    )
