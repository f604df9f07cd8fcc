"""URL filters: host and path rules, then a blocked Bloom filter in front of an exact join.

Rules name a host with its subdomains and a path prefix; the longest that fits
decides. What no rule decides is looked up in a list of canonical URLs. The
list becomes a Bloom filter of blocks of 256 bits, four words of 64, and a URL
sets one bit in each word of one block. So a URL is tested by one row of the
filter, rows that fail the test are not listed and never move, and those that
pass are held against the list itself, which removes false positives.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import stage

BLOCK_WORDS, KEYS_A_BLOCK = 4, 16
# 2 MB of bits: the filter that every task gets is never larger, whatever the list. A longer list fills it more.
MAX_BLOCKS = 1 << 16
SALTS = 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Query parameters that don't change what a URL names.
TRACKING = r"^(utm_[^=]*|ref)(=|\z)"

Rule = tuple[str, str]  # verdict, "host/path"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one and for null."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    """The host in lower case (A-Z): after the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """The path: from the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """One spelling for URLs of one page; null where there is no host.

    Scheme, a leading ``www.``, the fragment, slashes at the end of the path and
    tracking parameters go; the other parameters are sorted.
    """
    host = host_of(url)
    site = F.when(host.startswith("www."), F.substring(host, 5, 1 << 30)).otherwise(host)
    query = F.regexp_extract(after_scheme(url), "^[^?#]*\\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.regexp_like(p, F.lit(TRACKING))))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(site, F.rtrim(path_of(url), F.lit("/")), tail))


def longest_rule(host: Column, path: Column, rules: Iterable[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, of equals the one with the longer host; null if none fits."""

    def fits(rule: str) -> Column:
        site, _, rest = rule.partition("/")
        return ((host == site) | host.endswith(f".{site}")) & path.startswith(f"/{rest}")

    ordered = sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/"), r[1]))
    if not ordered:
        return F.lit(None).cast("struct<rule: string, verdict: string>")
    chosen = [(fits(rule), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))) for verdict, rule in ordered]
    return reduce(lambda case, c: case.when(*c), chosen[1:], F.when(*chosen[0]))


def _bit(hashed: Column, word: int) -> Column:
    """The bit of a key in one word of its block: six bits of its hash."""
    place = F.shiftrightunsigned(hashed, 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _block(hashed: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(hashed, 6 * BLOCK_WORDS), F.lit(blocks)).cast("int")


def blocks_for(keys: int, most: int = MAX_BLOCKS) -> int:
    """A power of two with a block for ``KEYS_A_BLOCK`` keys, up to ``most``."""
    return min(most, 1 << max(0, -(-keys // KEYS_A_BLOCK) - 1).bit_length())


def bloom_filter(listed: DataFrame, url: str, blocks: int) -> DataFrame:
    """(block, w0 to w3): the blocks in which a listed URL sets bits, at most ``blocks`` rows."""
    hashed = listed.select(F.xxhash64(url).alias("h"))
    bits = hashed.select(_block(F.col("h"), blocks).alias("block"), *[_bit(F.col("h"), k).alias(f"b{k}") for k in range(BLOCK_WORDS)])
    return bits.groupBy("block").agg(*[F.bit_or(f"b{k}").alias(f"w{k}") for k in range(BLOCK_WORDS)])


def possibly_listed(df: DataFrame, url: str, bloom: DataFrame, blocks: int, flag: str) -> DataFrame:
    """``df`` with a boolean ``flag``: false only if the filter proves that the URL isn't listed."""
    named = bloom.select(F.col("block").alias("_uf_block"), *[F.col(f"w{k}").alias(f"_uf_w{k}") for k in range(BLOCK_WORDS)])
    hashed = df.withColumn("_uf_hash", F.when(F.col(url).isNotNull(), F.xxhash64(url)))
    hashed = hashed.withColumn("_uf_block", _block(F.col("_uf_hash"), blocks))
    # At most ``blocks`` rows, a parameter: safe to broadcast at any size of the list.
    met = hashed.join(F.broadcast(named), "_uf_block", "left")
    held = [F.col(f"_uf_w{k}").bitwiseAND(_bit(F.col("_uf_hash"), k)) != 0 for k in range(BLOCK_WORDS)]
    return met.withColumn(flag, F.coalesce(reduce(Column.__and__, held), F.lit(False))).drop(
        "_uf_hash", "_uf_block", *[f"_uf_w{k}" for k in range(BLOCK_WORDS)]
    )


def judge_urls(
    df: DataFrame, listed: DataFrame, rules: Iterable[Rule] = (), url: str = "url", listed_url: str = "url", max_blocks: int = MAX_BLOCKS
) -> DataFrame:
    """All rows and columns of ``df`` with ``host``, ``path``, ``rule`` and ``verdict``, replacing columns of these names.

    ``verdict`` is that of the longest rule that fits. Without one it is block if
    the URL, in canonical form, is in ``listed`` and allow otherwise. ``listed``
    holds URLs in any spelling; nulls and repeats in it do no harm.

    A null URL and one without ``://`` have an empty host and path, no rule and
    are allowed, as they have no canonical form. A rule's path starts with a
    slash, so a URL without a path fits none. Empty tables stay empty, an empty
    list allows all. Rows stay as many as they are; equal ones are judged alike.

    A URL that a third of all rows have is one row in the exact join, and only the
    join that brings the answer back is dealt by a salt.
    """
    names = stage(listed.select(canonical_url(F.col(listed_url)).alias("_uf_url")).filter("_uf_url is not null").distinct(), "url-list")
    blocks = blocks_for(names.count(), max_blocks)
    bloom = stage(bloom_filter(names, "_uf_url", blocks), "url-bloom")

    def probed(source: DataFrame) -> DataFrame:
        ruled = source.withColumns({"_uf_host": host_of(F.col("_uf_in")), "_uf_path": path_of(F.col("_uf_in"))})
        ruled = ruled.withColumn("_uf_rule", longest_rule(F.col("_uf_host"), F.col("_uf_path"), rules))
        # Only what no rule decides is looked up.
        open_url = F.when(F.col("_uf_rule").isNull(), canonical_url(F.col("_uf_in")))
        return possibly_listed(ruled.withColumn("_uf_url", open_url), "_uf_url", bloom, blocks, "_uf_maybe")

    asked = probed(df.select(F.col(url).alias("_uf_in"))).filter("_uf_maybe").select("_uf_url").distinct()
    hits = stage(asked.join(names, "_uf_url", "left_semi"), "url-hits")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_uf_salt")
    salted = hits.select("_uf_url", salts, F.lit(True).alias("_uf_hit"))
    # Rows that aren't asked for have no key, and salts of their own, so that a shuffle would spread them.
    row_salt = F.xxhash64(*[c for c, kind in df.dtypes if not kind.startswith("map")])
    rows = probed(df.withColumn("_uf_in", F.col(url))).withColumns({
        "_uf_url": F.when(F.col("_uf_maybe"), F.col("_uf_url")),
        "_uf_salt": F.when(F.col("_uf_maybe"), F.pmod(row_salt, F.lit(SALTS))).otherwise(row_salt),
    })
    judged = rows.join(salted, ["_uf_url", "_uf_salt"], "left")
    method = F.when(F.col("_uf_hit"), "block").otherwise("allow")
    return judged.withColumns({
        "host": F.col("_uf_host"),
        "path": F.col("_uf_path"),
        "rule": F.col("_uf_rule.rule"),
        "verdict": F.coalesce(F.col("_uf_rule.verdict"), method),
    }).drop(*[f"_uf_{c}" for c in ("in", "host", "path", "rule", "url", "maybe", "salt", "hit")])
