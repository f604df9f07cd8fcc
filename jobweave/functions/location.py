"""Locations: parsing, keys, markets and work arrangement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobweave.functions import as_col
from jobweave.functions.keys import UNKNOWN_KEY

# Phrases that mark hybrid work.
HYBRID_PHRASES = ["hybrid", "flexible working"]

# Name prefix and codes per market.
LOCATION_MARKETS: list[tuple[str, str, list[str]]] = [
    ("Kenya", "KENYA", ["KE"]),
    ("UK", "UNITED KINGDOM", ["UK", "GB"]),
    ("US", "UNITED STATES", ["US", "USA"]),
]

# Countries per wider region.
GEO_REGIONS: dict[str, list[str]] = {
    "Africa": [
        "Kenya", "Uganda", "Tanzania", "Rwanda", "Ethiopia",
        "Nigeria", "Ghana", "South Africa", "Egypt", "Morocco",
    ],
    "Europe": [
        "United Kingdom", "UK", "GB", "Germany", "France", "Netherlands", "Sweden",
        "Spain", "Italy", "Poland", "Ireland", "Denmark", "Switzerland", "Belgium",
    ],
    "North America": ["United States", "US", "USA", "Canada"],
    "Asia Pacific": [
        "India", "Singapore", "Australia", "New Zealand", "Japan", "Philippines", "Indonesia",
    ],
}

# The benchmark markets.
BENCHMARK_COUNTRIES = ["Kenya", "KE", "United Kingdom", "UK", "GB", "United States", "US", "USA"]

# Technology hubs per market.
TECH_HUBS: dict[str, list[str]] = {
    "Kenya Tech Hub": ["nairobi", "mombasa", "kisumu"],
    "UK Tech Hub": ["london", "manchester", "edinburgh", "bristol", "cambridge", "birmingham", "leeds"],
    "US Tech Hub": [
        "new york", "san francisco", "seattle", "austin", "boston",
        "chicago", "los angeles", "denver", "atlanta", "washington",
    ],
}


def tidy(value: Column | str) -> Column:
    return F.initcap(F.trim(as_col(value)))


def work_arrangement(is_remote: Column | str, text: Column | str) -> Column:
    low = F.lower(as_col(text))
    hybrid = F.lit(False)
    for phrase in HYBRID_PHRASES:
        hybrid = hybrid | low.contains(phrase)
    return F.when(as_col(is_remote), F.lit("remote")).when(hybrid, F.lit("hybrid")).otherwise(F.lit("onsite"))


def location_quality(is_remote: Column | str, city: Column | str, country: Column | str) -> Column:
    city, country = as_col(city), as_col(country)
    return (
        F.when(as_col(is_remote), F.lit("remote"))
        .when(city.isNotNull() & country.isNotNull(), F.lit("located"))
        .when(city.isNull() & country.isNull(), F.lit("missing"))
        .otherwise(F.lit("partial"))
    )


def location_key(city: Column | str, country: Column | str) -> Column:
    """md5 of city and country; null parts count as empty, both null is unknown."""
    city, country = as_col(city), as_col(country)
    parts = [F.coalesce(F.lower(F.trim(x)), F.lit("")) for x in (city, country)]
    return F.when(city.isNull() & country.isNull(), F.lit(UNKNOWN_KEY)).otherwise(
        F.md5(F.concat(parts[0], F.lit("||"), parts[1]))
    )


def split_location(location: Column | str) -> Column:
    return F.split(as_col(location), ",")


def parsed_city(parts: Column | str) -> Column:
    """First part; a single part is a country, so the city is then null."""
    parts = as_col(parts)
    return F.when(F.size(parts) >= 2, tidy(F.get(parts, F.lit(0))))


def parsed_region(parts: Column | str) -> Column:
    parts = as_col(parts)
    return F.when(F.size(parts) >= 3, tidy(F.get(parts, F.lit(1))))


def parsed_country(parts: Column | str) -> Column:
    return tidy(F.try_element_at(as_col(parts), F.lit(-1)))


def parsed_location_key(parts: Column | str) -> Column:
    """Same hash space as :func:`location_key`."""
    parts = as_col(parts)
    first = F.when(F.size(parts) >= 2, F.get(parts, F.lit(0)))
    return location_key(first, F.try_element_at(parts, F.lit(-1)))


def location_resolution(parts: Column | str) -> Column:
    parts = as_col(parts)
    return (
        F.when(parts.isNull(), F.lit("missing"))
        .when(F.size(parts) >= 2, F.lit("city"))
        .otherwise(F.lit("country"))
    )


def location_market(country: Column | str) -> Column:
    value = as_col(country)
    upper = F.trim(F.upper(value))
    out = F
    for market, prefix, codes in LOCATION_MARKETS:
        out = out.when(upper.startswith(prefix) | upper.isin(codes), F.lit(market))
    return out.when(value.isNull(), F.lit("Unknown")).otherwise(F.lit("Other"))


def geo_region(country: Column | str) -> Column:
    value = as_col(country)
    out = F
    for region, names in GEO_REGIONS.items():
        out = out.when(F.upper(value).isin([n.upper() for n in names]), F.lit(region))
    return out.when(value.isNull(), F.lit("Unknown")).otherwise(F.lit("Other"))


def is_benchmark_market(country: Column | str) -> Column:
    hit = F.upper(as_col(country)).isin([n.upper() for n in BENCHMARK_COUNTRIES])
    return F.coalesce(hit, F.lit(False))


def tech_hub_label(city: Column | str) -> Column:
    low = F.lower(as_col(city))
    out = F
    for label, cities in TECH_HUBS.items():
        out = out.when(low.isin(cities), F.lit(label))
    return out.otherwise(F.lit(None).cast("string"))


def location_completeness(city: Column | str, country: Column | str) -> Column:
    city, country = as_col(city), as_col(country)
    return (
        F.when(city.isNotNull() & country.isNotNull(), F.lit("full"))
        .when(country.isNotNull(), F.lit("country-only"))
        .when(city.isNotNull(), F.lit("city-only"))
        .otherwise(F.lit("unknown"))
    )
