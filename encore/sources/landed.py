"""Canonical rows from landed API records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: fields of the landed records
ARTIST_API = (
    "id string, name string, genres array<string>, popularity double, followers struct<total: bigint>, "
    "external_urls map<string,string>"
)
VENUE_API = (
    "id string, name string, type string, postalCode string, address struct<line1: string>, city struct<name: string>, "
    "state struct<stateCode: string>, country struct<countryCode: string>"
)
EVENT_API = (
    "id string, name string, url string, info string, "
    "dates struct<start: struct<dateTime: string, localDate: string>>, "
    "sales struct<public: struct<endDateTime: string>>, "
    "priceRanges array<struct<type: string, min: double, max: double>>, "
    "_embedded struct<venues: array<struct<id: string>>, attractions: array<struct<id: string>>>"
)
# fixed values: default capacity, hour of an event without a time, venue type words
DEFAULT_CAPACITY = 10000
DEFAULT_HOUR = "T20:00:00"
TYPE_WORDS = (
    (("theater", "theatre"), "theater"),
    (("club",), "club"),
    (("outdoor", "amphitheater"), "amphitheater"),
    (("stadium",), "stadium"),
    (("hall",), "hall"),
)


def _prefixed(source: str, key: Column) -> Column:
    return F.concat(F.lit(f"{source}_"), key)


def canonical_artists(raw: DataFrame, source: str = "spotify") -> DataFrame:
    return raw.select(
        _prefixed(source, F.col("id")).alias("artist_id"),
        F.trim(F.coalesce("name", F.lit(""))).alias("name"),
        F.coalesce("genres", F.array().cast("array<string>")).alias("genre"),
        F.coalesce("popularity", F.lit(0.0)).cast("double").alias("popularity_score"),
        F.lit(None).cast("date").alias("formation_date"),
        F.array().cast("array<string>").alias("members"),
        F.col("id").alias("spotify_id"),
        F.lit(source).alias("source"),
        F.to_json(F.struct(F.coalesce("followers.total", F.lit(0)).alias("followers"), "external_urls")).alias("raw_data"),
    )


def landed_type(column: Column) -> Column:
    text = F.lower(F.coalesce(column, F.lit("")))
    expr = None
    for words, kind in TYPE_WORDS:
        hit = None
        for word in words:
            one = text.contains(word)
            hit = one if hit is None else hit | one
        expr = F.when(hit, kind) if expr is None else expr.when(hit, kind)
    return expr.otherwise("other")


def canonical_venues(raw: DataFrame, source: str = "ticketmaster") -> DataFrame:
    """Rows without a name, city or country are dropped."""
    out = raw.select(
        _prefixed(source, F.col("id")).alias("venue_id"),
        F.trim("name").alias("name"),
        F.col("city.name").alias("city"),
        F.col("state.stateCode").alias("state"),
        F.col("country.countryCode").alias("country"),
        F.lit(DEFAULT_CAPACITY).alias("capacity"),
        landed_type(F.col("type")).alias("venue_type"),
        F.col("address.line1").alias("address"),
        F.col("postalCode").alias("postal_code"),
    )
    return out.filter((F.col("name") != "") & (F.col("city") != "") & (F.col("country") != ""))


def canonical_events(raw: DataFrame, as_of: dt.datetime, source: str = "ticketmaster") -> DataFrame:
    """Rows without a name or a readable date are dropped.

    The start time counts, or the local date at 20:00 where a start time is given but unreadable. The
    first venue and attraction count; price ranges become their middle; ended sales mean completed.
    """
    start = F.col("dates.start")
    given = F.nullif(start["dateTime"], F.lit(""))
    when = F.when(given.isNotNull(), F.coalesce(
        F.try_to_timestamp(given), F.try_to_timestamp(F.concat(start["localDate"], F.lit(DEFAULT_HOUR)))
    ))
    ended = F.try_to_timestamp(F.col("sales.public.endDateTime")) < F.lit(as_of.replace(tzinfo=dt.timezone.utc))
    prices = F.transform("priceRanges", lambda r: F.struct(
        F.lower(F.coalesce(r["type"], F.lit("general"))).alias("k"),
        ((F.coalesce(r["min"], F.lit(0.0)) + F.coalesce(r["max"], r["min"], F.lit(0.0))) / 2).alias("v"),
    ))
    # of two ranges of one type the last counts
    last = F.filter(prices, lambda p, i: F.size(F.filter(F.slice(prices, i + 2, F.size(prices)), lambda q: q["k"] == p["k"])) == 0)
    no_prices = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    out = raw.select(
        _prefixed(source, F.col("id")).alias("concert_id"),
        _prefixed(source, F.get("_embedded.attractions", F.lit(0))["id"]).alias("artist_id"),
        _prefixed(source, F.get("_embedded.venues", F.lit(0))["id"]).alias("venue_id"),
        when.alias("event_date"),
        F.coalesce(F.map_from_entries(last), no_prices).alias("ticket_prices"),
        F.when(ended, "completed").otherwise("scheduled").alias("status"),
        F.trim("name").alias("event_name"),
        F.lit(source).alias("source"),
    )
    return out.filter((F.col("event_name") != "") & F.col("event_date").isNotNull())
