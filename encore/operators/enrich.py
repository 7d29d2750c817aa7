"""Enrichment from landed external tables, with defaults where nothing fresh was landed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.operators.ordering import position_within

FRESH_MINUTES = 60


def request_key(kind: str, *parts: str):
    """Hash key of a lookup."""
    return F.md5(F.concat_ws(":", F.lit(kind), *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]))


def _origin(fetched: str, expires: str, now):
    """external if fetched for this run, cache while fresh, else the local fallback."""
    return (
        F.when(F.col(fetched) >= now, "external")
        .when(F.col(expires) >= now, "cache")
        .otherwise("local_fallback")
    )


def _with_landed(requests: DataFrame, landed: DataFrame, key: str, as_of: dt.datetime) -> DataFrame:
    """Left join the newest landed row per key, dropping rows that are no longer fresh."""
    now = F.lit(as_of).cast("timestamp_ntz")
    expires = F.col("fetched_at") + F.expr(f"INTERVAL {FRESH_MINUTES} MINUTES")
    fresh = landed.withColumn("expires_at", expires).filter(F.col("expires_at") >= now)
    others = [c for c in fresh.columns if c != key]
    newest = fresh.groupBy(key).agg(F.max_by(F.struct(*others), "fetched_at").alias("found"))
    joined = requests.join(newest, key, "left")
    return joined.withColumn("_fetched", F.col("found.fetched_at")).withColumn(
        "_expires", F.col("found.expires_at")
    ).withColumn("source", _origin("_fetched", "_expires", now)).drop("_fetched", "_expires")


def enrich_artists(requests: DataFrame, landed: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Requests (artist_id, name) with genre and popularity; defaults: no genre, popularity 50."""
    joined = _with_landed(requests, landed, "artist_id", as_of)
    return joined.select(
        "artist_id",
        F.coalesce("found.name", "name", F.lit("Unknown Artist")).alias("name"),
        F.coalesce("found.genre", F.array().cast("array<string>")).alias("genre"),
        F.when(F.col("source") == "local_fallback", 50.0)
        .otherwise(F.coalesce("found.popularity_score", F.lit(0.0))).alias("popularity_score"),
        "source",
    )


def enrich_venues(requests: DataFrame, landed: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Requests (venue_id, name, city) with capacity and type; defaults: capacity 1000, type other."""
    joined = _with_landed(requests, landed, "venue_id", as_of)
    fallback = F.col("source") == "local_fallback"
    return joined.select(
        "venue_id",
        F.coalesce("found.name", "name", F.lit("Unknown Venue")).alias("name"),
        F.coalesce("found.city", "city", F.lit("")).alias("city"),
        F.coalesce("found.country", F.lit("")).alias("country"),
        F.when(fallback, 1000).otherwise(F.coalesce("found.capacity", F.lit(0))).alias("capacity"),
        F.when(fallback, "other").otherwise(F.coalesce("found.venue_type", F.lit("other"))).alias("venue_type"),
        "source",
    )


def events_of_artists(
    requests: DataFrame, events: DataFrame, key: str = "artist_id", venue_text: str | None = None
) -> DataFrame:
    """Number of landed events per requested artist and the first of them by date.

    ``venue_text`` keeps events whose name contains it. The events themselves are the join of both
    tables; only their count and one example are gathered per artist, so a busy artist stays one row.
    """
    if venue_text:
        events = events.filter(F.lower("event_name").contains(venue_text.lower()))
    per_artist = events.groupBy(key).agg(
        F.count(F.lit(1)).alias("events"),
        F.min(F.struct("event_date", "event_id", "event_name")).alias("first"),
    )
    found = F.col("events").isNotNull()
    return requests.join(per_artist, key, "left").select(
        *requests.columns,
        F.coalesce("events", F.lit(0)).alias("event_count"),
        F.col("first.event_id").alias("first_event_id"),
        F.when(found, "external").otherwise("local_fallback").alias("source"),
    )


def listed_events(
    requests: DataFrame, events: DataFrame, most: int = 20, key: str = "artist_id", venue_text: str | None = None
) -> DataFrame:
    """Requests with event_count, their first ``most`` events by date, and source.

    ``events`` is a list of (event_date, event_id, event_name). It ends at ``most`` events, event_count counts them all,
    and :func:`event_pages` has the whole lists. Each task keeps only its own first ``most`` events of an artist before
    they move, so a busy artist is never gathered.
    """
    if venue_text:
        events = events.filter(F.lower("event_name").contains(venue_text.lower()))
    order = Window.partitionBy(key).orderBy("event_date", "event_id")
    first = events.select(key, "event_date", "event_id", "event_name").withColumn(
        "_nth", F.row_number().over(order)
    ).filter(F.col("_nth") <= most)
    lists = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("event_date", "event_id", "event_name"))).alias("events"))
    counts = events.groupBy(key).agg(F.count(F.lit(1)).alias("event_count"))
    none = F.array().cast(lists.schema["events"].dataType)
    return requests.join(counts, key, "left").join(lists, key, "left").select(
        *requests.columns,
        F.coalesce("event_count", F.lit(0)).alias("event_count"),
        F.coalesce("events", none).alias("events"),
        F.when(F.col("event_count").isNotNull(), "external").otherwise("local_fallback").alias("source"),
    )


def event_pages(requests: DataFrame, events: DataFrame, size: int = 20, key: str = "artist_id") -> DataFrame:
    """All events of the requested entities with ``page`` (from 0), ``size`` events a page in order of date.

    Places come from one global order, so the events of a busy artist are spread over tasks.
    """
    asked = events.join(requests.select(key).distinct(), key, "left_semi")
    placed = position_within(asked, [key], [F.col("event_date"), F.col("event_id")], "_nth").drop("_size")
    return placed.withColumn("page", F.floor((F.col("_nth") - 1) / size)).drop("_nth")
