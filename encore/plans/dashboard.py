"""Dashboard and documented report queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.numbers import half_up, share
from encore.functions.times import days_before, moment, month_span
from encore.plans.search import genre_text
from encore.plans.warehouse import completed_since


def venue_ranking(concerts: DataFrame, venues: DataFrame, as_of: str, top_n: int = 10, min_events: int = 5) -> DataFrame:
    """Venues of the last 365 days with enough events, by attendance rate and revenue."""
    if not 1 <= top_n <= 100 or min_events < 1:
        raise ValueError("top_n must be 1 to 100 and min_events at least 1")
    events = F.count_distinct("concert_id")
    per_venue = completed_since(concerts, days_before(as_of, 365)).groupBy("venue_id").agg(
        events.alias("total_concerts"),
        F.avg("total_attendance").alias("attendance"),
        F.avg("revenue").alias("avg_revenue_per_event"),
        share(events, month_span(F.min("event_date"), F.max("event_date"))).alias("booking_frequency"),
    ).filter(F.col("total_concerts") >= min_events)
    # rounded, so that the order does not hang on the summation order of doubles
    ranked = venues.join(per_venue, "venue_id").withColumn(
        "avg_attendance_rate", half_up(share(F.col("attendance"), F.col("capacity")), 6)
    ).withColumn("avg_revenue_per_event", half_up(F.col("avg_revenue_per_event"), 4))
    order = [F.desc_nulls_first("avg_attendance_rate"), F.desc_nulls_first("avg_revenue_per_event"), F.asc("venue_id")]
    # the window sees at most top_n rows
    top = ranked.orderBy(*order).limit(top_n)
    return top.withColumn("popularity_rank", F.row_number().over(Window.orderBy(*order))).select(
        "venue_id", "name", "city", "state", "capacity", "venue_type", "total_concerts", "avg_attendance_rate",
        "avg_revenue_per_event", "booking_frequency", "popularity_rank",
    )


def upcoming_by_taste(
    concerts: DataFrame,
    artists: DataFrame,
    venues: DataFrame,
    as_of: str,
    genres: Sequence[str] = (),
    location: str | None = None,
    top_n: int = 10,
) -> DataFrame:
    """Scheduled upcoming concerts by artist popularity; each place down costs 0.05 of the score."""
    if not 1 <= top_n <= 50:
        raise ValueError("top_n must be 1 to 50")
    wanted = concerts.filter((F.col("status") == "scheduled") & (F.col("event_date") >= moment(as_of)))
    a = artists.select("artist_id", F.col("name").alias("artist_name"), genre_text().alias("genre"), "popularity_score")
    v = venues.select("venue_id", F.col("name").alias("venue_name"), "city", "state", "capacity")
    if genres:
        a = a.filter(F.col("genre").isin(list(genres)))
    if location:
        text = F.lower(F.lit(location))
        v = v.filter(F.lower("city").contains(text) | F.lower("state").contains(text))
    order = [F.desc("popularity_score"), F.asc("event_date"), F.asc("concert_id")]
    top = wanted.join(a, "artist_id").join(v, "venue_id").orderBy(*order).limit(top_n)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order))).select(
        "concert_id", "artist_name", "genre", F.col("popularity_score").alias("artist_popularity"), "venue_name",
        "city", "state", "capacity", "event_date",
        (1.0 - (F.col("place") - 1) * 0.05).alias("score"),
        F.concat(F.lit("Popular "), F.col("genre"), F.lit(" artist")).alias("reasoning"),
    )


def details(entities: DataFrame, key: str, value) -> DataFrame:
    """Point lookup; the equality reaches the scan."""
    return entities.filter(F.col(key) == F.lit(value))


def top_artists(artists: DataFrame, limit: int = 10) -> DataFrame:
    return artists.orderBy(F.desc("popularity_score"), "artist_id").limit(limit)


def concerts_by_status(concerts: DataFrame) -> DataFrame:
    return concerts.groupBy("status").agg(
        F.count(F.lit(1)).alias("concert_count"),
        F.avg("total_attendance").alias("avg_attendance"),
        F.sum("revenue").alias("total_revenue"),
    )


def busiest_venues(concerts: DataFrame, venues: DataFrame, limit: int = 10) -> DataFrame:
    """Venues by number of concerts; those without any count 0."""
    counts = concerts.groupBy("venue_id").agg(
        F.count("concert_id").alias("n"), F.avg("total_attendance").alias("avg_attendance")
    )
    return (
        venues.select("venue_id", "name", "capacity")
        .join(counts, "venue_id", "left")
        .select("venue_id", "name", "capacity", F.coalesce("n", F.lit(0)).alias("total_concerts"), "avg_attendance")
        .orderBy(F.desc("total_concerts"), "venue_id")
        .limit(limit)
    )


def revenue_per_venue(concerts: DataFrame, venues: DataFrame) -> DataFrame:
    """Revenue per venue name, summed per venue before the join."""
    totals = concerts.groupBy("venue_id").agg(F.sum("revenue").alias("revenue"))
    return (
        venues.select("venue_id", "name").join(totals, "venue_id").groupBy("name")
        .agg(F.sum("revenue").alias("total_revenue"))
    )


def concert_calendar(concerts: DataFrame, artists: DataFrame, venues: DataFrame, as_of: str) -> DataFrame:
    """All concerts after ``as_of`` with their artist and venue names."""
    return (
        concerts.filter(F.col("event_date") > moment(as_of))
        .join(artists.select("artist_id", F.col("name").alias("artist")), "artist_id")
        .join(venues.select("venue_id", F.col("name").alias("venue")), "venue_id")
        .select("concert_id", "event_date", "artist", "venue")
    )


def freshness(df: DataFrame, updated: str, created: str, as_of: str, days: int = 1) -> DataFrame:
    """Rows updated in the last ``days``, with the first and last creation time among them."""
    recent = df.filter(F.col(updated) > moment(days_before(as_of, days)))
    return recent.agg(
        F.count(F.lit(1)).alias("recent_rows"),
        F.min(created).alias("first_created"),
        F.max(created).alias("last_created"),
    )
