"""Search and ranking queries with typed parameters (no SQL text is built from user values)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.times import moment
from encore.plans.warehouse import latest_snapshot


@dataclass(frozen=True)
class Search:
    artist_name: str | None = None
    venue_name: str | None = None
    city: str | None = None
    state: str | None = None
    country: str | None = None
    genre: str | None = None
    capacity: int | None = None
    date: str | None = None
    limit: int = 10
    sort_by: str | None = None

    def __post_init__(self):
        if not 1 <= self.limit <= 100:
            raise ValueError("limit must be 1 to 100")


def contains(column: str, text: str) -> Column:
    return F.lower(column).contains(F.lower(F.lit(text)))


def same_text(column: str, text: str) -> Column:
    return F.lower(column) == F.lower(F.lit(text))


def genre_text(genre: str = "genre") -> Column:
    """Genres as one text, the form in which the warehouse keeps them."""
    return F.concat_ws(",", genre)


def _where(df: DataFrame, *conditions: Column | None) -> DataFrame:
    for condition in conditions:
        if condition is not None:
            df = df.filter(condition)
    return df


def find_artists(artists: DataFrame, s: Search) -> DataFrame:
    found = _where(
        artists.withColumn("genre", genre_text()),
        contains("name", s.artist_name) if s.artist_name else None,
        contains("genre", s.genre) if s.genre else None,
    )
    return found.orderBy(F.desc(s.sort_by or "popularity_score"), "artist_id").limit(s.limit)


def find_venues(venues: DataFrame, s: Search) -> DataFrame:
    found = _where(
        venues,
        contains("name", s.venue_name) if s.venue_name else None,
        same_text("city", s.city) if s.city else None,
        same_text("state", s.state) if s.state else None,
        same_text("country", s.country) if s.country else None,
        F.col("capacity") >= s.capacity if s.capacity else None,
    )
    return found.orderBy(F.desc(s.sort_by or "capacity"), "venue_id").limit(s.limit)


def _star(concerts: DataFrame, artists: DataFrame, venues: DataFrame, s: Search) -> DataFrame:
    """Concerts with their artist and venue; filters sit on the dimensions, before the joins."""
    a = artists.select("artist_id", F.col("name").alias("artist_name"))
    v = venues.select("venue_id", F.col("name").alias("venue_name"), "city", "state")
    a = _where(a, contains("artist_name", s.artist_name) if s.artist_name else None)
    v = _where(
        v,
        contains("venue_name", s.venue_name) if s.venue_name else None,
        same_text("city", s.city) if s.city else None,
    )
    return concerts.join(a, "artist_id").join(v, "venue_id")


def find_concerts(
    concerts: DataFrame, artists: DataFrame, venues: DataFrame, s: Search, as_of: str
) -> DataFrame:
    """Upcoming concerts, or all of them once a date was asked for (the date itself is not applied)."""
    if s.date is None:
        concerts = concerts.filter(F.col("event_date") >= moment(as_of))
    order = F.col("event_date").asc() if s.sort_by is None else F.desc(s.sort_by)
    return (
        _star(concerts, artists, venues, s)
        .select(
            "concert_id", "event_date", "artist_name", "venue_name", "city", "state", "status",
            "total_attendance", "revenue",
        )
        .orderBy(order, "concert_id")
        .limit(s.limit)
    )


def sales_per_concert(
    concerts: DataFrame, artists: DataFrame, venues: DataFrame, sales: DataFrame, s: Search
) -> DataFrame:
    totals = sales.groupBy("concert_id").agg(
        F.count("sale_id").alias("total_sales"),
        F.sum("quantity").alias("total_tickets_sold"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("unit_price").alias("avg_ticket_price"),
    )
    return (
        _star(concerts, artists, venues, s)
        .join(totals, "concert_id", "left")
        .select(
            "concert_id", "artist_name", "venue_name", "event_date",
            F.coalesce("total_sales", F.lit(0)).alias("total_sales"),
            "total_tickets_sold", "total_revenue", "avg_ticket_price",
        )
        .orderBy(F.desc_nulls_last(s.sort_by or "total_revenue"), "concert_id")
        .limit(s.limit)
    )


def rank_artists(artists: DataFrame, concerts: DataFrame, s: Search) -> DataFrame:
    """Artists by popularity with their number of concerts; the top rows are taken before the count is joined."""
    top = _where(
        artists.withColumn("genre", genre_text()), contains("genre", s.genre) if s.genre else None
    ).orderBy(F.desc("popularity_score"), "artist_id").limit(s.limit)
    counts = concerts.groupBy("artist_id").agg(F.count(F.lit(1)).alias("total_concerts"))
    return (
        top.join(counts, "artist_id", "left")
        .select("artist_id", "name", "genre", "popularity_score", F.coalesce("total_concerts", F.lit(0)).alias("total_concerts"))
        .orderBy(F.desc("popularity_score"), "artist_id")
    )


def rank_venues(venues: DataFrame, popularity: DataFrame, s: Search) -> DataFrame:
    return (
        venues.select("venue_id", "name", "city", "state", "capacity")
        .join(latest_snapshot(popularity), "venue_id")
        .select(
            "venue_id", "name", "city", "state", "capacity", "popularity_rank", "avg_attendance_rate",
            "revenue_per_event", "total_events",
        )
        .orderBy("popularity_rank")
        .limit(s.limit)
    )


def revenue_by_artist(concerts: DataFrame, artists: DataFrame, s: Search) -> DataFrame:
    """Revenue per artist name. Concert ids are unique, so the distinct count is a plain count."""
    totals = concerts.filter(F.col("revenue").isNotNull()).groupBy("artist_id").agg(
        F.count("concert_id").alias("n"), F.sum("revenue").alias("revenue"), F.sum("total_attendance").alias("att")
    )
    names = _where(
        artists.select("artist_id", F.col("name").alias("artist_name")),
        contains("artist_name", s.artist_name) if s.artist_name else None,
    )
    return (
        totals.join(names, "artist_id")
        .groupBy("artist_name")
        .agg(
            F.sum("n").alias("total_concerts"),
            F.sum("revenue").alias("total_revenue"),
            (F.sum("revenue") / F.sum("n")).alias("avg_revenue_per_concert"),
            F.sum("att").alias("total_attendance"),
        )
        .orderBy(F.desc("total_revenue"), "artist_name")
        .limit(s.limit)
    )
