"""Trends, comparisons, statistical summaries and the data behind charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.evaluate import seeded
from encore.functions.numbers import share
from encore.functions.times import PERIOD_DAYS, days_before, period_start
from encore.plans.search import genre_text
from encore.plans.warehouse import completed_since


def _recent(concerts: DataFrame, as_of: str, period: str) -> DataFrame:
    return completed_since(concerts, days_before(as_of, PERIOD_DAYS.get(period, 365)))


def monthly_trend(concerts: DataFrame, as_of: str, period: str = "last_year") -> DataFrame:
    return (
        _recent(concerts, as_of, period)
        .groupBy(period_start("month", F.col("event_date")).alias("period"))
        .agg(
            F.count_distinct("concert_id").alias("total_concerts"),
            F.avg("total_attendance").alias("avg_attendance"),
            F.sum("revenue").alias("total_revenue"),
            F.sum("total_attendance").alias("total_attendance"),
        )
        .orderBy("period")
    )


def genre_trend(
    concerts: DataFrame, artists: DataFrame, as_of: str, period: str = "last_year", limit: int = 10
) -> DataFrame:
    """Concerts per genre text. They are summed per artist first, so the join moves one row per artist."""
    per_artist = _recent(concerts, as_of, period).groupBy("artist_id").agg(
        F.count_distinct("concert_id").alias("n"),
        F.sum("total_attendance").alias("attendance"),
        F.count("total_attendance").alias("attended"),
        F.sum("revenue").alias("revenue"),
    )
    return (
        artists.select("artist_id", genre_text().alias("genre"))
        .join(per_artist, "artist_id")
        .groupBy("genre")
        .agg(
            F.sum("n").alias("total_concerts"),
            share(F.sum("attendance"), F.sum("attended")).alias("avg_attendance"),
            F.sum("revenue").alias("total_revenue"),
        )
        .orderBy(F.desc("total_concerts"), "genre")
        .limit(limit)
    )


def raw_trend(concerts: DataFrame, as_of: str, period: str = "last_year") -> DataFrame:
    return _recent(concerts, as_of, period).select("event_date", "total_attendance", "revenue").orderBy("event_date")


def trend_facts(trend: DataFrame) -> DataFrame:
    """Growth between the first and last period, the peak and the total of a monthly trend."""
    first = F.min_by("total_concerts", "period")
    last = F.max_by("total_concerts", "period")
    growth = F.when((F.count(F.lit(1)) >= 2) & (first > 0), (last - first) / first * 100)
    return trend.agg(
        F.count(F.lit(1)).alias("data_points"),
        growth.alias("growth_pct"),
        F.max("avg_attendance").alias("peak_attendance"),
        F.sum("total_revenue").alias("total_revenue"),
    )


def compare_artists(artists: DataFrame, concerts: DataFrame, ids: Sequence) -> DataFrame:
    """Totals of the listed artists' completed concerts; the id list reaches both scans."""
    wanted = concerts.filter(F.col("artist_id").isin(list(ids)) & (F.col("status") == "completed"))
    totals = wanted.groupBy("artist_id").agg(
        F.count_distinct("concert_id").alias("total_concerts"),
        F.avg("total_attendance").alias("avg_attendance"),
        F.sum("revenue").alias("total_revenue"),
        F.max("total_attendance").alias("max_attendance"),
    )
    return artists.select("artist_id", "name", "popularity_score").join(totals, "artist_id")


def compare_venues(venues: DataFrame, concerts: DataFrame, ids: Sequence) -> DataFrame:
    wanted = concerts.filter(F.col("venue_id").isin(list(ids)) & (F.col("status") == "completed"))
    totals = wanted.groupBy("venue_id").agg(
        F.count_distinct("concert_id").alias("total_concerts"),
        F.avg("total_attendance").alias("avg_attendance"),
        F.sum("revenue").alias("total_revenue"),
    )
    return (
        venues.select("venue_id", "name", "capacity", "venue_type")
        .join(totals, "venue_id")
        .withColumn("avg_attendance_rate", share(F.col("avg_attendance"), F.col("capacity")))
    )


LEADER_METRICS = ("total_concerts", "total_revenue", "avg_attendance")


def comparison_leaders(compared: DataFrame, metrics: Sequence[str] = LEADER_METRICS) -> DataFrame:
    """The leading entity per metric (smallest name on a tie), one row per metric."""
    best = compared.agg(
        *[F.max(F.struct(F.col(m).cast("double").alias("value"))).alias(m) for m in metrics],
        *[F.min_by("name", F.struct(-F.col(m).cast("double"), F.col("name"))).alias(f"{m}_name") for m in metrics],
    )
    return best.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(m).alias("metric"), F.col(f"{m}_name").alias("leader"), F.col(m)["value"].alias("value")
                    )
                    for m in metrics
                ]
            )
        )
    )


def summarise_concerts(concerts: DataFrame) -> DataFrame:
    attendance = F.col("total_attendance")
    return concerts.filter(F.col("status") == "completed").agg(
        F.count_distinct("concert_id").alias("total_concerts"),
        F.count_distinct("artist_id").alias("unique_artists"),
        F.count_distinct("venue_id").alias("unique_venues"),
        F.avg(attendance).alias("avg_attendance"),
        F.stddev(attendance).alias("stddev_attendance"),
        F.min(attendance).alias("min_attendance"),
        F.max(attendance).alias("max_attendance"),
        F.avg("revenue").alias("avg_revenue"),
        F.sum("revenue").alias("total_revenue"),
        F.percentile(attendance, F.lit(0.5)).alias("median_attendance"),
    )


def summarise_artists(artists: DataFrame) -> DataFrame:
    score = F.col("popularity_score")
    return artists.agg(
        F.count_distinct("artist_id").alias("total_artists"),
        F.avg(score).alias("avg_popularity"),
        F.stddev(score).alias("stddev_popularity"),
        F.min(score).alias("min_popularity"),
        F.max(score).alias("max_popularity"),
        F.count_distinct(genre_text()).alias("unique_genres"),
    )


def summarise_venues(venues: DataFrame) -> DataFrame:
    size = F.col("capacity")
    return venues.agg(
        F.count_distinct("venue_id").alias("total_venues"),
        F.avg(size).alias("avg_capacity"),
        F.stddev(size).alias("stddev_capacity"),
        F.min(size).alias("min_capacity"),
        F.max(size).alias("max_capacity"),
        F.count_distinct("venue_type").alias("unique_types"),
        F.count_distinct("city").alias("unique_cities"),
    )


def metric_rows(summary: DataFrame) -> DataFrame:
    """A one-row summary as (metric, value) rows."""
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in summary.columns]
    return summary.select(F.inline(F.array(*pairs)))


def top_series(ranked: DataFrame, label: str, value: str, n: int) -> DataFrame:
    """Chart points of the n largest values."""
    return ranked.select(F.col(label).alias("label"), F.col(value).alias("value")).orderBy(F.desc("value"), "label").limit(n)


def artist_series(concerts: DataFrame, artists: DataFrame) -> DataFrame:
    """Attendance and revenue per artist and month."""
    monthly = concerts.filter(F.col("status") == "completed").groupBy(
        "artist_id", period_start("month", F.col("event_date")).alias("period")
    ).agg(F.sum("total_attendance").alias("attendance"), F.sum("revenue").alias("revenue"))
    return artists.select("artist_id", F.col("name").alias("artist_name")).join(monthly, "artist_id")


def genre_counts(artists: DataFrame) -> DataFrame:
    return artists.select(F.explode("genre").alias("genre")).groupBy("genre").agg(F.count(F.lit(1)).alias("artists"))


def revenue_attendance_points(concerts: DataFrame) -> DataFrame:
    return concerts.filter(
        (F.col("status") == "completed") & F.col("total_attendance").isNotNull() & F.col("revenue").isNotNull()
    ).select("concert_id", "total_attendance", "revenue")


def matrix(df: DataFrame, row: str, column: str, measure, column_values: Sequence) -> DataFrame:
    """Row by column matrix; the column values are given, so no extra pass collects them."""
    return df.groupBy(row).pivot(column, list(column_values)).agg(measure)


def random_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n random rows, drawn by key and seed alone; only each task's n smallest draws reach the last step."""
    return df.orderBy(seeded(key, seed), key).limit(n)
