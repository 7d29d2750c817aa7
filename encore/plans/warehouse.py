"""Warehouse calculations: popularity, performance and daily snapshots, and the reports read from them.

Facts are reduced to one row per key before they meet a dimension, so the joins move aggregates.
``as_of`` stands for the current date throughout.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.numbers import half_up, share
from encore.functions.times import (
    REPORT_PERIODS, as_date, days_before, moment, months_before, period_end, period_start,
)
from encore.operators.ordering import global_position


def completed_since(concerts: DataFrame, start: dt.date) -> DataFrame:
    return concerts.filter((F.col("status") == "completed") & (F.col("event_date") >= moment(start)))


def venue_popularity(concerts: DataFrame, venues: DataFrame, as_of: str) -> DataFrame:
    """Snapshot of the last two years: one row per venue with events, ranked by the weighted score."""
    recent = completed_since(concerts, months_before(as_of, 24))
    days = F.datediff(F.max("event_date"), F.min("event_date"))
    per_venue = recent.groupBy("venue_id").agg(
        F.count("concert_id").alias("total_events"),
        F.avg("total_attendance").alias("attendance"),
        F.avg("revenue").alias("revenue"),
        (share(F.count("concert_id"), days) * 30).alias("bookings"),
    )
    metrics = venues.select("venue_id", "capacity").join(per_venue, "venue_id").select(
        "venue_id",
        F.coalesce(
            F.when(F.col("capacity") > 0, F.col("attendance") / F.col("capacity") * 100), F.lit(0.0)
        ).alias("rate"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
        F.coalesce("bookings", F.lit(0.0)).alias("bookings"),
        "total_events",
    )
    score = F.col("rate") * 0.4 + F.col("revenue") / 100000 * 0.3 + F.col("bookings") * 0.3
    # rounded, so that the order does not hang on the summation order of doubles
    ranked = global_position(
        metrics.withColumn("score", half_up(score, 6)),
        [F.col("score").desc(), F.col("venue_id").asc()],
        "popularity_rank",
    )
    return ranked.select(
        "venue_id",
        "popularity_rank",
        half_up(F.col("rate"), 2).alias("avg_attendance_rate"),
        half_up(F.col("revenue"), 2).alias("revenue_per_event"),
        half_up(F.col("bookings"), 2).alias("booking_frequency"),
        "total_events",
        F.lit(as_date(as_of)).alias("calculated_at"),
    )


def artist_performance(
    concerts: DataFrame, artists: DataFrame, sales: DataFrame, as_of: str
) -> DataFrame:
    """Snapshot of the last two years: volume, mean sale value, revenue, engagement and growth."""
    start, half, year = (months_before(as_of, m) for m in (24, 6, 12))
    date = F.col("event_date")
    metrics = completed_since(concerts, start).filter(F.col("artist_id").isNotNull()).groupBy("artist_id").agg(
        F.count("concert_id").alias("total_concerts"),
        F.avg("total_attendance").alias("avg_attendance"),
        F.sum("revenue").alias("total_revenue"),
        F.count_if(date >= moment(half)).alias("recent"),
        F.count_if((date < moment(half)) & (date >= moment(year))).alias("earlier"),
    )
    in_window = concerts.filter(date >= moment(start)).filter(F.col("artist_id").isNotNull())
    per_concert = sales.groupBy("concert_id").agg(
        F.sum(F.col("quantity") * F.col("unit_price")).alias("value"), F.count(F.lit(1)).alias("rows")
    )
    sale_value = (
        in_window.select("concert_id", "artist_id")
        .join(per_concert, "concert_id")
        .groupBy("artist_id")
        .agg((F.sum("value") / F.sum("rows")).alias("sale_value"))
    )
    engagement = (
        F.coalesce("popularity_score", F.lit(0.0)) * 0.3
        + F.least(F.coalesce("avg_attendance", F.lit(0.0)) / 10000, F.lit(10.0)) * 0.4
        + F.least(F.coalesce("total_revenue", F.lit(0.0)) / 1000000, F.lit(10.0)) * 0.3
    )
    trend = (
        F.when(F.col("recent") > F.col("earlier"), "growing")
        .when(F.col("recent") < F.col("earlier"), "declining")
        .otherwise("stable")
    )
    return (
        artists.select("artist_id", "popularity_score")
        .join(metrics, "artist_id")
        .join(sale_value, "artist_id", "left")
        .select(
            "artist_id",
            "total_concerts",
            half_up(F.coalesce("sale_value", F.lit(0.0)), 2).alias("avg_ticket_sales"),
            half_up(F.coalesce("total_revenue", F.lit(0.0)), 2).alias("revenue_generated"),
            half_up(engagement, 2).alias("fan_engagement_score"),
            trend.alias("growth_trend"),
            F.lit(as_date(as_of)).alias("calculated_at"),
        )
    )


def daily_sales_summary(concerts: DataFrame, sales: DataFrame, day: str | None = None) -> DataFrame:
    """Sales per concert and day; with ``day`` only that day's sales are read.

    ``unique_customers`` counts sale ids. Sales with a customer id also get ``unique_buyers``.
    """
    if day is not None:
        when = F.col("purchase_timestamp")
        sales = sales.filter((when >= moment(day)) & (when < moment(days_before(day, -1))))
    measures = [
        F.sum("quantity").alias("total_tickets_sold"),
        F.sum(F.col("quantity") * F.col("unit_price")).alias("total_revenue"),
        F.avg("unit_price").alias("avg_ticket_price"),
        F.count_distinct("sale_id").alias("unique_customers"),
    ]
    if "customer_id" in sales.columns:
        measures.append(F.count_distinct("customer_id").alias("unique_buyers"))
    daily = sales.groupBy(F.col("purchase_timestamp").cast("date").alias("summary_date"), "concert_id").agg(*measures)
    return concerts.select("concert_id", "artist_id", "venue_id").join(daily, "concert_id").select(
        "summary_date", "artist_id", "venue_id", "concert_id", "total_tickets_sold",
        half_up(F.col("total_revenue"), 2).alias("total_revenue"),
        half_up(F.col("avg_ticket_price"), 2).alias("avg_ticket_price"),
        *[m for m in ("unique_customers", "unique_buyers") if m in daily.columns],
    )


def latest_snapshot(snapshots: DataFrame, column: str = "calculated_at") -> DataFrame:
    """Rows of the newest calculation date, found by a scalar subquery."""
    newest = snapshots.agg(F.max(F.col(column).cast("date")).alias("newest"))
    return snapshots.filter(F.col(column).cast("date") == newest.scalar())


def top_venues(
    concerts: DataFrame, venues: DataFrame, popularity: DataFrame, as_of: str, limit: int = 10, days: int = 365
) -> DataFrame:
    per_venue = completed_since(concerts, days_before(as_of, days)).groupBy("venue_id").agg(
        F.count("concert_id").alias("total_events"),
        F.sum("revenue").alias("revenue"),
        F.avg("total_attendance").alias("attendance"),
    )
    ranks = latest_snapshot(popularity).select("venue_id", "popularity_rank")
    rate = F.when(F.col("capacity") > 0, F.col("attendance") / F.col("capacity") * 100)
    return (
        venues.join(per_venue, "venue_id")
        .join(ranks, "venue_id", "left")
        .select(
            "venue_id",
            F.col("name").alias("venue_name"),
            "city",
            "total_events",
            half_up(F.coalesce("revenue", F.lit(0.0)), 2).alias("total_revenue"),
            half_up(F.coalesce(rate, F.lit(0.0)), 2).alias("avg_attendance_rate"),
            F.coalesce("popularity_rank", F.lit(999)).cast("bigint").alias("popularity_rank"),
        )
        .orderBy("popularity_rank", F.desc("total_revenue"), F.desc("avg_attendance_rate"), "venue_id")
        .limit(limit)
    )


def artist_trends(artists: DataFrame, performance: DataFrame, limit: int = 20, trend: str = "all") -> DataFrame:
    """Artists of the newest performance snapshot; ``trend`` keeps growing, declining or stable ones."""
    snapshot = latest_snapshot(performance).filter(F.col("total_concerts") > 0)
    if trend in ("growing", "declining", "stable"):
        snapshot = snapshot.filter(F.col("growth_trend") == trend)
    return (
        artists.select("artist_id", F.col("name").alias("artist_name"), "popularity_score")
        .join(snapshot, "artist_id")
        .select(
            "artist_id", "artist_name", "total_concerts", "revenue_generated", "fan_engagement_score",
            "growth_trend", half_up(F.coalesce("popularity_score", F.lit(0.0)), 2).alias("popularity_score"),
        )
        .orderBy(
            F.desc("fan_engagement_score"), F.desc("revenue_generated"), F.desc("popularity_score"), "artist_id"
        )
        .limit(limit)
    )


def revenue_analytics(
    concerts: DataFrame,
    sales: DataFrame,
    as_of: str,
    start: str | None = None,
    end: str | None = None,
    period: str = "month",
    compat_fanout: bool = False,
) -> DataFrame:
    """Completed concerts per period. ``compat_fanout`` counts each concert once per joined sale."""
    first = as_date(start) if start else months_before(as_of, 12)
    last = as_date(end) if end else as_date(as_of)
    if period not in REPORT_PERIODS:
        period = "month"
    date = F.col("event_date")
    wanted = concerts.filter(
        (F.col("status") == "completed") & (date >= moment(first)) & (date <= moment(last))
    ).select("concert_id", date, "revenue")
    per_concert = sales.groupBy("concert_id").agg(
        F.sum("quantity").alias("tickets"), F.sum("unit_price").alias("prices"), F.count("unit_price").alias("n")
    )
    # a concert without sales still counts once in the outer join
    copies = F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)) if compat_fanout else F.lit(1)
    grouped = (
        wanted.join(per_concert, "concert_id", "left")
        .groupBy(period_start(period, date).alias("period_start"))
        .agg(
            F.sum(copies).cast("bigint").alias("total_concerts"),
            F.sum(F.col("revenue") * copies).alias("revenue"),
            F.sum("tickets").alias("tickets"),
            (F.sum("prices") / F.nullif(F.sum("n"), F.lit(0))).alias("price"),
        )
    )
    return grouped.select(
        "period_start",
        period_end(period, F.col("period_start")).alias("period_end"),
        "total_concerts",
        half_up(F.coalesce("revenue", F.lit(0.0)), 2).alias("total_revenue"),
        half_up(F.col("revenue") / F.col("total_concerts"), 2).alias("avg_revenue_per_concert"),
        F.coalesce("tickets", F.lit(0)).cast("bigint").alias("total_tickets_sold"),
        half_up(F.coalesce("price", F.lit(0.0)), 2).alias("avg_ticket_price"),
    ).orderBy("period_start")


def retained(snapshots: DataFrame, column: str, as_of: str, days: int = 30) -> DataFrame:
    """Rows not older than ``days``; on a table partitioned by ``column`` this prunes partitions."""
    return snapshots.filter(F.col(column) >= F.lit(days_before(as_of, days)))


def calculation_report(**results: DataFrame) -> DataFrame:
    """One row per calculation with its row count."""
    report = None
    for name, df in results.items():
        row = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("calculation"), "rows")
        report = row if report is None else report.unionByName(row)
    return report


def run_calculations(
    concerts: DataFrame, venues: DataFrame, artists: DataFrame, sales: DataFrame, as_of: str, folder: str
) -> DataFrame:
    """Write the three snapshots, each replacing only its own date, and report success.

    A failed calculation is reported in its row; the others still run.
    """
    spark = concerts.sparkSession
    yesterday = days_before(as_of, 1).isoformat()
    jobs = {
        "venue_popularity": lambda: venue_popularity(concerts, venues, as_of),
        "artist_performance": lambda: artist_performance(concerts, artists, sales, as_of),
        "daily_sales_summary": lambda: daily_sales_summary(concerts, sales, yesterday),
    }
    rows = []
    for name, job in jobs.items():
        key = "summary_date" if name == "daily_sales_summary" else "calculated_at"
        try:
            path = f"{folder}/{name}"
            job().write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
            rows.append((name, True, None))
        except Exception as error:  # reported, as the caller runs all three
            rows.append((name, False, str(error).splitlines()[0]))
    return spark.createDataFrame(rows, "calculation string, success boolean, error string")
