"""Registered queries that run the writing operators and read back what they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.operators import enrich
from encore.operators import governance as gv
from encore.plans import features as ft
from encore.plans import models as md
from encore.plans import warehouse as w
from encore.registry import cleaning, records, training
from encore.registry import warehouse as wr
from encore.registry.analysis import stage
from encore.registry.helpers import AS_OF
from encore.registry.sqlviews import using
from encore.sources import warehouse as wh
from encore.streaming.pipeline import scratch_folder

LISTED, PAGE = 3, 4


def _snapshots(s):
    """The calculations run twice, as a repeated job does; each snapshot must be there once."""
    folder = scratch_folder(s.spark, "snapshots")
    views = s.concerts(), s.venues(), s.artists(), s.sales()
    w.run_calculations(*views, AS_OF, folder)
    report = w.run_calculations(*views, AS_OF, folder)
    return report.join(
        w.calculation_report(**{r["calculation"]: s.spark.read.parquet(f"{folder}/{r['calculation']}") for r in report.collect()}),
        "calculation",
    ).select("calculation", "success", "rows")


def _dropped(s):
    """Sales by the first of their month, a folder each, without those that are too old."""
    folder = scratch_folder(s.spark, "retention")
    months = w.daily_sales_summary(s.concerts(), s.sales()).withColumn("summary_date", F.trunc("summary_date", "month"))
    months.repartition("summary_date").write.partitionBy("summary_date").parquet(folder)
    dropped = wh.drop_old_dates(s.spark, folder, "summary_date", AS_OF, 30)
    left = s.spark.read.parquet(folder).groupBy("summary_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("total_tickets_sold").alias("tickets")
    )
    return left.withColumn("dropped", F.lit(dropped))


def _appended(s):
    folder = scratch_folder(s.spark, "lineage")
    edges = s.lineage()
    for day, part in (("2024-01-30", edges.filter("transformation = 'split'")), ("2024-01-31", edges.filter("transformation <> 'split'"))):
        gv.append_records(part.withColumn("timestamp", F.lit(f"{day} 10:00:00").cast("timestamp_ntz")), folder)
    return s.spark.read.parquet(folder).groupBy("day", "transformation").agg(F.count(F.lit(1)).alias("edges"))


def _training_file(s):
    """The exported rows, read back without names."""
    folder = scratch_folder(s.spark, "training")
    rows = md.training_rows(training._sales_features(s), "actual_sales", ft.SALES_FEATURES)
    wh.export_training_file(rows, folder)
    return s.spark.read.schema(rows.schema).csv(folder)


def _named_events(s):
    return s.concerts().select(
        "artist_id", "event_date", F.col("concert_id").alias("event_id"),
        F.concat(F.lit("Night at "), F.col("venue_id").cast("string")).alias("event_name"))


def _listed(s):
    found = enrich.listed_events(s.artists().select("artist_id", "name"), _named_events(s), LISTED)
    return found.select("artist_id", "event_count", "source", F.transform("events", lambda e: e["event_id"].cast("string")).alias("listed"))


def _pages(s):
    pages = enrich.event_pages(s.artists().select("artist_id"), _named_events(s), PAGE)
    return pages.select("artist_id", "page", "event_id")


QUERIES = {
    "q07_written_snapshots": stage(_snapshots),
    "q08_dropped_snapshots": stage(_dropped),
    "g01_appended_lineage": stage(_appended),
    "a22_training_file": stage(_training_file, actual_sales=2),
    "b14_listed_events": stage(_listed),
    "b14_event_pages": stage(_pages),
}
_EVENTS = """SELECT min(l_suppkey) AS artist_id, o_orderkey AS event_id, o_orderdate AS event_date
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderdate"""
ORACLE = {
    "q07_written_snapshots": using("concerts sales venues artists", f"""
        SELECT 'venue_popularity' AS calculation, TRUE AS success, count(*) AS rows FROM ({wr.POPULARITY})
        UNION ALL SELECT 'artist_performance', TRUE, count(*) FROM ({wr.PERFORMANCE})
        UNION ALL SELECT 'daily_sales_summary', TRUE, count(*) FROM ({wr._daily("CAST(ts.purchase_timestamp AS DATE) = DATE '2001-07-31'")})"""),
    "q08_dropped_snapshots": using("concerts sales", f"""
        WITH d AS (SELECT * REPLACE (CAST(date_trunc('month', summary_date) AS DATE) AS summary_date) FROM ({wr._daily("TRUE")}))
        SELECT summary_date, count(*) AS rows, CAST(sum(total_tickets_sold) AS BIGINT) AS tickets,
               (SELECT count(DISTINCT summary_date) FROM d WHERE summary_date < DATE '{AS_OF}' - INTERVAL 30 DAY) AS dropped
        FROM d WHERE summary_date >= DATE '{AS_OF}' - INTERVAL 30 DAY GROUP BY summary_date"""),
    "g01_appended_lineage": f"""
        SELECT CASE WHEN transformation = 'split' THEN DATE '2024-01-30' ELSE DATE '2024-01-31' END AS day, transformation,
               count(*) AS edges FROM ({records._LINEAGE}) GROUP BY 1, 2""",
    "a22_training_file": training.ORACLE["a22_training_rows"],
    "b14_listed_events": f"""
        WITH e AS ({_EVENTS})
        SELECT s_suppkey AS artist_id, count(event_id) AS event_count,
               CASE WHEN count(event_id) > 0 THEN 'external' ELSE 'local_fallback' END AS source,
               coalesce(array_to_string(list(event_id ORDER BY event_date, event_id) FILTER (WHERE event_id IS NOT NULL)[1:{LISTED}], '|'), '') AS listed
        FROM supplier LEFT JOIN e ON artist_id = s_suppkey GROUP BY s_suppkey""",
    "b14_event_pages": f"""
        WITH e AS ({_EVENTS})
        SELECT artist_id, (row_number() OVER (PARTITION BY artist_id ORDER BY event_date, event_id) - 1) // {PAGE} AS page, event_id
        FROM e JOIN supplier ON artist_id = s_suppkey""",
}
