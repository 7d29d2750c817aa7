"""Log queries and log-line metrics. All of them run on a batch table or on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def newest_errors(logs: DataFrame, limit: int = 100) -> DataFrame:
    return logs.filter(F.col("message").rlike("ERROR")).select("timestamp", "message", "log_stream").orderBy(
        F.desc("timestamp"), "log_stream", "message"
    ).limit(limit)


def _per(window: str, df: DataFrame, *measures: Column) -> DataFrame:
    grouped = df.groupBy(F.window("timestamp", window).alias("w")).agg(*measures)
    return grouped.select(F.col("w.start").alias("window_start"), *[c for c in grouped.columns if c != "w"])


def conversation_counts(logs: DataFrame) -> DataFrame:
    return _per("5 minutes", logs, F.count(F.lit(1)).alias("conversation_count"))


def slow_requests(logs: DataFrame, over_ms: float = 1000) -> DataFrame:
    latency = F.col("duration_ms")
    return _per(
        "5 minutes", logs.filter(latency > over_ms),
        F.avg(latency).alias("avg_latency"), F.max(latency).alias("max_latency"), F.min(latency).alias("min_latency"),
    )


def cold_starts(logs: DataFrame) -> DataFrame:
    """Reports with an initialisation time, per hour."""
    started = logs.filter((F.col("type") == "REPORT") & (F.col("init_duration") > 0))
    return _per(
        "1 hour", started, F.count(F.lit(1)).alias("cold_starts"), F.avg("init_duration").alias("avg_init_duration")
    )


def errors_per_stream(logs: DataFrame) -> DataFrame:
    failed = F.col("message").rlike("ERROR") | F.col("message").rlike("FAILED")
    return logs.filter(failed).groupBy("log_stream").agg(F.count(F.lit(1)).alias("error_count"))


def line_metrics(logs: DataFrame) -> DataFrame:
    """(timestamp, metric, value): one row per pattern a line matches; a duration carries its number."""
    line = F.col("message")
    duration = F.regexp_extract(line, r"duration_ms[\"=: ]+([0-9.]+)", 1)
    found = F.array(
        F.struct(F.lit("errors").alias("metric"), F.when(line.rlike(r"\bERROR"), 1.0).alias("value")),
        F.struct(F.lit("server_errors").alias("metric"), F.when(line.rlike(r"status_code[\"=: ]+5\d\d"), 1.0).alias("value")),
        F.struct(F.lit("quality_issues").alias("metric"), F.when(F.lower(line).contains("data quality"), 1.0).alias("value")),
        F.struct(F.lit("latency_ms").alias("metric"), duration.try_cast("double").alias("value")),
    )
    hits = F.filter(found, lambda m: m["value"].isNotNull())
    return logs.select("timestamp", F.inline(hits))
