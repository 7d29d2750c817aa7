"""Distribution drift and performance degradation."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.operators.evaluate import REGRESSION_METRICS, metric_rows
from encore.operators.ordering import running_sums

# fixed values: thresholds
PSI_LIMIT = 0.2
P_LIMIT = 0.05
FEATURE_SHARE = 0.3
EPSILON = 1e-10
DEGRADATION = {"mae": 20.0, "rmse": 20.0, "mape": 20.0, "r_squared": 10.0}
RANKING_DEGRADATION = 15.0


def samples(baseline: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Both samples as (feature, value, base, cur) rows; nulls and columns missing on a side drop out."""
    shared = [c for c in features if c in baseline.columns and c in current.columns]

    def long(df: DataFrame, base: int) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in shared]
        return df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull()).select(
            "feature", "value", F.lit(base).cast("bigint").alias("base"), F.lit(1 - base).cast("bigint").alias("cur")
        )

    return long(baseline, 1).unionByName(long(current, 0))


def bin_counts(both: DataFrame, bins: int = 10) -> DataFrame:
    """Counts per equal-width bin over the joint range, the last bin closed; empty bins stay.

    A feature with one single value has one bin.
    """
    ends = both.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    bin_no = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)
    # one row per requested feature
    counted = both.join(F.broadcast(ends), "feature").groupBy("feature", bin_no.cast("int").alias("bin")).agg(
        F.sum("base").alias("base"), F.sum("cur").alias("cur")
    )
    last = F.when(F.col("hi") > F.col("lo"), bins - 1).otherwise(0)
    grid = ends.select("feature", F.explode(F.sequence(F.lit(0), last)).alias("bin"))
    return grid.join(counted, ["feature", "bin"], "left").select(
        "feature", "bin", F.coalesce("base", F.lit(0)).alias("base"), F.coalesce("cur", F.lit(0)).alias("cur")
    )


def population_stability(both: DataFrame, bins: int = 10) -> DataFrame:
    """PSI per feature; drift from 0.2 on."""
    counts = bin_counts(both, bins)
    totals = counts.groupBy("feature").agg(F.sum("base").alias("nb"), F.sum("cur").alias("nc"))
    b = (F.col("base") + EPSILON) / (F.col("nb") + EPSILON * bins)
    c = (F.col("cur") + EPSILON) / (F.col("nc") + EPSILON * bins)
    return counts.join(totals, "feature").filter((F.col("nb") > 0) & (F.col("nc") > 0)).groupBy("feature").agg(
        F.sum((c - b) * F.ln(c / b)).alias("drift_score")
    ).withColumn("drift_detected", F.col("drift_score") >= PSI_LIMIT)


@F.pandas_udf(T.DoubleType())
def _chi_square_tail(statistic: pd.Series, degrees: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution, by the recurrence over degrees of freedom."""
    def tail(x: float, df: int) -> float:
        if x <= 0:
            return 1.0
        half = x / 2
        if df % 2:
            total, start, term = math.erfc(math.sqrt(half)), 1, math.sqrt(half) * math.exp(-half) / math.gamma(1.5)
        else:
            total, start, term = 0.0, 0, math.exp(-half)
        for k in range(start, df, 2):
            total += term
            term *= half / (k / 2 + 1)
        return min(total, 1.0)

    return pd.Series([tail(float(x), int(d)) for x, d in zip(statistic, degrees)], dtype="float64")


def chi_square(both: DataFrame, bins: int = 10) -> DataFrame:
    """Chi-square of current against baseline bin counts scaled to the current total."""
    counts = bin_counts(both, bins)
    totals = counts.groupBy("feature").agg(
        F.sum("base").alias("nb"), F.sum("cur").alias("nc"), F.count(F.lit(1)).alias("cells")
    )
    expected = F.col("base") / F.col("nb") * F.col("nc") + EPSILON
    gap = F.col("cur") + EPSILON - expected
    stats = counts.join(totals, "feature").filter((F.col("nb") > 0) & (F.col("nc") > 0)).groupBy("feature").agg(
        F.sum(gap * gap / expected).alias("drift_score"), (F.max("cells") - 1).alias("degrees")
    )
    return stats.withColumn("p_value", _chi_square_tail("drift_score", "degrees")).withColumn(
        "drift_detected", F.col("p_value") < P_LIMIT
    )


def ks_p_value(statistic: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic two-sided p-value: 2 * sum of (-1)^(k-1) exp(-2 k^2 n d^2), n the harmonic size."""
    size = n1 * n2 / (n1 + n2)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * size * statistic * statistic),
    )
    return F.when(statistic <= 0, 1.0).otherwise(F.least(F.greatest(2 * series, F.lit(0.0)), F.lit(1.0)))


def kolmogorov_smirnov(both: DataFrame) -> DataFrame:
    """Largest distance of the two distribution functions per feature, with the p-value.

    Equal values are counted first; the running totals come from a range-partitioned order.
    """
    counts = both.groupBy("feature", "value").agg(F.sum("base").alias("base"), F.sum("cur").alias("cur"))
    running = running_sums(counts, ["value"], ["base", "cur"], group=["feature"])
    sizes = both.groupBy("feature").agg(
        F.sum("base").cast("double").alias("nb"), F.sum("cur").cast("double").alias("nc")
    ).filter((F.col("nb") > 0) & (F.col("nc") > 0))
    gap = F.abs(F.col("base") / F.col("nb") - F.col("cur") / F.col("nc"))
    # one row per requested feature
    stats = running.join(F.broadcast(sizes), "feature").groupBy("feature", "nb", "nc").agg(F.max(gap).alias("drift_score"))
    return stats.select(
        "feature", "drift_score", ks_p_value(F.col("drift_score"), F.col("nb"), F.col("nc")).alias("p_value")
    ).withColumn("drift_detected", F.col("p_value") < P_LIMIT)


def detect_drift(both: DataFrame, method: str = "psi") -> DataFrame:
    """Drift record per feature: score, p-value where the method has one, threshold, verdict."""
    if method == "psi":
        found = population_stability(both).withColumn("p_value", F.lit(None).cast("double"))
    elif method == "ks_test":
        found = kolmogorov_smirnov(both)
    elif method == "chi_square":
        found = chi_square(both)
    else:
        raise ValueError(f"unknown method {method}")
    limit = PSI_LIMIT if method == "psi" else P_LIMIT
    return found.select(
        "feature", F.lit(method).alias("statistical_test"), "drift_score", "p_value",
        F.lit(limit).alias("threshold"), "drift_detected",
    )


def prediction_trigger(record: DataFrame) -> DataFrame:
    """Retraining trigger rows for drifted predictions."""
    return record.filter("drift_detected").select(
        F.concat(F.lit("Prediction drift detected (score="), F.format_string("%.4f", "drift_score"), F.lit(")")).alias("trigger_reason"),
        F.lit("drift").alias("trigger_type"),
        F.lit("high").alias("severity"),
    )


def feature_trigger(records: DataFrame, requested: int) -> DataFrame:
    """A trigger row once 30% of the requested features drift."""
    return records.agg(F.count_if("drift_detected").alias("drifted")).filter(
        F.col("drifted") >= requested * FEATURE_SHARE
    ).select(
        F.concat(F.lit("Feature drift detected in "), F.col("drifted"), F.lit(f"/{requested} features")).alias("trigger_reason"),
        F.lit("drift").alias("trigger_type"),
        F.lit("high").alias("severity"),
        "drifted",
    )


def _degradation(current: DataFrame, baseline: DataFrame, names: Sequence[str]) -> DataFrame:
    now = metric_rows(current, names).withColumnRenamed("value", "metric_value")
    then = metric_rows(baseline, names).withColumnRenamed("value", "baseline_value")
    down = ~F.col("metric").isin("mae", "rmse", "mape")
    gap = F.when(down, F.col("baseline_value") - F.col("metric_value")).otherwise(
        F.col("metric_value") - F.col("baseline_value")
    )
    limit = F.lit(RANKING_DEGRADATION)
    for name, value in DEGRADATION.items():
        limit = F.when(F.col("metric") == name, value).otherwise(limit)
    change = F.when(F.col("baseline_value") != 0, gap / F.abs("baseline_value") * 100).otherwise(0.0)
    return now.join(then, "metric").select(
        "metric", "metric_value", "baseline_value", change.alias("change_pct"), limit.alias("threshold"),
        (change > limit).alias("threshold_breached"),
    )


def monitor_regression(current: DataFrame, baseline: DataFrame) -> DataFrame:
    return _degradation(current, baseline, REGRESSION_METRICS)


def monitor_ranking(current: DataFrame, baseline: DataFrame) -> DataFrame:
    return _degradation(current, baseline, ("precision_at_10", "recall_at_10", "map"))


def degradation_trigger(monitored: DataFrame) -> DataFrame:
    """One trigger row that names all degraded metrics (a handful per model)."""
    reason = F.format_string(
        "%s degraded by %.1f%% (baseline=%.4f, current=%.4f)",
        F.upper("metric"), F.col("change_pct"), F.col("baseline_value"), F.col("metric_value"),
    )
    return monitored.filter("threshold_breached").select("metric", reason.alias("reason")).agg(
        F.array_sort(F.collect_list("reason")).alias("reasons")
    ).filter(F.size("reasons") > 0).select(
        F.array_join("reasons", "; ").alias("trigger_reason"),
        F.lit("performance_degradation").alias("trigger_type"),
        F.lit("high").alias("severity"),
    )


def monitoring_report(drifts: DataFrame, performance: DataFrame, triggers: DataFrame) -> DataFrame:
    """Counts and rates per model and version over the append-only tables."""
    keys = ["model_name", "model_version"]
    d = drifts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_drift_checks"), F.count_if("drift_detected").alias("drift_detected_count")
    )
    p = performance.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_performance_checks"),
        F.count_if("threshold_breached").alias("performance_issues_count"),
    )
    t = triggers.groupBy(*keys).agg(F.count(F.lit(1)).alias("retraining_triggers_count"))
    joined = d.join(p, keys, "full").join(t, keys, "full").na.fill(0)
    rate = F.col("drift_detected_count") / F.nullif(F.col("total_drift_checks"), F.lit(0))
    return joined.withColumn("drift_detection_rate", F.coalesce(rate, F.lit(0.0)))
