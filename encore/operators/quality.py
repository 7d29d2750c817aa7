"""Data quality: rules compiled to one aggregation per table, integrity, outliers, breaches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.numbers import share
from encore.functions.times import as_date

# fixed values: weight of a rule by severity, order of statuses, thresholds
WEIGHTS = {"critical": 3, "warning": 2, "info": 1}
STATUS_ORDER = ("passed", "warning", "failed")
WARNING_BELOW = 80
FIRST_DATE = dt.datetime(1950, 1, 1)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    rule_type: str
    column: str
    threshold: float
    severity: str
    check: str


# fixed values: the rules per data type
RULES: dict[str, tuple[Rule, ...]] = {
    "artists": (
        Rule("artist_name_completeness", "completeness", "name", 95.0, "critical", "complete"),
        Rule("artist_id_uniqueness", "uniqueness", "artist_id", 100.0, "critical", "unique"),
        Rule("popularity_score_validity", "validity", "popularity_score", 90.0, "warning", "range:0:100"),
        Rule("genre_completeness", "completeness", "genre", 80.0, "warning", "complete"),
    ),
    "venues": (
        Rule("venue_name_completeness", "completeness", "name", 95.0, "critical", "complete"),
        Rule("venue_id_uniqueness", "uniqueness", "venue_id", 100.0, "critical", "unique"),
        Rule("capacity_validity", "validity", "capacity", 85.0, "warning", "range:1:200000"),
        Rule("location_completeness", "completeness", "location.city", 90.0, "warning", "complete"),
        Rule("coordinates_consistency", "consistency", "location.latitude", 70.0, "info", "coordinates"),
    ),
    "concerts": (
        Rule("concert_id_uniqueness", "uniqueness", "concert_id", 100.0, "critical", "unique"),
        Rule("artist_venue_completeness", "completeness", "artist_id", 100.0, "critical", "complete"),
        Rule("event_date_validity", "validity", "event_date", 95.0, "critical", "date"),
        Rule("attendance_validity", "validity", "total_attendance", 80.0, "warning", "range:1:500000"),
        Rule("revenue_consistency", "consistency", "revenue", 75.0, "info", "revenue"),
    ),
}


def field_type(schema: T.StructType, path: str) -> T.DataType | None:
    """Type of a dotted column path, or None where the table lacks it."""
    kind: T.DataType = schema
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
            return None
        kind = kind[part].dataType
    return kind


def _percent(part: Column, whole: Column, empty: float) -> Column:
    """100 * part / whole, or ``empty`` when nothing was counted."""
    return F.when(whole == 0, F.lit(empty)).otherwise(share(part, whole) * 100)


def present(column: str, kind: T.DataType) -> Column:
    """Not null, and not blank for text."""
    col = F.col(column)
    return col.isNotNull() & (col != "") if isinstance(kind, T.StringType) else col.isNotNull()


def completeness(column: str, kind: T.DataType | None, empty: float = 100.0) -> Column:
    if kind is None:
        return F.lit(0.0)
    return _percent(F.count_if(present(column, kind)), F.count(F.lit(1)), empty)


def completeness_score(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean completeness of the required columns; a missing column or an empty table counts 0."""
    shares = [completeness(c, field_type(df.schema, c), empty=0.0) for c in columns]
    return df.agg((sum(shares[1:], shares[0]) / len(shares)).alias("completeness"))


def uniqueness(column: str, kind: T.DataType | None) -> Column:
    if kind is None:
        return F.lit(0.0)
    return _percent(F.count_distinct(F.col(column)), F.count(F.lit(1)), 100.0)


def range_validity(column: str, kind: T.DataType | None, low: float, high: float) -> Column:
    """Share of numbers within the range; 100 without any value, 0 without any number."""
    if kind is None:
        return F.lit(0.0)
    number = F.col(column).try_cast("double") if isinstance(kind, T.StringType) else F.col(column).cast("double")
    inside = F.count_if((number >= low) & (number <= high))
    return F.when(F.count(F.col(column)) == 0, F.lit(100.0)).otherwise(_percent(inside, F.count(number), 0.0))


def date_validity(column: str, kind: T.DataType | None, as_of: str) -> Column:
    if kind is None:
        return F.lit(0.0)
    when = F.try_to_timestamp(F.col(column)) if isinstance(kind, T.StringType) else F.col(column)
    when = when.cast("timestamp_ntz")
    day = as_date(as_of)
    last = dt.datetime(day.year + 5, day.month, min(day.day, 28) if day.month == 2 else day.day)
    first, end = (F.lit(d).cast("timestamp_ntz") for d in (FIRST_DATE, last))
    inside = F.count_if((when >= first) & (when <= end))
    return F.when(F.count(F.col(column)) == 0, F.lit(100.0)).otherwise(_percent(inside, F.count(when), 0.0))


def coordinate_consistency(schema: T.StructType) -> Column:
    """Latitude and longitude are both there or both missing (nested in ``location`` or flat)."""
    for prefix in ("location.", ""):
        if field_type(schema, f"{prefix}latitude") is not None:
            pair = F.col(f"{prefix}latitude").isNull() == F.col(f"{prefix}longitude").isNull()
            return _percent(F.count_if(pair), F.count(F.lit(1)), 100.0)
    return F.lit(100.0)


def revenue_consistency(schema: T.StructType) -> Column:
    """Revenue per head between 10 and 1000 where both are positive."""
    if not {"revenue", "total_attendance"} <= set(schema.fieldNames()):
        return F.lit(0.0)
    usable = (F.col("revenue") > 0) & (F.col("total_attendance") > 0)
    per_head = F.when(usable, F.col("revenue") / F.col("total_attendance"))
    return _percent(F.count_if(per_head.between(10, 1000)), F.count(per_head), 100.0)


def rule_score(rule: Rule, schema: T.StructType, as_of: str) -> Column:
    column = rule.column
    if field_type(schema, column) is None and field_type(schema, column.split(".")[-1]) is not None:
        column = column.split(".")[-1]
    kind = field_type(schema, column)
    if rule.check == "complete":
        return completeness(column, kind)
    if rule.check == "unique":
        return uniqueness(column, kind)
    if rule.check.startswith("range:"):
        low, high = (float(x) for x in rule.check.split(":")[1:])
        return range_validity(column, kind, low, high)
    if rule.check == "date":
        return date_validity(column, kind, as_of)
    if rule.check == "coordinates":
        return coordinate_consistency(schema)
    if rule.check == "revenue":
        return revenue_consistency(schema)
    raise ValueError(f"unknown check {rule.check}")


def rule_results(df: DataFrame, rules: Sequence[Rule], data_type: str, as_of: str) -> DataFrame:
    """One row per rule with its score and verdict; all rules share one pass over ``df``."""
    scores = df.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[rule_score(r, df.schema, as_of).cast("double").alias(r.rule_id) for r in rules],
    )
    rows = [
        F.struct(
            F.lit(r.rule_id).alias("rule_id"),
            F.lit(r.rule_type).alias("rule_type"),
            F.lit(r.column).alias("column_name"),
            F.lit(r.severity).alias("severity"),
            F.lit(r.threshold).alias("threshold"),
            F.col(r.rule_id).alias("score"),
            (F.col(r.rule_id) >= r.threshold).alias("passed"),
        )
        for r in rules
    ]
    return scores.select(F.lit(data_type).alias("data_type"), "total_records", F.inline(F.array(*rows)))


def quality_summary(results: DataFrame) -> DataFrame:
    """Weighted score and status per data type."""
    weight = F.when(F.col("severity") == "critical", WEIGHTS["critical"]).when(
        F.col("severity") == "warning", WEIGHTS["warning"]
    ).otherwise(WEIGHTS["info"])
    summary = results.groupBy("data_type").agg(
        (F.sum(F.col("score") * weight) / F.sum(weight)).alias("overall_score"),
        F.max("total_records").alias("total_records"),
        F.count(F.lit(1)).alias("rules_evaluated"),
        F.count_if("passed").alias("rules_passed"),
        F.count_if((F.col("severity") == "critical") & ~F.col("passed")).alias("critical_failures"),
    )
    status = (
        F.when((F.col("critical_failures") > 0) | (F.col("total_records") == 0), "failed")
        .when(F.col("overall_score") < WARNING_BELOW, "warning")
        .otherwise("passed")
    )
    return summary.withColumn("status", status)


def check_tables(tables: Mapping[str, DataFrame], as_of: str) -> DataFrame:
    """Rule results of several data types; unknown types are left out."""
    results = None
    for data_type, df in tables.items():
        if data_type in RULES:
            one = rule_results(df, RULES[data_type], data_type, as_of)
            results = one if results is None else results.unionByName(one)
    if results is None:
        raise ValueError("no known data type")
    return results


def pipeline_status(summary: DataFrame) -> DataFrame:
    """Worst status over the data types."""
    level = F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.col("status"))
    worst = F.element_at(F.array(*[F.lit(s) for s in STATUS_ORDER]), F.max(level).cast("int"))
    return summary.agg(F.count(F.lit(1)).alias("data_types"), worst.alias("overall_status"))


def outliers(df: DataFrame, columns: Sequence[str], width: float = 3.0) -> DataFrame:
    """Values further than ``width`` standard deviations from the mean, one row per numeric column."""
    long = df.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]))
    ).filter(F.col("value").isNotNull())
    stats = long.groupBy("column_name").agg(
        F.avg("value").alias("mean"),
        F.stddev("value").alias("stddev"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count("value").alias("n"),
    ).filter((F.col("n") > 1) & (F.col("stddev") > 0))
    # one row per requested column
    far = F.abs(F.col("value") - F.col("mean")) > width * F.col("stddev")
    counts = long.join(F.broadcast(stats.select("column_name", "mean", "stddev")), "column_name").groupBy(
        "column_name"
    ).agg(F.count_if(far).alias("outlier_count"))
    return stats.join(counts, "column_name").select(
        "column_name", "outlier_count", (F.col("outlier_count") / F.col("n") * 100).alias("outlier_percentage"),
        "mean", "stddev", "min", "max",
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` without a parent, a missing key included."""
    return child.join(parent.select(key), key, "left_anti")


def orphan_count(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Number of orphans; the child is counted per key first, so a hot key is one row in the join."""
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    missing = orphans(per_key, parent, key)
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")).select(F.lit(name).alias("check"), "orphans")


def integrity_report(
    concerts: DataFrame, artists: DataFrame, venues: DataFrame, sales: DataFrame
) -> DataFrame:
    """Orphan counts as (check, orphans) rows; a concert lacking both parents counts once in the first."""
    pairs = concerts.groupBy("artist_id", "venue_id").agg(F.count(F.lit(1)).alias("n"))
    known_artists = artists.select("artist_id").distinct().withColumn("has_artist", F.lit(True))
    known_venues = venues.select("venue_id").distinct().withColumn("has_venue", F.lit(True))
    either = (
        pairs.join(known_artists, "artist_id", "left")
        .join(known_venues, "venue_id", "left")
        .filter(F.col("has_artist").isNull() | F.col("has_venue").isNull())
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))
        .select(F.lit("orphaned_concerts").alias("check"), "orphans")
    )
    return (
        either.unionByName(orphan_count(concerts, artists, "artist_id", "orphaned_concerts_artists"))
        .unionByName(orphan_count(concerts, venues, "venue_id", "orphaned_concerts_venues"))
        .unionByName(orphan_count(sales, concerts, "concert_id", "orphaned_sales"))
    )


def load_statistics(df: DataFrame, table: str, created: str, updated: str) -> DataFrame:
    return df.agg(
        F.lit(table).alias("table_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.min(created).alias("earliest_record"),
        F.max(created).alias("latest_record"),
        F.max(updated).alias("last_updated"),
    )


def key_nulls(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Row count and missing values per key column, one pass per table."""
    counted = df.agg(F.count(F.lit(1)).alias("total_rows"), *[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    rows = [F.struct(F.lit(k).alias("key_column"), F.col(k).alias("null_keys")) for k in keys]
    return counted.select(F.lit(table).alias("table_name"), "total_rows", F.inline(F.array(*rows)))


def critical_fields(fields: Mapping[str, tuple[DataFrame, str]], threshold: float = 95.0) -> DataFrame:
    """Nulls in one critical field per table, over all tables together, against the threshold."""
    counts = None
    for df, column in fields.values():
        one = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(column).isNull()).alias("nulls"))
        counts = one if counts is None else counts.unionByName(one)
    total = counts.agg(F.sum("n").alias("total_rows"), F.sum("nulls").alias("null_values"))
    rate = _percent(F.col("total_rows") - F.col("null_values"), F.col("total_rows"), 0.0)
    return total.withColumn("quality_rate", rate).withColumn("passed", F.col("quality_rate") >= threshold)


def breaches(metrics: DataFrame, low_score: float = 70.0, high_duplicates: float = 10.0) -> DataFrame:
    """Metric rows (metric, value) beyond their limit: scores too low, duplicate shares too high."""
    low = F.col("metric").endswith("score") & (F.col("value") < low_score)
    high = F.col("metric").endswith("duplicate_percentage") & (F.col("value") > high_duplicates)
    return metrics.filter(low | high).withColumn(
        "reason", F.when(low, F.lit("score below limit")).otherwise(F.lit("too many duplicates"))
    )


# fixed values: volumes below which a generated data set is called small
MINIMUM_ROWS = {"artists": 1000, "venues": 500, "concerts": 10000, "ticket_sales": 50000}


def generated_data_checks(
    artists: DataFrame, venues: DataFrame, concerts: DataFrame, sales: DataFrame
) -> DataFrame:
    """Value checks as (check, level, violations) rows; issues make a data set invalid, warnings do not."""
    expected = F.col("quantity") * F.col("unit_price")
    parts = [
        artists.agg(
            F.count_if(~F.col("popularity_score").between(0, 100)).alias("issue:artist_popularity"),
            (F.count(F.lit(1)) < MINIMUM_ROWS["artists"]).cast("bigint").alias("warning:few_artists"),
        ),
        venues.agg(
            F.count_if(~F.col("capacity").between(100, 200000)).alias("warning:venue_capacity"),
            (F.count(F.lit(1)) < MINIMUM_ROWS["venues"]).cast("bigint").alias("warning:few_venues"),
        ),
        concerts.agg(
            F.count_if(F.col("total_attendance") > 500000).alias("warning:concert_attendance"),
            F.sum(
                F.size(F.filter(F.map_values("ticket_prices"), lambda p: ~((p > 0) & (p <= 10000))))
            ).alias("warning:ticket_price"),
            (F.count(F.lit(1)) < MINIMUM_ROWS["concerts"]).cast("bigint").alias("warning:few_concerts"),
        ),
        sales.agg(
            F.count_if(~F.col("quantity").between(1, 20)).alias("warning:sale_quantity"),
            F.count_if(F.abs(F.col("total_amount") - expected) > 0.01).alias("issue:sale_total"),
            (F.count(F.lit(1)) < MINIMUM_ROWS["ticket_sales"]).cast("bigint").alias("warning:few_sales"),
        ),
    ]
    report = None
    for part in parts:
        rows = [
            F.struct(
                F.lit(c.split(":")[1]).alias("check"),
                F.lit(c.split(":")[0]).alias("level"),
                F.col(c).cast("bigint").alias("violations"),
            )
            for c in part.columns
        ]
        one = part.select(F.inline(F.array(*rows)))
        report = one if report is None else report.unionByName(one)
    return report
