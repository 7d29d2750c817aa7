"""Registered data quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.operators import quality as q
from encore.registry.analysis import stage
from encore.registry.helpers import AS_OF
from encore.registry.sqlviews import rd, using


def _results(s):
    return q.check_tables(
        {"artists": s.artists(genre=True), "venues": s.venues(), "concerts": s.concerts()}, AS_OF)


def _concert_names(s):
    return s.concerts(prices=True)


def _breaches(s):
    summary = q.quality_summary(_results(s)).select(
        F.concat("data_type", F.lit("_score")).alias("metric"), F.col("overall_score").alias("value"))
    sales = s.sales().agg(
        ((1 - F.count_distinct("sale_id") / F.count(F.lit(1))) * 100).alias("value")
    ).select(F.lit("sale_duplicate_percentage").alias("metric"), "value")
    unique = q.rule_results(
        s.sales(), [q.Rule("sale_id_uniqueness", "uniqueness", "sale_id", 100.0, "critical", "unique")], "sales", AS_OF
    ).select(F.lit("sale_uniqueness_score").alias("metric"), (F.col("score") - 10).alias("value"))
    return q.breaches(summary.unionByName(sales).unionByName(unique))


QUERIES = {
    "e01_completeness_score": stage(lambda s: q.completeness_score(
        s.concerts(), ["concert_id", "artist_id", "total_attendance", "ticket_url"])),
    "e02_sale_uniqueness": stage(lambda s: s.sales().agg(
        q.uniqueness("sale_id", s.sales().schema["sale_id"].dataType).alias("uniqueness"))),
    "e03_attendance_validity": stage(lambda s: s.concerts().agg(q.range_validity(
        "total_attendance", s.concerts().schema["total_attendance"].dataType, 50, 300).alias("validity"))),
    "e04_event_date_validity": stage(lambda s: s.concerts(lines=False).agg(q.date_validity(
        "event_date", s.concerts(lines=False).schema["event_date"].dataType, "1994-06-30").alias("validity"))),
    "e05_coordinate_consistency": stage(lambda s: s.venues().withColumn(
        "longitude", F.when(F.col("longitude") <= 50, F.col("longitude"))).select(
        q.coordinate_consistency(s.venues().schema).alias("consistency"))),
    "e06_revenue_consistency": stage(lambda s: s.concerts().agg(
        q.revenue_consistency(s.concerts().schema).alias("consistency"))),
    "e07_rule_results": stage(_results),
    "e07_quality_summary": stage(lambda s: q.quality_summary(_results(s))),
    "e08_pipeline_status": stage(lambda s: q.pipeline_status(q.quality_summary(_results(s)))),
    "e09_integrity_report": stage(lambda s: q.integrity_report(
        s.concerts(), s.artists(), s.venues(), s.sales())),
    "e09_load_statistics": stage(lambda s: q.load_statistics(
        s.concerts(lines=False), "concerts", "event_date", "event_date").unionByName(q.load_statistics(
            s.sales(), "ticket_sales", "purchase_timestamp", "purchase_timestamp"))),
    "e10_outliers": stage(lambda s: q.outliers(
        s.table("events").select("value", "event_id", "user_id"), ["value", "event_id", "user_id"])),
    "e11_key_nulls": stage(lambda s: q.key_nulls(s.concerts(), "concerts", ["concert_id", "artist_id", "venue_id"])
                           .unionByName(q.key_nulls(s.sales(), "ticket_sales", ["sale_id", "concert_id"]))
                           .unionByName(q.key_nulls(s.artists(), "artists", ["artist_id"]))
                           .unionByName(q.key_nulls(s.venues(), "venues", ["venue_id"]))),
    "e12_critical_fields": stage(lambda s: q.critical_fields({
        "artists": (s.artists(), "name"), "venues": (s.venues(), "capacity"),
        "concerts": (s.concerts(), "total_attendance")})),
    "e13_breaches": stage(_breaches),
    "e14_generated_data_checks": stage(lambda s: q.generated_data_checks(
        s.artists(), s.venues(), _concert_names(s), s.sales())),
}


def _rule(table, data_type, rule_id, kind, column, severity, threshold, score):
    return f"""SELECT '{data_type}' AS data_type, (SELECT count(*) FROM {table}) AS total_records,
        '{rule_id}' AS rule_id, '{kind}' AS rule_type, '{column}' AS column_name, '{severity}' AS severity,
        {threshold}::DOUBLE AS threshold, (SELECT {score} FROM {table}) AS score"""


def _filled(column, text=False):
    test = f"{column} IS NOT NULL" + (f" AND {column} <> ''" if text else "")
    return f"avg(CASE WHEN {test} THEN 1.0::DOUBLE ELSE 0 END) * 100"


def _between(column, low, high):
    return f"avg(CASE WHEN {column} BETWEEN {low} AND {high} THEN 1.0::DOUBLE WHEN {column} IS NOT NULL THEN 0 END) * 100"


_UNIQUE = "count(DISTINCT {0}) * 100.0::DOUBLE / count(*)"
_PER_HEAD = """coalesce(avg(CASE WHEN revenue > 0 AND total_attendance > 0 THEN
    CASE WHEN revenue / total_attendance BETWEEN 10 AND 1000 THEN 1.0::DOUBLE ELSE 0 END END), 1) * 100"""
_ALL = " UNION ALL ".join([
    _rule("artists", "artists", "artist_name_completeness", "completeness", "name", "critical", 95, _filled("name", True)),
    _rule("artists", "artists", "artist_id_uniqueness", "uniqueness", "artist_id", "critical", 100, _UNIQUE.format("artist_id")),
    _rule("artists", "artists", "popularity_score_validity", "validity", "popularity_score", "warning", 90,
          _between("popularity_score", 0, 100)),
    _rule("artists", "artists", "genre_completeness", "completeness", "genre", "warning", 80, _filled("genre")),
    _rule("venues", "venues", "venue_name_completeness", "completeness", "name", "critical", 95, _filled("name", True)),
    _rule("venues", "venues", "venue_id_uniqueness", "uniqueness", "venue_id", "critical", 100, _UNIQUE.format("venue_id")),
    _rule("venues", "venues", "capacity_validity", "validity", "capacity", "warning", 85, _between("capacity", 1, 200000)),
    _rule("venues", "venues", "location_completeness", "completeness", "location.city", "warning", 90, _filled("city", True)),
    _rule("venues", "venues", "coordinates_consistency", "consistency", "location.latitude", "info", 70,
          "avg(CASE WHEN (latitude IS NULL) = (longitude IS NULL) THEN 1.0::DOUBLE ELSE 0 END) * 100"),
    _rule("concerts", "concerts", "concert_id_uniqueness", "uniqueness", "concert_id", "critical", 100,
          _UNIQUE.format("concert_id")),
    _rule("concerts", "concerts", "artist_venue_completeness", "completeness", "artist_id", "critical", 100,
          _filled("artist_id")),
    _rule("concerts", "concerts", "event_date_validity", "validity", "event_date", "critical", 95,
          _between("event_date", "TIMESTAMP '1950-01-01'", f"TIMESTAMP '{AS_OF}' + INTERVAL 5 YEAR")),
    _rule("concerts", "concerts", "attendance_validity", "validity", "total_attendance", "warning", 80,
          _between("total_attendance", 1, 500000)),
    _rule("concerts", "concerts", "revenue_consistency", "consistency", "revenue", "info", 75, _PER_HEAD),
])
_SUMMARY = f"""
    SELECT *, CASE WHEN critical_failures > 0 THEN 'failed' WHEN overall_score < 80 THEN 'warning' ELSE 'passed' END AS status
    FROM (SELECT data_type, sum(score * w) / sum(w) AS overall_score, max(total_records) AS total_records,
                 count(*) AS rules_evaluated, count(CASE WHEN score >= threshold THEN 1 END) AS rules_passed,
                 count(CASE WHEN severity = 'critical' AND score < threshold THEN 1 END) AS critical_failures
          FROM (SELECT *, CASE severity WHEN 'critical' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END AS w FROM ({_ALL}))
          GROUP BY data_type)"""
_THREE = "artists venues concerts"


def _check(name, level, source, violations):
    return f"SELECT '{name}' AS \"check\", '{level}' AS level, (SELECT CAST({violations} AS BIGINT) FROM {source}) AS violations"


ORACLE = {
    "e01_completeness_score": using("concerts", f"""
        SELECT {rd(f"({_filled('concert_id')} + {_filled('artist_id')} + {_filled('total_attendance')} + 0) / 4")}
               AS completeness FROM concerts"""),
    "e02_sale_uniqueness": using("sales", f"SELECT {rd(_UNIQUE.format('sale_id'))} AS uniqueness FROM sales"),
    "e03_attendance_validity": using("concerts", f"""
        SELECT {rd(_between('total_attendance', 50, 300))} AS validity FROM concerts"""),
    "e04_event_date_validity": using("concerts", f"""
        SELECT {rd(_between('event_date', "TIMESTAMP '1950-01-01'", "TIMESTAMP '1999-06-30'"))} AS validity FROM concerts"""),
    "e05_coordinate_consistency": using("venues", f"""
        SELECT {rd("avg(CASE WHEN longitude <= 50 THEN 1.0::DOUBLE ELSE 0 END) * 100")} AS consistency FROM venues"""),
    "e06_revenue_consistency": using("concerts", f"SELECT {rd(_PER_HEAD)} AS consistency FROM concerts"),
    "e07_rule_results": using(_THREE, f"""
        SELECT data_type, total_records, rule_id, rule_type, column_name, severity, threshold,
               {rd('score')} AS score, score >= threshold AS passed FROM ({_ALL})"""),
    "e07_quality_summary": using(_THREE, f"""
        SELECT data_type, {rd('overall_score')} AS overall_score, total_records, rules_evaluated, rules_passed,
               critical_failures, status FROM ({_SUMMARY})"""),
    "e08_pipeline_status": using(_THREE, f"""
        SELECT count(*) AS data_types, CASE max(CASE status WHEN 'failed' THEN 3 WHEN 'warning' THEN 2 ELSE 1 END)
               WHEN 3 THEN 'failed' WHEN 2 THEN 'warning' ELSE 'passed' END AS overall_status FROM ({_SUMMARY})"""),
    "e09_integrity_report": using(f"{_THREE} sales", """
        SELECT 'orphaned_concerts' AS "check", count(*) AS orphans FROM concerts c
            LEFT JOIN artists a ON c.artist_id = a.artist_id LEFT JOIN venues v ON c.venue_id = v.venue_id
            WHERE a.artist_id IS NULL OR v.venue_id IS NULL
        UNION ALL SELECT 'orphaned_concerts_artists', count(*) FROM concerts c
            WHERE NOT EXISTS (SELECT 1 FROM artists a WHERE a.artist_id = c.artist_id)
        UNION ALL SELECT 'orphaned_concerts_venues', count(*) FROM concerts c
            WHERE NOT EXISTS (SELECT 1 FROM venues v WHERE v.venue_id = c.venue_id)
        UNION ALL SELECT 'orphaned_sales', count(*) FROM sales ts
            LEFT JOIN concerts c ON ts.concert_id = c.concert_id WHERE c.concert_id IS NULL"""),
    "e09_load_statistics": using("concerts sales", """
        SELECT 'concerts' AS table_name, count(*) AS total_rows, min(event_date) AS earliest_record,
               max(event_date) AS latest_record, max(event_date) AS last_updated FROM concerts
        UNION ALL SELECT 'ticket_sales', count(*), min(purchase_timestamp), max(purchase_timestamp),
               max(purchase_timestamp) FROM sales"""),
    "e10_outliers": f"""
        WITH long AS (SELECT 'value' AS column_name, value AS v FROM events
                      UNION ALL SELECT 'event_id', event_id FROM events UNION ALL SELECT 'user_id', user_id FROM events),
        st AS (SELECT column_name, avg(v) AS m, stddev(v) AS s, min(v) AS lo, max(v) AS hi, count(v) AS n FROM long GROUP BY 1)
        SELECT st.column_name, count(CASE WHEN abs(v - m) > 3 * s THEN 1 END) AS outlier_count,
               {rd('count(CASE WHEN abs(v - m) > 3 * s THEN 1 END) * 100.0 / n')} AS outlier_percentage,
               {rd('m')} AS mean, {rd('s')} AS stddev, {rd('lo')} AS min, {rd('hi')} AS max
        FROM st JOIN long ON st.column_name = long.column_name GROUP BY st.column_name, m, s, lo, hi, n""",
    "e11_key_nulls": using(f"{_THREE} sales", " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS total_rows, '{k}' AS key_column, "
        f"count(CASE WHEN {k} IS NULL THEN 1 END) AS null_keys FROM {v}"
        for t, v, k in (("concerts", "concerts", "concert_id"), ("concerts", "concerts", "artist_id"),
                        ("concerts", "concerts", "venue_id"), ("ticket_sales", "sales", "sale_id"),
                        ("ticket_sales", "sales", "concert_id"), ("artists", "artists", "artist_id"),
                        ("venues", "venues", "venue_id")))),
    "e12_critical_fields": using(_THREE, f"""
        SELECT total_rows, null_values, {rd('(total_rows - null_values) * 100.0 / total_rows')} AS quality_rate,
               (total_rows - null_values) * 100.0 / total_rows >= 95 AS passed
        FROM (SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(k) AS BIGINT) AS null_values FROM (
            SELECT count(*) AS n, count(*) - count(name) AS k FROM artists
            UNION ALL SELECT count(*), count(*) - count(capacity) FROM venues
            UNION ALL SELECT count(*), count(*) - count(total_attendance) FROM concerts))"""),
    "e13_breaches": using(f"{_THREE} sales", f"""
        WITH m AS (SELECT data_type || '_score' AS metric, overall_score AS value FROM ({_SUMMARY})
                   UNION ALL SELECT 'sale_duplicate_percentage', (1 - count(DISTINCT sale_id)::DOUBLE / count(*)) * 100 FROM sales
                   UNION ALL SELECT 'sale_uniqueness_score', {_UNIQUE.format('sale_id')} - 10 FROM sales)
        SELECT metric, {rd('value')} AS value, CASE WHEN metric LIKE '%score' THEN 'score below limit'
               ELSE 'too many duplicates' END AS reason
        FROM m WHERE (metric LIKE '%score' AND value < 70) OR (metric LIKE '%duplicate_percentage' AND value > 10)"""),
    "e14_generated_data_checks": using(f"{_THREE} sales", " UNION ALL ".join([
        _check("artist_popularity", "issue", "artists", "count(CASE WHEN NOT popularity_score BETWEEN 0 AND 100 THEN 1 END)"),
        _check("few_artists", "warning", "artists", "count(*) < 1000"),
        _check("venue_capacity", "warning", "venues", "count(CASE WHEN NOT capacity BETWEEN 100 AND 200000 THEN 1 END)"),
        _check("few_venues", "warning", "venues", "count(*) < 500"),
        _check("concert_attendance", "warning", "concerts", "count(CASE WHEN total_attendance > 500000 THEN 1 END)"),
        _check("ticket_price", "warning", "concerts",
               "count(CASE WHEN price_general <= 0 OR price_general > 10000 THEN 1 END) "
               "+ count(CASE WHEN price_vip <= 0 OR price_vip > 10000 THEN 1 END)"),
        _check("few_concerts", "warning", "concerts", "count(*) < 10000"),
        _check("sale_quantity", "warning", "sales", "count(CASE WHEN NOT quantity BETWEEN 1 AND 20 THEN 1 END)"),
        _check("sale_total", "issue", "sales",
               "count(CASE WHEN abs(total_amount - quantity * unit_price) > 0.01 THEN 1 END)"),
        _check("few_sales", "warning", "sales", "count(*) < 50000"),
    ])),
}
