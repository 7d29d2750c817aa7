"""Registered cleaning, validation, enrichment and entity resolution queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from encore.functions.text import match_key
from encore.operators import dedupe, enrich, normalize, validate
from encore.registry.analysis import stage
from encore.registry.helpers import AS_OF
from encore.registry.sqlviews import rd
from encore.standin import PAY_TEXTS, STATUS_TEXTS, TIER_TEXTS, VENUE_TEXTS

NOW = dt.datetime(2024, 1, 31, 12, 0)


def _artists(s):
    return normalize.normalize_artists(s.raw_artists()).select(
        "artist_id", "name_normalized", "genres_cleaned", "popularity_score_normalized", "formation_date_parsed",
        "members_cleaned", "data_quality_score")


def _venues(compat):
    def build(s):
        return normalize.normalize_venues(s.raw_venues(), compat_types=compat).select(
            "venue_id", "name_normalized", "venue_type_normalized", "capacity_normalized", "city_normalized",
            "state_normalized", "country_normalized", "latitude_validated", "longitude_validated",
            "amenities_cleaned", "data_quality_score")
    return build


def _concerts(s):
    return normalize.normalize_concerts(s.raw_concerts(), AS_OF).select(
        "concert_id", F.to_date("event_date_validated").alias("event_day"), "status_normalized",
        "total_attendance_validated", "revenue_validated", "data_quality_score")


def _good_shares(s):
    return (
        normalize.good_share(normalize.normalize_artists(s.raw_artists()), "artists")
        .unionByName(normalize.good_share(normalize.normalize_venues(s.raw_venues()), "venues"))
        .unionByName(normalize.good_share(normalize.normalize_concerts(s.raw_concerts(), AS_OF), "concerts")))


def _marked(s, data_type):
    raw = {"artists": s.raw_artists, "venues": s.raw_venues, "concerts": s.raw_concerts, "ticket_sales": s.raw_sales}
    return validate.mark(raw[data_type](), data_type, AS_OF)


def _errors(data_type):
    return stage(lambda s: validate.error_counts(_marked(s, data_type)))


def _reports(s):
    return validate.report_types({
        "artists": s.raw_artists(), "venues": s.raw_venues(), "concerts": s.raw_concerts(),
        "ticket_sales": s.raw_sales()}, AS_OF)


def _valid_venues(s):
    valid, _ = validate.split(s.raw_venues(), "venues", AS_OF)
    return valid.select("venue_id", "name", "city", "state", "country", "capacity", "venue_type")


def _name_duplicates(s):
    return dedupe.find_duplicates(s.names(), ["name"], "id", dedupe.THRESHOLDS["artists"])


def _two_column_duplicates(s):
    rows = s.table("part").select("p_partkey", F.concat(F.lit("The "), "p_name", F.lit(" Inc.")).alias("name"), "p_brand")
    return dedupe.find_duplicates(rows, ["name", "p_brand"], "p_partkey", dedupe.THRESHOLDS["artists"], first_chunk=200)


def _duplicate_metrics(s):
    _, found = dedupe.deduplicate(s.names(), ["name"], "id", dedupe.THRESHOLDS["artists"])
    return dedupe.duplicate_metrics(s.names(), found, "part")


def _without_duplicates(s):
    kept, _ = dedupe.deduplicate(s.names(), ["name"], "id", dedupe.THRESHOLDS["artists"])
    return kept


def _enriched_artists(s):
    return enrich.enrich_artists(s.artists().select("artist_id", "name"), s.landed_artists(), NOW)


def _enriched_venues(s):
    return enrich.enrich_venues(s.venues().select("venue_id", "name", "city"), s.landed_venues(), NOW)


def _artist_events(s):
    events = s.concerts().select(
        "artist_id", "event_date", F.col("concert_id").alias("event_id"),
        F.concat(F.lit("Night at "), F.col("venue_id").cast("string")).alias("event_name"))
    return enrich.events_of_artists(s.artists().select("artist_id", "name"), events, venue_text="At 1")


QUERIES = {
    "b01_normalize_artists": stage(_artists),
    "b02_normalize_venues": stage(_venues(False)),
    "b02_normalize_venues_chained_types": stage(_venues(True)),
    "b03_normalize_concerts": stage(_concerts),
    "b04_good_shares": stage(_good_shares),
    "b05_artist_violations": _errors("artists"),
    "b06_venue_violations": _errors("venues"),
    "b07_concert_violations": _errors("concerts"),
    "b08_sale_violations": _errors("ticket_sales"),
    "b09_valid_venues": stage(_valid_venues),
    "b10_upload_reports": stage(_reports),
    "b11_match_keys": stage(lambda s: s.raw_venues().select("venue_id", match_key(F.col("name")).alias("match_key"))),
    "b13_enriched_artists": stage(_enriched_artists),
    "b13_enriched_venues": stage(_enriched_venues),
    "b14_artist_events": stage(_artist_events),
    "f03_name_duplicates": stage(_name_duplicates),
    "f03_two_column_duplicates": stage(_two_column_duplicates),
    "f04_without_duplicates": stage(_without_duplicates),
    "f05_duplicate_metrics": stage(_duplicate_metrics),
}


def _pick(words, index):
    listed = ", ".join(f"'{w}'" for w in words)
    return f"[{listed}][{index} + 1]"


_RAW_ARTISTS = """
    SELECT CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE 'art_' || p_partkey END AS artist_id,
           CASE WHEN p_partkey % 37 = 0 THEN '' WHEN p_partkey % 7 = 0 THEN ' ' || p_name || '!* '
                ELSE array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN string_split(p_name, ' ')], ' ') END AS name,
           CASE p_partkey % 5 WHEN 0 THEN p_type || ' / ' || p_brand WHEN 1 THEN p_type || '; ,' || p_brand
                WHEN 2 THEN NULL ELSE p_brand || '|' || p_type END AS genre,
           CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_size * 3.0::DOUBLE - 20 END AS popularity_score,
           CASE WHEN p_partkey % 13 = 0 THEN 'unknown'
                ELSE (1950 + p_partkey % 50) || '-0' || (1 + p_partkey % 9) || '-15' END AS formation_date,
           p_brand, p_type
    FROM part"""
_ARTISTS = f"""
    SELECT *, (CASE WHEN name <> '' AND artist_id IS NOT NULL THEN 25 + CASE WHEN len(genres) > 0 THEN 25 ELSE 0 END
               + CASE WHEN popularity_score IS NOT NULL THEN 25 ELSE 0 END
               + CASE WHEN day IS NOT NULL THEN 25 ELSE 0 END ELSE 0 END)::BIGINT AS score
    FROM (SELECT *, [trim(g) FOR g IN string_split(lower(regexp_replace(genre, '[,;/|]', ',', 'g')), ',') IF trim(g) <> ''] AS genres,
                 TRY_CAST(formation_date AS DATE) AS day FROM ({_RAW_ARTISTS}))"""
_RAW_VENUES = f"""
    SELECT 'ven_' || c_custkey AS venue_id,
           CASE WHEN c_custkey % 31 = 0 THEN '  ' ELSE 'The ' || c_name || ' Inc.' END AS name,
           CASE WHEN c_custkey % 23 = 0 THEN '' ELSE ' City. ' || c_nationkey END AS city,
           ' s' || (c_custkey % 50) || ' ' AS state, CASE WHEN c_custkey % 29 = 0 THEN 'x' ELSE 'usa' END AS country,
           c_nationkey * 9.0::DOUBLE - 100 AS latitude,
           CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE (c_custkey % 500 - 250)::DOUBLE END AS longitude,
           CAST(floor(c_acctbal * 25) AS INTEGER) AS capacity,
           {_pick(VENUE_TEXTS, f'c_custkey % {len(VENUE_TEXTS)}')} AS venue_type, c_mktsegment
    FROM customer"""


def _venue_sql(kinds):
    return f"""
    SELECT venue_id, name_normalized, venue_type_normalized, capacity_normalized, city_normalized, state_normalized,
           country_normalized, latitude_validated, longitude_validated, amenities_cleaned,
           CASE WHEN name = '' THEN 0 ELSE 20 + CASE WHEN capacity_normalized IS NOT NULL THEN 20 ELSE 0 END
               + CASE WHEN city_normalized <> '' THEN 20 ELSE 0 END + 20
               + CASE WHEN latitude_validated IS NOT NULL AND longitude_validated IS NOT NULL THEN 20 ELSE 0 END
           END::BIGINT AS data_quality_score
    FROM (SELECT venue_id, name, trim(regexp_replace(name, '[^A-Za-z0-9_\\s&''-]', '', 'g')) AS name_normalized,
                 {kinds} AS venue_type_normalized,
                 CASE WHEN capacity > 0 AND capacity <= 200000 THEN CAST(capacity AS BIGINT) END AS capacity_normalized,
                 trim(regexp_replace(city, '[^A-Za-z0-9_\\s''-]', '', 'g')) AS city_normalized,
                 upper(trim(state)) AS state_normalized, upper(trim(country)) AS country_normalized,
                 CASE WHEN latitude BETWEEN -90 AND 90 THEN latitude END AS latitude_validated,
                 CASE WHEN longitude BETWEEN -180 AND 180 THEN longitude END AS longitude_validated,
                 'parking|' || lower(c_mktsegment) AS amenities_cleaned
          FROM ({_RAW_VENUES}))"""


def _kinds(amphitheatre):
    return f"""CASE venue_type WHEN 'Sports ARENA' THEN 'arena' WHEN 'Amphitheatre ' THEN '{amphitheatre}'
        WHEN 'dance club' THEN 'club' WHEN 'Old Theater' THEN 'theater' WHEN 'Town Hall' THEN 'hall'
        ELSE lower(trim(venue_type)) END"""


_RAW_CONCERTS = f"""
    SELECT 'con_' || o_orderkey AS concert_id,
           CASE WHEN o_orderkey % 9 = 0 THEN '' WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'art_' || (o_orderkey % 200) END AS artist_id,
           'ven_' || o_custkey AS venue_id,
           CASE WHEN o_orderkey % 47 = 0 THEN NULL
                ELSE o_orderdate - to_years(CASE WHEN o_orderkey % 53 = 0 THEN 70 ELSE 0 END) END AS event_date,
           o_totalprice / 45 AS p1, o_totalprice / 30 - 50 AS p2,
           CAST(floor(o_totalprice * 1.2::DOUBLE - 40000) AS INTEGER) AS total_attendance,
           o_totalprice * 250 - 10000000 AS revenue,
           {_pick(STATUS_TEXTS, f'o_orderkey % {len(STATUS_TEXTS)}')} AS status
    FROM orders"""
_CONCERTS = f"""
    SELECT concert_id, CASE WHEN year(event_date) BETWEEN 1951 AND 2006 THEN CAST(event_date AS DATE) END AS event_day,
           CASE lower(trim(status)) WHEN 'confirmed' THEN 'scheduled' WHEN 'finished' THEN 'completed'
                WHEN 'canceled' THEN 'cancelled' WHEN 'rescheduled' THEN 'postponed' ELSE lower(trim(status)) END AS status_normalized,
           CASE WHEN total_attendance BETWEEN 0 AND 500000 THEN CAST(total_attendance AS BIGINT) END AS total_attendance_validated,
           {rd('CASE WHEN revenue BETWEEN 0 AND 100000000 THEN revenue END')} AS revenue_validated,
           CASE WHEN coalesce(artist_id, '') = '' THEN 0
                ELSE 75 + CASE WHEN year(event_date) BETWEEN 1951 AND 2006 THEN 25 ELSE 0 END END::BIGINT AS data_quality_score
    FROM ({_RAW_CONCERTS})"""
_RAW_SALES = f"""
    SELECT l_orderkey || '-' || l_linenumber AS sale_id, CASE WHEN l_suppkey % 19 = 0 THEN NULL ELSE l_suppkey END AS customer_id,
           {_pick(TIER_TEXTS, f'l_partkey % {len(TIER_TEXTS)}')} AS ticket_tier, CAST(l_quantity AS INTEGER) AS quantity,
           l_extendedprice / l_quantity / 10 AS unit_price,
           l_extendedprice / 10 + CASE WHEN l_linenumber = 3 THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS total_price,
           l_shipdate AS purchase_timestamp, {_pick(PAY_TEXTS, '(l_linenumber - 1)')} AS payment_method
    FROM lineitem"""

_CHECKS = {
    "artists": (_RAW_ARTISTS, {
        "artist_id missing": "artist_id IS NULL",
        "name empty": "trim(name) = ''",
        "popularity_score out of range": "NOT popularity_score BETWEEN 0 AND 100",
        "formation_date not a date": "formation_date = 'unknown'",
    }),
    "venues": (_RAW_VENUES, {
        "name empty": "trim(name) = ''",
        "city empty": "trim(city) = ''",
        "country length": "length(country) < 2",
        "capacity not positive": "capacity <= 0",
        "capacity too large": "capacity > 200000",
        "venue_type unknown": "lower(venue_type) NOT IN ('arena', 'stadium', 'theater', 'club', 'amphitheater', 'hall', 'other')",
    }),
    "concerts": (_RAW_CONCERTS, {
        "artist_id missing": "artist_id IS NULL",
        "event_date missing": "event_date IS NULL",
        "event_date too far in the past": "year(event_date) < 1951",
        "ticket price invalid": "p1 < 0 OR p2 < 0",
        "ticket price too high": "p1 > 10000 OR p2 > 10000",
        "total_attendance negative": "total_attendance < 0",
        "total_attendance too large": "total_attendance > 500000",
        "revenue negative": "revenue < 0",
        "status unknown": "lower(status) NOT IN ('scheduled', 'completed', 'cancelled', 'postponed')",
    }),
    "ticket_sales": (_RAW_SALES, {
        "customer_id missing": "customer_id IS NULL",
        "ticket_tier unknown": "ticket_tier = 'balcony'",
        "quantity out of range": "NOT quantity BETWEEN 1 AND 20",
        "unit_price out of range": "unit_price <= 0 OR unit_price > 10000",
        "total_price out of range": "total_price <= 0 OR total_price > 10000",
        "total_price does not match": "abs(total_price - quantity * unit_price) > 0.01",
        "purchase_timestamp in the future": f"purchase_timestamp > DATE '{AS_OF}'",
        "payment_method unknown": "payment_method = 'cheque'",
    }),
}


def _error_sql(data_type):
    raw, checks = _CHECKS[data_type]
    return f"WITH r AS ({raw}) SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{name}' AS error, count(*) AS rows FROM r WHERE {test}" for name, test in checks.items()
    ) + ") WHERE rows > 0"


def _report_sql(data_type):
    raw, checks = _CHECKS[data_type]
    bad = " OR ".join(f"coalesce({t}, FALSE)" for t in checks.values())
    return f"""SELECT '{data_type}' AS data_type, count(*) AS records_processed,
        count(CASE WHEN NOT ({bad}) THEN 1 END) AS records_successful, count(CASE WHEN {bad} THEN 1 END) AS records_failed,
        {rd(f'count(CASE WHEN NOT ({bad}) THEN 1 END)::DOUBLE / count(*)')} AS validation_rate,
        count(CASE WHEN {bad} THEN 1 END) = 0 AS success FROM ({raw})"""


def _share_sql(data_type, source, column, limit):
    return f"""SELECT '{data_type}_quality_score' AS metric,
        {rd(f'avg(CASE WHEN {column} >= {limit} THEN 1.0::DOUBLE ELSE 0 END) * 100')} AS value FROM ({source})"""


_BAD_VENUE = " OR ".join(f"coalesce({t}, FALSE)" for t in _CHECKS["venues"][1].values())
ORACLE = {
    "b01_normalize_artists": f"""
        SELECT artist_id, trim(regexp_replace(name, '[^A-Za-z0-9_\\s&''-]', '', 'g')) AS name_normalized,
               coalesce(array_to_string(genres, '|'), '') AS genres_cleaned,
               least(greatest(coalesce(popularity_score, 0), 0), 100) AS popularity_score_normalized,
               day AS formation_date_parsed, p_brand || '|' || p_type AS members_cleaned, score AS data_quality_score
        FROM ({_ARTISTS})""",
    "b02_normalize_venues": _venue_sql(_kinds("amphitheater")),
    "b02_normalize_venues_chained_types": _venue_sql(_kinds("theater")),
    "b03_normalize_concerts": _CONCERTS,
    "b04_good_shares": " UNION ALL ".join([
        _share_sql("artists", _ARTISTS, "score", 75),
        _share_sql("venues", _venue_sql(_kinds("amphitheater")), "data_quality_score", 80),
        _share_sql("concerts", _CONCERTS, "data_quality_score", 75)]),
    "b05_artist_violations": _error_sql("artists"),
    "b06_venue_violations": _error_sql("venues"),
    "b07_concert_violations": _error_sql("concerts"),
    "b08_sale_violations": _error_sql("ticket_sales"),
    "b09_valid_venues": f"""
        SELECT venue_id, trim(name) AS name, trim(city) AS city, trim(state) AS state, trim(country) AS country,
               CAST(capacity AS BIGINT) AS capacity, lower(venue_type) AS venue_type
        FROM ({_RAW_VENUES}) WHERE NOT ({_BAD_VENUE})""",
    "b10_upload_reports": " UNION ALL ".join(_report_sql(t) for t in _CHECKS),
    "b11_match_keys": f"""
        SELECT venue_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(name)),
               '^(the|a|an)\\s+', ''), '\\s+(inc|llc|ltd|corp|corporation)\\.?$', ''), '[^a-z0-9_\\s]', ' ', 'g'),
               '\\s+', ' ', 'g')) AS match_key FROM ({_RAW_VENUES})""",
    "b13_enriched_artists": f"""
        SELECT s_suppkey AS artist_id, CASE WHEN hit THEN 'ext ' || s_name ELSE s_name END AS name,
               CASE WHEN hit THEN 'genre' || (s_suppkey % 3) ELSE '' END AS genre,
               {rd('CASE WHEN hit THEN abs(s_acctbal) / 110 ELSE 50 END')} AS popularity_score,
               CASE WHEN hit AND s_suppkey % 5 = 0 THEN 'external' WHEN hit THEN 'cache' ELSE 'local_fallback' END AS source
        FROM (SELECT *, s_suppkey % 2 = 0 AND (s_suppkey % 5) * 30 <= 60 AS hit FROM supplier)""",
    "b13_enriched_venues": """
        SELECT c_custkey AS venue_id, CASE WHEN hit THEN 'ext ' || c_name ELSE c_name END AS name,
               CASE WHEN hit THEN 'City ' || c_nationkey ELSE n_name END AS city,
               CASE WHEN hit THEN 'US' ELSE '' END AS country,
               CASE WHEN hit THEN c_custkey % 900 + 100 ELSE 1000 END AS capacity,
               CASE WHEN hit THEN 'club' ELSE 'other' END AS venue_type,
               CASE WHEN hit AND c_custkey % 4 = 0 THEN 'external' WHEN hit THEN 'cache' ELSE 'local_fallback' END AS source
        FROM (SELECT *, c_custkey % 3 = 0 AND (c_custkey % 4) * 25 <= 60 AS hit FROM customer)
             LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "b14_artist_events": """
        WITH e AS (SELECT min(l_suppkey) AS artist_id, o_orderkey, o_orderdate, o_custkey
                   FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderdate, o_custkey),
        f AS (SELECT * FROM e WHERE lower('Night at ' || o_custkey) LIKE '%at 1%')
        SELECT s_suppkey AS artist_id, s_name AS name, count(f.o_orderkey) AS event_count,
               (SELECT o_orderkey FROM f g WHERE g.artist_id = s_suppkey ORDER BY o_orderdate, o_orderkey LIMIT 1) AS first_event_id,
               CASE WHEN count(f.o_orderkey) > 0 THEN 'external' ELSE 'local_fallback' END AS source
        FROM supplier LEFT JOIN f ON f.artist_id = s_suppkey GROUP BY s_suppkey, s_name""",
}
