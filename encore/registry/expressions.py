"""Registered scalar expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.functions import similarity as sm
from encore.functions import times as tm
from encore.functions.text import fuzzy_similarity, match_key
from encore.operators.enrich import request_key
from encore.plans.analysis import random_rows
from encore.plans.features import parse_prices, price_features
from encore.registry.analysis import stage
from encore.registry.sqlviews import rd, using
from encore.session import shuffle_partitions


def _dates(s):
    when = F.col("event_date")
    return s.concerts(lines=False).select(
        "concert_id", F.weekday(when).alias("weekday"), tm.is_weekend(when).alias("weekend"), tm.season(when).alias("season"),
        tm.period_start("quarter", when).alias("quarter_start"),
        tm.period_end("quarter", tm.period_start("quarter", when)).alias("quarter_end"),
        tm.month_span(F.lit("1995-01-31").cast("date"), when).alias("months"))


def _prices(s):
    text = F.to_json("ticket_prices")
    return s.concerts(lines=False, prices=True).select(
        "concert_id", *[c.alias(n) for n, c in price_features(parse_prices(text)).items()])


def _distances(s):
    here = [F.lit(5.0), F.lit(10.0)]
    far = sm.distance_km(F.col("latitude"), F.col("longitude"), *here)
    return s.venues().select(
        "venue_id", far.alias("km"), sm.capacity_similarity(F.col("capacity"), F.lit(250)).alias("capacity_similarity"))


def _genres(s):
    mine = F.array(F.lit("Promo"), F.lit("large"))
    return s.artists(genre=True).select(
        "artist_id", sm.genre_similarity(F.col("genre"), mine).alias("genre_similarity"),
        sm.popularity_similarity(F.col("popularity_score"), F.lit(40.0)).alias("popularity_similarity"))


def _fuzzy(s):
    """How close each customer's name is to the name of its nation."""
    nations = s.table("nation").select("n_nationkey", "n_name")
    # the scores cost far more than the bytes of the names tell, so few files are dealt over all tasks
    customers = s.table("customer").repartition(shuffle_partitions(s.spark))
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", (fuzzy_similarity(match_key(F.col("n_name")), match_key(F.concat("n_name", F.lit(" Inc.")))) == 1).alias("same"),
        fuzzy_similarity(match_key(F.col("c_name")), F.lit("")).alias("blank"),
        # letters that occur nowhere else in place of the last ones: all others stay in common, in the same order
        *[fuzzy_similarity(match_key(F.col("c_name")), F.concat(F.expr(f"left(replace(lower(c_name), '#', ' '), length(c_name) - {n})"), F.lit("z" * n)))
          .alias(f"without_{n}") for n in (1, 4)])


QUERIES = {
    "l03_random_rows": stage(lambda s: random_rows(s.table("orders").select("o_orderkey"), 100, "o_orderkey")),
    "x09_x12_dates": stage(_dates),
    "x13_x14_prices": stage(_prices),
    "x16_x17_artist_closeness": stage(_genres),
    "x18_x19_venue_closeness": stage(_distances),
    "x21_fuzzy_scores": stage(_fuzzy),
    "x24_request_keys": stage(lambda s: s.table("supplier").select(
        "s_suppkey", request_key("artist", "s_name", "s_nationkey").alias("request_key"))),
}
ORACLE = {
    "l03_random_rows": "SELECT o_orderkey FROM orders ORDER BY md5(o_orderkey || ':42'), o_orderkey LIMIT 100",
    "x09_x12_dates": using("concerts", """
        SELECT concert_id, isodow(event_date) - 1 AS weekday, isodow(event_date) >= 6 AS weekend,
               CASE WHEN month(event_date) IN (12, 1, 2) THEN 1 WHEN month(event_date) <= 5 THEN 2
                    WHEN month(event_date) <= 8 THEN 3 ELSE 4 END AS season,
               CAST(date_trunc('quarter', event_date) AS DATE) AS quarter_start,
               CAST(date_trunc('quarter', event_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
               date_diff('month', DATE '1995-01-31', event_date) AS months FROM concerts"""),
    "x13_x14_prices": using("concerts", f"""
        SELECT concert_id, {rd('(price_general + price_vip) / 2')} AS avg_ticket_price, {rd('price_vip - price_general')} AS price_range,
               price_general AS lowest_price, price_vip AS highest_price FROM concerts"""),
    "x16_x17_artist_closeness": using("artists", f"""
        SELECT artist_id, {rd('''CASE WHEN len(genre) > 0 THEN len(list_intersect(genre, ['promo', 'large']))::DOUBLE
               / len(list_distinct(list_concat(genre, ['promo', 'large']))) ELSE 0 END''')} AS genre_similarity,
               {rd('1 - abs(popularity_score - 40) / 100')} AS popularity_similarity FROM artists"""),
    "x18_x19_venue_closeness": using("venues", f"""
        SELECT venue_id, {rd('''2 * 6371::DOUBLE * asin(sqrt(least(1, sin(radians(5.0 - latitude) / 2) ** 2
               + cos(radians(latitude)) * cos(radians(5.0)) * sin(radians(10.0 - longitude) / 2) ** 2)))''')} AS km,
               {rd('greatest(1 - abs(log10(capacity) - log10(250)) / 3, 0)')} AS capacity_similarity FROM venues"""),
    "x21_fuzzy_scores": """SELECT c_custkey, TRUE AS same, 0.0::DOUBLE AS blank, round(100.0 * (length(c_name) - 1) / length(c_name)) / 100 AS without_1,
        round(100.0 * (length(c_name) - 4) / length(c_name)) / 100 AS without_4 FROM customer""",
    "x24_request_keys": "SELECT s_suppkey, md5('artist:' || s_name || ':' || s_nationkey) AS request_key FROM supplier",
}
