"""Registered stream queries: each runs a stream once over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.registry.analysis import stage
from encore.registry.helpers import AS_OF
from encore.registry.sqlviews import rd
from encore.standin import Stage
from encore.streaming import envelope as en
from encore.streaming import pipeline as pl

EVENT_TYPES = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _event_stream(s: Stage):
    return s.spark.readStream.schema(EVENT_TYPES).option("pathGlobFilter", "events.parquet").parquet(s.folder)


def _kind(event_type):
    return (F.when(event_type == "purchase", "ticket_sales").when(event_type == "view", "concerts")
            .when(event_type == "click", "artists").when(event_type == "signup", "venues").otherwise("errors"))


def _wire(events):
    """Events as stream values, in the three layouts and with broken ones among them."""
    key = F.col("event_id")
    concert = F.get_json_object("props", "$.k")
    payload = F.to_json(F.struct(
        F.concat(F.lit("sale_"), key.cast("string")).alias("sale_id"),
        F.when(key % 7 != 0, concert).alias("concert_id"), F.concat(F.lit("ev_"), key.cast("string")).alias("event_id"),
        F.concat(F.lit("art_"), F.col("user_id").cast("string")).alias("artist_id"),
        F.concat(F.lit("ven_"), F.col("user_id").cast("string")).alias("venue_id"),
        F.concat(F.lit(" Name "), key.cast("string"), F.lit(" ")).alias("name"),
        F.when(key % 5 != 0, F.col("value")).alias("unit_price"), F.when(key % 4 != 0, F.lit("2")).alias("quantity"),
        (F.col("value") * 2).alias("total_price"), F.when(key % 3 == 0, F.lit("rock")).alias("genre"),
        F.when(key % 2 == 0, F.lit("x9")).otherwise(F.lit("700")).alias("capacity"),
    ))
    head = F.to_json(F.struct(
        F.when(key % 17 != 0, F.concat(F.lit("rec_"), key.cast("string"))).alias("record_id"), F.lit("test").alias("source"),
        F.when(key % 11 != 0, _kind(F.col("event_type"))).alias("data_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ingestion_timestamp")))
    open_head = F.regexp_replace(head, r"\}$", ",")
    bare = F.concat(open_head, F.lit('"payload":'), payload, F.lit("}"))
    value = (F.when(key % 13 == 0, F.lit("{broken")).when(key % 3 == 0, F.concat(F.lit('{"timestamp":"t","data":'), bare, F.lit("}")))
             .when(key % 3 == 1, bare).otherwise(F.concat(open_head, F.regexp_replace(payload, r"^\{", ""))))
    return events.select(value.alias("value"))


def _parsed(s):
    return en.parse(_wire(s.table("events")))


def _good(s, *kinds):
    return _parsed(s).filter(F.col("problem").isNull() & F.col("data_type").isin(*kinds))


def _envelopes(s):
    rows = s.table("events").select(
        F.col("event_id"), F.get_json_object("props", "$.k").alias("concert_id"), F.col("ts"))
    made = en.envelopes(rows, "ticket_sales", "replay", F.col("ts"))
    return made.select(
        "key", F.get_json_object("value", "$.record_id").alias("record_id"),
        F.get_json_object("value", "$.data_type").alias("data_type"),
        F.get_json_object("value", "$.payload.event_id").cast("bigint").alias("event_id"))


def _routed(s):
    folder = pl.scratch_folder(s.spark, "routed")
    pl.start_router(_wire(_event_stream(s)), folder, f"{folder}/checkpoint", available_now=True).awaitTermination()
    return s.spark.read.parquet(f"{folder}/counts").groupBy("outcome").agg(F.sum("records").alias("records"))


def _sales_of(events):
    return events.filter("event_type = 'purchase'").select(
        F.col("ts").alias("purchase_timestamp"), F.get_json_object("props", "$.k").cast("bigint").alias("concert_id"),
        F.lit(1).alias("quantity"), F.col("value").alias("total_price"))


def _sales_stream(s):
    return _sales_of(_event_stream(s))


def _windows(length, slide=None):
    return stage(lambda s: pl.run_available(
        pl.sales_windows(_sales_stream(s), "purchase_timestamp", "concert_id", length, slide), "windows"))


def _all_windows(length, slide=None):
    """The earlier half of the events arrives and is run over, then the later half; all windows, open ones too."""
    def build(s):
        folder = pl.scratch_folder(s.spark, "window-table")
        events = s.table("events").select("event_id", "ts", "user_id", "event_type", "value", "props")
        middle = events.agg(F.expr("timestampadd(SECOND, timestampdiff(SECOND, min(ts), max(ts)) div 2, min(ts))").alias("m"))
        late = F.col("ts") >= middle.scalar()
        for part in (~late, late):
            events.filter(part).write.mode("append").parquet(f"{folder}/in")
            stream = s.spark.readStream.schema(EVENT_TYPES).parquet(f"{folder}/in")
            pl.run_windows(pl.sales_windows(_sales_of(stream), "purchase_timestamp", "concert_id", length, slide), folder)
        return pl.current_windows(s.spark, folder)

    return stage(build)


def _deduplicated(s):
    doubled = _wire(_event_stream(s)).withColumn("value", F.explode(F.array("value", "value")))
    found = pl.deduplicated(en.parse(doubled).filter("problem IS NULL"))
    return pl.run_available(found.select("record_id", "data_type"), "deduplicated").groupBy("data_type").agg(
        F.count(F.lit(1)).alias("records"))


def _quality(s):
    folder = pl.scratch_folder(s.spark, "quality")
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_totalprice", T.DoubleType())])
    orders = s.spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(s.folder)
    concerts = orders.select(
        F.col("o_orderkey").alias("concert_id"), F.when(F.col("o_custkey") % 9 != 0, F.col("o_custkey")).alias("artist_id"),
        F.col("o_orderdate").alias("event_date"), (F.col("o_totalprice") / 100 - 50).cast("int").alias("total_attendance"),
        F.col("o_totalprice").alias("revenue"))
    pl.run_batches(concerts, pl.quality_batch(f"{folder}/out", "concerts", AS_OF), f"{folder}/checkpoint")
    return s.spark.read.parquet(f"{folder}/out").drop("batch_id")


def _replayed(s):
    """Records as envelope lines of one stamp, each twice, in a landing folder, read back once by the file stream."""
    folder = pl.scratch_folder(s.spark, "landing")
    rows = s.table("supplier").select(F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("name"))
    made = en.envelopes(rows, "artists", "replay", F.lit("2024-01-31 00:00:00").cast("timestamp")).select("value")
    made.unionByName(made).write.text(f"{folder}/in")
    found = pl.deduplicated(en.parse(pl.file_stream(s.spark, f"{folder}/in")).filter("problem IS NULL"))
    out = en.process_artists(found)
    return pl.run_available(out.select("artist_id", "name", "popularity_score", "source"), "replayed")


def _decoded(s):
    """The stream values as base64 records, decoded and parsed."""
    raw = _wire(s.table("events")).select(F.base64(F.encode("value", "UTF-8")).alias("data"))
    return en.parse(en.decode(raw)).groupBy("data_type", "problem").agg(F.count(F.lit(1)).alias("records"))


QUERIES = {
    "x22_decoded_records": stage(_decoded),
    "s01_envelopes": stage(_envelopes),
    "s02_s03_parsed_records": stage(lambda s: _parsed(s).groupBy("data_type", "problem").agg(F.count(F.lit(1)).alias("records"))),
    "s04_artist_payloads": stage(lambda s: en.process_artists(_good(s, "artists")).select(
        "artist_id", "name", "genres", "popularity_score", "followers")),
    "s05_venue_payloads": stage(lambda s: en.process_venues(_good(s, "venues")).select(
        "venue_id", "name", F.col("location.city").alias("city"), "capacity", "venue_type")),
    "s06_concert_payloads": stage(lambda s: en.process_concerts(_good(s, "concerts", "events")).select(
        "concert_id", "artist_id", "status", "total_attendance")),
    "s07_sale_payloads": stage(lambda s: en.process_sales(_good(s, "ticket_sales")).select(
        "sale_id", "concert_id", "quantity", "unit_price", "total_price", "price_tier")),
    "s08_routed_counts": stage(_routed),
    "s08_deduplicated_counts": stage(_deduplicated),
    "s10_replayed_artists": stage(_replayed),
    "s11_hourly_sales": _windows("1 hour"),
    "s11_sliding_sales": _windows("6 hours", "2 hours"),
    "s11_all_hourly_sales": _all_windows("1 hour"),
    "s11_all_sliding_sales": _all_windows("6 hours", "2 hours"),
    "s12_batch_quality": stage(_quality),
}

_KIND = "CASE event_type WHEN 'purchase' THEN 'ticket_sales' WHEN 'view' THEN 'concerts' WHEN 'click' THEN 'artists' " \
        "WHEN 'signup' THEN 'venues' ELSE 'errors' END"
_OUTCOME = f"""SELECT *, CASE WHEN event_id % 13 <> 0 AND event_id % 11 <> 0 THEN {_KIND} END AS data_type,
    CASE WHEN event_id % 13 = 0 THEN 'not a record'
         WHEN event_id % 11 = 0 THEN 'missing data_type' WHEN event_type = 'error' THEN 'unknown data type' END AS problem FROM events"""


def _good_sql(kind, columns):
    return f"SELECT {columns} FROM ({_OUTCOME}) WHERE problem IS NULL AND data_type = '{kind}'"


def _window_sql(starts, length, closed=True):
    over = f"window_start + INTERVAL {length} HOUR <= (SELECT max(ts) FROM events WHERE event_type = 'purchase') - INTERVAL 10 MINUTE"
    return f"""SELECT window_start, window_start + INTERVAL {length} HOUR AS window_end, concert_id, count(*) AS sales,
        count(*) AS tickets, {rd('sum(value)')} AS revenue
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS concert_id, {starts} AS window_start
          FROM events WHERE event_type = 'purchase')
    WHERE {over if closed else 'TRUE'} GROUP BY 1, 2, 3"""


_RULE = "avg(CASE WHEN {0} THEN 1.0::DOUBLE WHEN {1} THEN 0 END) * 100"
ORACLE = {
    "s01_envelopes": """
        SELECT 'ticket_' || json_extract_string(props, '$.k') AS key,
               'replay_ticket_sales_' || epoch_us(ts) || '_' || substr(md5('{"event_id":' || event_id || ',"concert_id":"'
                   || json_extract_string(props, '$.k') || '","ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '"}'), 1, 16) AS record_id,
               'ticket_sales' AS data_type, event_id FROM events""",
    "x22_decoded_records": f"SELECT data_type, problem, count(*) AS records FROM ({_OUTCOME}) GROUP BY 1, 2",
    "s02_s03_parsed_records": f"SELECT data_type, problem, count(*) AS records FROM ({_OUTCOME}) GROUP BY 1, 2",
    "s04_artist_payloads": _good_sql("artists", """'art_' || user_id AS artist_id, 'Name ' || event_id AS name,
        CASE WHEN event_id % 3 = 0 THEN 'rock' ELSE '' END AS genres, 0.0::DOUBLE AS popularity_score, 0 AS followers"""),
    "s05_venue_payloads": _good_sql("venues", """'ven_' || user_id AS venue_id, 'Name ' || event_id AS name, '' AS city,
        CASE WHEN event_id % 2 = 0 THEN NULL ELSE 700 END AS capacity, '' AS venue_type"""),
    "s06_concert_payloads": _good_sql("concerts", """CASE WHEN event_id % 7 = 0 THEN 'ev_' || event_id
        ELSE json_extract_string(props, '$.k') END AS concert_id, 'art_' || user_id AS artist_id, 'scheduled' AS status,
        NULL::BIGINT AS total_attendance"""),
    "s07_sale_payloads": _good_sql("ticket_sales", f"""'sale_' || event_id AS sale_id,
        CASE WHEN event_id % 7 <> 0 THEN json_extract_string(props, '$.k') END AS concert_id,
        CASE WHEN event_id % 4 <> 0 THEN 2 ELSE 1 END AS quantity,
        CASE WHEN event_id % 5 <> 0 THEN value ELSE 0.0::DOUBLE END AS unit_price, {rd('value * 2')} AS total_price, '' AS price_tier"""),
    "s08_routed_counts": f"""
        SELECT CASE WHEN problem IS NULL THEN data_type ELSE 'failed' END AS outcome, count(*) AS records FROM ({_OUTCOME}) GROUP BY 1""",
    "s08_deduplicated_counts": f"SELECT data_type, count(*) AS records FROM ({_OUTCOME}) WHERE problem IS NULL GROUP BY 1",
    "s10_replayed_artists": """
        SELECT CAST(s_suppkey AS VARCHAR) AS artist_id, s_name AS name, 0.0::DOUBLE AS popularity_score, 'replay' AS source FROM supplier""",
    "s11_hourly_sales": _window_sql("time_bucket(INTERVAL 1 HOUR, ts)", 1),
    "s11_sliding_sales": _window_sql("time_bucket(INTERVAL 2 HOUR, ts) - to_hours(unnest([0, 2, 4]))", 6),
    "s11_all_hourly_sales": _window_sql("time_bucket(INTERVAL 1 HOUR, ts)", 1, closed=False),
    "s11_all_sliding_sales": _window_sql("time_bucket(INTERVAL 2 HOUR, ts) - to_hours(unnest([0, 2, 4]))", 6, closed=False),
    "s12_batch_quality": f"""
        SELECT data_type, {rd('(u * 3 + c * 3 + d * 3 + a * 2 + r) / 12')} AS overall_score, total_records, 5 AS rules_evaluated,
               (u >= 100)::INT + (c >= 100)::INT + (d >= 95)::INT + (a >= 80)::INT + (r >= 75)::INT AS rules_passed,
               (u < 100)::INT + (c < 100)::INT + (d < 95)::INT AS critical_failures,
               CASE WHEN u < 100 OR c < 100 OR d < 95 THEN 'failed' ELSE 'passed' END AS status
        FROM (SELECT 'concerts' AS data_type, count(*) AS total_records, count(DISTINCT o_orderkey) * 100.0::DOUBLE / count(*) AS u,
                     {_RULE.format('o_custkey % 9 <> 0', 'TRUE')} AS c, {_RULE.format("year(o_orderdate) >= 1950", 'TRUE')} AS d,
                     {_RULE.format('att BETWEEN 1 AND 500000', 'TRUE')} AS a,
                     {_RULE.format('o_totalprice > 0 AND att > 0 AND o_totalprice / att BETWEEN 10 AND 1000', 'o_totalprice > 0 AND att > 0')} AS r
              FROM (SELECT *, CAST(trunc(o_totalprice / 100 - 50) AS INTEGER) AS att FROM orders))""",
}
