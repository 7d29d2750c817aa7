"""Registered source and sink queries: each writes rows of the given tables to a new folder and reads them back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from encore.plans import jobs
from encore.registry.analysis import stage
from encore.registry.cleaning import _CONCERTS, _RAW_CONCERTS, _report_sql
from encore.registry.helpers import AS_OF
from encore.registry.sqlviews import rd, using
from encore.registry.warehouse import POPULARITY, _popularity
from encore.session import cut_lineage, shuffle_partitions
from encore.sources import files, landed
from encore.sources import warehouse as wh
from encore.streaming.pipeline import scratch_folder

AT = dt.datetime(2024, 1, 31, 12, 0)


def _folder(s, name):
    return scratch_folder(s.spark, name)


def _csv(s):
    """Two layouts in one folder: other delimiter, other column order."""
    folder = _folder(s, "csv")
    padded = s.names().withColumn("name", F.when(F.col("id") % 9 == 0, "  ").otherwise(F.concat(F.lit(" "), "name", F.lit(' "x"; '))))
    padded.filter("id % 2 = 0").write.option("header", True).option("sep", ";").option("escape", '"').csv(f"{folder}/a")
    padded.filter("id % 2 = 1").select("name", "id").write.option("header", True).option("escape", '"').csv(f"{folder}/b")
    return files.read_csv(s.spark, [f"{folder}/a", f"{folder}/b"], rows=True).groupBy("name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("id").cast("bigint")).alias("ids"),
        F.min(F.col("_source_row") >= 2).alias("numbered"))


def _json(s):
    """Objects with a data, records or items array of up to 500 rows, one object per file, and a file of JSON lines."""
    folder = _folder(s, "json")
    bucket = F.floor(F.col("id") / 500)
    for part, wrapper in enumerate(files.WRAPPERS):
        s.names().filter(bucket % 4 == part).groupBy(bucket.alias("bucket")).agg(
            F.collect_list(F.struct("id", "name")).alias(wrapper)
        ).drop("bucket").write.option("maxRecordsPerFile", 1).json(f"{folder}/{wrapper}")
    s.names().filter(bucket % 4 == 3).repartition(2).write.json(f"{folder}/lines")
    read = files.read_json(s.spark, [f"{folder}/{w}" for w in (*files.WRAPPERS, "lines")], "id bigint, name string", rows=True)
    return read.groupBy("name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"), F.min(F.col("_source_row") >= 1).alias("numbered"))


def _xml(s):
    folder = _folder(s, "xml")
    # a file is read by one task
    s.names().repartition(shuffle_partitions(s.spark)).withColumn("p", F.struct(F.col("id").alias("general"), (F.col("id") * 2).alias("vip"))).select(
        F.concat(F.lit("con_"), F.col("id").cast("string")).alias("concert_id"), F.col("name").alias("artist_id"),
        F.col("p").alias("ticket_prices")
    ).write.format("xml").option("rootTag", "concerts").option("rowTag", "concert").save(folder)
    read = files.read_xml(s.spark, folder, "concert_id string, artist_id string, ticket_prices map<string,double>")
    return read.groupBy("artist_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("ticket_prices")["vip"]).alias("vip"))


def _mixed(s):
    """JSON lines, wrapped JSON, Parquet, and CSV files in two column orders and delimiters, read as one folder."""
    folder = _folder(s, "mixed")
    rows = s.names().withColumn("k", F.col("id") % 5)
    part = lambda k: rows.filter(F.col("k") == k).drop("k")
    part(0).write.json(f"{folder}/a")
    part(1).write.parquet(f"{folder}/b")
    part(2).write.option("header", True).csv(f"{folder}/c")
    part(3).select("name", "id").write.option("header", True).option("sep", ";").csv(f"{folder}/d")
    part(4).groupBy(F.floor(F.col("id") / 300).alias("bucket")).agg(
        F.collect_list(F.struct("id", "name")).alias("records")
    ).drop("bucket").write.option("maxRecordsPerFile", 1).json(f"{folder}/e")
    return files.read_mixed(s.spark, folder, "id bigint, name string").groupBy("name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"))


def _upsert(s):
    orders = s.table("orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    target = orders.filter("o_orderkey % 3 <> 0")
    staged = orders.filter("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return wh.upsert(target, staged, ["o_orderkey"])


def _loaded(s):
    prepared = wh.prepare_load(s.raw_concerts().withColumn("created_at", F.lit("2024-01-31")).withColumn(
        "updated_at", F.lit("2024-01-31T10:00:00Z")), "concerts")
    return prepared.groupBy(F.array_join("_errors", ",").alias("problems"), "status").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("revenue").cast("double")).alias("revenue"),
        F.max(F.to_date("event_date")).alias("last"))


def _bulk(s):
    folder = _folder(s, "load")
    raw = s.sales().withColumn("unit_price", F.round("unit_price", 4)).withColumn(
        "purchase_timestamp", F.when((F.col("concert_id") % 50 == 0) & F.col("sale_id").endswith("-1"), "never")
        .otherwise(F.date_format("purchase_timestamp", "yyyy-MM-dd HH:mm:ss")))
    try:
        wh.bulk_load(raw, "ticket_sales", f"{folder}/good", f"{folder}/bad", AT, max_errors=0)
        refused = False
    except RuntimeError:
        refused = True
    counts = wh.bulk_load(raw, "ticket_sales", f"{folder}/good", f"{folder}/bad", AT)
    good = cut_lineage(s.spark.read.parquet(f"{folder}/good").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("total_amount").cast("double")).alias("amount")))
    bad = wh.read_quarantine(s.spark, f"{folder}/bad").agg(F.count(F.lit(1)).alias("n"))
    again = wh.bulk_load(raw.filter("concert_id % 50 <> 0"), "ticket_sales", f"{folder}/good", f"{folder}/clean", AT)
    clean = wh.read_quarantine(s.spark, f"{folder}/clean")  # a load without a bad row leaves it empty
    return good.withColumn("rejected", bad.scalar()).withColumn("agrees", F.col("rows") == counts["rows_loaded"]).withColumns({
        "refused": F.lit(refused), "before": F.lit(again["rows_before"]), "after": F.lit(again["rows_after"]),
        "clean": clean.agg(F.count(F.lit(1)).alias("n")).scalar(),
    })


def _column_statistics(s):
    folder = _folder(s, "statistics")
    s.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias(
        "o_orderpriority")).write.parquet(folder)
    return wh.column_statistics(s.spark.read.parquet(folder))


def _archive(s):
    folder = _folder(s, "archive")
    rows = s.table("events").select(
        F.lit("app").alias("source"), F.col("event_type").alias("data_type"), "event_id", "value", "ts")
    wh.archive(rows, folder, "ts")
    back = s.spark.read.schema("event_id bigint, value double, source string, data_type string, year string, month string, day string").json(folder)
    return back.groupBy("data_type", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("value").alias("value"))


def _exported(s):
    folder = _folder(s, "export")
    wh.export_csv(s.concerts(lines=False, prices=True).select("concert_id", "ticket_prices"), folder)
    back = s.spark.read.option("header", True).schema("concert_id bigint, ticket_prices string").csv(folder)
    parts = F.split("ticket_prices", "[|:]")
    return back.select("concert_id", F.get(parts, F.lit(0)).alias("tier"), F.get(parts, F.lit(3)).cast("double").alias("vip"))


def _api(s):
    """Suppliers, customers and orders as landed API records."""
    key = F.col("s_suppkey")
    artists = landed.canonical_artists(s.table("supplier").select(
        key.cast("string").alias("id"), F.concat(F.lit(" "), "s_name").alias("name"), F.array(F.lit("rock")).alias("genres"),
        F.when(key % 4 != 0, F.col("s_acctbal")).alias("popularity"), F.struct(key.alias("total")).alias("followers"),
        F.create_map(F.lit("web"), F.lit("x")).alias("external_urls")))
    return artists.select("artist_id", "name", "genre", "popularity_score", "spotify_id",
                          F.get_json_object("raw_data", "$.followers").cast("bigint").alias("followers"))


def _api_venues(s):
    key = F.col("c_custkey")
    kinds = F.array(*[F.lit(k) for k in ("Old Theatre", "CLUB", "outdoor stage", "Stadium", "hall", "park")])
    return landed.canonical_venues(s.table("customer").select(
        key.cast("string").alias("id"), F.when(key % 8 == 0, " ").otherwise(F.col("c_name")).alias("name"),
        F.element_at(kinds, (key % 6 + 1).cast("int")).alias("type"), F.lit("1").alias("postalCode"),
        F.struct(F.lit("street").alias("line1")).alias("address"),
        F.when(key % 9 != 0, F.struct(F.col("c_mktsegment").alias("name"))).alias("city"),
        F.struct(F.lit("ST").alias("stateCode")).alias("state"), F.struct(F.lit("US").alias("countryCode")).alias("country")))


def _api_events(s):
    key = F.col("o_orderkey")
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = s.table("orders").select(
        key.cast("string").alias("id"), F.when(key % 17 != 0, "Night").alias("name"), F.lit("u").alias("url"), F.lit("i").alias("info"),
        F.struct(F.struct(
            F.when(key % 5 == 0, "later").when(key % 7 != 0, F.concat(text, F.lit("T19:30:00Z"))).alias("dateTime"),
            text.alias("localDate")).alias("start")).alias("dates"),
        F.struct(F.struct(F.concat(text, F.lit("T00:00:00Z")).alias("endDateTime")).alias("public")).alias("sales"),
        F.array(F.struct(F.lit("Standard").alias("type"), F.col("o_totalprice").alias("min"), F.when(key % 2 == 0, F.col("o_totalprice") * 3).alias("max"))).alias("priceRanges"),
        F.struct(F.array(F.struct(F.col("o_custkey").cast("string").alias("id"))).alias("venues"),
                 F.when(key % 3 != 0, F.array(F.struct(F.lit("7").alias("id")))).alias("attractions")).alias("_embedded"))
    found = landed.canonical_events(raw, dt.datetime(2000, 1, 1))
    return found.select(
        "concert_id", "artist_id", "venue_id", F.date_format("event_date", "yyyy-MM-dd HH:mm").alias("starts"),
        F.col("ticket_prices")["standard"].alias("price"), "status")


def _incremental(s):
    folder = _folder(s, "incremental")
    schema = "id bigint, name string"
    for part in (0, 1):
        s.names().filter(F.col("id") % 2 == part).write.mode("append").json(f"{folder}/in")
        files.incremental(s.spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/checkpoint")
    return s.spark.read.parquet(f"{folder}/out").groupBy("name").agg(F.count(F.lit(1)).alias("rows"))


def _batch(s):
    folder = _folder(s, "uploads")
    s.raw_sales().withColumn("purchase_timestamp", F.date_format("purchase_timestamp", "yyyy-MM-dd HH:mm:ss")).write.json(folder)
    records = s.spark.read.schema(files.RECORDS["ticket_sales"]).json(folder).select(
        "*", F.col("_metadata.file_path").alias("_source_file"))
    return files.batch_report(records, "ticket_sales", AS_OF).agg(
        F.sum("records_processed").alias("records_processed"), F.sum("records_successful").alias("records_successful"),
        F.sum("records_failed").alias("records_failed"))


def _status(s):
    return wh.warehouse_status(
        {"artists": s.artists(), "venues": s.venues(), "concerts": s.concerts(lines=False), "ticket_sales": s.sales(),
         "venue_popularity": _popularity(s)}, {"venue_popularity": "calculated_at"})


def _checked_files(s):
    """Files of three endings, one per event type; only two endings are accepted."""
    folder = _folder(s, "checks")
    rows = s.table("events").select("event_id", "event_type").repartition("event_type")
    rows.write.partitionBy("event_type").csv(f"{folder}/a")
    rows.write.partitionBy("event_type").json(f"{folder}/b")
    rows.select(F.col("event_id").cast("string").alias("value"), "event_type").write.partitionBy("event_type").text(f"{folder}/c")
    found = files.check_files(s.spark, folder, "concerts")
    return found.groupBy(F.regexp_extract("path", r"[.](\w+)$", 1).alias("ending"), "problem").agg(
        F.count_distinct(F.regexp_extract("path", "event_type=([^/]+)", 1)).alias("types"))


def _concert_job(s):
    """Raw concerts from files to the cleaned table, read back."""
    folder = _folder(s, "job")
    s.raw_concerts().write.json(f"{folder}/in")
    jobs.concert_job(s.spark, f"{folder}/in", f"{folder}/out", AS_OF)
    return s.spark.read.parquet(f"{folder}/out").select(
        "concert_id", F.to_date("event_date_validated").alias("event_day"), "status_normalized",
        "total_attendance_validated", "revenue_validated", "data_quality_score")


def _listed_columns(s):
    """CSV files without header, loaded by a column list."""
    folder = _folder(s, "columns")
    s.table("supplier").select("s_suppkey", "s_name", "s_acctbal").write.option("sep", "|").csv(folder)
    raw = wh.load_csv(s.spark, folder, "artists", ["artist_id", "name", "popularity_score"], "|", header=False)
    return raw.select(F.col("artist_id").cast("bigint").alias("artist_id"), "name", F.col("popularity_score").cast("double").alias("score"))


def _manifest(s):
    """Two of three folders of JSON files, as a manifest lists them."""
    folder = _folder(s, "manifest")
    for part in range(3):
        s.names().filter(F.col("id") % 3 == part).write.json(f"{folder}/{part}")
    listed = [f for part in (0, 2) for f in s.spark.read.text(f"{folder}/{part}").inputFiles()]
    entries = F.array(*[F.struct(F.lit(f).alias("url"), F.lit(True).alias("mandatory")) for f in listed])
    s.spark.range(1).select(entries.alias("entries")).write.json(f"{folder}/list")
    return wh.read_manifest(s.spark, f"{folder}/list", "id bigint, name string").groupBy("name").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"))


def _reload(s):
    """A table that is emptied and loaded again holds the second load only."""
    folder = _folder(s, "reload")
    raw = s.table("supplier").select(
        F.col("s_suppkey").cast("string").alias("artist_id"), F.col("s_name").alias("name"))
    wh.bulk_load(raw, "artists", f"{folder}/t", f"{folder}/q", AT, mode="overwrite")
    wh.bulk_load(raw.filter("cast(artist_id as int) % 2 = 0"), "artists", f"{folder}/t", f"{folder}/q", AT, mode="overwrite")
    return s.spark.read.parquet(f"{folder}/t").select(F.col("artist_id").cast("bigint").alias("artist_id"), "name")


def _load_errors(s):
    """Errors of a load whose event dates are partly unreadable."""
    folder = _folder(s, "errors")
    raw = s.raw_concerts().withColumn("created_at", F.lit("2024-01-31")).withColumn("updated_at", F.lit("2024-01-31"))
    wh.bulk_load(raw, "concerts", f"{folder}/t", f"{folder}/q", AT, max_error_share=1.0)
    quarantine = s.spark.read.parquet(f"{folder}/q")
    late = wh.recent_load_errors(quarantine, AT + dt.timedelta(minutes=11))
    return wh.recent_load_errors(quarantine, AT).agg(F.count(F.lit(1)).alias("recent")).withColumn(
        "old", late.agg(F.count(F.lit(1)).alias("n")).scalar()).withColumn("all", quarantine.agg(F.count(F.lit(1)).alias("n")).scalar())


QUERIES = {
    "a05_checked_files": stage(_checked_files),
    "a07_concert_job": stage(_concert_job),
    "a11_listed_columns": stage(_listed_columns),
    "a12_manifest": stage(_manifest),
    "a13_reloaded_table": stage(_reload),
    "a16_load_errors": stage(_load_errors),
    "a01_csv_scan": stage(_csv),
    "a02_json_scan": stage(_json),
    "a03_xml_scan": stage(_xml),
    "a04_mixed_scan": stage(_mixed),
    "a06_batch_report": stage(_batch),
    "a09_archive": stage(_archive),
    "a10_prepared_load": stage(_loaded, revenue=2),
    "a15_bulk_load": stage(_bulk, amount=2),
    "a15_column_statistics": stage(_column_statistics),
    "a14_upsert": stage(_upsert),
    "a21_exported_prices": stage(_exported),
    "a23_warehouse_status": stage(_status),
    "a24_landed_artists": stage(_api),
    "a25_landed_venues": stage(_api_venues),
    "a26_landed_events": stage(_api_events),
    "a27_incremental_input": stage(_incremental),
}
ORACLE = {
    "a05_checked_files": """
        SELECT ending, CASE WHEN ending = 'txt' THEN 'unsupported format' END AS problem, count(DISTINCT event_type) AS types
        FROM events, (SELECT unnest(['csv', 'json', 'txt']) AS ending) GROUP BY 1, 2""",
    "a07_concert_job": _CONCERTS,
    "a11_listed_columns": "SELECT s_suppkey AS artist_id, s_name AS name, s_acctbal AS score FROM supplier",
    "a12_manifest": """
        SELECT p_name AS name, count(*) AS rows, CAST(sum(p_partkey) AS BIGINT) AS ids FROM part WHERE p_partkey % 3 <> 1 GROUP BY 1""",
    "a13_reloaded_table": "SELECT s_suppkey AS artist_id, s_name AS name FROM supplier WHERE s_suppkey % 2 = 0",
    "a16_load_errors": f"""
        SELECT least(count(*), 10) AS recent, 0 AS old, count(*) AS all
        FROM ({_RAW_CONCERTS}) WHERE coalesce(artist_id, '') = '' OR event_date IS NULL""",
    "a01_csv_scan": """SELECT CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_name || ' "x";' END AS name, count(*) AS rows,
        CAST(sum(p_partkey) AS BIGINT) AS ids, TRUE AS numbered FROM part GROUP BY 1""",
    "a02_json_scan": "SELECT p_name AS name, count(*) AS rows, CAST(sum(p_partkey) AS BIGINT) AS ids, TRUE AS numbered FROM part GROUP BY 1",
    "a03_xml_scan": "SELECT p_name AS artist_id, count(*) AS rows, sum(p_partkey * 2)::DOUBLE AS vip FROM part GROUP BY 1",
    "a04_mixed_scan": "SELECT p_name AS name, count(*) AS rows, CAST(sum(p_partkey) AS BIGINT) AS ids FROM part GROUP BY 1",
    "a06_batch_report": f"SELECT records_processed, records_successful, records_failed FROM ({_report_sql('ticket_sales')})",
    "a09_archive": f"""SELECT event_type AS data_type, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, count(*) AS rows,
        {rd('sum(value)')} AS value FROM events GROUP BY 1, 2, 3, 4""",
    "a10_prepared_load": f"""
        SELECT concat_ws(',', CASE WHEN coalesce(artist_id, '') = '' THEN 'artist_id missing' END,
                         CASE WHEN event_date IS NULL THEN 'event_date unreadable' END) AS problems, trim(status) AS status,
               count(*) AS rows, {rd('sum(round(revenue, 2))', 2)} AS revenue, max(CAST(event_date AS DATE)) AS last
        FROM ({_RAW_CONCERTS}) GROUP BY 1, 2""",
    "a15_bulk_load": f"""SELECT count(CASE WHEN NOT bad THEN 1 END) AS rows, {rd('sum(CASE WHEN NOT bad THEN l_extendedprice END)', 2)} AS amount,
        count(CASE WHEN bad THEN 1 END) AS rejected, TRUE AS agrees, count(CASE WHEN bad THEN 1 END) > 0 AS refused,
        count(*) - count(CASE WHEN bad THEN 1 END) AS before, count(*) - count(CASE WHEN bad THEN 1 END) + count(*) FILTER (WHERE l_orderkey % 50 <> 0) AS after, 0 AS clean
        FROM (SELECT *, l_orderkey % 50 = 0 AND l_linenumber = 1 AS bad FROM lineitem)""",
    "a15_column_statistics": " UNION ALL ".join(
        f"""SELECT '{name}' AS column, {i} AS position, count(*) AS rows, count(*) - count({value}) AS nulls,
            min({value})::VARCHAR AS lowest, max({value})::VARCHAR AS highest FROM orders"""
        for i, (name, value) in enumerate((
            ("o_orderkey", "o_orderkey"), ("o_custkey", "o_custkey"), ("o_orderstatus", "o_orderstatus"),
            ("o_orderpriority", "nullif(o_orderpriority, '1-URGENT')"))
        )
    ),
    "a14_upsert": f"""
        SELECT o_orderkey, o_orderstatus, {rd('o_totalprice + CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END')} AS o_totalprice
        FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0""",
    "a21_exported_prices": using("concerts", "SELECT concert_id, 'general' AS tier, price_vip AS vip FROM concerts"),
    "a23_warehouse_status": using("artists venues concerts sales", f"""
        SELECT 'artists' AS table_name, count(*) AS total_rows, NULL::DATE AS latest, NULL::BIGINT AS latest_rows FROM artists
        UNION ALL SELECT 'venues', count(*), NULL, NULL FROM venues UNION ALL SELECT 'concerts', count(*), NULL, NULL FROM concerts
        UNION ALL SELECT 'ticket_sales', count(*), NULL, NULL FROM sales
        UNION ALL SELECT 'venue_popularity', count(*), max(calculated_at), count(*) FROM ({POPULARITY})"""),
    "a24_landed_artists": f"""
        SELECT 'spotify_' || s_suppkey AS artist_id, s_name AS name, 'rock' AS genre,
               {rd('CASE WHEN s_suppkey % 4 <> 0 THEN s_acctbal ELSE 0 END')} AS popularity_score,
               CAST(s_suppkey AS VARCHAR) AS spotify_id, s_suppkey AS followers FROM supplier""",
    "a25_landed_venues": """
        SELECT 'ticketmaster_' || c_custkey AS venue_id, c_name AS name, c_mktsegment AS city, 'ST' AS state, 'US' AS country,
               10000 AS capacity, ['theater', 'club', 'amphitheater', 'stadium', 'hall', 'other'][c_custkey % 6 + 1] AS venue_type,
               'street' AS address, '1' AS postal_code FROM customer WHERE c_custkey % 8 <> 0 AND c_custkey % 9 <> 0""",
    "a26_landed_events": f"""
        SELECT 'ticketmaster_' || o_orderkey AS concert_id, CASE WHEN o_orderkey % 3 <> 0 THEN 'ticketmaster_7' END AS artist_id,
               'ticketmaster_' || o_custkey AS venue_id,
               strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 5 = 0 THEN ' 20:00' ELSE ' 19:30' END AS starts,
               {rd('CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice * 2 ELSE o_totalprice END')} AS price,
               CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'completed' ELSE 'scheduled' END AS status
        FROM orders WHERE o_orderkey % 17 <> 0 AND (o_orderkey % 5 = 0 OR o_orderkey % 7 <> 0)""",
    "a27_incremental_input": "SELECT p_name AS name, count(*) AS rows FROM part GROUP BY 1",
}
