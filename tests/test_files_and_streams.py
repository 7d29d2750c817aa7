"""Files, loads, jobs and streams with awkward input."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from encore.operators import enrich, governance
from encore.plans import jobs, warehouse as plans
from encore.schemas import RECORDS, TABLES
from encore.sources import files, warehouse as wh
from encore.streaming import envelope as en
from encore.streaming import pipeline as pl

AS_OF = "2024-06-01"


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def test_csv_with_lists_blanks_and_unicode(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'artist_id, name ,genre,popularity_score\nart_1, Café Tacvba ,"rock,latin",85.5\n,,,\nart_3,"Two\nLines",jazz,x\n')
    rows = files.read_csv(spark, path, rows=True).orderBy("_source_row").collect()
    assert [(r["artist_id"], r["name"], r["_source_row"]) for r in rows] == [("art_1", "Café Tacvba", 2), ("art_3", "Two\nLines", 4)]
    typed = files.typed_records(files.read_csv(spark, path), "artists").orderBy("artist_id").first()
    assert typed["genre"] == ["rock", "latin"]


def test_invalid_csv_rows_are_all_rejected(spark, tmp_path):
    path = put(tmp_path, "bad.csv", "artist_id,name,popularity_score\n,NoId,50\nart_2,,50\nart_3,High,150\n")
    records = files.read_records(spark, path, "artists", "csv")
    report = files.batch_report(records, "artists", AS_OF).first()
    assert (report["file_name"], report["records_processed"], report["records_failed"]) == ("bad.csv", 3, 3)


def test_semicolon_is_found(spark, tmp_path):
    path = put(tmp_path, "s.csv", "artist_id;name\n1;x\n")
    assert files.read_csv(spark, path).first()["name"] == "x"


@pytest.mark.parametrize("body,n", [
    ([{"artist_id": "1"}, {"artist_id": "2"}], 2), ({"data": [{"artist_id": "1"}]}, 1), ({"records": [{"artist_id": "1"}] * 3}, 3),
    ({"items": [{"artist_id": "1"}]}, 1), ({"artist_id": "1", "name": "x"}, 1)])
def test_json_layouts(spark, tmp_path, body, n):
    path = put(tmp_path, "a.json", json.dumps(body, indent=1))
    rows = files.read_json(spark, path, RECORDS["artists"], rows=True).collect()
    assert len(rows) == n and {r["artist_id"] for r in rows} <= {"1", "2"}
    assert sorted(r["_source_row"] for r in rows) == list(range(1, n + 1))


def test_corrupt_json_is_reported_and_stops_nothing(spark, tmp_path):
    put(tmp_path / "in", "good.json", json.dumps([{"artist_id": "1", "name": "x"}]))
    put(tmp_path / "in", "bad.json", '[{"artist_id": "1", "name": ')
    report = {r["file_name"]: r["success"] for r in files.batch_report(
        files.read_records(spark, str(tmp_path / "in"), "artists", "json"), "artists", AS_OF).collect()}
    assert report == {"good.json": True, "bad.json": False}


def test_xml_tags_are_found_per_file(spark, tmp_path):
    put(tmp_path / "x", "a.xml", "<concerts><concert><concert_id>c1</concert_id><ticket_prices><vip>9.5</vip></ticket_prices></concert></concerts>")
    put(tmp_path / "x", "b.xml", "<list><thing concert_id='c2'/><thing concert_id='c3'/></list>")
    rows = files.read_xml(spark, str(tmp_path / "x"), RECORDS["concerts"], rows=True).orderBy("concert_id").collect()
    assert [r["concert_id"] for r in rows] == ["c1", "c2", "c3"] and rows[0]["ticket_prices"] == {"vip": 9.5}
    assert [r["_source_row"] for r in rows] == [1, 1, 2]


def test_file_checks(spark, tmp_path):
    put(tmp_path / "c", "a.csv", "x" * 50)
    put(tmp_path / "c", "a.pdf", "x")
    found = {r["path"].split("/")[-1]: r["problem"] for r in files.check_files(spark, str(tmp_path / "c"), "artists", 10).collect()}
    assert found == {"a.csv": "file too large", "a.pdf": "unsupported format"}
    with pytest.raises(ValueError):
        files.check_files(spark, str(tmp_path), "cars")


def test_crawl_merges_new_columns(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "p/day=1"))
    spark.range(2).withColumn("x", F.lit(1)).write.parquet(str(tmp_path / "p/day=2"))
    assert set(files.crawl(spark, str(tmp_path / "p")).columns) == {"id", "x", "day"}


def test_bulk_load_limits_bad_rows(spark, tmp_path):
    raw = spark.createDataFrame([("1", "n" * 300, " "), ("2", None, "2020-01-01")], "artist_id string, name string, formation_date string")
    at = dt.datetime(2024, 1, 1)
    counts = wh.bulk_load(raw, "artists", str(tmp_path / "t"), str(tmp_path / "q"), at, max_error_share=0.5)
    assert (counts["rows_loaded"], counts["rows_rejected"]) == (1, 1)
    row = spark.read.parquet(str(tmp_path / "t")).first()
    assert len(row["name"]) == 200 and row["formation_date"] is None
    bad = wh.recent_load_errors(spark.read.parquet(str(tmp_path / "q")), at).first()
    assert bad["errors"] == ["name missing"]
    with pytest.raises(RuntimeError):
        wh.bulk_load(raw, "artists", str(tmp_path / "t"), str(tmp_path / "q"), at, max_errors=0)


def test_a_clean_load_leaves_a_readable_quarantine(spark, tmp_path):
    raw = spark.createDataFrame([("1", "n"), ("2", "m")], "artist_id string, name string")
    at = dt.datetime(2024, 1, 1)
    for loaded in (0, 2):
        report = wh.bulk_load(raw, "artists", str(tmp_path / "t"), str(tmp_path / "q"), at)
        assert (report["rows_before"], report["rows_after"], report["rows_rejected"]) == (loaded, loaded + 2, 0)
        assert report["seconds"] > 0
        assert wh.recent_load_errors(wh.read_quarantine(spark, str(tmp_path / "q")), at).count() == 0


def test_manifest(spark, tmp_path):
    one = put(tmp_path, "one.json", '{"id": 1}\n{"id": 2}\n')
    manifest = put(tmp_path, "manifest.json", json.dumps({"entries": [{"url": one, "mandatory": True}]}))
    assert wh.read_manifest(spark, manifest, "id int").count() == 2


def test_tables(spark, tmp_path):
    wh.create_tables(spark, "stage_dw", str(tmp_path / "dw"))
    wh.create_tables(spark, "stage_dw", str(tmp_path / "dw"))
    listed = {r["column_name"]: r for r in wh.column_listing(spark, "stage_dw", "daily_sales_summary").collect()}
    assert set(listed) == set(TABLES["daily_sales_summary"]) and listed["summary_date"]["is_partition"]
    wh.register_table(spark, "stage_dw", "ext", "id bigint, tags array<string>", str(tmp_path / "ext"), {"steward": "me"})
    assert "steward" in {r["key"] for r in spark.sql("SHOW TBLPROPERTIES stage_dw.ext").collect()}
    wh.drop_tables(spark, "stage_dw")
    assert not spark.catalog.tableExists("stage_dw.artists")


def test_old_partitions_are_dropped(spark, tmp_path):
    wh.create_tables(spark, "keep_dw", str(tmp_path / "dw"))
    for day in ("2024-01-01", "2024-05-30"):
        spark.sql(f"INSERT INTO keep_dw.venue_popularity PARTITION (calculated_at = '{day}') VALUES ('v', 1, 1, 1, 1, 1)")
    assert wh.drop_old_partitions(spark, "keep_dw.venue_popularity", "calculated_at", AS_OF) == 1
    assert [str(r["calculated_at"]) for r in spark.table("keep_dw.venue_popularity").collect()] == ["2024-05-30"]
    wh.drop_tables(spark, "keep_dw")


def test_enrichment_prefers_fresh_rows(spark):
    now = dt.datetime(2024, 1, 1, 12)
    wanted = spark.createDataFrame([("1", "One"), ("2", "Two"), ("3", "Three")], "artist_id string, name string")
    landed = spark.createDataFrame(
        [("1", "Uno", ["pop"], 70.0, now), ("1", "Old", ["x"], 1.0, now - dt.timedelta(minutes=5)),
         ("2", "Dos", ["pop"], 60.0, now - dt.timedelta(minutes=59)), ("3", "Tres", ["pop"], 60.0, now - dt.timedelta(minutes=61))],
        "artist_id string, name string, genre array<string>, popularity_score double, fetched_at timestamp_ntz")
    found = {r["artist_id"]: (r["name"], r["popularity_score"], r["source"]) for r in enrich.enrich_artists(wanted, landed, now).collect()}
    assert found == {"1": ("Uno", 70.0, "external"), "2": ("Dos", 60.0, "cache"), "3": ("Three", 50.0, "local_fallback")}


def test_snapshots_replace_only_their_date(spark, tmp_path):
    day = dt.datetime(2024, 1, 5)
    concerts = spark.createDataFrame([(1, 1, 1, day, 100.0, "completed", 50)], "concert_id int, artist_id int, venue_id int, event_date timestamp_ntz, revenue double, status string, total_attendance int")
    venues = spark.createDataFrame([(1, 100)], "venue_id int, capacity int")
    artists = spark.createDataFrame([(1, 50.0)], "artist_id int, popularity_score double")
    sales = spark.createDataFrame([("s", 1, 2, 5.0, day)], "sale_id string, concert_id int, quantity int, unit_price double, purchase_timestamp timestamp_ntz")
    for as_of in ("2024-01-06", "2024-01-07", "2024-01-06"):
        report = plans.run_calculations(concerts, venues, artists, sales, as_of, str(tmp_path))
        assert all(r["success"] for r in report.collect()), report.collect()
    assert spark.read.parquet(str(tmp_path / "venue_popularity")).count() == 2
    assert spark.read.parquet(str(tmp_path / "daily_sales_summary")).count() == 1


def test_artist_job(spark, tmp_path):
    rows = [{"artist_id": "1", "name": "The Kinks", "genre": "rock"}, {"artist_id": "2", "name": "Kinks!", "genre": "Rock"}, {"artist_id": "3", "name": "Blur", "genre": "pop"}]
    put(tmp_path / "in", "a.json", "\n".join(json.dumps(r) for r in rows))
    metrics = {r["metric"]: r["value"] for r in jobs.artist_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "dup")).collect()}
    assert metrics["artists_duplicate_count"] == 1.0
    assert sorted(r["artist_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "3"]
    assert spark.read.json(str(tmp_path / "dup")).first()["master_id"] == "1"


def test_audit_and_lineage_tables(spark, tmp_path):
    rows = [("a1", "me", "t1", "read", dt.datetime(2024, 5, 31), {"ip": "x"}), ("a2", "me", "t1", "read", dt.datetime(2024, 1, 1), {})]
    governance.append_records(spark.createDataFrame(rows, governance.AUDIT_SCHEMA), str(tmp_path / "audit"))
    governance.append_records(spark.createDataFrame(rows[:1], governance.AUDIT_SCHEMA), str(tmp_path / "audit"))
    audits = spark.read.parquet(str(tmp_path / "audit"))
    assert governance.audit_report(audits, AS_OF, 7, user="me", resource="t1").count() == 2


def test_partition_keys_and_envelope(spark):
    cases = [("artists", '{"artist_id":"123"}', "artist_123"), ("venues", '{"venue_id":"456"}', "venue_456"),
             ("concerts", '{"event_id":"789"}', "concert_789"), ("ticket_sales", '{"concert_id":"5"}', "ticket_5"), ("unknown_type", "{}", "unknown_type_unknown")]
    df = spark.createDataFrame(cases, "t string, p string, k string")
    assert all(r["a"] == r["k"] for r in df.select(en.partition_key(F.col("t"), F.col("p")).alias("a"), "k").collect())
    row = en.envelopes(spark.createDataFrame([("123", "x")], "artist_id string, name string"), "artists", "spotify", F.lit("2024-01-01").cast("timestamp")).first()
    body = json.loads(row["value"])
    assert body["record_id"].startswith("spotify_artists_") and body["payload"] == {"artist_id": "123", "name": "x"}


def test_base64_records(spark):
    df = spark.createDataFrame([("eyJhIjogMX0=",)], "data string")
    assert en.decode(df).first()["value"] == '{"a": 1}'


def line(key, kind="artists", **payload):
    return json.dumps({"record_id": key, "source": "t", "data_type": kind, "ingestion_timestamp": "2024-01-01T00:00:00", "payload": payload})


def test_router_restarts_from_its_checkpoint(spark, tmp_path):
    folder, check, inbox = str(tmp_path / "out"), str(tmp_path / "check"), tmp_path / "in"
    put(inbox, "1.txt", line("r1", artist_id="1", genre="rock") + "\nnot json\n")
    for name, body in (("2.txt", line("r2", "events", event_id="e1") + "\n"), (None, None)):
        pl.start_router(pl.file_stream(spark, str(inbox)), folder, check, available_now=True).awaitTermination()
        if name:
            put(inbox, name, body)
    counts = {r["outcome"]: r["n"] for r in spark.read.parquet(f"{folder}/counts").groupBy("outcome").agg(F.sum("records").alias("n")).collect()}
    assert counts == {"artists": 1, "failed": 1, "events": 1}
    assert spark.read.parquet(f"{folder}/processed/artists").first()["genres"] == ["rock"]
    assert spark.read.parquet(f"{folder}/processed/concerts").first()["concert_id"] == "e1"


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    batch = spark.createDataFrame([(line("r1", artist_id="1"),)], "value string")
    route = pl.route_batch(str(tmp_path / "out"))
    route(batch, 3)
    route(batch, 3)
    assert spark.read.parquet(str(tmp_path / "out/raw")).count() == 1


def test_late_rows_are_counted(spark, tmp_path):
    write = pl.late_rows("ts", "10 minutes", str(tmp_path))

    def batch(*minutes):
        return spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, m),) for m in minutes], "ts timestamp_ntz")

    write(batch(0, 30), 0)
    write(batch(5, 25, 40), 1)
    assert spark.read.parquet(str(tmp_path / "late")).agg(F.sum("late")).first()[0] == 1


def test_windows_drop_late_rows_and_close(spark, tmp_path):
    inbox = tmp_path / "sales"

    def put_rows(name, *rows):
        put(inbox, name, "\n".join(json.dumps({"ts": t, "concert_id": 1, "quantity": 1, "total_price": 2.0}) for t in rows))

    def run():
        stream = spark.readStream.schema("ts timestamp, concert_id int, quantity int, total_price double").json(str(inbox))
        pl.sales_windows(stream, "ts", "concert_id").writeStream.format("parquet").option("path", str(tmp_path / "o")).option(
            "checkpointLocation", str(tmp_path / "k")).trigger(availableNow=True).start().awaitTermination()

    put_rows("1.json", "2024-01-01T00:10:00Z", "2024-01-01T03:00:00Z")
    run()
    put_rows("2.json", "2024-01-01T00:20:00Z", "2024-01-01T05:00:00Z")
    run()
    rows = spark.read.parquet(str(tmp_path / "o")).orderBy("window_start").collect()
    assert [r["sales"] for r in rows] == [1, 1]


def test_csv_files_of_different_layouts(spark, tmp_path):
    put(tmp_path / "m", "a.csv", "id,name\n1,x\n2,y\n")
    put(tmp_path / "m", "b.csv", "name,id\nz,3\n")
    put(tmp_path / "m", "c.csv", "id;note\n4;a,b\n")
    rows = files.read_csv(spark, str(tmp_path / "m"), rows=True).orderBy("id").collect()
    assert [(r["id"], r["name"], r["note"], r["_source_row"]) for r in rows] == [
        ("1", "x", None, 2), ("2", "y", None, 3), ("3", "z", None, 2), ("4", None, "a,b", 2)]


def test_json_lines(spark, tmp_path):
    put(tmp_path / "j", "lines.json", "".join(f'{{"id": {i}, "name": "n{i}"}}\n' for i in range(10)) + "{broken\n")
    put(tmp_path / "j", "array.json", '[{"id": 10, "name": "n10"},\n {"id": 11, "name": "n11"}]')
    rows = files.read_json(spark, str(tmp_path / "j"), "id bigint, name string", rows=True).collect()
    assert sorted(r["id"] for r in rows if r["id"] is not None) == list(range(12))
    assert [r["_corrupt_record"] for r in rows if r["id"] is None] == ["{broken"]
    assert sorted(r["_source_row"] for r in rows if r["_source_file"].endswith("lines.json")) == list(range(1, 12))


def test_mixed_folder_loses_no_row(spark, tmp_path):
    folder = tmp_path / "x"
    put(folder / "a", "lines.json", '{"id": 1, "name": "a"}\n{"id": 2, "name": "b"}\n')
    put(folder / "b", "wrapped.json", '{"data": [{"id": 3, "name": "c"}]}')
    put(folder / "c", "one.csv", "id,name\n4,d\n")
    put(folder / "c", "two.csv", "name;id\ne;5\n")
    put(folder / "d", "bad.json", '[{"id": ')
    spark.createDataFrame([(6, "f")], "id bigint, name string").write.parquet(str(folder / "p"))
    rows = files.read_mixed(spark, str(folder), "id bigint, name string").collect()
    assert sorted((r["id"], r["name"]) for r in rows) == [(i, c) for i, c in enumerate("abcdef", 1)]
    bad = files.read_mixed(spark, str(folder), "id bigint, name string", problems=True).collect()
    assert [r["path"].split("/")[-1] for r in bad] == ["bad.json"]


def test_records_with_one_stamp_or_no_id_stay(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "artist_id int, name string")
    stamped = en.envelopes(rows, "artists", "x", F.lit("2024-01-31 00:00:00").cast("timestamp")).select("value")
    nameless = stamped.select(F.regexp_replace("value", '"record_id":"[^"]*",', "").alias("value"))
    for name, lines in (("one", stamped), ("none", nameless)):
        lines.unionByName(lines).write.text(str(tmp_path / name))
        found = pl.deduplicated(en.parse(pl.file_stream(spark, str(tmp_path / name))).filter("problem IS NULL"))
        assert pl.run_available(found.select("payload"), name).count() == 10


def test_venues_without_city_stay(spark):
    from encore.plans import features as ft

    day = dt.datetime(2024, 1, 5)
    concerts = spark.createDataFrame(
        [(i, i % 3, i % 2, day + dt.timedelta(days=i), 10.0, "completed", 5) for i in range(8)],
        "concert_id int, artist_id int, venue_id int, event_date timestamp_ntz, revenue double, status string, total_attendance int")
    venues = spark.createDataFrame([(0, None, 10, "club"), (1, "x", 10, "ARENA")], "venue_id int, city string, capacity int, venue_type string")
    got = {r["venue_id"]: (r["city_popularity"], r["venue_type_encoded"]) for r in ft.venue_features(concerts, venues, AS_OF).collect()}
    assert got == {0: (0.0, 2.0), 1: (4.0, 4.0)}


def test_windows_outlive_a_run(spark, tmp_path):
    rows = [(f"2024-01-01T{m // 60:02d}:{m % 60:02d}:00Z", m % 3) for m in range(0, 600, 7)]
    lines = [json.dumps({"ts": t, "concert_id": c, "quantity": 1, "total_price": 2.0}) for t, c in rows]

    def run(inbox, folder):
        stream = spark.readStream.schema("ts timestamp, concert_id int, quantity int, total_price double").json(str(inbox))
        pl.run_windows(pl.sales_windows(stream, "ts", "concert_id", "2 hours"), str(folder))

    put(tmp_path / "whole", "all.json", "\n".join(lines))
    run(tmp_path / "whole", tmp_path / "one")
    for i, part in enumerate((lines[:40], lines[40:41], lines[41:])):  # cut inside windows
        put(tmp_path / "parts", f"{i}.json", "\n".join(part))
        run(tmp_path / "parts", tmp_path / "more")

    def table(folder, **how):
        return sorted(map(tuple, pl.current_windows(spark, str(tmp_path / folder), **how).select(
            "window_start", "window_end", "concert_id", "sales", "tickets", "revenue").collect()))

    want = table("one")
    assert sum(r[3] for r in want) == len(rows) and table("more") == want
    assert spark.read.parquet(str(tmp_path / "more/windows")).count() > len(want)
    pl.compact_windows(spark, str(tmp_path / "more"))
    assert table("more") == want and spark.read.parquet(str(tmp_path / "more/windows")).count() == len(want)
    assert table("one", until="2024-01-01 04:00:00") == [r for r in want if r[1].hour <= 4]


def test_record_tags_without_known_ones(spark, tmp_path):
    """The tag below the root on the first or the second line with one, over files with and without known tags; no sort."""
    put(tmp_path / "x", "a.xml", "\n<?xml version='1.0'?>\n\n<list>\n text \n<thing id='1'/><other/>\n<thing/>\n</list>")
    put(tmp_path / "x", "b.xml", "<root><pair a='1'/></root>\n<late/>")
    put(tmp_path / "x", "c.xml", "<row:s>\n<entry/>\n<item>1</item>\n</row:s>")
    put(tmp_path / "x", "d.xml", "no tag at all")
    put(tmp_path / "x", "e.xml", "<lonely>")
    found = {r["path"].split("/")[-1]: r["tag"] for r in files.record_tags(spark, str(tmp_path / "x")).collect()}
    assert found == {"a.xml": "thing", "b.xml": "pair", "c.xml": "item", "e.xml": None}


def test_record_tags_sort_no_lines(spark, tmp_path, monkeypatch):
    """The aggregation over all lines holds flags only: a sort of whole lines needs the memory of a whole file."""
    put(tmp_path / "x", "a.xml", "<concerts>\n<concert><concert_id>1</concert_id></concert>\n</concerts>")
    plans = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df))
    assert files.read_xml(spark, str(tmp_path / "x"), "concert_id string").count() == 1
    assert plans and not any("Sort" in p for p in plans)


def test_raw_lines_are_kept_of_bad_rows_only(spark):
    raw = spark.createDataFrame([("1", "x", "5"), ("2", None, "many"), (None, "y", None)], "artist_id string, name string, popularity_score string")
    rows = wh.prepare_load(raw, "artists").orderBy("name").collect()
    assert [(r["artist_id"], r["name"], list(r["_errors"])) for r in rows] == [
        ("2", None, ["name missing", "popularity_score unreadable"]), ("1", "x", []), (None, "y", ["artist_id missing"])]
    assert [r["_raw"] and json.loads(r["_raw"]) for r in rows] == [
        {"artist_id": "2", "popularity_score": "many"}, None, {"name": "y"}]


def test_batch_report_is_compiled(spark):
    records = spark.createDataFrame(
        [("s1", "c", "u", "vip", 2, 5.0, 10.0, "2024-01-01 10:00:00", "cash", "file:/a/b/x.json"),
         ("s2", None, "u", None, 2, 5.0, 11.0, None, "", "file:/a/b/x.json"),
         ("s3", "c", "u", "vip", None, 5.0, None, "2030-01-01", None, "y.json")], f"{RECORDS['ticket_sales']}, _source_file string")
    report = files.batch_report(records, "ticket_sales", "2024-06-01")
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "regexp" not in plan
    assert {r["file_name"]: (r["records_processed"], r["records_failed"]) for r in report.collect()} == {"x.json": (2, 1), "y.json": (1, 1)}
    errors = {r["sale_id"]: r["errors"] for r in files.mark(records, "ticket_sales", "2024-06-01").collect()}
    assert errors == {
        "s1": [], "s2": ["concert_id missing", "ticket_tier unknown", "total_price does not match", "purchase_timestamp missing"],
        "s3": ["quantity out of range", "total_price out of range", "purchase_timestamp in the future"],
    }
