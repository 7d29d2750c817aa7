"""Registered log, governance and conversation queries."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import functions as F

from encore.operators import conversations as cv
from encore.operators import governance as gv
from encore.operators import logs as lg
from encore.registry.analysis import stage
from encore.registry.helpers import EVENTS_AS_OF
from encore.registry.sqlviews import rd, using
from encore.standin import QUESTIONS


def _reports(s):
    return s.logs().withColumn("type", F.when(F.col("kind") == "signup", "REPORT").otherwise("LINE")).withColumn(
        "init_duration", F.col("duration_ms") - 300)


def _lines(s):
    return s.logs().withColumn("message", F.concat(
        F.col("message"), F.when(F.col("kind") == "view", ' status_code=503 data Quality').otherwise(""),
        F.when(F.col("kind") == "click", F.concat(F.lit(" duration_ms="), F.col("event_id").cast("string"))).otherwise("")))


def _line_totals(s):
    return lg.line_metrics(_lines(s)).groupBy("metric").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def _datasets(s):
    rules = F.array(F.lit("AUDIT_REQUIRED"), F.lit("ACCESS_CONTROL"), F.lit("LINEAGE_TRACKING"))
    nations = s.table("nation").select(F.concat(F.lit("nation/"), (F.col("n_nationkey") * 5).cast("string")).alias("dataset"))
    return nations.withColumn("regulations", rules)


def _classified(s):
    return s.questions().withColumn("intent", cv.classify_intent(F.col("content")))


def _contexts(s):
    found = cv.query_context(cv.extract_entities(_classified(s), "content"))
    joined = F.array_join(F.transform(F.array_sort(F.map_entries("filters")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return found.select("session_id", "turn", "intent", "query_limit", joined.alias("filters"), "sort_by")


def _preferences(s):
    m = s.messages()
    now = dt.datetime(2024, 1, 31)
    text = F.map_from_arrays(F.array(F.lit("role"), F.lit("turn")), F.array(F.col("role"), F.col("turn").cast("string")))
    first = dt.datetime(2024, 1, 1)
    stored = m.filter("turn = 0 AND session_id % 3 <> 0").select(
        F.col("session_id").alias("user_id"), text.alias("preferences"),
        F.lit(first).cast("timestamp_ntz").alias("created_at"), F.lit(first).cast("timestamp_ntz").alias("updated_at"))
    changes = m.filter("turn = 1 AND session_id % 2 = 0").select(
        F.col("session_id").alias("user_id"), F.create_map(F.lit("role"), F.col("role")).alias("preferences"))
    merged = cv.merge_preferences(stored, changes, now)
    return merged.select(
        "user_id", F.col("preferences")["role"].alias("role"), F.col("preferences")["turn"].alias("turn"),
        F.to_date("created_at").alias("created"), F.to_date("updated_at").alias("updated"))


QUERIES = {
    "k01_newest_errors": stage(lambda s: lg.newest_errors(s.logs())),
    "k02_conversation_counts": stage(lambda s: lg.conversation_counts(s.logs())),
    "k03_slow_requests": stage(lambda s: lg.slow_requests(s.logs())),
    "k04_cold_starts": stage(lambda s: lg.cold_starts(_reports(s))),
    "k05_errors_per_stream": stage(lambda s: lg.errors_per_stream(s.logs())),
    "k06_line_metrics": stage(_line_totals),
    "g01_lineage_edges": stage(lambda s: s.lineage().groupBy("transformation").agg(F.count(F.lit(1)).alias("edges"))),
    "g02_lineage_of_resource": stage(lambda s: gv.lineage_of(s.lineage(), "nation/7")),
    "g03_audit_report": stage(lambda s: gv.audit_report(s.audits(), EVENTS_AS_OF, 7, resource="nation/7")),
    "g04_compliance": stage(lambda s: gv.compliance(_datasets(s), s.audits(), s.permissions(), s.lineage(), EVENTS_AS_OF)),
    "g05_governance_summary": stage(lambda s: gv.governance_summary(s.audits(), s.permissions(), EVENTS_AS_OF)),
    "p01_session_history": stage(lambda s: cv.session_history(s.messages(), 7, start=1, end=5, order="turn")),
    "p01_user_history": stage(lambda s: cv.user_history(
        s.logs().withColumnRenamed("session_id", "user_id").select("user_id", "timestamp", "message"), 7, 20)),
    "p02_context_summaries": stage(lambda s: cv.context_summaries(s.messages(), 4, "turn")),
    "p03_memory_statistics": stage(lambda s: cv.memory_statistics(s.messages())),
    "p03_intent_distribution": stage(lambda s: cv.distribution(_classified(s), "intent")),
    "p04_preferences": stage(_preferences),
    "p05_intents": stage(lambda s: _classified(s).select(
        "session_id", "turn", "intent", cv.detect_intent(F.col("content")).alias("keyword_intent"))),
    "p06_entities": stage(lambda s: cv.extract_entities(_classified(s), "content").select(
        "session_id", "turn", "intent", "limit", "names", "cities", "genres")),
    "p07_query_context": stage(_contexts),
}

_LIMIT = r"[^\pL\pN_]"


def _re2(pattern):
    """The pattern with Unicode word limits spelled out, as RE2 only knows ASCII ones."""
    out = pattern.replace(r"\b.*\b", f"(?:{_LIMIT}[^\\n]*)?{_LIMIT}").replace(r").*\b", f")[^\\n]*{_LIMIT}")
    out = re.sub(r"^\\b", lambda _: f"(?:^|{_LIMIT})", out)
    return re.sub(r"\\b$", lambda _: f"(?:$|{_LIMIT})", out)


_CASES = " ".join(
    f"WHEN {' OR '.join(f'''regexp_matches(lower(content), '{_re2(p)}')''' for p in ps)} THEN '{i}'"
    for i, ps in cv.INTENTS.items())
_WORD_CASES = " ".join(
    f"WHEN {' OR '.join(f'''contains(lower(content), '{w}')''' for w in ws)} THEN '{i}'"
    for i, ws in cv.KEYWORD_INTENTS.items())
_ASKED = "[" + ", ".join(f"'{q}'" for q in QUESTIONS) + "]"
_QUESTIONS = f"""
    SELECT *, CASE {_CASES} ELSE 'unknown' END AS intent, CASE {_WORD_CASES} ELSE 'general_query' END AS keyword_intent
    FROM (SELECT session_id, turn, role, content || ' ' || {_ASKED}[(session_id + turn) % {len(QUESTIONS)} + 1] AS content FROM messages)"""


def _found(words):
    return "[w FOR w IN [" + ", ".join(f"'{w}'" for w in words) + "] IF contains(lower(content), w)]"


_TITLE = "[array_to_string([upper(p[1]) || p[2:] FOR p IN string_split(c, ' ')], ' ') FOR c IN {}]".format(_found(cv.CITIES))
_NUMBER = f"TRY_CAST(regexp_extract(content, '(?:^|{_LIMIT})([0-9]+)(?:$|{_LIMIT})', 1) AS HUGEINT)"
_ENTITIES = f"""
    SELECT session_id, turn, intent, CASE WHEN {_NUMBER} <= 100 THEN CAST({_NUMBER} AS BIGINT) END AS "limit",
           CASE WHEN intent IN ('artist_lookup', 'venue_search') THEN regexp_extract_all(content, '"([^"]+)"', 1) ELSE [] END AS names,
           {_TITLE} AS cities, {_found(cv.GENRES)} AS genres FROM ({_QUESTIONS})"""
_LINEAGE = """SELECT 'region/' || n_regionkey AS source, 'nation/' || n_nationkey AS target, 'split' AS transformation FROM nation
    UNION ALL SELECT 'nation/' || c_nationkey, 'customer/' || c_custkey, lower(c_mktsegment) FROM customer"""
_AUDITS = """SELECT event_id AS audit_id, 'user/' || user_id AS "user", 'nation/' || json_extract_string(props, '$.k') AS resource,
    event_type AS action, ts AS "timestamp" FROM events"""


def _since(days):
    return f"\"timestamp\" >= DATE '{EVENTS_AS_OF}' - INTERVAL {days} DAY"


ORACLE = {
    "k01_newest_errors": using("logs", """
        SELECT "timestamp", message, log_stream FROM logs WHERE message LIKE '%ERROR%'
        ORDER BY "timestamp" DESC, log_stream, message LIMIT 100"""),
    "k02_conversation_counts": using("logs", """
        SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS window_start, count(*) AS conversation_count FROM logs GROUP BY 1"""),
    "k03_slow_requests": using("logs", f"""
        SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS window_start, {rd('avg(duration_ms)')} AS avg_latency,
               {rd('max(duration_ms)')} AS max_latency, {rd('min(duration_ms)')} AS min_latency
        FROM logs WHERE duration_ms > 1000 GROUP BY 1"""),
    "k04_cold_starts": using("logs", f"""
        SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") AS window_start, count(*) AS cold_starts,
               {rd('avg(duration_ms - 300)')} AS avg_init_duration
        FROM logs WHERE kind = 'signup' AND duration_ms - 300 > 0 GROUP BY 1"""),
    "k05_errors_per_stream": using("logs", """
        SELECT log_stream, count(*) AS error_count FROM logs WHERE message LIKE '%ERROR%' OR message LIKE '%FAILED%' GROUP BY 1"""),
    "k06_line_metrics": """
        SELECT 'errors' AS metric, count(*) AS n, count(*)::DOUBLE AS total FROM events WHERE event_type = 'error'
        UNION ALL SELECT 'server_errors', count(*), count(*)::DOUBLE FROM events WHERE event_type = 'view'
        UNION ALL SELECT 'quality_issues', count(*), count(*)::DOUBLE FROM events WHERE event_type = 'view'
        UNION ALL SELECT 'latency_ms', count(*), sum(event_id)::DOUBLE FROM events WHERE event_type = 'click'""",
    "g01_lineage_edges": f"SELECT transformation, count(*) AS edges FROM ({_LINEAGE}) GROUP BY 1",
    "g02_lineage_of_resource": f"""
        SELECT *, 'upstream' AS direction FROM ({_LINEAGE}) WHERE target = 'nation/7'
        UNION ALL SELECT *, 'downstream' FROM ({_LINEAGE}) WHERE source = 'nation/7'""",
    "g03_audit_report": f"SELECT * FROM ({_AUDITS}) WHERE {_since(7)} AND resource = 'nation/7'",
    "g04_compliance": f"""
        WITH d AS (SELECT 'nation/' || (n_nationkey * 5) AS dataset FROM nation),
        x AS (SELECT dataset, [v FOR v IN [
                  CASE WHEN dataset NOT IN (SELECT resource FROM ({_AUDITS}) WHERE {_since(1)}) THEN 'No recent audit logs found' END,
                  CASE WHEN dataset NOT IN (SELECT 'nation/' || s_nationkey FROM supplier) THEN 'No access controls configured' END,
                  CASE WHEN dataset NOT IN (SELECT source FROM ({_LINEAGE}) UNION SELECT target FROM ({_LINEAGE}))
                       THEN 'No lineage information available' END] IF v IS NOT NULL] AS v FROM d)
        SELECT dataset, array_to_string(v, '|') AS violations, len(v) = 0 AS compliant FROM x""",
    "g05_governance_summary": f"""
        SELECT count(*) AS audit_logs_last_7_days, (SELECT count(*) FROM supplier) AS total_permissions
        FROM ({_AUDITS}) WHERE {_since(7)}""",
    "p01_session_history": using("messages", "SELECT * FROM messages WHERE session_id = 7 AND turn BETWEEN 1 AND 5 ORDER BY turn LIMIT 50"),
    "p01_user_history": using("logs", """
        SELECT session_id AS user_id, "timestamp", message FROM logs WHERE session_id = 7 ORDER BY "timestamp" DESC LIMIT 20"""),
    "p02_context_summaries": using("messages", """
        SELECT session_id, count(*) AS message_count, min(turn) AS first_message, max(turn) AS last_message,
               count(CASE WHEN role = 'user' THEN 1 END) AS user_message_count,
               count(CASE WHEN role = 'assistant' THEN 1 END) AS assistant_message_count
        FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY turn) AS n FROM messages) WHERE n <= 4 GROUP BY 1"""),
    "p03_memory_statistics": using("messages", f"""
        SELECT count(DISTINCT session_id) AS total_sessions, count(*) AS total_messages,
               {rd('count(*)::DOUBLE / count(DISTINCT session_id)')} AS average_messages_per_session FROM messages"""),
    "p03_intent_distribution": using("messages", f"SELECT intent, count(*) AS count FROM ({_QUESTIONS}) GROUP BY 1"),
    "p04_preferences": """
        WITH s AS (SELECT conv_id AS user_id, role, turn FROM conversations WHERE turn = 0 AND conv_id % 3 <> 0),
        c AS (SELECT conv_id AS user_id, role FROM conversations WHERE turn = 1 AND conv_id % 2 = 0)
        SELECT coalesce(s.user_id, c.user_id) AS user_id, coalesce(c.role, s.role) AS role, CAST(s.turn AS VARCHAR) AS turn,
               CASE WHEN s.user_id IS NULL THEN DATE '2024-01-31' ELSE DATE '2024-01-01' END AS created,
               CASE WHEN c.user_id IS NOT NULL THEN DATE '2024-01-31' ELSE DATE '2024-01-01' END AS updated
        FROM s FULL JOIN c ON s.user_id = c.user_id""",
    "p05_intents": using("messages", f"SELECT session_id, turn, intent, keyword_intent FROM ({_QUESTIONS})"),
    "p06_entities": using("messages", f"""
        SELECT session_id, turn, intent, "limit", coalesce(array_to_string(names, '|'), '') AS names,
               coalesce(array_to_string(cities, '|'), '') AS cities, coalesce(array_to_string(genres, '|'), '') AS genres FROM ({_ENTITIES})"""),
    "p07_query_context": using("messages", f"""
        SELECT session_id, turn, intent, least(coalesce("limit", 10), 100) AS query_limit,
               coalesce(array_to_string([f FOR f IN [
                   CASE WHEN intent = 'artist_lookup' AND len(names) > 0 THEN 'artist_name=' || names[-1] END,
                   CASE WHEN len(cities) > 0 THEN 'city=' || cities[-1] END,
                   CASE WHEN len(genres) > 0 THEN 'genre=' || genres[-1] END,
                   CASE WHEN intent = 'venue_search' AND len(names) > 0 THEN 'venue_name=' || names[-1] END] IF f IS NOT NULL], ';'), '') AS filters,
               CASE intent WHEN 'popularity_ranking' THEN 'popularity_score' WHEN 'revenue_analysis' THEN 'revenue'
                    WHEN 'ticket_sales_query' THEN 'total_tickets_sold' END AS sort_by FROM ({_ENTITIES})"""),
}
