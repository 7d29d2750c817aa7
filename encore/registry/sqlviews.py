"""The stand-in views of ``encore.standin`` as SQL, and helpers to write the check queries."""

from __future__ import annotations

VIEWS = {
    "concerts": """
        SELECT o_orderkey AS concert_id, o_custkey AS venue_id, o_orderdate AS event_date,
               o_totalprice AS revenue,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'scheduled' ELSE 'postponed' END AS status,
               floor(o_totalprice / 1000) + 10.0::DOUBLE AS price_general,
               floor(o_totalprice / 250) + 25.0::DOUBLE AS price_vip,
               artist_id, total_attendance
        FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS artist_id,
                                      CAST(sum(l_quantity) AS INTEGER) AS total_attendance
                               FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
    "sales": """
        SELECT l_orderkey || '-' || l_linenumber AS sale_id, l_orderkey AS concert_id,
               l_returnflag AS price_tier, CAST(l_quantity AS INTEGER) AS quantity,
               l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total_amount,
               l_shipdate AS purchase_timestamp
        FROM lineitem""",
    "venues": """
        SELECT c_custkey AS venue_id, c_name AS name, n_name AS city, 'S' || (c_custkey % 50) AS state,
               r_name AS country, CAST(100 + floor(abs(c_acctbal) / 50) AS INTEGER) AS capacity,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'arena' WHEN 'AUTOMOBILE' THEN 'theater' WHEN 'HOUSEHOLD' THEN 'club'
                    ELSE lower(c_mktsegment) END AS venue_type,
               c_nationkey * 2.5::DOUBLE - 30 + (c_custkey % 100) / 100::DOUBLE AS latitude,
               c_nationkey * 5.0::DOUBLE - 60 + (c_custkey % 40) / 40::DOUBLE AS longitude
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                      LEFT JOIN region ON n_regionkey = r_regionkey""",
    "artists": """
        SELECT s_suppkey AS artist_id, s_name AS name,
               least(greatest((s_acctbal + 1000) / 110, 0.0::DOUBLE), 100.0::DOUBLE) AS popularity_score,
               coalesce(genre, []::VARCHAR[]) AS genre
        FROM supplier LEFT JOIN (
            SELECT l_suppkey, list_sort(list(style)) AS genre FROM (
                SELECT l_suppkey, lower(p_type) AS style,
                       row_number() OVER (PARTITION BY l_suppkey ORDER BY sum(l_quantity) DESC, lower(p_type)) AS nth
                FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, lower(p_type))
            WHERE nth <= 3 GROUP BY l_suppkey) ON s_suppkey = l_suppkey""",
    "raw_interactions": """
        SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS concert_id,
               event_type AS interaction_type,
               CASE event_type WHEN 'purchase' THEN 1.0::DOUBLE WHEN 'click' THEN 0.5::DOUBLE ELSE 0.2::DOUBLE END
                   AS interaction_strength,
               ts AS "timestamp"
        FROM events WHERE event_type IN ('purchase', 'click', 'view')""",
    "interactions": """
        SELECT user_id, concert_id, interaction_strength AS strength FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, concert_id ORDER BY "timestamp" DESC, event_id DESC) AS rn
            FROM raw_interactions) WHERE rn = 1""",
    "logs": """
        SELECT event_id, ts AS "timestamp", user_id % 5 AS log_stream, user_id AS session_id,
               CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END || ' ' || event_type || ' ' || props AS message,
               CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
               value * 10 AS duration_ms, event_type AS kind
        FROM events""",
    "messages": "SELECT conv_id AS session_id, turn, role, text AS content FROM conversations",
    "predictions": """
        SELECT o_orderkey AS concert_id, o_orderdate AS event_date, year(o_orderdate) AS year,
               o_orderstatus AS status, o_totalprice AS actual, predicted, challenger, lines
        FROM orders JOIN (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS predicted,
                                 sum(l_extendedprice) AS challenger, count(*) AS lines
                          FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""",
}
NEEDS = {"interactions": ("raw_interactions",)}


def using(names: str, body: str) -> str:
    """``body`` with the named views in front; body may start with its own ``WITH``."""
    wanted: list[str] = []
    for name in names.split():
        for each in (*NEEDS.get(name, ()), name):
            if each not in wanted:
                wanted.append(each)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in wanted)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def rd(expr: str, digits: int = 4) -> str:
    """Half-up rounding on the decimal value, as ``encore.functions.numbers.half_up`` does."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"
