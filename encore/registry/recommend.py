"""Registered recommendation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.operators import neighbours as nb
from encore.operators import recommend as rc
from encore.registry.analysis import stage
from encore.registry.sqlviews import rd, using
from encore.session import cut_lineage


def _matrix(s):
    return nb.interaction_matrix(s.raw_interactions())


def _liked(s, entity, matrix=None):
    """Artists or venues of the concerts a user bought."""
    bought = (matrix or _matrix(s)).filter("strength = 1.0").select("user_id", "concert_id")
    return bought.join(s.concerts().select("concert_id", entity), "concert_id").filter(
        F.col(entity).isNotNull()).select("user_id", entity).distinct()


def _similar(find, entity, table):
    def build(s):
        entities = s.artists(genre=True) if table == "artists" else s.venues()
        return find(entities, _liked(s, entity).select(entity), 20)
    return build


def _strategy(name):
    def build(s):
        matrix = cut_lineage(_matrix(s))
        # read more than once only where they are used at all
        needed = {"content_artist": ["artist_id"], "content_venue": ["venue_id"], "content_hybrid": ["artist_id", "venue_id"],
                  "hybrid_all": ["artist_id", "venue_id"]}.get(name, [])
        liked = {e: cut_lineage(_liked(s, e, matrix)) if e in needed else _liked(s, e, matrix) for e in ("artist_id", "venue_id")}
        return rc.recommend(
            name, matrix.select("user_id").distinct(), matrix, s.artists(genre=True), s.venues(), s.concerts(),
            liked["artist_id"], liked["venue_id"], matrix.select("user_id", "concert_id"))
    return build


def _reasons(entity, table):
    """The concerts of every user's preferred entities with their reasons, best three per user."""
    def build(s):
        entities = s.artists(genre=True) if table == "artists" else s.venues()
        liked = cut_lineage(_liked(s, entity))
        similar = (rc.similar_artists if table == "artists" else rc.similar_venues)(entities, liked.select(entity), 20)
        found = rc.concerts_by_preference(liked, similar, s.concerts(), entity, 3)
        return rc.with_reasons(found, s.concerts(), entities, entity).select(
            "user_id", "item_id", "rank", "reasoning", F.col("metadata")["venue_id"].alias("venue_id"))
    return build


def _artists(s):
    return rc.recommend_artists(_liked(s, "artist_id"), s.artists(genre=True)).select(
        "user_id", "item_id", "rank", "score", "confidence", "reasoning", F.col("metadata")["genres"].alias("genres"))


def _venues(s):
    return rc.recommend_venues(_liked(s, "venue_id"), s.venues()).select(
        "user_id", "item_id", "rank", "score", "confidence", "reasoning", F.col("metadata")["capacity"].alias("capacity"))


QUERIES = {
    "m01_interaction_matrix": stage(_matrix),
    "m01_matrix_statistics": stage(lambda s: nb.matrix_statistics(_matrix(s))),
    "m02_similar_users": stage(lambda s: nb.similar_users(_matrix(s))),
    "m03_similar_concerts": stage(lambda s: nb.similar_concerts(_matrix(s))),
    "m04_user_based": stage(lambda s: rc.user_based(_matrix(s))),
    "m05_item_based": stage(lambda s: rc.item_based(_matrix(s))),
    "m06_similar_artists": stage(_similar(rc.similar_artists, "artist_id", "artists")),
    "m08_similar_venues": stage(_similar(rc.similar_venues, "venue_id", "venues")),
    "m09_concerts_by_artist": stage(_strategy("content_artist")),
    "m10_concerts_by_venue": stage(_strategy("content_venue")),
    "m09_artist_reasons": stage(_reasons("artist_id", "artists")),
    "m10_venue_reasons": stage(_reasons("venue_id", "venues")),
    "m11_content_hybrid": stage(_strategy("content_hybrid")),
    "m12_hybrid_all": stage(_strategy("hybrid_all")),
    "m13_recommend_artists": stage(_artists),
    "m13_recommend_venues": stage(_venues),
    "m14_batch_collaborative_user": stage(_strategy("collaborative_user")),
    "m14_batch_collaborative_item": stage(_strategy("collaborative_item")),
    "m15_system_statistics": stage(lambda s: rc.system_statistics(_matrix(s), s.artists(), s.venues(), s.concerts(lines=False))),
}


def _neighbours(row, column, k):
    return f"""
    SELECT * FROM (SELECT id1, id2, similarity, row_number() OVER (PARTITION BY id1 ORDER BY similarity DESC, id2) AS rank
    FROM (SELECT a.{row} AS id1, b.{row} AS id2,
                 round(sum(a.strength * b.strength) / (max(na.n) * max(nb.n)), 9) AS similarity
          FROM interactions a JOIN interactions b ON a.{column} = b.{column} AND a.{row} <> b.{row}
          JOIN (SELECT {row}, sqrt(sum(strength * strength)) AS n FROM interactions GROUP BY 1) na ON a.{row} = na.{row}
          JOIN (SELECT {row}, sqrt(sum(strength * strength)) AS n FROM interactions GROUP BY 1) nb ON b.{row} = nb.{row}
          GROUP BY 1, 2)
    WHERE similarity >= 0.1) WHERE rank <= {k}"""


def _best(source, k):
    return f"""SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank,
        score, confidence FROM (SELECT * REPLACE (round(score, 9) AS score) FROM ({source})) QUALIFY rank <= {k}"""


_USER_SOURCE = f"""
    SELECT n.id1 AS user_id, i.concert_id AS item_id, sum(similarity * strength) / sum(similarity) AS score,
           least(sum(similarity) / 20, 1) AS confidence
    FROM ({_neighbours('user_id', 'concert_id', 20)}) n JOIN interactions i ON n.id2 = i.user_id
    WHERE NOT EXISTS (SELECT 1 FROM interactions k WHERE k.user_id = n.id1 AND k.concert_id = i.concert_id)
    GROUP BY 1, 2"""
_ITEM_SOURCE = f"""
    SELECT i.user_id, n.id2 AS item_id, sum(similarity * strength) / sum(similarity) AS score,
           least(sum(similarity) / max(kn.known), 1) AS confidence
    FROM interactions i JOIN ({_neighbours('concert_id', 'user_id', 20)}) n ON n.id1 = i.concert_id
    JOIN (SELECT user_id, count(*) AS known FROM interactions GROUP BY 1) kn ON kn.user_id = i.user_id
    WHERE NOT EXISTS (SELECT 1 FROM interactions k WHERE k.user_id = i.user_id AND k.concert_id = n.id2)
    GROUP BY 1, 2"""


def _liked_sql(entity):
    return f"""SELECT DISTINCT i.user_id, c.{entity} FROM interactions i JOIN concerts c ON i.concert_id = c.concert_id
        WHERE i.strength = 1.0 AND c.{entity} IS NOT NULL"""


_ARTIST_PAIR = """
    0.6::DOUBLE * CASE WHEN len(a.genre) > 0 AND len(b.genre) > 0 THEN len(list_intersect(a.genre, b.genre))::DOUBLE
        / len(list_distinct(list_concat(a.genre, b.genre))) ELSE 0 END
    + 0.4::DOUBLE * (1 - abs(a.popularity_score - b.popularity_score) / 100)"""
_VENUE_PAIR = """
    0.4::DOUBLE * greatest(1 - 2 * 6371::DOUBLE * asin(sqrt(least(1, sin(radians(b.latitude - a.latitude) / 2) ** 2
        + cos(radians(a.latitude)) * cos(radians(b.latitude)) * sin(radians(b.longitude - a.longitude) / 2) ** 2))) / 100, 0)
    + 0.3::DOUBLE * greatest(1 - abs(log10(greatest(a.capacity, 1)) - log10(greatest(b.capacity, 1))) / 3, 0)
    + 0.3::DOUBLE * (a.venue_type = b.venue_type)::INT"""


def _similar_sql(entity, table, pair, k=20):
    return f"""
    SELECT id1, id2, similarity, row_number() OVER (PARTITION BY id1 ORDER BY similarity DESC, id2) AS rank
    FROM (SELECT a.{entity} AS id1, b.{entity} AS id2, round({pair}, 9) AS similarity
          FROM (SELECT * FROM {table} WHERE {entity} IN (SELECT {entity} FROM ({_liked_sql(entity)}))) a
          JOIN {table} b ON a.{entity} <> b.{entity})
    WHERE similarity >= 0.3 QUALIFY rank <= {k}"""


def _preferred(entity, table, pair, k, known=True):
    source = f"""
    SELECT s.user_id, c.concert_id AS item_id, s.score, least(l.n / 5.0::DOUBLE, 1) AS confidence
    FROM (SELECT user_id, {entity}, max(score) AS score FROM (
              SELECT p.user_id, z.id2 AS {entity}, z.similarity AS score FROM ({_liked_sql(entity)}) p
              JOIN ({_similar_sql(entity, table, pair)}) z ON p.{entity} = z.id1
              UNION ALL SELECT user_id, {entity}, 1.0::DOUBLE FROM ({_liked_sql(entity)})) GROUP BY 1, 2) s
    JOIN concerts c ON c.{entity} = s.{entity}
    JOIN (SELECT user_id, count(*) AS n FROM ({_liked_sql(entity)}) GROUP BY 1) l ON l.user_id = s.user_id
    {"WHERE NOT EXISTS (SELECT 1 FROM interactions x WHERE x.user_id = s.user_id AND x.concert_id = c.concert_id)" if known else ""}"""
    return _best(source, k)


def _by_artist(k):
    return _preferred("artist_id", "artists", _ARTIST_PAIR, k)


def _by_venue(k):
    return _preferred("venue_id", "venues", _VENUE_PAIR, k)


def _content(k):
    return _best(f"""SELECT user_id, item_id, sum(score) AS score, max(confidence) AS confidence FROM (
        SELECT * REPLACE (score * 0.6::DOUBLE AS score) FROM ({_by_artist(2 * k)})
        UNION ALL SELECT * REPLACE (score * 0.4::DOUBLE AS score) FROM ({_by_venue(2 * k)})) GROUP BY 1, 2""", k)


_ALL = _best(f"""SELECT user_id, item_id, avg(score) AS score, max(confidence) AS confidence FROM (
    SELECT * FROM ({_best(_USER_SOURCE, 20)}) UNION ALL SELECT * FROM ({_content(20)})) GROUP BY 1, 2""", 10)


def _out(source, algorithm):
    return f"""SELECT user_id, item_id, rank, {rd('score')} AS score, {rd('confidence')} AS confidence,
        '{algorithm}' AS algorithm FROM ({source})"""


def _entities(entity, table, pair, reason, extra):
    source = f"""SELECT p.user_id, z.id2 AS item_id, max(z.similarity) AS score, max(least(l.n / 5.0::DOUBLE, 1)) AS confidence
        FROM ({_liked_sql(entity)}) p JOIN ({_similar_sql(entity, table, pair)}) z ON p.{entity} = z.id1
        JOIN (SELECT user_id, count(*) AS n FROM ({_liked_sql(entity)}) GROUP BY 1) l ON l.user_id = p.user_id GROUP BY 1, 2"""
    return f"""SELECT user_id, item_id, rank, {rd('score')} AS score, {rd('confidence')} AS confidence,
        {reason} AS reasoning, {extra} FROM ({_best(source, 10)}) r JOIN {table} e ON e.{entity} = r.item_id"""


def _reason_sql(entity, table, pair, reason):
    return f"""SELECT r.user_id, r.item_id, r.rank, {reason} AS reasoning, CAST(c.venue_id AS VARCHAR) AS venue_id
        FROM ({_preferred(entity, table, pair, 3, known=False)}) r JOIN concerts c ON c.concert_id = r.item_id
        JOIN {table} e ON e.{entity} = c.{entity}"""


_STATS = """SELECT count(DISTINCT user_id) AS total_users, count(DISTINCT concert_id) AS total_items,
    count(*) AS total_interactions FROM interactions"""
_STAT_COLUMNS = f"""total_users, total_items, total_interactions,
    {rd('1 - total_interactions::DOUBLE / (total_users * total_items)')} AS sparsity,
    {rd('total_interactions::DOUBLE / total_users')} AS avg_interactions_per_user"""
_FULL = "interactions concerts artists venues"
ORACLE = {
    "m01_interaction_matrix": using("interactions", "SELECT user_id, concert_id, strength FROM interactions"),
    "m01_matrix_statistics": using("interactions", f"SELECT {_STAT_COLUMNS} FROM ({_STATS})"),
    "m02_similar_users": using("interactions", f"SELECT id1, id2, {rd('similarity')} AS similarity, rank FROM ({_neighbours('user_id', 'concert_id', 10)})"),
    "m03_similar_concerts": using("interactions", f"SELECT id1, id2, {rd('similarity')} AS similarity, rank FROM ({_neighbours('concert_id', 'user_id', 10)})"),
    "m04_user_based": using("interactions", f"""
        SELECT r.user_id, item_id, rank, {rd('score')} AS score, {rd('confidence')} AS confidence,
               'Based on ' || n || ' similar users' AS reasoning FROM ({_best(_USER_SOURCE, 10)}) r
        JOIN (SELECT id1, max(rank) AS n FROM ({_neighbours('user_id', 'concert_id', 20)}) GROUP BY 1) c ON c.id1 = r.user_id"""),
    "m05_item_based": using("interactions", f"""
        SELECT r.user_id, item_id, rank, {rd('score')} AS score, {rd('confidence')} AS confidence,
               'Similar to ' || n || ' concerts you attended' AS reasoning FROM ({_best(_ITEM_SOURCE, 10)}) r
        JOIN (SELECT user_id, count(*) AS n FROM interactions GROUP BY 1) c ON c.user_id = r.user_id"""),
    "m06_similar_artists": using(_FULL, f"""
        SELECT id1, id2, {rd('similarity')} AS similarity, rank FROM ({_similar_sql('artist_id', 'artists', _ARTIST_PAIR)})"""),
    "m08_similar_venues": using(_FULL, f"""
        SELECT id1, id2, {rd('similarity')} AS similarity, rank FROM ({_similar_sql('venue_id', 'venues', _VENUE_PAIR)})"""),
    "m09_concerts_by_artist": using(_FULL, _out(_by_artist(10), "content_artist")),
    "m10_concerts_by_venue": using(_FULL, _out(_by_venue(10), "content_venue")),
    "m09_artist_reasons": using(_FULL, _reason_sql(
        "artist_id", "artists", _ARTIST_PAIR,
        "'Similar to your preferred artists (genre: ' || array_to_string(e.genre[1:2], ', ') || ')'")),
    "m10_venue_reasons": using(_FULL, _reason_sql(
        "venue_id", "venues", _VENUE_PAIR, "'Similar venue (' || e.venue_type || ', ' || e.city || ')'")),
    "m11_content_hybrid": using(_FULL, _out(_content(10), "content_hybrid")),
    "m12_hybrid_all": using(_FULL, _out(_ALL, "hybrid_all")),
    "m13_recommend_artists": using(_FULL, _entities(
        "artist_id", "artists", _ARTIST_PAIR, "'Similar genres: ' || array_to_string(e.genre[1:2], ', ')",
        "array_to_string(e.genre, ',') AS genres")),
    "m13_recommend_venues": using(_FULL, _entities(
        "venue_id", "venues", _VENUE_PAIR, "'Similar venue: ' || e.venue_type || ' in ' || e.city",
        "CAST(e.capacity AS VARCHAR) AS capacity")),
    "m14_batch_collaborative_user": using("interactions", _out(_best(_USER_SOURCE, 10), "collaborative_user")),
    "m14_batch_collaborative_item": using("interactions", _out(_best(_ITEM_SOURCE, 10), "collaborative_item")),
    "m15_system_statistics": using(_FULL, f"""
        SELECT {_STAT_COLUMNS}, (SELECT count(*) FROM artists) AS total_artists,
               (SELECT count(*) FROM venues) AS total_venues, (SELECT count(*) FROM concerts) AS total_concerts FROM ({_STATS})"""),
}
