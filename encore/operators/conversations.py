"""Message tables: history, summaries, intents, entities, preferences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# fixed values: intents in the order they are tried, with their patterns
INTENTS = {
    "revenue_analysis": (
        r"\b(revenue|earnings|income|profit)\b",
        r"\b(total|sum)\b.*\b(revenue|earnings)\b",
        r"\b(financial|money)\b.*\b(artist|concert|venue)\b",
        r"\b(highest|most)\b.*\b(earning|revenue)\b",
    ),
    "ticket_sales_query": (
        r"\b(ticket|sales|sold)\b",
        r"\b(how many|total)\b.*\b(ticket|sales)\b",
        r"\b(price|pricing)\b",
        r"\b(ticket).*\b(revenue|sales)\b",
    ),
    "popularity_ranking": (
        r"\b(popular|top|best|ranking|rank)\b",
        r"\b(most|highest)\b.*\b(popular|attended)\b",
        r"\b(trending|hot)\b",
    ),
    "artist_lookup": (
        r"\b(tell me about|who is|information about)\b",
        r"\b(find|search|show|list)\b.*\b(artist|band|musician)\b",
        r"\b(artist|band|musician|performer|singer)\b.*\b(genre|style|type)\b",
    ),
    "venue_search": (
        r"\b(venue|location|place|arena|theater|stadium)\b",
        r"\b(where|find|search)\b.*\b(venue|location)\b",
        r"\b(capacity|seating)\b",
    ),
    "concert_search": (
        r"\b(concert|show|event|performance|gig)\b",
        r"\b(when|upcoming|scheduled)\b.*\b(concert|show)\b",
        r"\b(find|search|list)\b.*\b(concert|show)\b",
    ),
}
# fixed values: conversation intents in the order they are tried, with their keywords
KEYWORD_INTENTS = {
    "artist_lookup": ("artist", "band", "musician", "performer", "who is"),
    "venue_search": ("venue", "location", "place", "where", "arena", "theater"),
    "concert_recommendation": ("recommend", "suggest", "should i", "what concert", "upcoming"),
    "ticket_prediction": ("ticket", "sales", "predict", "forecast", "how many"),
    "data_analysis": ("analyze", "trend", "statistics", "data", "insights"),
}
# fixed values: cities and genres found by substring
CITIES = (
    "new york", "los angeles", "chicago", "houston", "phoenix", "philadelphia", "san antonio", "san diego", "dallas",
    "san jose", "austin", "boston", "seattle", "denver", "nashville", "miami",
)
GENRES = (
    "rock", "pop", "jazz", "blues", "country", "hip hop", "rap", "electronic", "classical", "metal", "indie", "folk",
)
# fixed values: sort column by intent
SORT_KEYS = {
    "popularity_ranking": "popularity_score",
    "revenue_analysis": "revenue",
    "ticket_sales_query": "total_tickets_sold",
}
DEFAULT_LIMIT, MAX_LIMIT = 10, 100


def session_history(
    messages: DataFrame, session, start=None, end=None, limit: int = 50, order: str = "timestamp"
) -> DataFrame:
    """Messages of a session in a time range, oldest first."""
    found = messages.filter(F.col("session_id") == session)
    if start is not None:
        found = found.filter(F.col(order) >= start)
    if end is not None:
        found = found.filter(F.col(order) <= end)
    return found.orderBy(order, *[c for c in sorted(found.columns) if c != order]).limit(limit)


def user_history(messages: DataFrame, user, limit: int = 50, order: str = "timestamp") -> DataFrame:
    """Messages of a user, newest first."""
    ties = [c for c in sorted(messages.columns) if c != order]
    return messages.filter(F.col("user_id") == user).orderBy(F.desc(order), *ties).limit(limit)


def context_summaries(messages: DataFrame, limit: int = 10, order: str = "timestamp") -> DataFrame:
    """Per session: counts by role and the times of the first ``limit`` messages."""
    first = Window.partitionBy("session_id").orderBy(order)
    fetched = messages.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= limit)
    return fetched.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.min(order).alias("first_message"),
        F.max(order).alias("last_message"),
        F.count_if(F.col("role") == "user").alias("user_message_count"),
        F.count_if(F.col("role") == "assistant").alias("assistant_message_count"),
    )


def memory_statistics(messages: DataFrame) -> DataFrame:
    """Totals over all sessions; messages are counted per session first."""
    per_session = messages.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    return per_session.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.sum("n").alias("total_messages"),
        F.avg("n").alias("average_messages_per_session"),
    )


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def classify_intent(text: Column) -> Column:
    """First intent one of whose patterns is found; Unicode word limits, and only a line feed ends a line."""
    lowered = F.lower(text)
    expr = None
    for intent, patterns in INTENTS.items():
        hit = None
        for pattern in patterns:
            one = lowered.rlike(f"(?dU){pattern}")
            hit = one if hit is None else hit | one
        expr = F.when(hit, intent) if expr is None else expr.when(hit, intent)
    return expr.otherwise("unknown")


def detect_intent(text: Column) -> Column:
    """First intent one of whose keywords is contained."""
    lowered = F.lower(text)
    expr = None
    for intent, words in KEYWORD_INTENTS.items():
        hit = None
        for word in words:
            one = lowered.contains(word)
            hit = one if hit is None else hit | one
        expr = F.when(hit, intent) if expr is None else expr.when(hit, intent)
    return expr.otherwise("general_query")


def extract_entities(df: DataFrame, text: str, intent: str = "intent") -> DataFrame:
    """Add ``limit``, ``names``, ``cities`` and ``genres`` found in the text.

    The first number counts as a limit if it is at most 100; quoted names count for artist and venue
    questions.
    """
    lowered = F.lower(text)
    number = F.regexp_extract(F.col(text), r"(?U)\b(\d+)\b", 1).try_cast("decimal(38,0)")
    quoted = F.regexp_extract_all(F.col(text), F.lit('"([^"]+)"'), F.lit(1))
    named = F.col(intent).isin("artist_lookup", "venue_search")

    def contained(words):
        return F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(lowered, w))

    return df.withColumns({
        "limit": F.when(number <= 100, number.cast("int")),
        "names": F.when(named, quoted).otherwise(F.array().cast("array<string>")),
        "cities": F.transform(contained(CITIES), lambda c: F.initcap(c)),
        "genres": contained(GENRES),
    })


def query_context(entities: DataFrame, intent: str = "intent") -> DataFrame:
    """Limit, filters and sort column of each question; the last entity of a kind wins."""
    filters = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("artist_name"), F.when(F.col(intent) == "artist_lookup", F.get("names", F.size("names") - 1))),
        F.struct(F.lit("venue_name"), F.when(F.col(intent) == "venue_search", F.get("names", F.size("names") - 1))),
        F.struct(F.lit("city"), F.get("cities", F.size("cities") - 1)),
        F.struct(F.lit("genre"), F.get("genres", F.size("genres") - 1)),
    ), lambda e: e["col2"].isNotNull()))
    sort = F.lit(None).cast("string")
    for key, column in SORT_KEYS.items():
        sort = F.when(F.col(intent) == key, column).otherwise(sort)
    return entities.withColumns({
        "query_limit": F.least(F.coalesce("limit", F.lit(DEFAULT_LIMIT)), F.lit(MAX_LIMIT)),
        "filters": filters,
        "sort_by": sort,
    })


def merge_preferences(stored: DataFrame, changes: DataFrame, now: dt.datetime) -> DataFrame:
    """Stored preferences (user_id, preferences, created_at, updated_at) after the changes (user_id, preferences).

    A changed key replaces the old value, other keys and ``created_at`` stay, unknown users are added.
    """
    old = F.coalesce("s.preferences", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    fresh = F.col("c.preferences")
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(fresh, k))
    changed = fresh.isNotNull()
    stamp = F.lit(now).cast("timestamp_ntz")
    return stored.alias("s").join(changes.alias("c"), "user_id", "full").select(
        "user_id",
        F.when(changed, F.map_concat(kept, fresh)).otherwise(old).alias("preferences"),
        F.coalesce("s.created_at", stamp).alias("created_at"),
        F.when(changed, stamp).otherwise(F.col("s.updated_at")).alias("updated_at"),
    )
