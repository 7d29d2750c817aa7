"""Cleaning of raw artist, venue and concert rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.numbers import lookup
from encore.functions.times import as_date
from encore.operators.quality import field_type

# fixed values: venue type words and what they stand for, longest first so that
# "amphitheater" is not taken for a "theater"
VENUE_WORDS = {
    "amphitheater": "amphitheater",
    "amphitheatre": "amphitheater",
    "stadium": "stadium",
    "theater": "theater",
    "theatre": "theater",
    "outdoor": "outdoor",
    "center": "center",
    "centre": "center",
    "arena": "arena",
    "club": "club",
    "hall": "hall",
}
# fixed values: the same words in the order in which the chained replacement visits them
CHAINED_WORDS = (
    "arena", "stadium", "theater", "theatre", "club", "outdoor", "amphitheater", "amphitheatre", "hall", "center",
    "centre",
)
# fixed values: concert status synonyms
STATUS_WORDS = {
    "scheduled": "scheduled",
    "confirmed": "scheduled",
    "completed": "completed",
    "finished": "completed",
    "cancelled": "cancelled",
    "canceled": "cancelled",
    "postponed": "postponed",
    "rescheduled": "postponed",
}
# fixed values: quality score from which a row counts as good
GOOD_SCORE = {"artists": 75, "venues": 80, "concerts": 75}


def clean_name(column: Column, unicode: bool = False, keep: str = "&'-") -> Column:
    """Drop characters outside words, blanks and ``keep``. ASCII words unless ``unicode``."""
    flag = "(?U)" if unicode else ""
    return F.trim(F.regexp_replace(column, rf"{flag}[^\w\s{keep}]", ""))


def _filled(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def _points(worth: int, *conditions: Column) -> Column:
    total = F.lit(0)
    for condition in conditions:
        total = total + F.when(condition, worth).otherwise(0)
    return total


def _number(column: str, df: DataFrame) -> Column:
    return F.col(column).try_cast("double") if isinstance(df.schema[column].dataType, T.StringType) else F.col(column)


def normalize_artists(df: DataFrame, unicode_names: bool = False) -> DataFrame:
    genre = F.col("genre")
    if isinstance(df.schema["genre"].dataType, T.ArrayType):
        genre = F.concat_ws(",", genre)
    parts = F.split(F.lower(F.regexp_replace(genre, "[,;/|]", ",")), ",")
    score = _number("popularity_score", df)
    out = df.withColumns({
        "name_normalized": clean_name(F.col("name"), unicode_names),
        "genres_cleaned": F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""),
        "popularity_score_normalized": F.when(score.isNull() | (score < 0), 0.0)
        .when(score > 100, 100.0).otherwise(score.cast("double")),
        "formation_date_parsed": F.try_to_date(F.col("formation_date").cast("string"), "yyyy-MM-dd"),
        "members_cleaned": F.transform("members", lambda x: F.trim(x)),
    })
    quality = _points(
        25, _filled("name"), F.size("genres_cleaned") > 0, F.col("popularity_score").isNotNull(),
        F.col("formation_date_parsed").isNotNull(),
    )
    return out.withColumn(
        "data_quality_score", F.when(_filled("name") & _filled("artist_id"), quality).otherwise(0)
    )


def _chained_meanings() -> dict[str, str]:
    """What a text ends as whose first word of the chain is the key; the rest of the chain depends on that word alone.

    Replacing the text step by step as an expression would double its size with every word.
    """
    ends = {}
    for i, first in enumerate(CHAINED_WORDS):
        text = VENUE_WORDS[first]
        for word in CHAINED_WORDS[i + 1:]:
            text = VENUE_WORDS[word] if word in text else text
        ends[first] = text
    return ends


def venue_type(column: Column, compat: bool = False) -> Column:
    """Known word contained in the type. ``compat`` lets every later word of the chain overrule the earlier."""
    text = F.lower(F.trim(column))
    expr = None
    for word, meaning in (_chained_meanings() if compat else VENUE_WORDS).items():
        hit = text.contains(word)
        expr = F.when(hit, meaning) if expr is None else expr.when(hit, meaning)
    return expr.otherwise(text)


def normalize_venues(df: DataFrame, unicode_names: bool = False, compat_types: bool = False) -> DataFrame:
    """Accepts nested ``location`` or flat place columns."""
    def place(name: str) -> Column:
        for path in (f"location.{name}", name):
            if field_type(df.schema, path) is not None:
                return F.col(path)
        return F.lit(None)

    capacity = _number("capacity", df)
    lat, lon = place("latitude").cast("double"), place("longitude").cast("double")
    out = df.withColumns({
        "name_normalized": clean_name(F.col("name"), unicode_names),
        "venue_type_normalized": venue_type(F.col("venue_type"), compat_types),
        "capacity_normalized": F.when((capacity > 0) & (capacity <= 200000), capacity),
        "city_normalized": clean_name(place("city"), unicode_names, keep="'-"),
        "state_normalized": F.upper(F.trim(place("state"))),
        "country_normalized": F.upper(F.trim(place("country"))),
        "latitude_validated": F.when(lat.between(-90, 90), lat),
        "longitude_validated": F.when(lon.between(-180, 180), lon),
        "amenities_cleaned": F.transform("amenities", lambda x: F.lower(F.trim(x))),
    })
    quality = _points(
        20, _filled("name"), F.col("capacity_normalized").isNotNull(), _filled("city_normalized"),
        F.col("venue_type_normalized").isNotNull(),
        F.col("latitude_validated").isNotNull() & F.col("longitude_validated").isNotNull(),
    )
    return out.withColumn(
        "data_quality_score", F.when(_filled("name") & _filled("venue_id"), quality).otherwise(0)
    )


def normalize_concerts(df: DataFrame, as_of: str) -> DataFrame:
    year = as_date(as_of).year
    when = F.col("event_date")
    if isinstance(df.schema["event_date"].dataType, T.StringType):
        when = F.try_to_timestamp(when, F.lit("yyyy-MM-dd HH:mm:ss"))
    status = F.lower(F.trim("status"))
    attendance, revenue = _number("total_attendance", df), _number("revenue", df)
    out = df.withColumn("event_date_parsed", when).withColumns({
        "event_date_validated": F.when(
            F.year("event_date_parsed").between(year - 50, year + 5), F.col("event_date_parsed")
        ),
        "status_normalized": lookup(status, STATUS_WORDS, default=status),
        "total_attendance_validated": F.when(attendance.between(0, 500000), attendance),
        "revenue_validated": F.when(revenue.between(0, 100000000), revenue),
    })
    quality = _points(
        25, _filled("concert_id"), F.col("event_date_validated").isNotNull(), _filled("artist_id"), _filled("venue_id")
    )
    keys = _filled("concert_id") & _filled("artist_id") & _filled("venue_id")
    return out.withColumn("data_quality_score", F.when(keys, quality).otherwise(0))


def good_share(normalized: DataFrame, data_type: str) -> DataFrame:
    """Percent of rows at or over the quality score of their type, in one pass."""
    good = F.when(F.col("data_quality_score") >= GOOD_SCORE[data_type], 1.0).otherwise(0.0)
    return normalized.agg(F.coalesce(F.avg(good) * 100, F.lit(0.0)).alias("value")).select(
        F.lit(f"{data_type}_quality_score").alias("metric"), "value"
    )
