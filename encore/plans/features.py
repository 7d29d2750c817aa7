"""Feature tables for the venue and the sales model, built for all entities at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.numbers import half_up, lookup, share
from encore.functions.times import as_date, days_before, is_weekend, moment, month_span, season
from encore.operators.ordering import dense_rank_by, earlier_totals, global_position, position_within
from encore.plans.search import genre_text
from encore.session import cut_lineage

# fixed values: feature order, type codes, score weights
VENUE_FEATURES = (
    "total_concerts", "avg_attendance", "avg_attendance_rate", "total_revenue", "avg_revenue_per_event",
    "booking_frequency", "capacity", "venue_type_encoded", "location_popularity", "artist_diversity_score",
    "repeat_booking_rate",
)
VENUE_WEIGHTS = {
    "total_concerts": 0.15,
    "avg_attendance": 0.10,
    "avg_attendance_rate": 0.20,
    "total_revenue": 0.10,
    "avg_revenue_per_event": 0.15,
    "booking_frequency": 0.15,
    "capacity": 0.05,
    "venue_type_encoded": 0.02,
    "location_popularity": 0.03,
    "artist_diversity_score": 0.03,
    "repeat_booking_rate": 0.02,
}
VENUE_TYPE_CODES = {"arena": 4.0, "theater": 3.0, "club": 2.0, "outdoor": 1.0}
SALES_TYPE_CODES = {"arena": 4.0, "stadium": 5.0, "theater": 3.0, "club": 2.0, "outdoor": 1.0, "amphitheater": 3.0}
SALES_FEATURES = (
    "artist_popularity_score", "artist_avg_attendance", "artist_total_concerts", "artist_avg_revenue",
    "artist_genre_popularity", "venue_capacity", "venue_avg_attendance_rate", "venue_popularity_rank",
    "venue_type_encoded", "venue_location_popularity", "historical_avg_sales", "historical_max_sales",
    "similar_concert_avg_sales", "days_until_event", "is_weekend", "month_of_year", "season_encoded",
    "avg_ticket_price", "price_range", "lowest_price", "highest_price",
)
LOW_CONFIDENCE = 0.7


def _zero(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(0.0)).cast("double")


def venue_features(concerts: DataFrame, venues: DataFrame, as_of: str, lookback: int = 365) -> DataFrame:
    """The 11 venue features of every venue with completed concerts, in one aggregation of the facts.

    ``location_popularity`` is the mean number of concerts over all venues and ``repeat_booking_rate``
    the share of distinct artists, as the score was defined; ``city_popularity`` and
    ``returning_artist_share`` hold what those names promise.
    """
    recent = concerts.filter(F.col("event_date") >= moment(days_before(as_of, lookback)))
    done = F.col("status") == "completed"

    def completed(column: str) -> Column:
        return F.when(done, F.col(column))

    # per artist first, so that distinct counts become plain counts of pairs
    pairs = recent.groupBy("venue_id", "artist_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(done).alias("n_done"),
        F.sum(completed("total_attendance")).alias("attendance"),
        F.count(completed("total_attendance")).alias("attended"),
        F.sum(completed("revenue")).alias("revenue"),
        F.count(completed("revenue")).alias("earned"),
        F.min(completed("event_date")).alias("first"),
        F.max(completed("event_date")).alias("last"),
    )
    known = F.col("artist_id").isNotNull()
    per_venue = pairs.groupBy("venue_id").agg(
        F.sum("n").alias("n"),
        F.count_if(known).alias("artists"),
        F.count_if(known & (F.col("n") > 1)).alias("returning"),
        F.sum("n_done").alias("n_done"),
        F.count_if(known & (F.col("n_done") > 0)).alias("artists_done"),
        F.sum("attendance").alias("attendance"),
        F.sum("attended").alias("attended"),
        F.sum("revenue").alias("revenue"),
        F.sum("earned").alias("earned"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    joined = venues.select("venue_id", "city", "capacity", "venue_type").join(per_venue, "venue_id")
    everywhere = per_venue.agg(F.avg("n").alias("n")).scalar()
    per_city = joined.groupBy("city").agg(F.avg("n").alias("city_popularity"))
    mean_attendance = share(F.col("attendance"), F.col("attended"))
    return joined.filter("n_done > 0").join(per_city, "city", "left").select(
        "venue_id",
        F.col("n_done").cast("double").alias("total_concerts"),
        _zero(mean_attendance).alias("avg_attendance"),
        _zero(share(mean_attendance, F.col("capacity"))).alias("avg_attendance_rate"),
        _zero("revenue").alias("total_revenue"),
        _zero(share(F.col("revenue"), F.col("earned"))).alias("avg_revenue_per_event"),
        _zero(share(F.col("n_done"), month_span(F.col("first"), F.col("last")))).alias("booking_frequency"),
        F.col("capacity").cast("double").alias("capacity"),
        lookup(F.lower("venue_type"), VENUE_TYPE_CODES, default=0.0).alias("venue_type_encoded"),
        _zero(everywhere).alias("location_popularity"),
        _zero(share(F.col("artists_done"), F.col("n_done"))).alias("artist_diversity_score"),
        F.when(F.col("artists") > 1, share(F.col("artists"), F.col("n"))).otherwise(0.0).alias("repeat_booking_rate"),
        _zero("city_popularity").alias("city_popularity"),
        _zero(share(F.col("returning"), F.col("artists"))).alias("returning_artist_share"),
    )


def popularity_scores(features: DataFrame) -> DataFrame:
    """Weighted sum of the features, each divided by its maximum, with the dense rank.

    The feature table (one row per venue) is read three times, so it is materialised first.
    """
    features = cut_lineage(features)
    peaks = features.agg(F.struct(*[F.max(c).alias(c) for c in VENUE_WEIGHTS]).alias("peaks")).scalar()
    score = None
    for name, weight in VENUE_WEIGHTS.items():
        scaled = F.when(peaks[name] > 0, F.col(name) / peaks[name]).otherwise(F.col(name)) * weight
        score = scaled if score is None else score + scaled
    # rounded, so that the rank does not hang on the summation order of doubles
    scored = features.withColumn("popularity_score", half_up(score, 6))
    return dense_rank_by(scored, "popularity_score", "popularity_rank").select(
        "venue_id", "popularity_rank", "popularity_score", "avg_attendance_rate", "avg_revenue_per_event",
        "booking_frequency",
    )


def price_features(prices: Column) -> dict[str, Column]:
    """Mean, range, lowest and highest of a tier to price map; 0 without prices."""
    values = F.map_values(prices)
    total = F.aggregate(values, F.lit(0.0), lambda acc, p: acc + p)
    low, high = F.array_min(values), F.array_max(values)
    return {
        "avg_ticket_price": _zero(total / F.nullif(F.size(values), F.lit(0))),
        "price_range": _zero(high - low),
        "lowest_price": _zero(low),
        "highest_price": _zero(high),
    }


def parse_prices(text: Column) -> Column:
    """Tier to price map from its JSON text."""
    return F.from_json(text, "map<string,double>")


def time_features(when: Column, as_of: str) -> dict[str, Column]:
    days = F.greatest(F.datediff(when, F.lit(as_date(as_of))), F.lit(0))
    return {
        "days_until_event": days.cast("double"),
        "is_weekend": is_weekend(when).cast("double"),
        "month_of_year": F.month(when).cast("double"),
        "season_encoded": season(when).cast("double"),
    }


def sales_history(concerts: DataFrame, sales: DataFrame) -> DataFrame:
    """Concerts with the sum, largest value and number of their sales."""
    value = F.col("quantity") * F.col("unit_price")
    per_concert = sales.groupBy("concert_id").agg(
        F.sum(value).alias("sales"), F.max(value).alias("largest"), F.count(F.lit(1)).alias("sold")
    )
    return concerts.join(per_concert, "concert_id", "left")


def sales_features(
    targets: DataFrame, concerts: DataFrame, artists: DataFrame, venues: DataFrame, sales: DataFrame, as_of: str,
    lookback: int = 730, point_in_time: bool = False, lead: int = 0,
) -> DataFrame:
    """The 21 sales features of the target concerts (concert_id, artist_id, venue_id, event_date, ticket_prices).

    Every statistic is an aggregate per artist, venue, city or genre over the lookback. Targets whose
    artist or venue has no completed concert there get none and are left out.

    With ``point_in_time`` each target sees only what was known ``lead`` days before it (:func:`_known_before`), so that
    no label is in its own history; without, all history up to ``as_of`` counts.
    """
    if point_in_time:
        return _known_before(targets, concerts, artists, venues, sales, as_of, lookback, lead)
    recent = sales_history(concerts, sales).filter(F.col("event_date") >= moment(days_before(as_of, lookback)))
    done = recent.filter(F.col("status") == "completed")
    genre = artists.select("artist_id", "popularity_score", genre_text().alias("genre"))
    per_genre = genre.groupBy("genre").agg(F.avg("popularity_score").alias("artist_genre_popularity"))
    artist_stats = (
        done.filter(F.col("artist_id").isNotNull()).groupBy("artist_id").agg(
            F.avg("total_attendance").alias("artist_avg_attendance"),
            F.count(F.lit(1)).alias("artist_total_concerts"),
            F.avg("revenue").alias("artist_avg_revenue"),
        )
        .join(genre, "artist_id").join(per_genre, "genre")
    )
    any_venue = recent.groupBy("venue_id").agg(F.count(F.lit(1)).alias("n"))
    places = venues.select("venue_id", "city", "capacity", "venue_type")
    per_city = places.join(any_venue, "venue_id").groupBy("city").agg(F.sum("n").alias("venue_location_popularity"))
    done_venue = done.groupBy("venue_id").agg(F.avg("total_attendance").alias("attendance"))
    ranks = global_position(
        done_venue.withColumn("attendance", half_up(F.col("attendance"), 6)),
        [F.desc_nulls_first("attendance"), F.col("venue_id").asc()], "venue_popularity_rank",
    ).select("venue_id", "attendance", "venue_popularity_rank")
    venue_stats = places.join(ranks, "venue_id").join(per_city, "city", "left").select(
        "venue_id", "venue_type", F.col("capacity").alias("venue_capacity"),
        share(F.col("attendance"), F.col("capacity")).alias("venue_avg_attendance_rate"),
        "venue_popularity_rank", "venue_location_popularity",
    )
    sold = recent.filter((F.col("sold") > 0) & F.col("artist_id").isNotNull())
    totals = [F.sum("sales").alias("sales"), F.sum("sold").alias("sold")]
    per_artist = sold.groupBy("artist_id").agg(
        (F.sum("sales") / F.sum("sold")).alias("historical_avg_sales"), F.max("largest").alias("historical_max_sales")
    )
    at_venue = sold.groupBy("venue_id").agg(*totals)
    # "similar" concerts are those of other artists at the venue: the venue's total less the artist's own
    own = sold.groupBy("venue_id", "artist_id").agg(F.sum("sales").alias("own_sales"), F.sum("sold").alias("own_sold"))
    joined = (
        targets.join(artist_stats, "artist_id")
        .join(venue_stats, "venue_id")
        .join(per_artist, "artist_id", "left")
        .join(at_venue, "venue_id", "left")
        .join(own, ["venue_id", "artist_id"], "left")
    )
    others = F.col("sold") - F.coalesce("own_sold", F.lit(0))
    similar = F.when(others > 0, (F.col("sales") - F.coalesce("own_sales", F.lit(0.0))) / others)
    return _finished(joined, targets, similar, time_features(F.col("event_date"), as_of))


def _finished(joined: DataFrame, targets: DataFrame, similar: Column, times: dict[str, Column]) -> DataFrame:
    out = joined.withColumns({
        "artist_popularity_score": _zero("popularity_score"),
        "similar_concert_avg_sales": _zero(similar),
        "venue_type_encoded": lookup(F.lower("venue_type"), SALES_TYPE_CODES, default=0.0),
        **times,
        **price_features(F.col("ticket_prices")),
    })
    keep = [c for c in targets.columns if c not in ("event_date", "ticket_prices")]
    return out.select(*keep, *[_zero(c).alias(c) for c in SALES_FEATURES])


def as_of_totals(
    facts: DataFrame, points: DataFrame, key: list[str], day: str, sums: dict[str, Column],
    maxima: dict[str, Column] | None = None,
) -> DataFrame:
    """Totals of each key's facts of days before each point (key and day): one row per distinct point.

    Facts are summed per key and day first; facts and points then stand in one order of key and day, whose prefix totals
    are the answer, so no fact meets a point in a join. Points with a null key or day are left out.
    """
    maxima = maxima or {}
    known = facts.dropna(subset=[*key, day]).groupBy(*key, day).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()], *[F.max(c).alias(n) for n, c in maxima.items()]
    )
    asked = points.select(*key, day).dropna().distinct().withColumn("_asked", F.lit(True))
    merged = known.unionByName(asked, allowMissingColumns=True).groupBy(*key, day).agg(
        F.max("_asked").alias("_asked"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sums],
        *[F.max(n).alias(n) for n in maxima],
    )
    return earlier_totals(merged, [day], key, list(sums), list(maxima)).filter("_asked").drop("_asked")


def _known_before(
    targets: DataFrame, concerts: DataFrame, artists: DataFrame, venues: DataFrame, sales: DataFrame, as_of: str,
    lookback: int, lead: int,
) -> DataFrame:
    """The sales features as they were known at the start of the day ``lead`` days before each target.

    History is what lies in the lookback before ``as_of`` and before that day; a concert's sales are known from the day
    after it. The venue's rank is that of the first day of the month, over all venues with a completed concert before it,
    and 0 where the venue had none. ``days_until_event`` is ``lead``. Targets whose artist or venue has no completed
    concert before are left out.
    """
    day = F.to_date("event_date")
    history = cut_lineage(
        sales_history(concerts, sales).filter(F.col("event_date") >= moment(days_before(as_of, lookback)))
        .select("artist_id", "venue_id", "status", "total_attendance", "revenue", "sales", "largest", "sold", day.alias("seen"))
    )
    places = venues.select("venue_id", "city", "capacity", "venue_type")
    genre = cut_lineage(artists.select("artist_id", "popularity_score", genre_text().alias("genre")))
    per_genre = genre.groupBy("genre").agg(F.avg("popularity_score").alias("artist_genre_popularity"))
    # every statistic reads these rows, so the facts behind them are scanned once
    asked = cut_lineage(targets.withColumn("seen", F.date_sub(day, lead)).join(places, "venue_id").join(
        genre.join(per_genre, "genre"), "artist_id"
    ))
    done = history.filter(F.col("status") == "completed")
    sold = history.filter((F.col("sold") > 0) & F.col("artist_id").isNotNull())
    crowd = {"crowd": F.col("total_attendance"), "counted": F.col("total_attendance").isNotNull().cast("bigint")}

    def named(totals: DataFrame, prefix: str, key: list[str]) -> DataFrame:
        return totals.select(*key, "seen", *[F.col(c).alias(f"{prefix}_{c}") for c in totals.columns if c not in (*key, "seen")])

    sums = {"sales": F.col("sales"), "sold": F.col("sold")}
    earned = {"n": F.lit(1), "earned": F.col("revenue"), "paid": F.col("revenue").isNotNull().cast("bigint")}
    parts = [
        ("artist", ["artist_id"], done, {**crowd, **earned}, {}),
        ("venue", ["venue_id"], done, {**crowd, "n": F.lit(1)}, {}),
        ("city", ["city"], history.join(places.select("venue_id", "city"), "venue_id"), {"n": F.lit(1)}, {}),
        ("by_artist", ["artist_id"], sold, sums, {"largest": F.col("largest")}),
        ("at_venue", ["venue_id"], sold, sums, {}),
        ("own", ["venue_id", "artist_id"], sold, sums, {}),
    ]
    joined = asked
    for prefix, key, facts, added, maxima in parts:
        joined = joined.join(named(as_of_totals(facts, asked, key, "seen", added, maxima), prefix, key), [*key, "seen"], "left")
    ranks = _monthly_ranks(done, as_of, lookback)
    joined = joined.withColumn("month", F.trunc("seen", "month")).join(ranks, ["venue_id", "month"], "left").filter(
        "artist_n > 0 AND venue_n > 0"
    )
    others = F.col("at_venue_sold") - F.coalesce("own_sold", F.lit(0))
    similar = F.when(others > 0, (F.col("at_venue_sales") - F.coalesce("own_sales", F.lit(0.0))) / others)
    joined = joined.withColumns({
        "artist_avg_attendance": share(F.col("artist_crowd"), F.col("artist_counted")),
        "artist_total_concerts": F.col("artist_n"),
        "artist_avg_revenue": share(F.col("artist_earned"), F.col("artist_paid")),
        "venue_capacity": F.col("capacity"),
        "venue_avg_attendance_rate": share(share(F.col("venue_crowd"), F.col("venue_counted")), F.col("capacity")),
        "venue_location_popularity": F.col("city_n"),
        "historical_avg_sales": share(F.col("by_artist_sales"), F.col("by_artist_sold")),
        "historical_max_sales": F.col("by_artist_largest"),
    })
    times = time_features(F.col("event_date"), as_of) | {"days_until_event": F.lit(float(lead))}
    return _finished(joined, targets, similar, times)


def _monthly_ranks(done: DataFrame, as_of: str, lookback: int) -> DataFrame:
    """venue_id, month, venue_popularity_rank: the order by mean attendance at the start of each month of the lookback.

    One row per venue and month from the month after its first concert on.
    """
    last = F.trunc(F.lit(as_date(as_of)), "month")
    monthly = done.select("venue_id", "total_attendance", F.trunc("seen", "month").alias("month"))
    step = F.expr("INTERVAL 1 MONTH")
    points = monthly.groupBy("venue_id").agg(F.min("month").alias("first")).filter(F.col("first") < last).select(
        "venue_id", F.explode(F.sequence(F.add_months("first", 1), last, step)).alias("month")
    )
    totals = as_of_totals(
        monthly, points, ["venue_id"], "month",
        {"crowd": F.col("total_attendance"), "counted": F.col("total_attendance").isNotNull().cast("bigint")},
    )
    means = totals.select("venue_id", "month", half_up(share(F.col("crowd"), F.col("counted")), 6).alias("mean"))
    return position_within(means, ["month"], [F.desc_nulls_first("mean"), F.col("venue_id").asc()], "venue_popularity_rank").select(
        "venue_id", "month", "venue_popularity_rank"
    )


def training_targets(concerts: DataFrame, sales: DataFrame, as_of: str, lookback: int = 730) -> DataFrame:
    """Completed concerts of the lookback with their sales, where there were any."""
    done = sales_history(concerts, sales).filter(
        (F.col("status") == "completed")
        & (F.col("event_date") >= moment(days_before(as_of, lookback)))
        & (F.col("event_date") <= moment(as_of))
        & (F.col("sales") > 0)
    )
    return done.select(
        "concert_id", "artist_id", "venue_id", "event_date", "ticket_prices", F.col("sales").alias("actual_sales")
    )


def confidence() -> Column:
    """Confidence of a sales prediction from the features it rests on, rounded to 3 digits."""
    concerts = F.col("artist_total_concerts")
    artist = F.when(concerts > 0, F.least(concerts / 20.0, F.lit(1.0))).otherwise(0.3)
    past = F.when(F.col("historical_avg_sales") > 0, 1.0).when(F.col("similar_concert_avg_sales") > 0, 0.7).otherwise(0.4)
    rate = F.col("venue_avg_attendance_rate")
    venue = F.when(rate > 0, F.least(rate, F.lit(1.0))).otherwise(0.5)
    days = F.col("days_until_event")
    time = F.when(days > 180, 0.6).when(days > 90, 0.8).when(days > 30, 0.9).otherwise(1.0)
    price = F.when(F.col("avg_ticket_price") > 0, 1.0).otherwise(0.5)
    return half_up(artist * 0.25 + past * 0.25 + venue * 0.20 + time * 0.15 + price * 0.15, 3)


def demo_venue_features(concerts: DataFrame, venues: DataFrame) -> DataFrame:
    """Nine features and the weighted target of the demo venue model, over all completed concerts."""
    done = concerts.filter(F.col("status") == "completed")
    per_venue = done.groupBy("venue_id").agg(
        F.count_distinct("concert_id").alias("total_concerts"),
        F.avg("total_attendance").alias("avg_attendance"),
        F.sum("revenue").alias("total_revenue"),
        F.avg("revenue").alias("avg_revenue_per_concert"),
        F.count_distinct("artist_id").alias("unique_artists"),
    )
    base = venues.select("venue_id", "capacity", "venue_type").join(per_venue, "venue_id").withColumns({
        "avg_capacity_utilization": share(F.col("avg_attendance"), F.col("capacity")) * 100,
        "revenue_per_seat": share(F.col("total_revenue"), F.col("capacity")),
        "concerts_per_month": F.col("total_concerts") / 12,
    })
    peaks = base.agg(F.struct(F.max("total_revenue").alias("r"), F.max("total_concerts").alias("c")).alias("p")).scalar()
    target = (
        F.col("avg_capacity_utilization") * 0.4
        + F.col("total_revenue") / peaks["r"] * 100 * 0.3
        + F.col("total_concerts") / peaks["c"] * 100 * 0.3
    )
    return base.withColumn("popularity_score", target)


def demo_sales_features(concerts: DataFrame, artists: DataFrame, venues: DataFrame, sales: DataFrame) -> DataFrame:
    """Eight features and the target of the demo sales model, one row per completed concert with sales."""
    per_concert = sales.groupBy("concert_id").agg(
        F.sum("quantity").alias("total_tickets_sold"), F.avg("unit_price").alias("avg_ticket_price")
    )
    when = F.col("event_date")
    return (
        concerts.filter(F.col("status") == "completed")
        .join(artists.select("artist_id", F.col("popularity_score").alias("artist_popularity")), "artist_id")
        .join(venues.select("venue_id", F.col("capacity").alias("venue_capacity"), "venue_type"), "venue_id")
        .join(per_concert, "concert_id")
        .select(
            "concert_id", "artist_popularity", "venue_capacity", "avg_ticket_price",
            (F.col("artist_popularity") * (F.col("venue_capacity") / 10000)).alias("artist_venue_score"),
            F.weekday(when).alias("day_of_week"), F.month(when).alias("month"),
            is_weekend(when).cast("int").alias("is_weekend"), "venue_type", "total_tickets_sold",
        )
    )
