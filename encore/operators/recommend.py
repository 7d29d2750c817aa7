"""Recommendations for all users at once; one user is a filter on the result or on the inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.similarity import (
    artist_similarity, capacity_similarity, distance_km, place_similarity, venue_similarity,
)
from encore.operators.neighbours import matrix_statistics, similar_concerts, similar_users
from encore.operators.ordering import position_within, running_sums
from encore.session import cut_lineage, shuffle_partitions

NEIGHBOURS = 20
# listed concerts one task ranks, and the length of all lists up to which every task gets them
TASK_ROWS, SENT_ROWS = 2_000_000, 100_000
STRATEGIES = (
    "collaborative_user", "collaborative_item", "content_artist", "content_venue", "content_hybrid", "hybrid_all",
)


def _stable(score: Column) -> Column:
    """Rounded, so that the order does not hang on the summation order of doubles."""
    return F.round(score, 9)


def _best(scored: DataFrame, k: int) -> DataFrame:
    """The k best items per user; ties go to the smaller item id."""
    order = Window.partitionBy("user_id").orderBy(F.desc("score"), "item_id")
    return scored.withColumn("score", _stable(F.col("score"))).withColumn(
        "rank", F.row_number().over(order)
    ).filter(F.col("rank") <= k)


def user_based(matrix: DataFrame, k: int = 10, neighbours: int = NEIGHBOURS, users: DataFrame | None = None) -> DataFrame:
    """Concerts of similar users, by their strength weighted with the similarity."""
    near = similar_users(matrix, neighbours, queries=users).select(
        F.col("id1").alias("user_id"), F.col("id2").alias("other"), "similarity"
    )
    near_count = near.groupBy("user_id").agg(F.count(F.lit(1)).alias("near"))
    known = matrix.select("user_id", F.col("concert_id").alias("item_id"))
    theirs = matrix.select(F.col("user_id").alias("other"), F.col("concert_id").alias("item_id"), "strength")
    scored = near.join(theirs, "other").groupBy("user_id", "item_id").agg(
        (F.sum(F.col("similarity") * F.col("strength")) / F.sum("similarity")).alias("score"),
        F.least(F.sum("similarity") / neighbours, F.lit(1.0)).alias("confidence"),
    ).join(known, ["user_id", "item_id"], "left_anti")
    reason = F.concat(F.lit("Based on "), F.col("near").cast("string"), F.lit(" similar users"))
    return _best(scored, k).join(near_count, "user_id").select(
        "user_id", "item_id", "rank", "score", "confidence", reason.alias("reasoning")
    )


def item_based(matrix: DataFrame, k: int = 10, similar: int = NEIGHBOURS, users: DataFrame | None = None) -> DataFrame:
    """Concerts similar to those the user knows, by the user's strength weighted with the similarity."""
    mine = matrix if users is None else matrix.join(users.select("user_id").distinct(), "user_id", "left_semi")
    # concert_id is the id asked for, so it comes first
    asked = None if users is None else mine.select("concert_id")
    near = similar_concerts(matrix, similar, queries=asked).select(
        F.col("id1").alias("concert_id"), F.col("id2").alias("item_id"), "similarity"
    )
    known = mine.groupBy("user_id").agg(F.count(F.lit(1)).alias("known"))
    scored = mine.join(near, "concert_id").groupBy("user_id", "item_id").agg(
        (F.sum(F.col("similarity") * F.col("strength")) / F.sum("similarity")).alias("score"),
        F.sum("similarity").alias("weight"),
    ).join(mine.select("user_id", F.col("concert_id").alias("item_id")), ["user_id", "item_id"], "left_anti")
    reason = F.concat(F.lit("Similar to "), F.col("known").cast("string"), F.lit(" concerts you attended"))
    return _best(scored, k).join(known, "user_id").select(
        "user_id", "item_id", "rank", "score",
        F.least(F.col("weight") / F.col("known"), F.lit(1.0)).alias("confidence"), reason.alias("reasoning"),
    )


def _top_similar(scored: DataFrame, k: int, min_similarity: float) -> DataFrame:
    best = scored.withColumn("similarity", _stable(F.col("similarity"))).filter(F.col("similarity") >= min_similarity)
    order = Window.partitionBy("id1").orderBy(F.desc("similarity"), "id2")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest_in_scope(members: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(scope, value, id2): of ``members`` (scope, value, id) those nearest to each ``asked`` (scope, value).

    Per distinct value of a scope only the k + 1 smallest ids can be among the k best of anyone, so values are the
    nodes; around an asked value the k + 1 values up to it and the k above are taken. Positions come from a global
    order, so a scope that holds all members is spread over tasks.
    """
    first = Window.partitionBy("scope", "value").orderBy("id")
    values = members.withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") <= k + 1).groupBy(
        "scope", "value"
    ).agg(F.collect_list("id").alias("ids"))
    values = cut_lineage(values)
    placed = position_within(values.select("scope", "value"), ["scope"], [F.col("value")], "place").drop("_size")
    asked = asked.select("scope", "value").distinct()
    both = values.select("scope", "value", F.lit(0).alias("kind"), F.lit(1).alias("at")).unionByName(
        asked.select("scope", "value", F.lit(1).alias("kind"), F.lit(0).alias("at"))
    )
    counted = running_sums(both, ["value", "kind"], ["at"], ["scope"]).filter("kind = 1")
    around = counted.select(
        "scope", F.col("value").alias("asked"),
        F.explode(F.sequence(F.greatest(F.col("at") - k, F.lit(1)), F.col("at") + k)).alias("place"),
    )
    return around.join(placed, ["scope", "place"]).join(values, ["scope", "value"]).select(
        "scope", F.col("asked").alias("value"), F.explode("ids").alias("id2")
    )


def _subsets(genre: Column) -> Column:
    """Keys of all single genres and of all pairs of a sorted list."""
    ones = F.transform(genre, lambda g: F.to_json(F.array(g)))
    pairs = F.flatten(F.transform(genre, lambda g, i: F.transform(
        F.filter(genre, lambda h, j: j > i), lambda h: F.to_json(F.array(g, h))
    )))
    return F.concat(ones, pairs)


def _rarest_first(classes: DataFrame, artists: DataFrame) -> DataFrame:
    """class and ordered: its genres from the one with the fewest artists to the one with the most."""
    held = artists.select(F.explode("genre").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("df"))
    each = classes.select("class", F.explode("genre").alias("g")).join(held, "g")
    # a list of genres, not of artists
    return each.groupBy("class").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "g"))), lambda x: x["g"]).alias("ordered"))


def _best_of_node(scored: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("class", "value").orderBy(F.desc("similarity"), "id2")
    return scored.withColumn("_nth", F.row_number().over(best)).filter(F.col("_nth") <= k)


def _sharing_three(nodes: DataFrame, values: DataFrame, ordered: DataFrame, floor: DataFrame) -> DataFrame:
    """(class, value, genre, class2, value2): nodes and values with three genres or more in common that can be good enough.

    Prefix filter: with genres from the rarest on, the first one in common is at least the third from the end of both
    lists, so that frequent genres, which come last, hardly ever join. What the two places still allow in common bounds
    the Jaccard; with the gap in popularity this bounds the similarity, which has to reach the node's ``floor``.
    """
    def places(df: DataFrame, suffix: str) -> DataFrame:
        long = df.join(ordered, "class").filter(F.size("ordered") >= 3)
        return long.select(
            F.col("class").alias(f"class{suffix}"), F.col("value").alias(f"value{suffix}"), F.size("ordered").alias(f"n{suffix}"),
            *[c for c in ("floor",) if c in long.columns], F.posexplode("ordered").alias(f"at{suffix}", "g"),
        ).filter(F.col(f"at{suffix}") <= F.col(f"n{suffix}") - 3)

    left, right = places(nodes.select("class", "value").join(floor, ["class", "value"]), ""), places(values, "2")
    common = F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2"))
    bound = 0.6 * common / (F.col("n") + F.col("n2") - common) + 0.4 * (1 - F.abs(F.col("value") - F.col("value2")) / 100.0)
    met = left.join(right, "g").filter(bound >= F.col("floor") - 1e-8)
    return met.select("class", "value", "class2", "value2").distinct()


def similar_artists(artists: DataFrame, queries: DataFrame, k: int = 10, min_similarity: float = 0.3) -> DataFrame:
    """(id1, id2, similarity, rank) for the artists asked for.

    Artists of equal genres and popularity are one node. With the genres in common and the number of the other's genres
    fixed, the similarity falls with the gap in popularity alone, so the nearest k on either side are enough: of all
    artists (nothing in common), of the same genres, and of those that have a genre, or a pair of genres, and as many
    genres in all. That settles every partner with at most two genres in common at a cost of k for each of these lists,
    whatever their length, and gives each node a similarity to beat; partners with three or more in common are joined
    through their rarest genres as far as they can still reach it (:func:`_sharing_three`).
    """
    none = F.array().cast("array<string>")
    base = artists.select(
        F.col("artist_id").alias("id"),
        F.array_sort(F.array_distinct(F.transform(F.coalesce("genre", none), lambda g: F.lower(g)))).alias("genre"),
        F.col("popularity_score").cast("double").alias("value"),
    ).filter(F.col("value").isNotNull()).withColumn("class", F.concat(F.lit("c:"), F.to_json("genre")))
    base = cut_lineage(base)
    asked = base.join(queries.select(F.col(queries.columns[0]).alias("id")).distinct(), "id", "left_semi")
    nodes = asked.select("class", "genre", "value").distinct()

    sized = F.struct(F.size("genre").alias("n"), F.col("key"))
    of_keys = base.select("genre", "value", "id", F.explode(_subsets(F.col("genre"))).alias("key"))
    members = base.select(F.explode(F.array("class", F.lit("*"))).alias("scope"), "value", "id").unionByName(
        of_keys.select(F.to_json(sized).alias("scope"), "value", "id")
    )
    lists = of_keys.select("key", F.to_json(sized).alias("scope")).distinct()
    wanted = nodes.select("class", "genre", "value", F.explode(_subsets(F.col("genre"))).alias("key")).join(lists, "key")
    wanted = wanted.select("class", "genre", "value", "scope").unionByName(
        nodes.select("class", "genre", "value", F.explode(F.array("class", F.lit("*"))).alias("scope"))
    )
    found = wanted.join(nearest_in_scope(members, wanted, k), ["scope", "value"]).select(
        "class", "genre", "value", "id2"
    ).distinct()
    other = base.select(F.col("id").alias("id2"), F.col("genre").alias("g2"), F.col("value").alias("s2"))
    similarity = _stable(artist_similarity(F.col("genre"), F.col("g2"), F.col("value"), F.col("s2"))).alias("similarity")
    # equal artists have equal lists, so the k + 1 best are chosen once for all of them
    first = cut_lineage(_best_of_node(found.join(other, "id2").select("class", "value", "id2", similarity), k + 1))
    floor = first.groupBy("class", "value").agg(
        F.greatest(F.coalesce(F.min(F.when(F.col("_nth") == k + 1, F.col("similarity"))), F.lit(min_similarity)), F.lit(min_similarity)).alias("floor")
    )
    classes = base.select("class", "genre").distinct()
    near = _sharing_three(nodes, base.select("class", "value").distinct(), _rarest_first(classes, base), floor)
    smallest = Window.partitionBy("class", "value").orderBy("id")
    fellows = base.withColumn("_nth", F.row_number().over(smallest)).filter(F.col("_nth") <= k + 1).select(
        F.col("class").alias("class2"), F.col("value").alias("value2"), F.col("genre").alias("g2"), F.col("id").alias("id2")
    )
    second = near.join(classes, "class").join(fellows, ["class2", "value2"]).select(
        "class", "value", "id2",
        _stable(artist_similarity(F.col("genre"), F.col("g2"), F.col("value"), F.col("value2"))).alias("similarity"),
    )
    listed = _best_of_node(first.drop("_nth").unionByName(second).distinct(), k + 1)
    pairs = asked.select(F.col("id").alias("id1"), "class", "value").join(listed, ["class", "value"]).filter(
        F.col("id1") != F.col("id2")
    )
    return _top_similar(pairs.select("id1", "id2", "similarity"), k, min_similarity)


def similar_venues(venues: DataFrame, queries: DataFrame, k: int = 10, min_similarity: float = 0.3) -> DataFrame:
    """(id1, id2, similarity, rank) for the venues asked for.

    A pair reaches 0.3 only with the same type, with equal capacity, or with a place that counts. Where the place
    counts nothing, or the city stands for it, the similarity falls with the gap in capacity alone, so the nearest k
    on either side are enough: of the type, of all venues, and of the city with and without the type. Venues within
    100 km meet through cells of 1 degree latitude by 2 degrees longitude and their neighbours; beyond 58 degrees,
    where meridians draw together, through the latitude alone.
    """
    if min_similarity < 0.3:
        raise ValueError("candidates cover similarities from 0.3 on")
    base = venues.select(
        "venue_id", "city", "state", "latitude", "longitude", "capacity", "venue_type",
        F.log10(F.greatest(F.col("capacity"), F.lit(1)).cast("double")).alias("value"),
    )
    asked = base.join(queries.select(F.col(queries.columns[0]).alias("venue_id")).distinct(), "venue_id", "left_semi")

    def key(prefix: str, *values: Column) -> Column:
        named = F.concat_ws(":", F.lit(prefix), *[v.cast("string") for v in values])
        known = [v.isNotNull() for v in values]
        return F.when(reduce(lambda x, y: x & y, known, F.lit(True)), named)

    kind, city, state = F.col("venue_type"), F.lower("city"), F.lower("state")
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    town = [key("town", city, state), key("town-type", city, state, kind)]
    lost = [key("lost", city, state), key("lost-type", city, state, kind)]
    whole = [F.lit("*"), key("type", kind)]
    mine = F.array_compact(F.array(*whole, *town, *[F.when(~located, x) for x in lost]))
    # with coordinates a venue meets those of its city that have none; without, it meets all of them
    sought = F.array_compact(F.array(
        *whole, *[F.when(located, x) for x in lost], *[F.when(~located, x) for x in town],
    ))
    members = base.select(F.explode(mine).alias("scope"), "value", F.col("venue_id").alias("id"))
    wanted = asked.select(F.col("venue_id").alias("id1"), F.explode(sought).alias("scope"), "value")
    by_size = wanted.join(nearest_in_scope(members, wanted, k), ["scope", "value"]).select("id1", "id2")

    lat, lon = F.floor("latitude"), F.pmod(F.floor(F.col("longitude") / 2), F.lit(180))
    far_north = F.abs("latitude") >= 58
    cells = [
        F.when(F.abs("latitude") < 60, key("cell", lat + i, F.pmod(lon + j, F.lit(180))))
        for i in (-1, 0, 1) for j in (-1, 0, 1)
    ]
    rows = [F.when(far_north, key("lat", lat + i)) for i in (-1, 0, 1)]
    spot = ["latitude", "longitude"]
    left = asked.filter(located).select(
        F.col("venue_id").alias("id1"), *[F.col(c).alias(f"{c}1") for c in spot], F.explode(F.array_compact(F.array(*cells, *rows))).alias("key")
    )
    right = base.filter(located).select(
        F.col("venue_id").alias("id2"), *[F.col(c).alias(f"{c}2") for c in spot],
        F.explode(F.array_compact(F.array(cells[4], rows[1]))).alias("key"),
    )
    distance = distance_km(F.col("latitude1"), F.col("longitude1"), F.col("latitude2"), F.col("longitude2"))
    by_place = left.join(right, "key").filter(distance < 100).select("id1", "id2")

    names = [c for c in base.columns if c not in ("venue_id", "value")]
    pairs = by_size.unionByName(by_place).filter(F.col("id1") != F.col("id2")).distinct()
    for i in (1, 2):
        pairs = pairs.join(
            base.select(F.col("venue_id").alias(f"id{i}"), *[F.col(c).alias(f"{c}{i}") for c in names]), f"id{i}"
        )
    same_place = (F.lower("city1") == F.lower("city2")) & (F.lower("state1") == F.lower("state2"))
    similarity = venue_similarity(
        place_similarity(distance, same_place),
        capacity_similarity(F.col("capacity1"), F.col("capacity2")),
        F.col("venue_type1") == F.col("venue_type2"),
    )
    return _top_similar(pairs.select("id1", "id2", similarity.alias("similarity")), k, min_similarity)


def _preference_scores(preferences: DataFrame, similar: DataFrame, entity: str) -> DataFrame:
    """Best similarity per user and entity over the user's preferred entities."""
    near = similar.select(F.col("id1").alias(entity), F.col("id2").alias("near"), "similarity")
    return preferences.join(near, entity).groupBy("user_id", F.col("near").alias(entity)).agg(
        F.max("similarity").alias("score")
    )


def _confidence(preferences: DataFrame, entity: str) -> DataFrame:
    return preferences.groupBy("user_id").agg(
        F.least(F.count_distinct(entity) / 5.0, F.lit(1.0)).alias("confidence")
    )


def concerts_by_preference(
    preferences: DataFrame, similar: DataFrame, concerts: DataFrame, entity: str, k: int = 10,
    exclude: DataFrame | None = None,
) -> DataFrame:
    """Concerts of the preferred (score 1) and similar entities; ``entity`` is artist_id or venue_id.

    A concert among a user's best k stands, in the list of the preferred entity that gives it its score, behind fewer
    than k concerts besides those the user excludes. So each preferred entity gets one list of its best concerts, however
    many users share it, and a user reads as much of it as can count; the exclusions are counted per user and list.
    """
    preferences = preferences.select("user_id", F.col(entity).alias("_liked")).distinct()
    liked = preferences.select("_liked").distinct()
    near = cut_lineage(
        similar.select(F.col("id1").alias("_liked"), F.col("id2").alias(entity), "similarity").join(liked, "_liked", "left_semi")
        .unionByName(liked.select("_liked", F.col("_liked").alias(entity), F.lit(1.0).alias("similarity")))
        .filter(F.col(entity).isNotNull()).groupBy("_liked", entity).agg(F.max(_stable(F.col("similarity"))).alias("score"))
    )
    held = cut_lineage(concerts.select("concert_id", entity).join(near.select(entity).distinct(), entity, "left_semi"))
    wanted = preferences.withColumn("dropped", F.lit(0).cast("bigint"))
    if exclude is not None:
        dropped = exclude.select("user_id", "concert_id").distinct()
        counts = cut_lineage(dropped.join(held, "concert_id").groupBy("user_id", entity).agg(F.count(F.lit(1)).alias("n")))
        per_list = counts.join(near.select("_liked", entity), entity).groupBy("user_id", "_liked").agg(F.sum("n").alias("dropped"))
        wanted = preferences.join(per_list, ["user_id", "_liked"], "left").fillna(0, ["dropped"])
    wanted = cut_lineage(wanted.withColumn("take", F.col("dropped") + k))
    reach = wanted.groupBy("_liked").agg(F.max("take").alias("reach"))
    sums = wanted.agg(F.max("take").alias("most"), F.sum("take").alias("all")).first()
    by_id = Window.partitionBy(entity).orderBy("concert_id")
    placed = held.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= (sums["most"] or k))
    by_score = Window.partitionBy("_liked").orderBy(F.desc("score"), "concert_id")
    lists = cut_lineage(
        near.join(reach, "_liked").join(placed, entity).filter("place <= reach")
        .withColumn("nth", F.row_number().over(by_score)).filter("nth <= reach").drop("reach")
    )
    if lists.count() <= SENT_ROWS:
        # a row here becomes ``take`` rows, so tasks are cut by these
        parts = max(shuffle_partitions(lists.sparkSession), (sums["all"] or 0) // TASK_ROWS)
        listed = wanted.repartition(parts, "user_id").join(F.broadcast(lists), "_liked")
    else:
        listed = wanted.join(lists, "_liked")
    listed = listed.filter("nth <= take")
    # a concert row is its entity and place, so that repeated ids stay
    found = listed.groupBy("user_id", entity, "place", F.col("concert_id").alias("item_id")).agg(F.max("score").alias("score"))
    if exclude is not None:
        spare = counts.groupBy("user_id").agg(F.sum("n").alias("spare"))
        order = Window.partitionBy("user_id").orderBy(F.desc(_stable(F.col("score"))), "item_id")
        found = found.withColumn("nth", F.row_number().over(order)).join(spare, "user_id", "left").filter(
            F.col("nth") <= F.coalesce("spare", F.lit(0)) + k)
        found = found.join(dropped.withColumnRenamed("concert_id", "item_id"), ["user_id", "item_id"], "left_anti")
    return _best(found, k).join(_confidence(preferences.withColumnRenamed("_liked", entity), entity), "user_id").select(
        "user_id", "item_id", "rank", "score", "confidence"
    )


def with_reasons(found: DataFrame, concerts: DataFrame, entities: DataFrame, entity: str) -> DataFrame:
    """Add the reason of a content match and the artist and venue of the concert."""
    if entity == "artist_id":
        reason = F.concat(
            F.lit("Similar to your preferred artists (genre: "), F.array_join(F.slice("genre", 1, 2), ", "), F.lit(")")
        )
        bare = "Artist match"
    else:
        reason = F.concat(F.lit("Similar venue ("), F.col("venue_type"), F.lit(", "), F.col("city"), F.lit(")"))
        bare = "Venue match"
    about = concerts.select(F.col("concert_id").alias("item_id"), "artist_id", "venue_id")
    metadata = F.create_map(
        F.lit("artist_id"), F.col("artist_id").cast("string"), F.lit("venue_id"), F.col("venue_id").cast("string")
    )
    return (
        found.join(about, "item_id")
        .join(entities.select(entity, reason.alias("reasoning")), entity, "left")
        .select(*found.columns, F.coalesce("reasoning", F.lit(bare)).alias("reasoning"), metadata.alias("metadata"))
    )


def content_hybrid(by_artist: DataFrame, by_venue: DataFrame, k: int = 10) -> DataFrame:
    """0.6 artist + 0.4 venue over the two lists (made with 2k each), with the better confidence."""
    both = by_artist.withColumn("score", F.col("score") * 0.6).unionByName(
        by_venue.withColumn("score", F.col("score") * 0.4)
    )
    merged = both.groupBy("user_id", "item_id").agg(F.sum("score").alias("score"), F.max("confidence").alias("confidence"))
    return _best(merged, k).select("user_id", "item_id", "rank", "score", "confidence")


def hybrid_all(collaborative: DataFrame, content: DataFrame, k: int = 10) -> DataFrame:
    """Mean score where both lists (2k each) name a concert, with the better confidence."""
    columns = ["user_id", "item_id", "score", "confidence"]
    merged = collaborative.select(*columns).unionByName(content.select(*columns)).groupBy("user_id", "item_id").agg(
        F.avg("score").alias("score"), F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("sources")
    )
    return _best(merged, k).select(
        "user_id", "item_id", "rank", "score", "confidence",
        F.when(F.col("sources") > 1, "Hybrid: collaborative + content").otherwise("One source").alias("reasoning"),
    )


def recommend_artists(preferences: DataFrame, artists: DataFrame, k: int = 10) -> DataFrame:
    """Artists similar to the preferred ones; a preferred artist stays if it is similar to another."""
    preferences = preferences.select("user_id", "artist_id").distinct()
    similar = similar_artists(artists, preferences.select("artist_id"), 2 * k)
    scores = _preference_scores(preferences, similar, "artist_id").withColumnRenamed("artist_id", "item_id")
    about = artists.select(
        F.col("artist_id").alias("item_id"),
        F.concat(F.lit("Similar genres: "), F.array_join(F.slice("genre", 1, 2), ", ")).alias("reasoning"),
        F.create_map(
            F.lit("name"), F.col("name"), F.lit("genres"), F.array_join("genre", ","),
            F.lit("popularity"), F.col("popularity_score").cast("string"),
        ).alias("metadata"),
    )
    return _best(scores, k).join(_confidence(preferences, "artist_id"), "user_id").join(about, "item_id")


def recommend_venues(preferences: DataFrame, venues: DataFrame, k: int = 10) -> DataFrame:
    preferences = preferences.select("user_id", "venue_id").distinct()
    similar = similar_venues(venues, preferences.select("venue_id"), 2 * k)
    scores = _preference_scores(preferences, similar, "venue_id").withColumnRenamed("venue_id", "item_id")
    about = venues.select(
        F.col("venue_id").alias("item_id"),
        F.concat(F.lit("Similar venue: "), F.col("venue_type"), F.lit(" in "), F.col("city")).alias("reasoning"),
        F.create_map(
            F.lit("name"), F.col("name"), F.lit("type"), F.col("venue_type"),
            F.lit("capacity"), F.col("capacity").cast("string"), F.lit("city"), F.col("city"),
            F.lit("state"), F.col("state"),
        ).alias("metadata"),
    )
    return _best(scores, k).join(_confidence(preferences, "venue_id"), "user_id").join(about, "item_id")


def recommend(
    strategy: str, users: DataFrame, matrix: DataFrame, artists: DataFrame, venues: DataFrame, concerts: DataFrame,
    artist_preferences: DataFrame, venue_preferences: DataFrame, exclude: DataFrame | None = None, k: int = 10,
) -> DataFrame:
    """(user_id, item_id, rank, score, confidence, algorithm) for the listed users; users without a
    result simply have no rows."""
    def only(df: DataFrame) -> DataFrame:
        return df.join(users.select("user_id").distinct(), "user_id", "left_semi")

    def by_artist(n: int) -> DataFrame:
        liked = only(artist_preferences)
        near = similar_artists(artists, liked.select("artist_id"), NEIGHBOURS)
        return concerts_by_preference(liked, near, concerts, "artist_id", n, exclude)

    def by_venue(n: int) -> DataFrame:
        liked = only(venue_preferences)
        near = similar_venues(venues, liked.select("venue_id"), NEIGHBOURS)
        return concerts_by_preference(liked, near, concerts, "venue_id", n, exclude)

    if strategy == "collaborative_user":
        found = user_based(matrix, k, users=users)
    elif strategy == "collaborative_item":
        found = item_based(matrix, k, users=users)
    elif strategy == "content_artist":
        found = by_artist(k)
    elif strategy == "content_venue":
        found = by_venue(k)
    elif strategy == "content_hybrid":
        found = content_hybrid(by_artist(2 * k), by_venue(2 * k), k)
    elif strategy == "hybrid_all":
        # each of the two lists holds 2k, and the content list is itself merged from lists of twice that
        content = content_hybrid(by_artist(4 * k), by_venue(4 * k), 2 * k)
        found = hybrid_all(user_based(matrix, 2 * k, users=users), content, k)
    else:
        raise ValueError(f"unknown strategy {strategy}")
    return found.select("user_id", "item_id", "rank", "score", "confidence", F.lit(strategy).alias("algorithm"))


def system_statistics(matrix: DataFrame, artists: DataFrame, venues: DataFrame, concerts: DataFrame) -> DataFrame:
    """Matrix statistics and entity counts in one row."""
    out = matrix_statistics(matrix)
    for name, df in (("artists", artists), ("venues", venues), ("concerts", concerts)):
        out = out.withColumn(f"total_{name}", df.agg(F.count(F.lit(1)).alias("n")).scalar())
    return out
