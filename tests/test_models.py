"""Orders, splits, metrics, drift and recommendations against small exact versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.operators import drift, evaluate, neighbours, ordering, recommend


def test_global_position_with_a_hot_key(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    rows = ordering.global_position(df, [F.col("k").asc(), F.col("id").asc()]).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(1, 3001))
    assert [(r["k"], r["id"]) for r in rows] == sorted((r["k"], r["id"]) for r in rows)


def test_position_within_and_dense_rank(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2), (None, 5), ("b", 9), ("b", 4)], "g string, v int")
    found = {(r["g"], r["v"]): (r["p"], r["_size"]) for r in ordering.position_within(df, ["g"], [F.col("v").asc()], "p").collect()}
    assert found == {("a", 1): (1, 2), ("a", 3): (2, 2), ("b", 2): (1, 3), ("b", 4): (2, 3), ("b", 9): (3, 3), (None, 5): (1, 1)}
    ranks = ordering.dense_rank_by(spark.createDataFrame([(1.0,), (2.0,), (2.0,), (0.5,)], "s double"), "s").collect()
    assert sorted((r["s"], r["rank"]) for r in ranks) == [(0.5, 3), (1.0, 2), (2.0, 1), (2.0, 1)]


def test_running_sums(spark):
    df = spark.range(500).select(F.col("id").alias("v"), (F.col("id") % 2).alias("g"), F.lit(1).alias("n"))
    rows = ordering.running_sums(df, ["v"], ["n"], ["g"]).collect()
    assert all(r["n"] == r["v"] // 2 + 1 for r in rows)


def test_splits(spark):
    df = spark.range(365).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    parts = {r["split"]: (r["n"], r["lo"], r["hi"]) for r in evaluate.temporal_split(df, "d", "id").groupBy("split").agg(
        F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).collect()}
    assert parts == {"train": (255, 0, 254), "val": (55, 255, 309), "test": (55, 310, 364)}
    random_parts = {r["split"]: r["count"] for r in evaluate.random_split(df, "id").groupBy("split").count().collect()}
    assert random_parts == {"train": 255, "val": 55, "test": 55}
    strata = evaluate.stratified_split(df.withColumn("s", F.col("id") % 3 == 0), "s", "id")
    assert {(r["s"], r["split"]): r["count"] for r in strata.groupBy("s", "split").count().collect()}[(True, "train")] == int(122 * 0.7)
    with pytest.raises(ValueError):
        evaluate.temporal_split(df, "d", "id", 0.5, 0.1, 0.1)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(float(a), float(a + e)) for a, e in zip((100, 200, 300, 400, 500), (10, -10, 10, -10, 10))], "actual double, predicted double")
    row = evaluate.regression_metrics(df).first()
    assert row["mae"] == 10 and row["rmse"] == 10 and row["r_squared"] == pytest.approx(1 - 500 / 100000)
    zero = evaluate.regression_metrics(spark.createDataFrame([(0.0, 1.0)], "actual double, predicted double")).first()
    assert zero["mape"] == math.inf and zero["r_squared"] == 0.0


def test_ranking_metrics(spark):
    recommended = spark.createDataFrame([("u", f"i{i}", i) for i in range(1, 6)], "user_id string, item_id string, rank int")
    truth = spark.createDataFrame([("u", "i1"), ("u", "i3"), ("u", "i6"), ("v", "i1")], "user_id string, item_id string")
    row = evaluate.ranking_metrics(recommended, truth).first()
    assert row["precision_at_5"] == pytest.approx(0.4) and row["recall_at_5"] == pytest.approx(2 / 3)
    assert row["precision_at_10"] == pytest.approx(0.2) and row["num_users"] == 1
    assert row["map"] == pytest.approx((1 + 2 / 3) / 3)
    ideal = 1 + 1 / math.log2(3) + 1 / math.log2(4)
    assert row["ndcg_at_5"] == pytest.approx((1 + 1 / math.log2(4)) / ideal)


def test_challenger_wins(spark):
    df = spark.createDataFrame([(float(a), a + 10.0, a + 5.0) for a in range(100, 600, 100)], "actual double, predicted double, c double")
    rows = evaluate.compare_regression(evaluate.regression_metrics(df), evaluate.regression_metrics(df, predicted="c")).collect()
    assert {r["winner"] for r in rows} == {"challenger"} and {r["confidence"] for r in rows} == {0.8}


def both(spark, base, cur):
    def to(values):
        return spark.createDataFrame([(float(v),) for v in values], "x double")
    return drift.samples(to(base), to(cur), ["x"])


def test_drift_of_shifted_normals(spark):
    rng = np.random.default_rng(0)
    base, cur = rng.normal(100, 15, 1000), rng.normal(120, 20, 800)
    pair = both(spark, base, cur)
    values = np.sort(np.concatenate([base, cur]))
    expected = np.max(np.abs(np.searchsorted(np.sort(base), values, "right") / 1000 - np.searchsorted(np.sort(cur), values, "right") / 800))
    row = drift.kolmogorov_smirnov(pair).first()
    assert row["drift_score"] == pytest.approx(expected) and row["drift_detected"]
    edges = np.linspace(values[0], values[-1], 11)
    b, c = np.histogram(base, edges)[0], np.histogram(cur, edges)[0]
    assert [(r["base"], r["cur"]) for r in drift.bin_counts(pair).orderBy("bin").collect()] == list(zip(b.tolist(), c.tolist()))
    p, q = (b + 1e-10) / (1000 + 1e-9), (c + 1e-10) / (800 + 1e-9)
    assert drift.population_stability(pair).first()["drift_score"] == pytest.approx(float(np.sum((q - p) * np.log(q / p))))
    assert drift.chi_square(pair).first()["drift_detected"]


def test_no_drift(spark):
    rng = np.random.default_rng(1)
    sample = rng.normal(0, 1, 500)
    pair = both(spark, sample, sample)
    assert not drift.population_stability(pair).first()["drift_detected"]
    assert drift.kolmogorov_smirnov(pair).first()["p_value"] == 1.0
    constant = both(spark, [3.0] * 5, [3.0] * 7)
    assert drift.population_stability(constant).first()["drift_score"] == pytest.approx(0.0, abs=1e-9)


@pytest.mark.parametrize("x,degrees,p", [(16.918977604620448, 9, 0.05), (3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05)])
def test_chi_square_tail(spark, x, degrees, p):
    df = spark.createDataFrame([(x, degrees)], "x double, d int")
    assert df.select(drift._chi_square_tail("x", "d")).first()[0] == pytest.approx(p, abs=1e-9)


def brute_neighbours(cells, k, floor):
    vectors = {}
    for user, item, w in cells:
        vectors.setdefault(user, {})[item] = w
    norms = {u: math.sqrt(sum(x * x for x in v.values())) for u, v in vectors.items()}
    out = {}
    for u in vectors:
        scored = []
        for o in vectors:
            if o != u:
                s = sum(w * vectors[o].get(i, 0.0) for i, w in vectors[u].items()) / (norms[u] * norms[o])
                if round(s, 9) >= floor:
                    scored.append((-round(s, 9), o))
        out[u] = [(o, -s) for s, o in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("hot_degree,hot_columns", [(10_000, 5), (12, 3), (5, 5)])
def test_neighbours_with_hot_columns(spark, seed, hot_degree, hot_columns):
    rng = random.Random(seed)
    cells = []
    for user in range(50):
        items = {rng.choice([0, 0, 0, 1, 1, rng.randint(2, 30)]) for _ in range(rng.randint(1, 5))}
        cells += [(user, i, rng.choice([1.0, 0.5, 0.2])) for i in items]
    matrix = spark.createDataFrame(cells, "user_id int, concert_id int, strength double")
    found = {}
    for r in neighbours.cosine_neighbours(matrix, "user_id", "concert_id", 6, 0.1, hot_degree=hot_degree, hot_columns=hot_columns).orderBy("id1", "rank").collect():
        found.setdefault(r["id1"], []).append((r["id2"], pytest.approx(r["similarity"], abs=2e-9)))
    wanted = {u: v for u, v in brute_neighbours(cells, 6, 0.1).items() if v}
    assert wanted.keys() == found.keys()
    for user, rows in wanted.items():
        assert [s for _, s in rows] == [s for _, s in found[user]], user


def test_neighbours_with_negative_strengths(spark):
    rng = random.Random(7)
    cells = []
    for user in range(40):
        items = {rng.choice([0, 0, 0, 1, 1, rng.randint(2, 12)]) for _ in range(rng.randint(1, 5))}
        cells += [(user, i, rng.choice([1.0, 0.5, -0.7, -0.2])) for i in items]
    matrix = spark.createDataFrame(cells, "user_id int, concert_id int, strength double")
    found = {}
    for r in neighbours.cosine_neighbours(matrix, "user_id", "concert_id", 4, 0.1, hot_degree=5).orderBy("id1", "rank").collect():
        found.setdefault(r["id1"], []).append(pytest.approx(r["similarity"], abs=2e-9))
    assert {u: [s for _, s in v] for u, v in brute_neighbours(cells, 4, 0.1).items() if v} == found


def test_many_hot_columns_are_not_joined(spark, monkeypatch):
    """No cell of a hot column goes to the join of pairs; equal rows come in the order of their ids, over several blocks."""
    rng = random.Random(3)
    kinds = [{i: rng.choice([1.0, 0.5, 0.2]) for i in rng.sample(range(12), rng.randint(2, 7))} for _ in range(14)]
    cells = [(user, i, w) for user in range(70) for i, w in kinds[user % 14].items()]
    cells += [(user, None, 0.5) for user in range(70)]
    matrix = spark.createDataFrame(cells, "user_id int, concert_id int, strength double")
    joined = []
    shared = neighbours._shared_columns
    monkeypatch.setattr(neighbours, "_shared_columns", lambda unit, queries: joined.append(unit.filter("c IS NOT NULL").count()) or shared(unit, queries))
    monkeypatch.setattr(neighbours, "LEFT_BLOCK", 5)
    monkeypatch.setattr(neighbours, "RIGHT_BLOCK", 4)
    monkeypatch.setattr(neighbours, "TASK_CELLS", 50)
    found = neighbours.cosine_neighbours(matrix, "user_id", "concert_id", 6, 0.1, hot_degree=4).orderBy("id1", "rank").collect()
    assert joined == [0]
    known = [(u, f"none {u}" if i is None else i, w) for u, i, w in cells]  # a column without a name is shared with nobody
    for user, rows in brute_neighbours(known, 6, 0.1).items():
        assert rows == [(r["id2"], pytest.approx(r["similarity"], abs=2e-9)) for r in found if r["id1"] == user]
    some = neighbours.cosine_neighbours(
        matrix, "user_id", "concert_id", 6, 0.1, spark.createDataFrame([(3,), (40,)], "u int"), hot_degree=4).orderBy("id1", "rank").collect()
    assert some == [r for r in found if r["id1"] in (3, 40)]


def test_predictions_follow_the_target(spark):
    """The sales model explains most of an unseen part; a batch has the model's own predictions, and errors elsewhere."""
    from pyspark.sql import functions as F

    from encore.plans import features as ft
    from encore.plans import models as md

    rng = random.Random(3)
    rows = []
    for i in range(400):
        x = [rng.uniform(0, 10) for _ in ft.SALES_FEATURES]
        rows.append((i, *x, 100 + 20 * x[0] + (50 if x[5] > 5 else 0)))
    names = ", ".join(f"{c} double" for c in ft.SALES_FEATURES)
    features = spark.createDataFrame(rows, f"concert_id int, {names}, actual_sales double")
    model, scores = md.train_and_test(features, "concert_id", "actual_sales", lambda d: md.train_sales_model(d, rounds=15))
    unseen = {r["split"]: r.asDict() for r in scores.collect()}["test"]
    assert unseen["r_squared"] > 0.7 and unseen["num_predictions"] > 40  # a constant has 0
    known = features.filter("concert_id % 2 = 0")
    batch = {r.concert_id: r for r in md.batch_predict(features.select("concert_id"), known, model, "concert_id").collect()}
    own = {r.concert_id: r.predicted for r in model.transform(features).select("concert_id", "predicted").collect()}
    assert len(batch) == 400
    for i, r in batch.items():
        assert (r.predicted, r.error) == ((own[i], None) if i % 2 == 0 else (None, "insufficient data for prediction"))
    weights = md.feature_importances(model, ft.SALES_FEATURES).filter(F.col("importance") > 0.1).collect()
    assert [w.feature for w in weights][:2] == ["artist_popularity_score", "venue_capacity"]


def test_matrix_statistics(spark):
    rows = [("u1", "c1", 1.0, 1), ("u1", "c2", 1.0, 1), ("u2", "c1", 1.0, 1), ("u2", "c3", 0.2, 1), ("u2", "c3", 0.5, 2), ("u3", "c2", 1.0, 1)]
    matrix = neighbours.interaction_matrix(spark.createDataFrame(rows, "user_id string, concert_id string, interaction_strength double, timestamp int"))
    assert {(r["user_id"], r["concert_id"]): r["strength"] for r in matrix.collect()}[("u2", "c3")] == 0.5
    row = neighbours.matrix_statistics(matrix).first()
    assert (row["total_users"], row["total_items"], row["total_interactions"]) == (3, 3, 5)


def test_artist_similarity_prefers_shared_genre(spark):
    artists = spark.createDataFrame([("a", ["rock"], 80.0), ("b", ["Rock"], 75.0), ("c", ["jazz"], 78.0), ("d", [], 10.0)], "artist_id string, genre array<string>, popularity_score double")
    rows = recommend.similar_artists(artists, artists.filter("artist_id = 'a'").select("artist_id")).collect()
    assert [(r["id2"], round(r["similarity"], 4)) for r in sorted(rows, key=lambda r: r["rank"])] == [("b", 0.98), ("c", 0.392)]


def test_similar_artists_equal_all_pairs(spark):
    rng = random.Random(8)
    kinds = ["rock", "Pop", "jazz", "folk"]
    rows = [(i, rng.sample(kinds, rng.randint(0, 3)) if i % 9 else None, rng.choice([0.0, 50.0, rng.uniform(0, 100), None]))
            for i in range(80)]
    artists = spark.createDataFrame(rows, "artist_id int, genre array<string>, popularity_score double")

    def similarity(a, b):
        x, y = ({g.lower() for g in r[1] or []} for r in (a, b))
        shared = len(x & y) / len(x | y) if x and y else 0.0
        return round(0.6 * shared + 0.4 * (1 - abs(a[2] - b[2]) / 100), 9)

    known = [r for r in rows if r[2] is not None]
    for k in (3, 100):
        want = set()
        for a in known:
            best = sorted((-similarity(a, b), b[0]) for b in known if b[0] != a[0] and similarity(a, b) >= 0.3)[:k]
            want |= {(a[0], b, i + 1) for i, (_, b) in enumerate(best)}
        got = recommend.similar_artists(artists, artists.select("artist_id"), k).collect()
        assert {(r["id1"], r["id2"], r["rank"]) for r in got} == want


def test_similar_artists_with_distinct_genre_sets(spark, monkeypatch):
    rng = random.Random(3)
    genres = [f"g{i}" for i in range(50)]
    weights = [1 / (i + 1) for i in range(50)]  # a few genres are everywhere
    rows = []
    for i in range(2500):
        held = set(rng.choices(genres, weights, k=rng.randint(1, 7)))
        rows.append((i, sorted(held, key=lambda g: rng.random()), round(rng.uniform(0, 100), rng.choice([0, 6]))))
    artists = spark.createDataFrame(rows, "artist_id int, genre array<string>, popularity_score double")
    asked = rows[::50]
    joined, inner = [], recommend._sharing_three

    def counted(*parts):
        met = inner(*parts)
        joined.append(met.count())
        return met

    monkeypatch.setattr(recommend, "_sharing_three", counted)
    want = set()
    for a in asked:
        scored = []
        for b in rows:
            x, y = set(a[1]), set(b[1])
            likeness = round(0.6 * len(x & y) / len(x | y) + 0.4 * (1 - abs(a[2] - b[2]) / 100), 9)
            if b[0] != a[0] and likeness >= 0.3:
                scored.append((-likeness, b[0]))
        want |= {(a[0], b, i + 1) for i, (_, b) in enumerate(sorted(scored)[:10])}
    queries = spark.createDataFrame([(a[0],) for a in asked], "artist_id int")
    got = recommend.similar_artists(artists, queries, 10).collect()
    assert {(r["id1"], r["id2"], r["rank"]) for r in got} == want
    assert joined[0] < 0.05 * len(asked) * len(rows)


def test_similar_venues_equal_all_pairs(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice("AB"), "S", rng.choice([None, rng.uniform(57, 62)]), rng.uniform(-180, 180) if i % 2 else rng.choice([179.9, -179.9]), rng.choice([100, 1000, 1000, 50000]), rng.choice(["club", "hall"])) for i in range(60)]
    venues = spark.createDataFrame(rows, "venue_id int, city string, state string, latitude double, longitude double, capacity int, venue_type string")

    def km(a, b):
        la, lo, lb, ob = (math.radians(x) for x in (a[3], a[4], b[3], b[4]))
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((ob - lo) / 2) ** 2
        return 2 * 6371 * math.asin(math.sqrt(min(h, 1)))

    def similarity(a, b):
        place = float(a[1] == b[1]) if a[3] is None or b[3] is None else max(0.0, 1 - km(a, b) / 100)
        size = max(0.0, 1 - abs(math.log10(a[5]) - math.log10(b[5])) / 3)
        return round(0.4 * place + 0.3 * size + 0.3 * (a[6] == b[6]), 9)

    found = {(r["id1"], r["id2"]): r["similarity"] for r in recommend.similar_venues(venues, venues.select("venue_id"), 100).collect()}
    wanted = {(a[0], b[0]): similarity(a, b) for a in rows for b in rows if a[0] != b[0] and similarity(a, b) >= 0.3}
    assert found.keys() == wanted.keys()
    assert all(abs(found[k] - wanted[k]) < 1e-6 for k in wanted)
    few = {}
    for (a, b), v in wanted.items():
        few.setdefault(a, []).append(v)
    for r in recommend.similar_venues(venues, venues.select("venue_id"), 4).collect():
        assert abs(r["similarity"] - sorted(few[r["id1"]], reverse=True)[r["rank"] - 1]) < 1e-6


@pytest.mark.parametrize("sent", [0, 100_000])
def test_preferred_concerts_are_listed_once_per_entity(spark, monkeypatch, sent):
    rng = random.Random(5)
    # thirty artists of equal similarity to each preferred one, repeated concert rows, exclusions
    concerts = [(rng.randrange(400), rng.randrange(40)) for _ in range(600)] + [(7, None), (None, 3)]
    near = [(e, x, rng.choice([1.0, 1.0, 0.5])) for e in range(5) for x in rng.sample(range(40), 30) if x != e]
    liked = [(u, e) for u in range(12) for e in rng.sample(range(6), 3)] + [(0, None), (12, 39)]
    excluded = [(u, rng.randrange(200)) for u in range(12) for _ in range(u * 4)]
    k, rows = 4, []
    best = recommend._best

    def counted(scored, n):
        rows.append(scored.count())
        return best(scored, n)

    monkeypatch.setattr(recommend, "_best", counted)
    monkeypatch.setattr(recommend, "SENT_ROWS", sent, raising=False)
    found = recommend.concerts_by_preference(
        spark.createDataFrame(liked, "user_id long, artist_id long"),
        spark.createDataFrame(near, "id1 long, id2 long, similarity double"),
        spark.createDataFrame(concerts, "concert_id long, artist_id long"), "artist_id", k,
        spark.createDataFrame(excluded, "user_id long, concert_id long"),
    ).collect()
    want = []
    for user in range(13):
        scores = {e: 1.0 for u, e in liked if u == user and e is not None}
        for e, x, s in near:
            if (user, e) in liked:
                scores[x] = max(scores.get(x, 0.0), s)
        listed = [(-scores[e], -1 if c is None else c) for c, e in concerts if e in scores and (user, c) not in excluded]
        want += [(user, n, s, c) for n, (s, c) in enumerate(sorted(listed)[:k], 1)]
    got = [(r["user_id"], r["rank"], -r["score"], -1 if r["item_id"] is None else r["item_id"]) for r in found]
    assert sorted(got) == sorted(want)
    # what is ranked does not grow with the number of similar artists
    assert rows[0] <= 13 * k + 2 * len(excluded)


def test_training_rows_are_dealt_over_all_slots(spark, monkeypatch):
    """However the joins left the rows, training reads equal parts, one a slot, or more where they would be too large."""
    from encore.plans import models as md

    monkeypatch.setattr(md, "DEALT_ROWS", 100)
    slots, seen = spark.sparkContext.defaultParallelism, []
    recorder = type("Recorder", (), {"fit": lambda self, df: seen.append(df)})()
    monkeypatch.setattr(md, "_pipeline", lambda *a, **b: recorder)

    def sizes(df):
        parts = df.groupBy(F.spark_partition_id().alias("part")).count().collect()
        return sorted(r["count"] for r in parts)

    rows = [(i % 50, None if i % 7 == 0 else "club") for i in range(601)]  # repeated rows, nulls
    one = spark.createDataFrame(rows, "concert_id int, venue_type string").coalesce(1)
    uneven = one.union(spark.createDataFrame(rows[:40], one.schema).repartition(7))
    for train in (md.train_venue_model, md.train_sales_model, md.train_demo_venue_model, md.train_demo_sales_model):
        for given in (one, uneven):
            train(given)
            got = sizes(seen[-1])
            assert len(got) == slots and got[-1] - got[0] <= 8
            assert sorted(map(str, seen[-1].collect())) == sorted(map(str, given.collect()))
    monkeypatch.setattr(md, "PART_ROWS", 100)
    assert len(sizes(md.dealt(one))) == slots * -(-601 // (slots * 100))
    assert sizes(md.dealt(one.limit(99))) == [99]
