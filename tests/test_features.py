"""Totals as of a day and features known before an event, against plain loops."""

import datetime as dt
import random

from pyspark.sql import functions as F

from encore.operators.ordering import earlier_totals
from encore.plans import features as ft


def test_earlier_totals_with_a_hot_group(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"g{i % 7}", i, rng.randrange(100), rng.randrange(100)) for i in range(3000)] + [(None, 1, 5, 5)]
    got = earlier_totals(
        spark.createDataFrame(rows, "g string, at int, a int, b int").filter("g is not null"), ["at"], ["g"], ["a"], ["b"]
    ).collect()
    seen = {}
    want = {}
    for g, at, a, b in sorted(r for r in rows if r[0]):
        total, top = seen.get(g, (0, None))
        want[g, at] = total, top
        seen[g] = total + a, b if top is None else max(top, b)
    assert {(r.g, r["at"]): (r.a, r.b) for r in got} == want


def test_as_of_totals(spark):
    rng = random.Random(4)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    facts = [(rng.choice(["a", "a", "a", "b", None]), day(rng.randrange(40)), rng.randrange(9)) for _ in range(400)]
    points = [(k, day(n)) for k in "abc" for n in range(0, 45, 4)] + [(None, day(3)), ("a", None), ("a", day(4))]
    got = ft.as_of_totals(
        spark.createDataFrame(facts, "k string, d date, v int"), spark.createDataFrame(points, "k string, d date"), ["k"], "d",
        {"n": F.lit(1), "total": F.col("v")}, {"top": F.col("v")},
    ).collect()
    want = {}
    for k, d in points:
        if k and d:
            past = [v for key, when, v in facts if key == k and when < d]
            want[k, d] = len(past), sum(past), max(past, default=None)
    assert {(r.k, r.d): (r.n, r.total, r.top) for r in got} == want and len(got) == len(want)


def _tables(spark, labels):
    first = dt.datetime(2020, 1, 1)
    concerts = spark.createDataFrame(
        [(i, i % 2, 0, first + dt.timedelta(days=10 * i), "completed", 100 + i, 10.0 * i, {"general": 5.0, "vip": 9.0})
         for i in range(40)],
        "concert_id int, artist_id int, venue_id int, event_date timestamp, status string, total_attendance int, revenue double, "
        "ticket_prices map<string,double>")
    sales = spark.createDataFrame([(i, 1, labels[i]) for i in range(40)], "concert_id int, quantity int, unit_price double")
    artists = spark.createDataFrame([(0, ["x"], 5.0), (1, ["y"], 7.0)], "artist_id int, genre array<string>, popularity_score double")
    venues = spark.createDataFrame([(0, "c", 1000, "arena")], "venue_id int, city string, capacity int, venue_type string")
    return concerts, artists, venues, sales


def test_no_label_in_its_own_history(spark):
    labels = [float(i + 1) for i in range(40)]
    as_of = "2021-06-01"

    def built(labels, **how):
        concerts, artists, venues, sales = _tables(spark, labels)
        targets = ft.training_targets(concerts, sales, as_of)
        return {r.concert_id: r.asDict() for r in ft.sales_features(
            targets, concerts, artists, venues, sales, as_of, point_in_time=True, **how).collect()}

    got = built(labels)
    assert sorted(got) == list(range(2, 40))  # the first concert of each artist has no history
    for i, r in got.items():
        past = [labels[j] for j in range(i) if j % 2 == i % 2]
        other = [labels[j] for j in range(i) if j % 2 != i % 2]
        assert r["actual_sales"] == labels[i] and r["days_until_event"] == 0 and r["venue_location_popularity"] == i
        assert r["artist_total_concerts"] == len(past) and abs(r["historical_avg_sales"] - sum(past) / len(past)) < 1e-9
        assert r["historical_max_sales"] == max(past) and abs(r["similar_concert_avg_sales"] - sum(other) / len(other)) < 1e-9
    later = list(labels)
    later[20:] = [x * 1000 for x in later[20:]]
    changed = built(later)
    for i in range(2, 21):  # what comes on the day or after it changes nothing but the label
        assert {k: v for k, v in changed[i].items() if k != "actual_sales"} == {k: v for k, v in got[i].items() if k != "actual_sales"}
    early = built(labels, lead=25)
    assert early[10]["artist_total_concerts"] == 4 and early[10]["venue_location_popularity"] == 8
    assert early[10]["days_until_event"] == 25


def test_point_in_time_features_read_the_targets_once(spark, monkeypatch):
    day = lambda n: dt.datetime(2020, 1, 1) + dt.timedelta(days=n)
    concerts = spark.createDataFrame(
        [(i, i % 3, i % 4, day(i * 5), "completed", 10 * i, 5.0 * i) for i in range(60)],
        "concert_id int, artist_id int, venue_id int, event_date timestamp, status string, total_attendance int, revenue double",
    )
    sales = spark.createDataFrame([(i, 2, 3.0) for i in range(60)], "concert_id int, quantity int, unit_price double")
    artists = spark.createDataFrame([(i, 50.0, ["rock"]) for i in range(3)], "artist_id int, popularity_score double, genre array<string>")
    venues = spark.createDataFrame([(i, "x", 100, "club") for i in range(4)], "venue_id int, city string, capacity int, venue_type string")
    prices = F.create_map(F.lit("general"), F.lit(10.0))
    targets = ft.training_targets(concerts.withColumn("ticket_prices", prices), sales, "2021-01-01")
    plans, totals = [], ft.as_of_totals

    def seen(facts, points, *more):
        plans.append(points._jdf.queryExecution().optimizedPlan().toString())
        return totals(facts, points, *more)

    monkeypatch.setattr(ft, "as_of_totals", seen)
    rows = ft.sales_features(targets, concerts, artists, venues, sales, "2021-01-01", point_in_time=True, lead=30).collect()
    assert len(plans) == 7 and all("Join" not in p for p in plans[:6])
    assert {r["concert_id"] for r in rows} == {t for t in range(60) if t - 6 > max(t % 3, t % 4)}
