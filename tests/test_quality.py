"""Golden values of the quality checks."""

import pytest
from pyspark.sql import functions as F

from encore.operators import quality as q

AS_OF = "2024-06-01"


def value(df, column):
    return df.agg(column.alias("v")).first()["v"]


def test_completeness_ignores_blank_and_null(spark):
    df = spark.createDataFrame([("A1",), ("A2",), ("",), (None,), ("A5",)], "name string")
    assert value(df, q.completeness("name", df.schema["name"].dataType)) == 60.0


def test_completeness_of_genre(spark):
    df = spark.createDataFrame([(["a"],), (["b"],), (None,), (["c"],), (["d"],)], "genre array<string>")
    assert value(df, q.completeness("genre", df.schema["genre"].dataType)) == 80.0


def test_uniqueness(spark):
    df = spark.createDataFrame([(i,) for i in ("1", "2", "3", "4", "4")], "id string")
    assert value(df, q.uniqueness("id", df.schema["id"].dataType)) == 80.0


@pytest.mark.parametrize("values,low,high,expected", [
    ([85.5, 92.0, 150.0, -10.0, 75.5, None], 0, 100, 60.0),
    ([1000.0, 5000.0, 250000.0, -100.0, 15000.0, 0.0], 1, 200000, 50.0),
])
def test_range(spark, values, low, high, expected):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert value(df, q.range_validity("x", df.schema["x"].dataType, low, high)) == expected


def test_range_of_text_and_of_nothing(spark):
    text = spark.createDataFrame([("abc",), ("",)], "x string")
    assert value(text, q.range_validity("x", text.schema["x"].dataType, 0, 1)) == 0.0
    none = spark.createDataFrame([(None,)], "x double")
    assert value(none, q.range_validity("x", none.schema["x"].dataType, 0, 1)) == 100.0


def test_rule_verdict(spark):
    df = spark.createDataFrame([("a",), ("b",), ("",), ("d",)], "name string")
    rule = q.Rule("name_completeness", "completeness", "name", 80.0, "critical", "complete")
    row = q.rule_results(df, [rule], "artists", AS_OF).first()
    assert (row["score"], row["passed"]) == (75.0, False)


def test_coordinates_nested(spark):
    rows = [((1.0, 2.0),), ((1.0, 2.0),), ((None, None),), ((1.0, None),), ((None, 2.0),)]
    df = spark.createDataFrame(rows, "location struct<latitude: double, longitude: double>")
    assert value(df, q.coordinate_consistency(df.schema)) == 60.0


def test_revenue_per_head(spark):
    df = spark.createDataFrame([(5000.0, 100), (5000.0, 100), (50000.0, 100), (10000.0, 100)], "revenue double, total_attendance int")
    assert value(df, q.revenue_consistency(df.schema)) == 100.0


def test_dirty_artists_fail_the_validity_rule(spark):
    df = spark.createDataFrame(
        [("a1", " The Band ", ["rock"], 150.0), ("a2", "Other", ["pop"], -10.0)],
        "artist_id string, name string, genre array<string>, popularity_score double")
    results = {r["rule_id"]: r for r in q.rule_results(df, q.RULES["artists"], "artists", AS_OF).collect()}
    assert not results["popularity_score_validity"]["passed"]
    assert results["artist_id_uniqueness"]["passed"]


def test_empty_table_fails(spark):
    df = spark.createDataFrame([], "artist_id string, name string, genre array<string>, popularity_score double")
    assert q.quality_summary(q.rule_results(df, q.RULES["artists"], "artists", AS_OF)).first()["status"] == "failed"


def test_missing_column_counts_zero(spark):
    df = spark.createDataFrame([("a",)], "name string")
    assert q.completeness_score(df, ["name", "absent"]).first()["completeness"] == 50.0


def test_orphans_keep_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert q.orphan_count(child, parent, "k", "c").first()["orphans"] == 3
    assert q.orphans(child, parent, "k").count() == 3


def test_outliers(spark):
    df = spark.range(200).select(F.when(F.col("id") == 7, 1e6).otherwise(F.col("id") % 5).cast("double").alias("x"))
    assert q.outliers(df, ["x"]).first()["outlier_count"] == 1
