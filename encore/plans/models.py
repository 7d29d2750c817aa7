"""Training and scoring with MLlib."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.operators.evaluate import random_split, regression_metrics
from encore.session import cut_lineage
from encore.plans.features import LOW_CONFIDENCE, SALES_FEATURES, VENUE_FEATURES, confidence

DEMO_VENUE_FEATURES = (
    "capacity", "total_concerts", "avg_attendance", "avg_revenue_per_concert", "avg_capacity_utilization",
    "unique_artists", "revenue_per_seat", "concerts_per_month", "venue_type_encoded",
)
DEMO_SALES_FEATURES = (
    "artist_popularity", "venue_capacity", "avg_ticket_price", "artist_venue_score", "day_of_week", "month",
    "is_weekend", "venue_type_encoded",
)

#: From so many rows on, training deals them out, and gives no part more than so many.
DEALT_ROWS, PART_ROWS = 100_000, 2_000_000


def training_rows(features: DataFrame, target: str, names: Sequence[str]) -> DataFrame:
    """Target first, then the features in their order, rows with nulls dropped."""
    return features.select(target, *names).dropna()


def _pipeline(names: Sequence[str], regressor, encode: bool = False) -> Pipeline:
    stages = [VectorAssembler(inputCols=list(names), outputCol="features", handleInvalid="skip"), regressor]
    if encode:
        stages.insert(0, StringIndexer(
            inputCol="venue_type", outputCol="venue_type_encoded", stringOrderType="alphabetAsc", handleInvalid="keep"
        ))
    return Pipeline(stages=stages)


def dealt(features: DataFrame) -> DataFrame:
    """All rows in equal parts, as many as there are task slots, or a multiple of that where parts would be too large.

    Training makes hundreds of short passes, and each waits for its last task; as the joins before leave the rows, one part
    more than there are slots doubles every pass, and the parts become more with the input. Few rows stay as they lie.
    """
    rows, slots = features.count(), features.sparkSession.sparkContext.defaultParallelism
    return features if rows < DEALT_ROWS else features.repartition(slots * math.ceil(rows / (slots * PART_ROWS)))


def train_venue_model(features: DataFrame, target: str = "popularity_score", rounds: int = 100, seed: int = 42) -> PipelineModel:
    boost = GBTRegressor(
        featuresCol="features", labelCol=target, predictionCol="predicted", maxIter=rounds, maxDepth=5, stepSize=0.2,
        subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed,
    )
    return _pipeline(VENUE_FEATURES, boost).fit(dealt(features))


def train_sales_model(features: DataFrame, target: str = "actual_sales", rounds: int = 150, seed: int = 42) -> PipelineModel:
    boost = GBTRegressor(
        featuresCol="features", labelCol=target, predictionCol="predicted", maxIter=rounds, maxDepth=6, stepSize=0.1,
        subsamplingRate=0.8, featureSubsetStrategy="0.8", minInstancesPerNode=3, seed=seed,
    )
    return _pipeline(SALES_FEATURES, boost).fit(dealt(features))


def train_demo_venue_model(features: DataFrame, trees: int = 100, seed: int = 42) -> PipelineModel:
    forest = RandomForestRegressor(
        featuresCol="features", labelCol="popularity_score", predictionCol="predicted", numTrees=trees, maxDepth=10,
        seed=seed,
    )
    return _pipeline(DEMO_VENUE_FEATURES, forest, encode=True).fit(dealt(features))


def train_demo_sales_model(features: DataFrame, rounds: int = 100, seed: int = 42) -> PipelineModel:
    boost = GBTRegressor(
        featuresCol="features", labelCol="total_tickets_sold", predictionCol="predicted", maxIter=rounds, maxDepth=5,
        stepSize=0.1, seed=seed,
    )
    return _pipeline(DEMO_SALES_FEATURES, boost, encode=True).fit(dealt(features))


def train_and_test(features: DataFrame, key: str, target: str, train) -> tuple[PipelineModel, DataFrame]:
    """Fit on 80% and report the metrics of both parts, one row each.

    The features are materialised once; split, every training round and scoring read them.
    """
    parts = random_split(cut_lineage(features).dropna(), key, train=0.8, val=0.0, test=0.2)
    model = train(parts.filter("split = 'train'"))
    scored = model.transform(parts)
    return model, regression_metrics(scored, target, "predicted", by=["split"])


def feature_importances(model: PipelineModel, names: Sequence[str]) -> DataFrame:
    """(feature, importance), largest first; one row per feature."""
    from pyspark.sql import SparkSession

    weights = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def batch_predict(requests: DataFrame, features: DataFrame, model: PipelineModel, key: str) -> DataFrame:
    """A prediction per request; requests without features stay, with an error."""
    scored = model.transform(features).select(key, "predicted")
    return requests.select(key).join(scored, key, "left").withColumn(
        "error", F.when(F.col("predicted").isNull(), "insufficient data for prediction")
    )


def evaluate_predictions(scored: DataFrame, actual: str = "actual_sales", predicted: str = "predicted") -> DataFrame:
    """Error metrics with the mean confidence and the share of predictions of low confidence."""
    rated = scored.withColumn("confidence_score", confidence())
    trust = rated.agg(F.struct(
        F.avg("confidence_score").alias("mean"), F.count_if(F.col("confidence_score") < LOW_CONFIDENCE).alias("low")
    ).alias("t")).scalar()
    return regression_metrics(rated, actual, predicted).withColumns({
        "avg_confidence_score": trust["mean"],
        "low_confidence_count": trust["low"],
        "low_confidence_percentage": trust["low"] / F.nullif(F.col("num_predictions"), F.lit(0)) * 100,
    })
