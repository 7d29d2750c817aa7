"""Model metrics, comparisons, splits and histories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.operators.ordering import global_position, position_within

REGRESSION_METRICS = ("mae", "rmse", "mape", "r_squared")
RANKING_METRICS = ("precision_at_10", "recall_at_10", "map")


def regression_metrics(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", by: Sequence[str] = ()
) -> DataFrame:
    """MAE, RMSE, MAPE (zero actuals left out, infinite if none is left) and R2 in one aggregation."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    rows = df.filter(a.isNotNull() & p.isNotNull())
    error = p - a
    spread = F.var_pop(a) * F.count(F.lit(1))
    return rows.groupBy(*by).agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.coalesce(F.avg(F.when(a != 0, F.abs(error / a))) * 100, F.lit(float("inf"))).alias("mape"),
        F.when(spread > 0, 1 - F.sum(error * error) / spread).otherwise(0.0).alias("r_squared"),
        F.count(F.lit(1)).alias("num_predictions"),
    )


def ranking_per_user(recommended: DataFrame, truth: DataFrame, ks: Sequence[int] = (5, 10, 20)) -> DataFrame:
    """Precision, recall, NDCG and average precision per user that has truth.

    ``recommended`` holds (user_id, item_id, rank) with rank from 1, ``truth`` (user_id, item_id).
    """
    relevant = truth.select("user_id", "item_id").distinct()
    wanted = relevant.groupBy("user_id").agg(F.count(F.lit(1)).alias("relevant"))
    hit = F.col("hit")
    marked = recommended.join(relevant.withColumn("hit", F.lit(1)), ["user_id", "item_id"], "left").withColumn(
        "hit", F.coalesce(hit, F.lit(0))
    )
    so_far = Window.partitionBy("user_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = marked.withColumn("seen", F.sum("hit").over(so_far))
    sums: list[Column] = [F.sum(F.when(hit == 1, F.col("seen") / F.col("rank")).otherwise(0.0)).alias("ap")]
    for k in ks:
        top = (F.col("rank") <= k) & (hit == 1)
        sums.append(F.count_if(top).alias(f"hits{k}"))
        sums.append(F.sum(F.when(top, 1 / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias(f"dcg{k}"))
    per_user = ranked.groupBy("user_id").agg(*sums).join(wanted, "user_id")
    out = [F.col("user_id")]
    for k in ks:
        ideal = F.aggregate(
            F.sequence(F.lit(1), F.least(F.lit(k), F.col("relevant").cast("int"))),
            F.lit(0.0), lambda acc, i: acc + 1 / F.log2(i + 1),
        )
        out += [
            (F.col(f"hits{k}") / k).alias(f"precision_at_{k}"),
            (F.col(f"hits{k}") / F.col("relevant")).alias(f"recall_at_{k}"),
            (F.col(f"dcg{k}") / ideal).alias(f"ndcg_at_{k}"),
        ]
    return per_user.select(*out, (F.col("ap") / F.col("relevant")).alias("map"))


def ranking_metrics(recommended: DataFrame, truth: DataFrame, ks: Sequence[int] = (5, 10, 20)) -> DataFrame:
    """Means over the users with recommendations and truth."""
    per_user = ranking_per_user(recommended, truth, ks)
    names = [c for c in per_user.columns if c != "user_id"]
    return per_user.agg(
        *[F.coalesce(F.avg(n), F.lit(0.0)).alias(n) for n in names], F.count(F.lit(1)).alias("num_users")
    )


def metric_rows(metrics: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Metric columns as (metric, value) rows."""
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
    return metrics.select(*keep, F.inline(F.array(*pairs)))


def improvement(baseline: Column, challenger: Column, higher_is_better: Column) -> Column:
    gain = F.when(higher_is_better, challenger - baseline).otherwise(baseline - challenger)
    return F.when(baseline != 0, gain / F.abs(baseline) * 100).otherwise(0.0)


def _side_by_side(baseline: DataFrame, challenger: DataFrame, names: Sequence[str]) -> DataFrame:
    left = metric_rows(baseline, names).withColumnRenamed("value", "baseline")
    right = metric_rows(challenger, names).withColumnRenamed("value", "challenger")
    better_up = ~F.col("metric").isin("mae", "rmse", "mape")
    return left.join(right, "metric").withColumn(
        "improvement_pct", improvement(F.col("baseline"), F.col("challenger"), better_up)
    )


def compare_regression(baseline: DataFrame, challenger: DataFrame) -> DataFrame:
    """Metrics of two versions with the improvement and the verdict: MAE and R2 decide, MAE breaks the tie."""
    rows = _side_by_side(baseline, challenger, REGRESSION_METRICS)
    gain = F.max(F.when(F.col("metric") == "mae", F.col("improvement_pct") > 0))
    fit = F.max(F.when(F.col("metric") == "r_squared", F.col("improvement_pct") > 0))
    verdict = rows.agg(gain.alias("gain"), fit.alias("fit")).select(
        F.struct(
            F.when(F.col("gain"), "challenger").otherwise("baseline").alias("winner"),
            F.when(F.col("gain") == F.col("fit"), 0.8).otherwise(0.6).alias("confidence"),
        ).alias("verdict")
    ).scalar()
    return rows.withColumns({"winner": verdict["winner"], "confidence": verdict["confidence"]})


def compare_ranking(baseline: DataFrame, challenger: DataFrame) -> DataFrame:
    """The challenger wins with two of precision@10, recall@10 and MAP."""
    rows = _side_by_side(baseline, challenger, RANKING_METRICS)
    verdict = rows.agg(
        F.when(F.count_if(F.col("improvement_pct") > 0) >= 2, "challenger").otherwise("baseline").alias("winner")
    ).scalar()
    return rows.withColumns({"winner": verdict, "confidence": F.lit(0.8)})


def _check_ratios(train: float, val: float, test: float) -> None:
    if abs(train + val + test - 1.0) > 0.001:
        raise ValueError("ratios must sum to 1")


def seeded(key: str, seed: int) -> Column:
    """Order drawn from key and seed alone, so that a retry or another partitioning draws alike."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def _cuts(n: Column, train: float, val: float) -> Column:
    """Which cut a 1-based position is: the last one of the training part, of the validation part, or none."""
    position = F.col("_position")
    return F.array_compact(F.array(
        F.when(position == F.floor(n * train), "train_end"),
        F.when(position == F.floor(n * (train + val)), "val_end"),
    ))


def _by_cuts(place: Column, train_end: Column, val_end: Column) -> Column:
    return (
        F.when(F.coalesce(place <= train_end, F.lit(False)), "train")
        .when(F.coalesce(place <= val_end, F.lit(False)), "val")
        .otherwise("test")
    )


def _ends(cuts: DataFrame, *group: str) -> DataFrame:
    return cuts.groupBy(*group).agg(*[
        F.max(F.when(F.col("cut") == end, F.col("_place"))).alias(end) for end in ("train_end", "val_end")
    ])


def _positional(df: DataFrame, order: Sequence[Column], train: float, val: float, test: float) -> DataFrame:
    """Only the order's columns are sorted and written; the two rows at the cuts then divide the relation itself."""
    _check_ratios(train, val, test)
    keys = [f"_k{i}" for i in range(len(order))]
    placed = global_position(df.select(*[c.alias(k) for c, k in zip(order, keys)]), [F.col(k) for k in keys], "_position")
    n = placed.agg(F.count(F.lit(1)).alias("n")).scalar()
    cuts = placed.select(F.struct(*keys).alias("_place"), F.explode(_cuts(n, train, val)).alias("cut"))
    ends = _ends(cuts)
    place = F.struct(*[c.alias(k) for c, k in zip(order, keys)])
    split = _by_cuts(place, ends.select("train_end").scalar(), ends.select("val_end").scalar())
    return df.withColumn("split", split)


def temporal_split(
    df: DataFrame, date: str, key: str, train: float = 0.7, val: float = 0.15, test: float = 0.15
) -> DataFrame:
    """Add ``split`` by position in date order (ties by ``key``)."""
    return _positional(df, [F.col(date), F.col(key)], train, val, test)


def random_split(
    df: DataFrame, key: str, seed: int = 42, train: float = 0.7, val: float = 0.15, test: float = 0.15
) -> DataFrame:
    """Exact sizes in an order given by a hash of key and seed, so that a retry splits alike."""
    return _positional(df, [seeded(key, seed), F.col(key)], train, val, test)


def stratified_split(
    df: DataFrame, stratum: str, key: str, seed: int = 42, train: float = 0.7, val: float = 0.15, test: float = 0.15
) -> DataFrame:
    """Exact sizes within each stratum; a stratum with a third of all rows is spread over tasks."""
    _check_ratios(train, val, test)
    slim = df.select(F.col(stratum).alias("_stratum"), seeded(key, seed).alias("_k0"), F.col(key).alias("_k1"))
    placed = position_within(slim, ["_stratum"], [F.col("_k0"), F.col("_k1")], "_position")
    cuts = placed.select(
        "_stratum", F.struct("_k0", "_k1").alias("_place"), F.explode(_cuts(F.col("_size"), train, val)).alias("cut")
    )
    ends = _ends(cuts, "_stratum")  # one row per stratum
    place = F.struct(seeded(key, seed).alias("_k0"), F.col(key).alias("_k1"))
    return df.join(ends, F.col(stratum).eqNullSafe(F.col("_stratum")), "left").withColumn(
        "split", _by_cuts(place, F.col("train_end"), F.col("val_end"))
    ).drop("_stratum", "train_end", "val_end")


def history(records: DataFrame, stamp: str, model: str | None = None, limit: int = 100, **where: str) -> DataFrame:
    """Newest records, optionally of one model and with further equalities; ties go by all other columns."""
    if model is not None:
        where["model_name"] = model
    for column, value in where.items():
        records = records.filter(F.col(column) == value)
    return records.orderBy(F.desc(stamp), *[c for c in sorted(records.columns) if c != stamp]).limit(limit)


def performance_report(evaluations: DataFrame, comparisons: DataFrame, model: str, version: str) -> DataFrame:
    """Evaluations of one version and the number of comparisons it took part in."""
    mine = evaluations.filter((F.col("model_name") == model) & (F.col("model_version") == version))
    met = comparisons.filter(
        (F.col("model_name") == model)
        & ((F.col("baseline_version") == version) | (F.col("challenger_version") == version))
    ).agg(F.count(F.lit(1)).alias("n"))
    return mine.agg(
        F.count(F.lit(1)).alias("num_evaluations"), F.avg("mae").alias("mean_mae"), F.min("mae").alias("best_mae")
    ).withColumn("num_comparisons", met.scalar())


def metric_series(evaluations: DataFrame, names: Sequence[str] = REGRESSION_METRICS) -> DataFrame:
    """Chart series: one row per version and metric."""
    return metric_rows(evaluations, names, keep=["model_name", "model_version"])
