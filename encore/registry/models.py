"""Registered model evaluation and monitoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.operators import drift as dr
from encore.operators import evaluate as ev
from encore.registry.analysis import stage
from encore.registry.sqlviews import rd, using

FEATURES = ["actual", "predicted", "lines"]


def _windows(s):
    p = s.predictions()
    return p.filter(F.col("year") < 1999), p.filter(F.col("year") >= 1999)


def _both(s, features=FEATURES):
    base, cur = _windows(s)
    return dr.samples(base, cur.withColumn("actual", F.col("actual") * F.when(F.col("lines") > 3, 1.6).otherwise(1.0)), features)


def _ranking(s, flip=False):
    """Recommended: a user's latest items by time; truth: items the user bought."""
    raw = s.raw_interactions()
    views = raw.filter(F.col("interaction_type") != "purchase").groupBy("user_id", "concert_id").agg(
        F.max(F.struct("timestamp", "event_id")).alias("last"))
    from pyspark.sql import Window
    order = F.col("last").asc() if flip else F.col("last").desc()
    ranked = views.select(
        "user_id", F.col("concert_id").alias("item_id"),
        F.row_number().over(Window.partitionBy("user_id").orderBy(order)).alias("rank"))
    truth = raw.filter(F.col("interaction_type") == "purchase").select("user_id", F.col("concert_id").alias("item_id"))
    return ranked, truth


def _by_year(s):
    return ev.regression_metrics(s.predictions(), by=["year"]).select(
        F.lit("net").alias("model_name"), F.col("year").cast("string").alias("model_version"),
        *ev.REGRESSION_METRICS, "num_predictions")


def _comparison(s):
    p = s.predictions()
    return ev.compare_regression(ev.regression_metrics(p), ev.regression_metrics(p, predicted="challenger"))


def _ranking_comparison(s):
    return ev.compare_ranking(ev.ranking_metrics(*_ranking(s)), ev.ranking_metrics(*_ranking(s, True)))


def _monitored(s):
    base, cur = _windows(s)
    current = cur.withColumn("predicted", F.col("predicted") * 0.2)
    return dr.monitor_regression(ev.regression_metrics(current), ev.regression_metrics(base))


def _monitored_ranking(s):
    return dr.monitor_ranking(ev.ranking_metrics(*_ranking(s, True)), ev.ranking_metrics(*_ranking(s)))


def _split_counts(split):
    def build(s):
        p = s.predictions().select("concert_id", "event_date", "status", "actual")
        return split(p).groupBy("split").agg(
            F.count(F.lit(1)).alias("rows"), F.min("event_date").alias("first"), F.max("event_date").alias("last"),
            F.sum("concert_id").alias("ids"))
    return build


def _stratified(s):
    p = s.predictions().select("concert_id", "status")
    return ev.stratified_split(p, "status", "concert_id").groupBy("status", "split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("concert_id").alias("ids"))


def _random(s):
    p = s.predictions().select("concert_id")
    return ev.random_split(p, "concert_id").groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("concert_id").alias("ids"))


def _report(s):
    per_year = _by_year(s).select("model_name", "model_version", "mae", "r_squared", "num_predictions")
    drifts = per_year.withColumn("drift_detected", F.col("num_predictions") >= 2000)
    performance = ev.metric_rows(_by_year(s), ev.REGRESSION_METRICS, ["model_name", "model_version"]).withColumn(
        "threshold_breached", (F.col("metric") == "r_squared") & (F.col("value") < 0))
    triggers = per_year.filter(F.col("num_predictions") < 2000)
    return dr.monitoring_report(drifts, performance, triggers)


QUERIES = {
    "v01_regression_metrics": stage(lambda s: ev.regression_metrics(s.predictions())),
    "v02_ranking_metrics": stage(lambda s: ev.ranking_metrics(*_ranking(s)), ),
    "v03_compare_regression": stage(_comparison),
    "v04_compare_ranking": stage(_ranking_comparison),
    "v05_performance_report": stage(lambda s: ev.performance_report(
        _by_year(s), _by_year(s).select("model_name", F.col("model_version").alias("baseline_version"),
                                        (F.col("model_version") + 1).cast("int").cast("string").alias("challenger_version")),
        "net", "1998")),
    "v05_evaluation_history": stage(lambda s: ev.history(
        _by_year(s).withColumn("stamp", F.col("model_version")), "stamp", "net", 3)),
    "v06_temporal_split": stage(_split_counts(lambda p: ev.temporal_split(p, "event_date", "concert_id"))),
    "v07_random_split": stage(_random),
    "v08_stratified_split": stage(_stratified),
    "v09_metric_series": stage(lambda s: ev.metric_series(_by_year(s))),
    "n01_kolmogorov_smirnov": stage(lambda s: dr.kolmogorov_smirnov(_both(s))),
    "n02_population_stability": stage(lambda s: dr.population_stability(_both(s))),
    "n03_chi_square": stage(lambda s: dr.chi_square(_both(s, ["predicted", "lines"]))),
    "n04_prediction_drift": stage(lambda s: dr.detect_drift(_both(s, ["actual"]), "psi")),
    "n04_prediction_trigger": stage(lambda s: dr.prediction_trigger(dr.detect_drift(_both(s, ["actual"]), "psi"))),
    "n05_feature_trigger": stage(lambda s: dr.feature_trigger(dr.detect_drift(_both(s), "ks_test"), len(FEATURES))),
    "n06_monitor_regression": stage(_monitored),
    "n06_degradation_trigger": stage(lambda s: dr.degradation_trigger(_monitored(s))),
    "n07_monitor_ranking": stage(_monitored_ranking),
    "n08_monitoring_report": stage(_report),
    "n08_retraining_triggers": stage(lambda s: ev.history(
        _report(s).withColumn("severity", F.when(F.col("drift_detected_count") > 0, "high").otherwise("low")),
        "model_version", "net", 3, severity="high")),
    "d14_bin_counts": stage(lambda s: dr.bin_counts(_both(s))),
}

_METRICS = """avg(abs({p} - actual)) AS mae, sqrt(avg(({p} - actual) ** 2)) AS rmse,
    avg(abs((actual - {p}) / actual)) * 100 AS mape,
    1 - sum((actual - {p}) ** 2) / (var_pop(actual) * count(*)) AS r_squared, count(*) AS num_predictions"""
_NAMES = ev.REGRESSION_METRICS


def _metrics(p="predicted", source="predictions", by=""):
    head = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return f"SELECT {head}{_METRICS.format(p=p)} FROM {source}{tail}"


def _rounded(columns):
    return ", ".join(f"{rd(c)} AS {c}" for c in columns)


def _unpivot(source, names, value, keep=""):
    return " UNION ALL ".join(f"SELECT {keep}'{n}' AS metric, {n} AS {value} FROM {source}" for n in names)


_BY_YEAR = f"SELECT 'net' AS model_name, CAST(year AS VARCHAR) AS model_version, * EXCLUDE (year) FROM ({_metrics(by='year')})"


def _rank_sql(direction):
    return f"""
    SELECT user_id, concert_id AS item_id, rk AS rank FROM (
        SELECT user_id, concert_id, row_number() OVER (PARTITION BY user_id ORDER BY ts {direction}, id {direction}) AS rk
        FROM (SELECT user_id, concert_id, max(("timestamp", event_id))[1] AS ts, max(("timestamp", event_id))[2] AS id
              FROM raw_interactions WHERE interaction_type <> 'purchase' GROUP BY 1, 2))"""


def _rank_metrics(direction):
    per_k = ",\n".join(
        f"""sum(CASE WHEN hit AND rank <= {k} THEN 1 ELSE 0 END) / {k}::DOUBLE AS precision_at_{k},
            sum(CASE WHEN hit AND rank <= {k} THEN 1 ELSE 0 END) / max(n)::DOUBLE AS recall_at_{k},
            sum(CASE WHEN hit AND rank <= {k} THEN 1 / log2(rank + 1) ELSE 0 END)
              / max(list_sum([1 / log2(i + 1) FOR i IN range(1, least({k}, n) + 1)])) AS ndcg_at_{k}"""
        for k in (5, 10, 20))
    names = [f"{m}_at_{k}" for k in (5, 10, 20) for m in ("precision", "recall", "ndcg")] + ["map"]
    return f"""
    SELECT {', '.join(f'avg({n}) AS {n}' for n in names)}, count(*) AS num_users FROM (
        SELECT user_id, {per_k},
               sum(CASE WHEN hit THEN seen / rank::DOUBLE ELSE 0 END) / max(n)::DOUBLE AS map
        FROM (SELECT r.user_id, rank, t.item_id IS NOT NULL AS hit, n,
                     count(t.item_id) OVER (PARTITION BY r.user_id ORDER BY rank) AS seen
              FROM ({_rank_sql(direction)}) r
              LEFT JOIN (SELECT DISTINCT user_id, concert_id AS item_id FROM raw_interactions
                         WHERE interaction_type = 'purchase') t ON r.user_id = t.user_id AND r.item_id = t.item_id
              JOIN (SELECT user_id, count(DISTINCT concert_id) AS n FROM raw_interactions
                    WHERE interaction_type = 'purchase' GROUP BY 1) c ON r.user_id = c.user_id)
        GROUP BY user_id)"""


_RANK_NAMES = [f"{m}_at_{k}" for k in (5, 10, 20) for m in ("precision", "recall", "ndcg")] + ["map"]
_SAMPLES = """
    SELECT 'actual' AS feature, CASE WHEN year < 1999 THEN actual
           WHEN lines > 3 THEN actual * 1.6::DOUBLE ELSE actual * 1.0::DOUBLE END AS value, year < 1999 AS is_base FROM predictions
    UNION ALL SELECT 'predicted', predicted, year < 1999 FROM predictions
    UNION ALL SELECT 'lines', lines, year < 1999 FROM predictions"""
_BINS = f"""
    SELECT g.feature, g.bin, count(CASE WHEN is_base THEN 1 END) AS base, count(CASE WHEN NOT is_base THEN 1 END) AS cur
    FROM (SELECT feature, lo, hi, unnest(range(0, 10)) AS bin FROM ends) g
    LEFT JOIN (SELECT s.feature, is_base, least(floor((value - lo) / ((hi - lo) / 10)), 9) AS bin
               FROM smp s JOIN ends e ON s.feature = e.feature) x ON g.feature = x.feature AND g.bin = x.bin
    GROUP BY g.feature, g.bin"""
_DRIFT_HEAD = f"""WITH smp AS ({_SAMPLES}), ends AS (SELECT feature, min(value) AS lo, max(value) AS hi FROM smp GROUP BY 1),
    bins AS ({_BINS}), tot AS (SELECT feature, sum(base) AS nb, sum(cur) AS nc FROM bins GROUP BY 1)"""
_PSI = """SELECT b.feature, sum(((cur + 1e-10) / (nc + 1e-9) - (base + 1e-10) / (nb + 1e-9))
             * ln(((cur + 1e-10) / (nc + 1e-9)) / ((base + 1e-10) / (nb + 1e-9)))) AS score
          FROM bins b JOIN tot t ON b.feature = t.feature GROUP BY b.feature"""
_CHI = """SELECT b.feature, sum((cur + 1e-10 - (base / nb * nc + 1e-10)) ** 2 / (base / nb * nc + 1e-10)) AS score
          FROM (SELECT feature, base::DOUBLE AS base, cur::DOUBLE AS cur FROM bins) b
          JOIN (SELECT feature, nb::DOUBLE AS nb, nc::DOUBLE AS nc FROM tot) t ON b.feature = t.feature GROUP BY b.feature"""
# upper tail for 9 degrees of freedom: one minus the series of the incomplete gamma function of 9 / 2
_CHI_TAIL = """CASE WHEN score <= 0 THEN 1 WHEN score > 600 THEN 0 ELSE greatest(0, 1 - list_sum(
    [exp((k + 0.5) * ln(score / 2) - score / 2 - lgamma(k + 1.5)) FOR k IN range(4, 1200)])) END"""
_KS = """
    SELECT feature, d, CASE WHEN d <= 0 THEN 1 ELSE least(greatest(2 * list_sum([
               (CASE WHEN k % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) * exp(-2.0::DOUBLE * k * k * (nb * nc / (nb + nc)) * d * d)
               FOR k IN range(1, 101)]), 0), 1) END AS p
    FROM (SELECT r.feature, nb, nc, max(abs(cb / nb - cc / nc)) AS d
          FROM (SELECT feature, value, sum(b) OVER (PARTITION BY feature ORDER BY value)::DOUBLE AS cb,
                       sum(c) OVER (PARTITION BY feature ORDER BY value)::DOUBLE AS cc
                FROM (SELECT feature, value, count(CASE WHEN is_base THEN 1 END) AS b,
                             count(CASE WHEN NOT is_base THEN 1 END) AS c FROM smp GROUP BY 1, 2)) r
          JOIN (SELECT feature, nb::DOUBLE AS nb, nc::DOUBLE AS nc FROM tot) t ON r.feature = t.feature
          GROUP BY r.feature, nb, nc)"""


def _two(names, left, right, down="('mae', 'rmse', 'mape')"):
    return f"""WITH a AS ({left}), b AS ({right}),
    x AS (SELECT l.metric, baseline, challenger, CASE WHEN baseline = 0 THEN 0
              WHEN l.metric IN {down} THEN (baseline - challenger) / abs(baseline) * 100
              ELSE (challenger - baseline) / abs(baseline) * 100 END AS improvement_pct
          FROM ({_unpivot('a', names, 'baseline')}) l JOIN ({_unpivot('b', names, 'challenger')}) r ON l.metric = r.metric)"""


def _degraded(names, now, then, limits):
    return f"""WITH a AS ({now}), b AS ({then}),
    x AS (SELECT *, change_pct > threshold AS threshold_breached FROM (
          SELECT l.metric, metric_value, baseline_value, CASE WHEN baseline_value = 0 THEN 0
                     WHEN l.metric IN ('mae', 'rmse', 'mape') THEN (metric_value - baseline_value) / abs(baseline_value) * 100
                     ELSE (baseline_value - metric_value) / abs(baseline_value) * 100 END AS change_pct,
                 {limits} AS threshold
          FROM ({_unpivot('a', names, 'metric_value')}) l JOIN ({_unpivot('b', names, 'baseline_value')}) r ON l.metric = r.metric))"""


_MONITORED = _degraded(
    _NAMES, _metrics("(predicted * 0.2::DOUBLE)", "(SELECT * FROM predictions WHERE year >= 1999)"),
    _metrics("predicted", "(SELECT * FROM predictions WHERE year < 1999)"),
    "CASE l.metric WHEN 'r_squared' THEN 10.0::DOUBLE ELSE 20.0::DOUBLE END")
_MONITOR_COLUMNS = f"""SELECT metric, {rd('metric_value')} AS metric_value, {rd('baseline_value')} AS baseline_value,
    {rd('change_pct')} AS change_pct, threshold, threshold_breached FROM x"""
_SPLIT = """SELECT *, CASE WHEN rn <= floor(n * 0.7::DOUBLE) THEN 'train'
    WHEN rn <= floor(n * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM (
    SELECT *, row_number() OVER ({order}) AS rn, count(*) OVER ({part}) AS n FROM predictions)"""
_REPORT = f"""
    WITH y AS ({_BY_YEAR})
    SELECT model_name, model_version, 1 AS total_drift_checks, (num_predictions >= 2000)::BIGINT AS drift_detected_count,
           4 AS total_performance_checks, (r_squared < 0)::BIGINT AS performance_issues_count,
           (num_predictions < 2000)::BIGINT AS retraining_triggers_count, (num_predictions >= 2000)::BIGINT::DOUBLE AS drift_detection_rate
    FROM y"""
P = "predictions"
ORACLE = {
    "v01_regression_metrics": using(P, f"SELECT {_rounded(_NAMES)}, num_predictions FROM ({_metrics()})"),
    "v02_ranking_metrics": using("raw_interactions", f"SELECT {_rounded(_RANK_NAMES)}, num_users FROM ({_rank_metrics('DESC')})"),
    "v03_compare_regression": using(P, f"""{_two(_NAMES, _metrics(), _metrics('challenger'))}
        SELECT metric, {_rounded(['baseline', 'challenger', 'improvement_pct'])},
               CASE WHEN gain THEN 'challenger' ELSE 'baseline' END AS winner,
               CASE WHEN gain = fit THEN 0.8::DOUBLE ELSE 0.6::DOUBLE END AS confidence
        FROM x, (SELECT bool_or(metric = 'mae' AND improvement_pct > 0) AS gain,
                        bool_or(metric = 'r_squared' AND improvement_pct > 0) AS fit FROM x)"""),
    "v04_compare_ranking": using("raw_interactions", f"""
        {_two(ev.RANKING_METRICS, _rank_metrics('DESC'), _rank_metrics('ASC'))}
        SELECT metric, {_rounded(['baseline', 'challenger', 'improvement_pct'])},
               (SELECT CASE WHEN count(*) >= 2 THEN 'challenger' ELSE 'baseline' END FROM x WHERE improvement_pct > 0) AS winner,
               0.8::DOUBLE AS confidence FROM x"""),
    "v05_performance_report": using(P, f"""
        WITH y AS ({_BY_YEAR})
        SELECT 1 AS num_evaluations, {rd('mae')} AS mean_mae, {rd('mae')} AS best_mae, 2 AS num_comparisons
        FROM y WHERE model_version = '1998'"""),
    "v05_evaluation_history": using(P, f"""
        SELECT model_name, model_version, {_rounded(_NAMES)}, num_predictions, model_version AS stamp
        FROM ({_BY_YEAR}) ORDER BY model_version DESC LIMIT 3"""),
    "v06_temporal_split": using(P, f"""
        SELECT split, count(*) AS rows, min(event_date) AS first, max(event_date) AS last, CAST(sum(concert_id) AS BIGINT) AS ids
        FROM ({_SPLIT.format(order='ORDER BY event_date, concert_id', part='')}) GROUP BY split"""),
    "v07_random_split": using(P, f"""
        SELECT split, count(*) AS rows, CAST(sum(concert_id) AS BIGINT) AS ids
        FROM ({_SPLIT.format(order="ORDER BY md5(concert_id || ':42'), concert_id", part='')}) GROUP BY split"""),
    "v08_stratified_split": using(P, f"""
        SELECT status, split, count(*) AS rows, CAST(sum(concert_id) AS BIGINT) AS ids
        FROM ({_SPLIT.format(order="PARTITION BY status ORDER BY md5(concert_id || ':42'), concert_id", part='PARTITION BY status')})
        GROUP BY 1, 2"""),
    "v09_metric_series": using(P, f"""
        WITH y AS ({_BY_YEAR}) SELECT model_name, model_version, metric, {rd('value')} AS value
        FROM ({_unpivot('y', _NAMES, 'value', 'model_name, model_version, ')})"""),
    "n01_kolmogorov_smirnov": using(P, f"""{_DRIFT_HEAD}
        SELECT feature, {rd('d')} AS drift_score, {rd('p')} AS p_value, p < 0.05 AS drift_detected FROM ({_KS})"""),
    "n02_population_stability": using(P, f"""{_DRIFT_HEAD}
        SELECT feature, {rd('score')} AS drift_score, score >= 0.2 AS drift_detected FROM ({_PSI})"""),
    "n03_chi_square": using(P, f"""{_DRIFT_HEAD}
        SELECT feature, {rd('score')} AS drift_score, 9 AS degrees, {rd('p')} AS p_value, p < 0.05 AS drift_detected
        FROM (SELECT feature, score, {_CHI_TAIL} AS p FROM ({_CHI}) WHERE feature <> 'actual')"""),
    "n04_prediction_drift": using(P, f"""{_DRIFT_HEAD}
        SELECT feature, 'psi' AS statistical_test, {rd('score')} AS drift_score, NULL::DOUBLE AS p_value,
               0.2::DOUBLE AS threshold, score >= 0.2 AS drift_detected FROM ({_PSI}) WHERE feature = 'actual'"""),
    "n04_prediction_trigger": using(P, f"""{_DRIFT_HEAD}
        SELECT 'Prediction drift detected (score=' || printf('%.4f', score) || ')' AS trigger_reason,
               'drift' AS trigger_type, 'high' AS severity FROM ({_PSI}) WHERE feature = 'actual' AND score >= 0.2"""),
    "n05_feature_trigger": using(P, f"""{_DRIFT_HEAD}
        SELECT 'Feature drift detected in ' || k || '/3 features' AS trigger_reason, 'drift' AS trigger_type,
               'high' AS severity, k AS drifted FROM (SELECT count(CASE WHEN p < 0.05 THEN 1 END) AS k FROM ({_KS}))
        WHERE k >= 3 * 0.3"""),
    "n06_monitor_regression": using(P, f"{_MONITORED} {_MONITOR_COLUMNS}"),
    "n06_degradation_trigger": using(P, f"""{_MONITORED}
        SELECT string_agg(reason, '; ' ORDER BY reason) AS trigger_reason, 'performance_degradation' AS trigger_type,
               'high' AS severity
        FROM (SELECT printf('%s degraded by %.1f%% (baseline=%.4f, current=%.4f)', upper(metric), change_pct,
                            baseline_value, metric_value) AS reason FROM x WHERE threshold_breached) HAVING count(*) > 0"""),
    "n07_monitor_ranking": using("raw_interactions", _degraded(
        ev.RANKING_METRICS, _rank_metrics("ASC"), _rank_metrics("DESC"), "15.0::DOUBLE") + _MONITOR_COLUMNS),
    "n08_monitoring_report": using(P, _REPORT),
    "n08_retraining_triggers": using(P, f"""
        SELECT *, 'high' AS severity FROM ({_REPORT}) WHERE drift_detected_count > 0 ORDER BY model_version DESC LIMIT 3"""),
    "d14_bin_counts": using(P, f"{_DRIFT_HEAD} SELECT feature, bin, base, cur FROM bins"),
}
