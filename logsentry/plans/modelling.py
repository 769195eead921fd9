"""Queries of trained models, searches and attributions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.functions.calendar import create_time_features
from logsentry.functions.rules import log_score
from logsentry.operators import behave, explain, models, records, splits
from logsentry.operators import evaluate as ev
from logsentry.operators.features import build_features, create_feature_matrix
from logsentry.plans.inputs import rounded
from logsentry.plans.ordered import ORACLES as ORDERED_SQL
from logsentry.plans.sql import SCORED, r6, with_
from logsentry.session import pin, scratch_path
from logsentry.sources.network_logs import network_logs
from logsentry.sources.schemas import CATEGORICAL_COLUMNS, DEPENDENCE_FEATURES, FEATURE_COLUMNS, TARGET

# Small settings for the registered fits; the full search space is in operators.models.
PARAMS = {"num_iterations": 5, "max_depth": 4, "learning_rate": 0.3}
SEARCH = {
    "max_evals": 2,
    "params": {
        "learning_rate": {"type": "uniform", "low": 0.05, "high": 0.3},
        "max_depth": {"type": "quniform", "low": 2, "high": 3, "q": 1},
        "scale_pos_weight": {"type": "uniform", "low": 1, "high": 3},
        "reg_alpha": {"type": "choice", "options": [0, 0.01, 0.1]},
    },
    "override_schemas": {"max_depth": "int"},
    "default_params": {"num_iterations": 2},
}

# A linear model in log units, for attributions with a closed form.
LINEAR = {"Payload_Size": 0.0004, "hour": -0.05, "day_of_week": 0.1, "minute": 0.01, "is_weekend": 0.6, "is_business_hours": -0.4}
OTHER_LINEAR = {"minute": 0.02, "is_weekend": -0.1, "is_business_hours": 0.2, "month": 0.5, "day": 0.03}


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature matrix, written once: training reads it in every iteration."""
    logs = network_logs(spark, sf_dir).select("log_id", "Timestamp", *CATEGORICAL_COLUMNS, "Payload_Size", TARGET)
    return pin(create_feature_matrix(build_features(logs)[0]), "matrix")


def _fitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, PipelineModel]:
    train, test = splits.split_time_series(_matrix(spark, sf_dir))
    return train, test, models.train(train, FEATURE_COLUMNS, params=PARAMS)


def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test, model = _fitted(spark, sf_dir)
    return rounded(models.predictions(model, test))


def gbt_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test, model = _fitted(spark, sf_dir)
    test = pin(test, "test")
    pred = pin(models.predictions(model, test), "predictions")
    folds = models.cv_on_test(test, FEATURE_COLUMNS, TARGET, {**PARAMS, "num_iterations": 2}, 2)
    return rounded(records.metric_log(ev.evaluate(pred, folds), "gbt"))


def model_save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a model read back from storage; equal to those of the fitted one."""
    _, test, model = _fitted(spark, sf_dir)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    again = models.scorer(PipelineModel.load(path))(models.scorer(model)(test, "first"), "second")
    return again.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("first") != F.col("second")).alias("n_different"))


def search_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = splits.split_time_series(_matrix(spark, sf_dir))
    return rounded(models.search(pin(train, "train"), FEATURE_COLUMNS, specs=SEARCH, folds=2))


def parameter_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = models.best_params(search_trials(spark, sf_dir))
    return records.parameter_log(spark, "search", best, 2, SEARCH["max_evals"])


def split_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, model = _fitted(spark, sf_dir)
    return explain.split_importance(explain.tree_nodes(model), FEATURE_COLUMNS)


def tree_shap(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test, model = _fitted(spark, sf_dir)
    return rounded(explain.attribution_long(explain.compute_shap_values(model, test, FEATURE_COLUMNS), FEATURE_COLUMNS))


def tree_shap_additivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose attributions and base value do not add up to the log-odds of their score: none."""
    _, test, model = _fitted(spark, sf_dir)
    out = models.scorer(model)(explain.compute_shap_values(model, test, FEATURE_COLUMNS), "y_prob")
    margin = F.col("base_value") + F.aggregate("shap", F.lit(0.0), lambda a, v: a + v)
    wrong = F.abs(F.col("y_prob") - 1 / (1 + F.exp(-margin))) > 1e-9
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("n_wrong"))


def tree_local_interpretation(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test, model = _fitted(spark, sf_dir)
    scored = models.scorer(model)(test, "y_prob").withColumnRenamed(TARGET, "y_true")
    shap = explain.compute_shap_values(model, scored, FEATURE_COLUMNS)
    return rounded(explain.local_lines(explain.local_interpretations(shap, FEATURE_COLUMNS)))


def gbt_importance_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test, model = _fitted(spark, sf_dir)
    nodes = explain.tree_nodes(model)
    shap = explain.shap_importance(explain.compute_shap_values(model, test, FEATURE_COLUMNS, nodes), FEATURE_COLUMNS)
    return rounded(explain.importance_comparison(explain.split_importance(nodes, FEATURE_COLUMNS), shap))


def gbt_invariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test, model = _fitted(spark, sf_dir)
    return rounded(behave.invariance_test(test, models.scorer(model)))


def gbt_robustness(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test, model = _fitted(spark, sf_dir)
    return rounded(behave.robustness_test(test, models.scorer(model), ["Payload_Size", "payload_rolling_mean", "payload_lag_1"]))


def kmeans_prototypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, test, model = _fitted(spark, sf_dir)
    return behave.prototype_test(test, models.scorer(model), FEATURE_COLUMNS)


# ---- attributions of a linear model


def _linear(spark: SparkSession, sf_dir: str, coefficients: dict[str, float]) -> DataFrame:
    logs = network_logs(spark, sf_dir)
    rows = create_time_features(logs).withColumn("y_prob", log_score()).withColumn("idx", F.col("log_id"))
    return explain.linear_attribution(rows.withColumnRenamed(TARGET, "y_true"), coefficients)


def linear_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explain.attribution_long(_linear(spark, sf_dir, LINEAR), list(LINEAR)))


def attribution_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explain.shap_importance(_linear(spark, sf_dir, LINEAR), list(LINEAR)))


def attribution_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explain.shap_stats(_linear(spark, sf_dir, LINEAR)))


def attribution_dependence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explain.shap_dependence(_linear(spark, sf_dir, LINEAR), list(LINEAR), DEPENDENCE_FEATURES))


def local_interpretation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explain.local_lines(explain.local_interpretations(_linear(spark, sf_dir, LINEAR), list(LINEAR))))


def _pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (explain.shap_importance(_linear(spark, sf_dir, LINEAR), list(LINEAR)),
            explain.shap_importance(_linear(spark, sf_dir, OTHER_LINEAR), list(OTHER_LINEAR)))


def importance_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explain.merge_importance(*_pair(spark, sf_dir)))


def importance_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explain.importance_comparison(*_pair(spark, sf_dir), 4))


def importance_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(explain.importance_stats(_pair(spark, sf_dir)[0]))


def top15_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 features of largest attribution when every coefficient is a seventh."""
    equal = explain.linear_attribution(_matrix(spark, sf_dir), dict.fromkeys(FEATURE_COLUMNS, 1.0 / 7.0))
    return rounded(explain.top_features(explain.shap_importance(equal, FEATURE_COLUMNS)))


def risk_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of the highest and of the lowest score."""
    logs = network_logs(spark, sf_dir).select("log_id", log_score().alias("y_prob"))
    return logs.agg(
        F.max_by("log_id", F.struct("y_prob", -F.col("log_id"))).alias("highest"),
        F.min_by("log_id", F.struct("y_prob", F.col("log_id"))).alias("lowest"))


QUERIES = {f.__name__: f for f in (
    gbt_scores, gbt_metrics, model_save_load, search_trials, parameter_log, split_importance, tree_shap,
    tree_shap_additivity, tree_local_interpretation, gbt_importance_comparison, gbt_invariance, gbt_robustness,
    kmeans_prototypes, linear_attribution, attribution_importance, attribution_stats, attribution_dependence,
    local_interpretation, importance_merge, importance_comparison, importance_stats, top15_features, risk_extremes,
)}

_VALUES = {
    "Payload_Size": "Payload_Size", "hour": 'hour("Timestamp")', "day_of_week": '(isodow("Timestamp") - 1)',
    "minute": 'minute("Timestamp")', "month": 'month("Timestamp")', "day": 'day("Timestamp")',
    "is_weekend": 'CASE WHEN isodow("Timestamp") >= 6 THEN 1 ELSE 0 END',
    "is_business_hours": 'CASE WHEN hour("Timestamp") BETWEEN 9 AND 17 THEN 1 ELSE 0 END',
}


def _cells(coefficients: dict[str, float], name: str) -> str:
    lines = " UNION ALL ".join(
        f"SELECT log_id AS idx, {i} AS position, '{f}' AS feature, CAST({_VALUES[f]} AS DOUBLE) AS feature_value,"
        f" CAST({c} AS DOUBLE) * ({_VALUES[f]} - (SELECT avg({_VALUES[f]}) FROM logs)) AS shap_value, y_prob, Intrusion FROM scored"
        for i, (f, c) in enumerate(coefficients.items()))
    return f"{name} AS ({lines})"


_A = SCORED + ", " + _cells(LINEAR, "cells_a")
_AB = _A + ", " + _cells(OTHER_LINEAR, "cells_b") + """,
  imp_a AS (SELECT feature, avg(abs(shap_value)) AS importance FROM cells_a GROUP BY 1),
  imp_b AS (SELECT feature, avg(abs(shap_value)) AS importance FROM cells_b GROUP BY 1),
  both_imp AS (SELECT coalesce(a.feature, b.feature) AS feature, coalesce(a.importance, CAST(0 AS DOUBLE)) AS model_importance,
    coalesce(b.importance, CAST(0 AS DOUBLE)) AS shap_importance FROM imp_a a FULL OUTER JOIN imp_b b ON a.feature = b.feature)"""
_MERGED = f"feature, {r6('model_importance')} AS model_importance, {r6('shap_importance')} AS shap_importance"
_COUNT = "SELECT count(*) - CAST(floor(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) AS n, CAST(0 AS BIGINT) AS {zero} FROM events"
_EQUAL = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, avg(abs(({f} - (SELECT avg({f}) FROM m)) / CAST(7 AS DOUBLE))) AS importance FROM m" for f in FEATURE_COLUMNS)

ORACLES = {
    # Properties that hold for any trained model.
    "model_save_load": _COUNT.format(zero="n_different"),
    "tree_shap_additivity": _COUNT.format(zero="n_wrong"),
    "linear_attribution": with_(_A, f"SELECT idx, position, feature, feature_value, {r6('shap_value')} AS shap_value FROM cells_a"),
    "attribution_importance": with_(_A, f"SELECT feature, {r6('avg(abs(shap_value))')} AS importance FROM cells_a GROUP BY 1"),
    "attribution_stats": with_(_A, f"""
        SELECT {r6('avg(abs(shap_value))')} AS shap_values_mean_abs, {r6('max(abs(shap_value))')} AS shap_values_max_abs FROM cells_a"""),
    "attribution_dependence": with_(_A, f"""
        SELECT idx, feature, feature_value, {r6('shap_value')} AS shap_value FROM cells_a
        WHERE feature IN ({', '.join(f"'{f}'" for f in DEPENDENCE_FEATURES)})"""),
    "local_interpretation": with_(_A + """, cases AS (
        SELECT 'highest_risk' AS description, (SELECT log_id FROM scored ORDER BY y_prob DESC, log_id LIMIT 1) AS index
        UNION ALL SELECT 'lowest_risk', (SELECT log_id FROM scored ORDER BY y_prob, log_id LIMIT 1)),
        listed AS (SELECT *, CAST(row_number() OVER (PARTITION BY description ORDER BY abs(shap_value) DESC, position) AS INTEGER) AS rank
          FROM cases JOIN cells_a ON idx = index)""", f"""
        SELECT description, index, {r6('y_prob')} AS predicted_probability,
          CASE WHEN Intrusion = 1 THEN 'Intrusion' ELSE 'Normal' END AS actual_label, rank, feature, feature_value,
          {r6('shap_value')} AS shap_value, CASE WHEN shap_value > 0 THEN 'increases' ELSE 'decreases' END AS direction,
          concat(CASE WHEN shap_value > 0 THEN 'increases' ELSE 'decreases' END, ' risk by ', printf('%.3f', abs(shap_value))) AS impact
        FROM listed WHERE rank <= 5"""),
    "importance_merge": with_(_AB, f"SELECT {_MERGED} FROM both_imp"),
    "importance_comparison": with_(_AB, f"""
        SELECT {_MERGED}, 'model_importance' AS measure
          FROM (SELECT * FROM both_imp ORDER BY model_importance DESC, feature LIMIT 4)
        UNION ALL SELECT {_MERGED}, 'shap_importance'
          FROM (SELECT * FROM both_imp ORDER BY shap_importance DESC, feature LIMIT 4)"""),
    "importance_stats": with_(_AB, f"""
        SELECT count(*) AS n_features, {r6('max(importance)')} AS max_feature_importance,
          {r6('avg(importance)')} AS mean_feature_importance FROM imp_a"""),
    "top15_features": f"""
        WITH m AS ({ORDERED_SQL['feature_matrix']}), u AS ({_EQUAL})
        SELECT feature, {r6('importance')} AS importance FROM u ORDER BY u.importance DESC, feature LIMIT 15""",
    "risk_extremes": with_(SCORED, """
        SELECT (SELECT log_id FROM scored ORDER BY y_prob DESC, log_id LIMIT 1) AS highest,
          (SELECT log_id FROM scored ORDER BY y_prob, log_id LIMIT 1) AS lowest"""),
}
