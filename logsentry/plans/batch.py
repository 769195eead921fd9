"""The whole run over a raw log, in four stages that hand tables to each other.

Each stage is a plain function over DataFrames. What later stages read several
times is written once under ``out``; everything else stays a lazy plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from logsentry.operators import behave, explain, models, records, splits
from logsentry.operators import evaluate as ev
from logsentry.operators.features import build_features, create_feature_matrix, require_rows
from logsentry.session import pin
from logsentry.sources import schemas


@dataclass
class Settings:
    """Defaults are the fixed values of ``sources.schemas`` and ``operators.models``."""

    features: list[str] = field(default_factory=lambda: list(schemas.FEATURE_COLUMNS))
    train_ratio: float = schemas.TRAIN_RATIO
    search: dict = field(default_factory=lambda: models.SEARCH_SPECS)
    cv_folds: int = schemas.CV_FOLDS
    eval_folds: int = schemas.EVAL_FOLDS
    eval_params: dict | None = None
    prototypes: int = schemas.PROTOTYPES
    invariance_feature: str = schemas.INVARIANCE_FEATURE
    dependence: list[str] = field(default_factory=lambda: list(schemas.DEPENDENCE_FEATURES))
    parallelism: int = 2


def process(logs: DataFrame, tie: str, out: str, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Raw log to (train, test) feature tables; the category codes are saved beside them."""
    enriched, mapping = build_features(require_rows(logs), tie)
    pin(mapping, "encoders", f"{out}/label_encoders")
    matrix = pin(create_feature_matrix(enriched, settings.features), "matrix", f"{out}/feature_matrix")
    return splits.split_time_series(matrix, settings.train_ratio)


def optimize(train: DataFrame, out: str, settings: Settings) -> tuple[dict, PipelineModel]:
    """Search, then fit the best candidate. A failing search raises."""
    trials = models.search(
        train, settings.features, specs=settings.search, folds=settings.cv_folds, parallelism=settings.parallelism)
    best = models.best_params(pin(trials, "trials", f"{out}/search_trials"))
    model = models.train(train, settings.features, params={**settings.search.get("default_params", {}), **best})
    model.write().overwrite().save(f"{out}/trained_model")
    return best, model


def validate(model: PipelineModel, test: DataFrame, params: dict, out: str, settings: Settings) -> DataFrame:
    """Predictions, metrics, curve tables and behavioural tests; returns the predictions."""
    score = models.scorer(model)
    pred = pin(models.predictions(model, test), "predictions", f"{out}/validation_predictions")
    folds = models.cv_on_test(
        test, settings.features, schemas.TARGET, settings.eval_params or params, settings.eval_folds)
    scores = ev.score_table(pred)
    tables = {
        "model_performance_metrics": ev.evaluate(pred, folds),
        "prediction_summary": ev.prediction_summary(pred),
        "density_summary": ev.density_summary(scores),
        "class_histogram": ev.class_histogram(scores),
        "calibration_curve": ev.calibration_curve(pred),
        "roc_curve": ev.roc_curve(scores),
        "pr_curve": ev.pr_curve(scores),
        "invariance_test_results": behave.invariance_test(test, score, settings.invariance_feature),
        "prototype_test_results": behave.prototype_test(test, score, settings.features, settings.prototypes),
    }
    for name, table in tables.items():
        pin(table, name, f"{out}/{name}")
    return pred


def interpret(model: PipelineModel, test: DataFrame, pred: DataFrame, out: str, settings: Settings) -> None:
    """Importances, attributions and local interpretations."""
    nodes = pin(explain.tree_nodes(model), "nodes", f"{out}/tree_nodes")
    rows = test.join(pred, "idx")  # idx is unique on both sides
    shap = pin(explain.compute_shap_values(model, rows, settings.features, nodes), "shap", f"{out}/shap_data")
    by_splits, by_shap = explain.split_importance(nodes, settings.features), explain.shap_importance(shap, settings.features)
    tables = {
        "feature_importance_data": by_splits,
        "shap_feature_importance": by_shap,
        "shap_dependence": explain.shap_dependence(shap, settings.features, settings.dependence),
        "local_interpretations": explain.local_interpretations(shap, settings.features),
        "importance_comparison": explain.importance_comparison(by_splits, by_shap),
    }
    for name, table in tables.items():
        pin(table, name, f"{out}/{name}")


def run(logs: DataFrame, tie: str, out: str, run_id: str, settings: Settings | None = None) -> dict[str, DataFrame]:
    """All four stages into ``out``; returns the logged metrics and parameters."""
    settings = settings or Settings()
    spark = logs.sparkSession
    train, test = process(logs, tie, out, settings)
    best, model = optimize(train, out, settings)
    params = {**settings.search.get("default_params", {}), **best}
    pred = validate(model, test, params, out, settings)
    interpret(model, test, pred, out, settings)
    shap = spark.read.parquet(f"{out}/shap_data")
    metrics = records.metric_log(spark.read.parquet(f"{out}/model_performance_metrics"), run_id)
    for values, stage in (
        (ev.training_stats(train, schemas.TARGET, len(settings.features)), "model_training"),
        (explain.importance_stats(spark.read.parquet(f"{out}/feature_importance_data")), "model_training"),
        (explain.shap_stats(shap), "interpretability"),
    ):
        metrics = metrics.unionByName(records.numeric_log(values, run_id, stage))
    parameters = records.parameter_log(spark, run_id, best, settings.cv_folds, settings.search["max_evals"])
    records.append_log(metrics, f"{out}/metric_log")
    records.append_log(parameters, f"{out}/parameter_log")
    return {"metrics": spark.read.parquet(f"{out}/metric_log"), "parameters": spark.read.parquet(f"{out}/parameter_log")}
