import os

import pytest

from logsentry.plans import batch
from logsentry.plans.modelling import SEARCH
from logsentry.sources.network_logs import network_logs
from tests.conftest import SF

TABLES = [
    "label_encoders", "feature_matrix", "search_trials", "trained_model", "validation_predictions", "model_performance_metrics",
    "prediction_summary", "density_summary", "class_histogram", "calibration_curve", "roc_curve", "pr_curve",
    "invariance_test_results", "prototype_test_results", "tree_nodes", "shap_data", "feature_importance_data",
    "shap_feature_importance", "shap_dependence", "local_interpretations", "importance_comparison", "metric_log", "parameter_log",
]


def test_whole_run(spark, tmp_path):
    out = str(tmp_path / "run")
    settings = batch.Settings(search=SEARCH, cv_folds=2, eval_folds=2, prototypes=3, eval_params={"num_iterations": 2})
    logged = batch.run(network_logs(spark, SF), "log_id", out, "r1", settings)
    assert sorted(os.listdir(out)) == sorted(TABLES)
    values = {r.name: r.value for r in logged["metrics"].collect()}
    assert values["n_train_samples"] == 800 and values["accuracy"] > 0.5
    assert values["true_negatives"] + values["false_positives"] + values["false_negatives"] + values["true_positives"] == 200
    assert {"cv_mean_accuracy", "shap_values_mean_abs", "max_feature_importance", "class_balance_ratio"} <= set(values)
    assert {"best_learning_rate", "cv_folds"} <= {r.name for r in logged["parameters"].collect()}
    local = {r.description: r for r in spark.read.parquet(f"{out}/local_interpretations").collect()}
    assert set(local) == {"highest_risk", "lowest_risk"} and len(local["highest_risk"].top_contributing_features) == 5


def test_empty_log_raises(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows"):
        batch.process(network_logs(spark, SF).filter("false"), "log_id", str(tmp_path / "x"), batch.Settings())
