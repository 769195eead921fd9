"""Run records as tables: metrics, parameters, comparison of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Logged metrics and the names of the confusion matrix cells.
METRIC_NAMES = [
    "f1_score", "precision", "recall", "accuracy", "roc_auc", "pr_auc", "cv_mean_accuracy", "cv_std_accuracy",
]
CELL_NAMES = [["true_negatives", "false_positives"], ["false_negatives", "true_positives"]]


def metric_log(metrics: DataFrame, run_id: str, stage: str = "model_evaluation") -> DataFrame:
    """(run_id, stage, name, value) of the known metrics and confusion cells in a one-row metrics table."""
    cells = {n: F.col(n) for n in METRIC_NAMES if n in metrics.columns}
    if "confusion_matrix" in metrics.columns:
        cells |= {CELL_NAMES[y][p]: F.col("confusion_matrix")[y][p] for y in (0, 1) for p in (0, 1)}
    return _lines(metrics, cells, run_id, stage)


def numeric_log(values: DataFrame, run_id: str, stage: str, prefix: str = "") -> DataFrame:
    """Every numeric column of a one-row table under ``prefix``; other columns are left out."""
    numeric = [f.name for f in values.schema if isinstance(f.dataType, NumericType)]
    return _lines(values, {prefix + n: F.col(n) for n in numeric}, run_id, stage)


def _lines(row: DataFrame, cells: dict, run_id: str, stage: str) -> DataFrame:
    lines = [F.struct(F.lit(n).alias("name"), c.cast("double").alias("value")) for n, c in cells.items()]
    return row.select(F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), F.explode(F.array(*lines)).alias("l")).select(
        "run_id", "stage", "l.*"
    )


def parameter_log(
    spark: SparkSession, run_id: str, best: dict, cv_folds: int, max_evals: int, algorithm: str = "random"
) -> DataFrame:
    """(run_id, name, value as text): the chosen parameters as best_<name> and the search settings."""
    values = {f"best_{k}": v for k, v in best.items()}
    values |= {"cv_folds": cv_folds, "max_evals": max_evals, "algorithm": algorithm}
    return spark.createDataFrame([(run_id, k, str(v)) for k, v in values.items()], "run_id string, name string, value string")


def append_log(log: DataFrame, path: str) -> None:
    """Add to the log table, one directory per run and, where the log has stages, per stage.

    Written again under one run (and stage), the lines replace those written before; other runs stay.
    """
    by = [c for c in ("run_id", "stage") if c in log.columns]
    log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def compare_runs(log: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One row per run, one column per metric; of values of one name from several stages, the largest."""
    pivot = log.groupBy("run_id").pivot("name", names) if names else log.groupBy("run_id").pivot("name")
    return pivot.agg(F.max("value"))
