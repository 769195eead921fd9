"""Gradient-boosted trees as Spark jobs: training, prediction, search, cross-validation.

Each fit is a distributed job; a small thread pool only submits several at a time.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsentry.operators import evaluate as ev
from logsentry.operators.splits import fold_bounds
from logsentry.session import shared_dir
from logsentry.sources.schemas import CV_FOLDS, TARGET

# A scorer adds a probability column of the given name, leaving the rest unchanged.
Scorer = Callable[[DataFrame, str], DataFrame]

# Search space, integer parameters, kinds of distribution.
SEARCH_SPECS = {
    "max_evals": 20,
    "params": {
        "learning_rate": {"type": "uniform", "low": 0.001, "high": 0.3},
        "num_iterations": {"type": "quniform", "low": 100, "high": 1000, "q": 50},
        "max_depth": {"type": "quniform", "low": 3, "high": 10, "q": 1},
        "num_leaves": {"type": "quniform", "low": 10, "high": 100, "q": 10},
        "colsample_bytree": {"type": "uniform", "low": 0.5, "high": 1.0},
        "subsample": {"type": "uniform", "low": 0.5, "high": 1.0},
        "min_child_samples": {"type": "quniform", "low": 5, "high": 30, "q": 5},
        "reg_alpha": {"type": "choice", "options": [0, 0.01, 0.1, 0.5, 1]},
        "reg_lambda": {"type": "choice", "options": [0, 0.01, 0.1, 0.5, 1]},
        "scale_pos_weight": {"type": "uniform", "low": 1, "high": 10},
    },
    "override_schemas": {
        "num_leaves": "int", "min_child_samples": "int", "max_depth": "int", "num_iterations": "int",
    },
}
INTEGER_PARAMS = ["n_estimators", "max_depth", "num_leaves", "min_child_samples", "num_iterations"]
SPACE_TYPES = ["quniform", "uniform", "choice"]

# Parameters with a counterpart in Spark's trees; the others are reported as ignored.
_TO_GBT = {
    "learning_rate": "stepSize", "num_iterations": "maxIter", "n_estimators": "maxIter", "max_depth": "maxDepth",
    "subsample": "subsamplingRate", "min_child_samples": "minInstancesPerNode", "random_state": "seed", "max_bin": "maxBins",
}
_HANDLED = ("colsample_bytree", "scale_pos_weight")


def gbt_settings(params: dict) -> tuple[dict, list[str]]:
    """(GBTClassifier settings, parameter names without a counterpart)."""
    settings = {}
    for name, value in params.items():
        if name in _TO_GBT:
            settings[_TO_GBT[name]] = int(value) if name in (*INTEGER_PARAMS, "random_state", "max_bin") else float(value)
    if "colsample_bytree" in params:
        settings["featureSubsetStrategy"] = str(float(params["colsample_bytree"]))
    return settings, sorted(p for p in params if p not in _TO_GBT and p not in _HANDLED)


def train(
    data: DataFrame, features: list[str], label: str = TARGET, params: dict | None = None, seed: int = 42
) -> PipelineModel:
    """Fit boosted trees on the feature columns. ``scale_pos_weight`` weighs the positive class."""
    params = dict(params or {})
    shared_dir(data.sparkSession)
    settings, _ = gbt_settings(params)
    weight = float(params.get("scale_pos_weight", 1.0))
    gbt = GBTClassifier(
        featuresCol="_features", labelCol=label, predictionCol="_prediction", **{"seed": seed, **settings}
    ).setRawPredictionCol("_raw").setProbabilityCol("_probability")
    if weight != 1.0:
        data = data.withColumn("_weight", F.when(F.col(label) == 1, F.lit(weight)).otherwise(F.lit(1.0)))
        gbt = gbt.setWeightCol("_weight")
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_features"), gbt]).fit(data)


def positive_probability(probability: str = "_probability") -> Column:
    """P(1) of a probability vector, dense or sparse."""
    return vector_to_array(probability)[1]


def scorer(model: PipelineModel) -> Scorer:
    """The model as a map-only step that adds P(1)."""

    def score(df: DataFrame, out: str = "y_prob") -> DataFrame:
        return model.transform(df).select(*[c for c in df.columns if c != out], positive_probability().alias(out))

    return score


def predictions(model: PipelineModel, data: DataFrame, label: str = TARGET, idx: str = "idx") -> DataFrame:
    """(idx, y_true, y_prob)."""
    return scorer(model)(data, "y_prob").select(
        F.col(idx).alias("idx"), F.col(label).cast("int").alias("y_true"), "y_prob"
    )


# ---- search


def draw(specs: dict, rng: random.Random) -> dict:
    """One candidate from the space. Choices are read from ``choices``, ``choice`` or ``options``."""
    out = {}
    for name, spec in specs["params"].items():
        if spec["type"] not in SPACE_TYPES:
            raise ValueError(f"Unsupported parameter type: {spec['type']}. Supported types are: {SPACE_TYPES}")
        if spec["type"] == "choice":
            options = spec.get("choices") or spec.get("choice") or spec.get("options")
            if not options:
                raise ValueError(f"parameter {name} has no choices")
            out[name] = rng.choice(options)
        else:
            value = rng.uniform(spec["low"], spec["high"])
            out[name] = round(value / spec["q"]) * spec["q"] if spec["type"] == "quniform" else value
    return cast_params(out, specs)


def cast_params(params: dict, specs: dict) -> dict:
    """Declared types first, then integers by parameter name."""
    casts = {"int": int, "float": float}
    out = {n: casts.get(specs.get("override_schemas", {}).get(n), lambda v: v)(v) for n, v in params.items()}
    return {
        n: int(v) if isinstance(v, float) and any(i in n.lower() for i in INTEGER_PARAMS) else v for n, v in out.items()
    }


def _in_order(rows: DataFrame, idx: str) -> int:
    """Row count of an indexed slice that starts at position 0."""
    last = rows.agg(F.max(idx)).first()[0]
    return 0 if last is None else last + 1


def fold_scores(
    data: DataFrame, features: list[str], label: str, params: dict, folds: int, metric: str = "f1_score",
    idx: str = "idx", seed: int = 42, n_rows: int | None = None,
) -> list[float]:
    """Score of each time-series fold: fit on all rows before it, test on the fold. Folds are index ranges."""
    n = n_rows or _in_order(data, idx)
    scores = []
    for start, end in fold_bounds(n, folds):
        model = train(data.filter(F.col(idx) < start), features, label, params, seed)
        pred = predictions(model, data.filter((F.col(idx) >= start) & (F.col(idx) < end)), label, idx)
        scores.append(ev.weighted_scores(pred).first()[metric])
    return scores


def search(
    data: DataFrame, features: list[str], label: str = TARGET, specs: dict | None = None, folds: int = CV_FOLDS,
    seed: int = 42, parallelism: int = 2, idx: str = "idx",
) -> DataFrame:
    """Seeded random search; one row per trial and fold: trial, params (JSON), fold, score, objective.

    ``objective`` is minus the mean weighted F1 over the trial's folds. ``data``
    should be pinned or persisted: every fit reads it again.
    """
    specs = specs or SEARCH_SPECS
    rng = random.Random(seed)
    candidates = [draw(specs, rng) for _ in range(specs["max_evals"])]
    n = _in_order(data, idx)

    def run(trial: int) -> list[tuple]:
        fixed = {**specs.get("default_params", {}), **candidates[trial]}
        scores = fold_scores(data, features, label, fixed, folds, idx=idx, seed=seed, n_rows=n)
        mean = -sum(scores) / len(scores)
        return [(trial, json.dumps(candidates[trial], sort_keys=True), fold, s, mean) for fold, s in enumerate(scores)]

    with ThreadPoolExecutor(parallelism) as pool:
        rows = [r for part in pool.map(run, range(len(candidates))) for r in part]
    return data.sparkSession.createDataFrame(rows, "trial int, params string, fold int, score double, objective double")


def best_params(trials: DataFrame) -> dict:
    """Parameters of the lowest objective; the earliest trial wins a tie."""
    row = trials.agg(F.min_by("params", F.struct("objective", "trial"))).first()
    return json.loads(row[0])


def cv_on_test(
    test: DataFrame, features: list[str], label: str, params: dict, folds: int, idx: str = "idx", seed: int = 42
) -> DataFrame:
    """Fold accuracies (fold, score) from refitting on time folds of the *test* rows.

    ``idx`` is shifted so that the test rows start at 0.
    """
    first = test.agg(F.min(idx)).first()[0]
    scores = fold_scores(test.withColumn(idx, F.col(idx) - first), features, label, params, folds, "accuracy", idx, seed)
    return test.sparkSession.createDataFrame(list(enumerate(scores)), "fold int, score double")
