"""Feature importance and attributions.

Attribution tables are wide: the feature columns plus ``shap``, an array in feature
order. Global summaries aggregate array positions, so rows are never exploded for them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.session import scratch_path

# Features shown per row and per chart, class names in reports.
TOP_LOCAL = 5
TOP_GLOBAL = 15

# Up to this many features on a path, attributions are tabulated per pattern of satisfied conditions.
_TABULATE = 6


def tree_nodes(model: PipelineModel, path: str | None = None) -> DataFrame:
    """One row per node of the trained trees: tree, weight, node, feature, threshold, children, value, cover.

    Read back from the saved model. Its size depends on tree count and depth, not on the data.
    """
    spark = SparkSession.active()
    path = path or scratch_path(spark, "trees")
    model.stages[-1].write().overwrite().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("tree"), F.col("_3").alias("weight"))
    node = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node.id.alias("node"), node.split.featureIndex.alias("feature"),
        F.try_element_at(node.split.leftCategoriesOrThreshold, F.lit(1)).alias("threshold"),
        node.leftChild.alias("left"), node.rightChild.alias("right"), node.prediction.alias("value"),
        node.rawCount.alias("cover"),
    ).join(F.broadcast(weights), "tree")


def split_importance(nodes: DataFrame, features: list[str]) -> DataFrame:
    """Number of splits on each feature, most first; unused features count 0."""
    counts = nodes.filter(F.col("left") >= 0).groupBy("feature").agg(F.count(F.lit(1)).cast("double").alias("importance"))
    names = nodes.sparkSession.createDataFrame(list(enumerate(features)), "feature int, name string")
    return names.join(counts, "feature", "left").select(
        F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance")
    ).orderBy(F.desc("importance"), "feature")


def gain_importance(model: PipelineModel, features: list[str]) -> DataFrame:
    """The gain-based importance of Spark's trees."""
    values = model.stages[-1].featureImportances.toArray()
    return SparkSession.active().createDataFrame(
        [(f, float(v)) for f, v in zip(features, values)], "feature string, importance double"
    ).orderBy(F.desc("importance"), "feature")


# ---- attributions of tree ensembles


def tree_leaves(nodes: DataFrame) -> list[tuple]:
    """Per leaf: feature indices on its path, interval (low, high] of each, cover share of each, weighted value.

    Repeated splits on a feature fold into one interval. The node table is model-sized and is collected.
    """
    trees: dict[int, dict[int, object]] = {}
    for r in nodes.collect():
        trees.setdefault(r["tree"], {})[r["node"]] = r
    leaves = []
    for tree in trees.values():
        stack = [(0, {})]
        while stack:
            at, path = stack.pop()
            r = tree[at]
            if r["left"] < 0:
                names = list(path)
                low, high, share = (np.array([path[f][i] for f in names]) for i in range(3))
                leaves.append((np.array(names, dtype=int), low, high, share, r["value"] * r["weight"]))
                continue
            low, high, share = path.get(r["feature"], (-np.inf, np.inf, 1.0))
            for child, bounds in ((r["left"], (low, min(high, r["threshold"]))), (r["right"], (max(low, r["threshold"]), high))):
                stack.append((child, {**path, r["feature"]: (*bounds, share * tree[child]["cover"] / r["cover"])}))
    return leaves


def path_attribution(met: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Shapley values of the game whose payoff for a coalition is the product of ``met`` inside and ``share`` outside it.

    ``met`` is rows x features of 0/1, ``share`` one number per feature. For each
    feature the other features' products are grouped by coalition size as
    polynomial coefficients.
    """
    rows, n = met.shape
    out = np.empty((rows, n))
    for j in range(n):
        by_size = np.zeros((rows, n))
        by_size[:, 0] = 1.0
        for k in range(n):
            if k != j:
                grown = by_size * share[k]
                grown[:, 1:] += by_size[:, :-1] * met[:, [k]]
                by_size = grown
        weight = np.array([factorial(s) * factorial(n - 1 - s) / factorial(n) for s in range(n)])
        out[:, j] = (met[:, j] - share[j]) * (by_size @ weight)
    return out


def _attribute(x: np.ndarray, leaves: list[tuple], tables: list) -> np.ndarray:
    """Rows x features matrix of attributions in log-odds (twice the trees' margin)."""
    out = np.zeros(x.shape)
    for (features, low, high, share, value), table in zip(leaves, tables):
        if not len(features):
            continue
        met = (x[:, features] > low) & (x[:, features] <= high)
        if table is None:
            out[:, features] += 2 * value * path_attribution(met.astype(float), share)
        else:
            out[:, features] += 2 * value * table[met @ (1 << np.arange(len(features)))]
    return out


def _tables(leaves: list[tuple]) -> list:
    """Per leaf, the attribution of every pattern of met conditions (bit j for feature j), or None for long paths."""
    out = []
    for features, _, _, share, _ in leaves:
        n = len(features)
        if n == 0 or n > _TABULATE:
            out.append(None)
        else:
            patterns = np.array([bits[::-1] for bits in product((0.0, 1.0), repeat=n)])
            out.append(path_attribution(patterns, share))
    return out


def base_value(leaves: list[tuple]) -> float:
    """Mean log-odds of the trees under their training cover."""
    return float(sum(2 * value * np.prod(share) for _, _, _, share, value in leaves))


def compute_shap_values(model: PipelineModel, data: DataFrame, features: list[str], nodes: DataFrame | None = None) -> DataFrame:
    """Add ``shap`` (array in feature order) and ``base_value``.

    Exact path-dependent values on the log-odds scale: base_value plus the sum of
    shap is the row's log-odds, P(1) = 1 / (1 + exp(-log-odds)). A map-only Arrow
    stage; the leaves travel with the task and their tables are built once per task.
    """
    leaves = tree_leaves(nodes if nodes is not None else tree_nodes(model))

    @F.pandas_udf("array<double>")
    def attribute(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        tables = _tables(leaves)
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            yield pd.Series(list(_attribute(x, leaves, tables)))

    return data.withColumn("shap", attribute(*[F.col(f).cast("double") for f in features])).withColumn(
        "base_value", F.lit(base_value(leaves))
    )


def linear_attribution(data: DataFrame, coefficients: dict[str, float], fit_on: DataFrame | None = None) -> DataFrame:
    """Add ``shap`` of a linear model: coefficient x (value - mean), with means of ``fit_on`` or the table itself."""
    source = fit_on if fit_on is not None else data
    means = source.agg(*[F.avg(f).alias(f) for f in coefficients])
    mean = means.select(F.struct(*means.columns)).scalar()
    return data.withColumn("_mean", mean).withColumn("shap", F.array(*[
        F.lit(float(c)) * (F.col(f) - F.col(f"_mean.{f}")) for f, c in coefficients.items()
    ])).drop("_mean")


# ---- tables over attributions


def attribution_long(shap: DataFrame, features: list[str], only: list[str] | None = None, idx: str = "idx") -> DataFrame:
    """(idx, position, feature, feature_value, shap_value); ``only`` limits the features before rows multiply."""
    wanted = [(i, f) for i, f in enumerate(features) if only is None or f in only]
    cells = [F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"), F.col(f).cast("double").alias("feature_value"),
                      F.element_at("shap", i + 1).alias("shap_value")) for i, f in wanted]
    return shap.select(idx, F.explode(F.array(*cells)).alias("cell")).select(idx, "cell.*")


def shap_importance(shap: DataFrame, features: list[str]) -> DataFrame:
    """Mean absolute attribution per feature, largest first. One aggregate row is turned into lines."""
    means = shap.agg(*[F.avg(F.abs(F.element_at("shap", i + 1))).alias(f"_{i}") for i in range(len(features))])
    lines = [F.struct(F.lit(f).alias("feature"), F.col(f"_{i}").alias("importance")) for i, f in enumerate(features)]
    return means.select(F.explode(F.array(*lines)).alias("line")).select("line.*").orderBy(F.desc("importance"), "feature")


def shap_stats(shap: DataFrame) -> DataFrame:
    """Mean and largest absolute attribution over the whole matrix."""
    size = F.aggregate("shap", F.lit(0.0), lambda a, v: a + F.abs(v))
    largest = F.array_max(F.transform("shap", F.abs))
    return shap.agg(
        (F.sum(size) / F.sum(F.size("shap"))).alias("shap_values_mean_abs"), F.max(largest).alias("shap_values_max_abs")
    )


def importance_stats(importance: DataFrame) -> DataFrame:
    return importance.agg(
        F.count(F.lit(1)).alias("n_features"), F.max("importance").alias("max_feature_importance"),
        F.avg("importance").alias("mean_feature_importance"),
    )


def shap_dependence(shap: DataFrame, features: list[str], key_features: list[str]) -> DataFrame:
    """(idx, feature, feature_value, shap_value) of the listed features; unknown names are skipped."""
    return attribution_long(shap, features, key_features).drop("position")


def top_features(importance: DataFrame, by: str = "importance", k: int = TOP_GLOBAL) -> DataFrame:
    return importance.orderBy(F.desc(by), "feature").limit(k)


def merge_importance(model_importance: DataFrame, shap_imp: DataFrame) -> DataFrame:
    """(feature, model_importance, shap_importance); a feature absent on one side has 0 there."""
    return model_importance.select("feature", F.col("importance").alias("model_importance")).join(
        shap_imp.select("feature", F.col("importance").alias("shap_importance")), "feature", "full_outer"
    ).fillna(0, ["model_importance", "shap_importance"])


def importance_comparison(model_importance: DataFrame, shap_imp: DataFrame, k: int = TOP_GLOBAL) -> DataFrame:
    """The k first features by each measure: (measure, feature, model_importance, shap_importance)."""
    merged = merge_importance(model_importance, shap_imp)
    return top_features(merged, "model_importance", k).withColumn("measure", F.lit("model_importance")).unionByName(
        top_features(merged, "shap_importance", k).withColumn("measure", F.lit("shap_importance"))
    )


def direction(value: Column) -> Column:
    return F.when(value > 0, "increases").otherwise("decreases")


def impact(value: Column) -> Column:
    return F.format_string("%s risk by %.3f", direction(value), F.abs(value))


def label_name(label: Column) -> Column:
    return F.when(label == 1, "Intrusion").otherwise("Normal")


def top_contributions(features: list[str], k: int = TOP_LOCAL) -> Column:
    """The row's k features of largest absolute attribution as an array of structs; the earlier feature wins a tie.

    Sorted inside the row: no shuffle.
    """
    cells = [F.struct((-F.abs(F.element_at("shap", i + 1))).alias("rank"), F.lit(i).alias("position"), F.lit(f).alias("feature"),
                      F.col(f).cast("double").alias("feature_value"), F.element_at("shap", i + 1).alias("shap_value"))
             for i, f in enumerate(features)]
    best = F.slice(F.array_sort(F.array(*cells)), 1, k)
    return F.transform(best, lambda c: F.struct(
        c["feature"].alias("feature"), c["feature_value"].alias("feature_value"), c["shap_value"].alias("shap_value"),
        direction(c["shap_value"]).alias("direction"), impact(c["shap_value"]).alias("impact"),
    ))


def local_interpretations(shap: DataFrame, features: list[str], idx: str = "idx") -> DataFrame:
    """The highest- and lowest-risk rows with label, probability and top features.

    ``shap`` also carries y_prob and y_true. The first row wins a tie. Two rows are
    picked by aggregates in one scan.
    """
    row = F.struct(idx, "y_prob", "y_true", "shap", *[f for f in features if f != idx])
    picked = shap.agg(
        F.max_by(row, F.struct("y_prob", -F.col(idx))).alias("highest_risk"),
        F.min_by(row, F.struct("y_prob", F.col(idx))).alias("lowest_risk"),
    )
    cases = F.array(*[F.struct(F.lit(d).alias("description"), F.col(d).alias("row")) for d in ("highest_risk", "lowest_risk")])
    return picked.select(F.explode(cases).alias("case")).select("case.description", "case.row.*").select(
        "description", F.col(idx).alias("index"), F.col("y_prob").alias("predicted_probability"),
        label_name(F.col("y_true")).alias("actual_label"), top_contributions(features).alias("top_contributing_features"),
    )


def local_lines(local: DataFrame) -> DataFrame:
    """Local interpretations flattened: one line per listed feature with its rank."""
    return local.select(
        "description", "index", "predicted_probability", "actual_label",
        F.posexplode("top_contributing_features").alias("rank", "f"),
    ).select("description", "index", "predicted_probability", "actual_label", (F.col("rank") + 1).alias("rank"), "f.*")
