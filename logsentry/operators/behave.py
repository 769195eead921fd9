"""Behavioural tests of a scorer: invariance, direction, robustness, prototypes.

Perturbed scores are computed beside the original ones in the same row, so no
join and no shuffle is needed before the summary.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsentry.functions.rules import log_score
from logsentry.operators.models import Scorer
from logsentry.sources.schemas import INVARIANCE_FEATURE, PROTOTYPES

# A change below it is stable, the smallest feature value tested, noise, robust change.
STABLE_DELTA = 0.05
FLOOR = 1
NOISE = 0.01
ROBUST_DELTA = 0.1


def rule_scorer(df: DataFrame, out: str = "y_prob") -> DataFrame:
    """The fixed rules as a scorer over network-log columns."""
    return df.withColumn(out, log_score())


def with_change(df: DataFrame, scorer: Scorer, feature: str, delta: Column, out: str) -> DataFrame:
    """Add the score the row would have with ``delta`` added to ``feature``."""
    moved = df.withColumn("_kept", F.col(feature)).withColumn(feature, F.col(feature) + delta)
    return scorer(moved, out).withColumn(feature, F.col("_kept")).drop("_kept")


def invariance_deltas(df: DataFrame, scorer: Scorer, feature: str = INVARIANCE_FEATURE) -> DataFrame:
    """Rows whose feature exceeds 1, with the scores one up and one down and their distance."""
    if feature not in df.columns:
        raise ValueError(f"Feature '{feature}' not found in test data")
    kept = df.filter(F.col(feature) > FLOOR)
    moved = with_change(with_change(kept, scorer, feature, F.lit(1), "y_plus"), scorer, feature, F.lit(-1), "y_minus")
    return moved.withColumn("abs_delta", F.abs(F.col("y_minus") - F.col("y_plus")))


def invariance_test(
    df: DataFrame, scorer: Scorer, feature: str = INVARIANCE_FEATURE, sample_std: bool = False, check: bool = True
) -> DataFrame:
    """abs_delta_std (population unless ``sample_std``), proportion_stable, test_feature, test_samples."""
    deltas = invariance_deltas(df, scorer, feature)
    if check and deltas.isEmpty():
        raise ValueError(f"No data remains after filtering for feature '{feature}' > {FLOOR}")
    spread = F.stddev_samp if sample_std else F.stddev_pop
    return deltas.agg(
        spread("abs_delta").alias("abs_delta_std"),
        F.avg((F.col("abs_delta") < STABLE_DELTA).cast("int")).alias("proportion_stable"),
        F.lit(feature).alias("test_feature"), F.count(F.lit(1)).alias("test_samples"),
    )


def directional_profile(df: DataFrame, scorer: Scorer, feature: str, steps: list[float]) -> DataFrame:
    """Add ``profile`` (score after each ascending step), ``rises`` and ``falls`` (never moving the other way)."""
    out = df
    for i, step in enumerate(steps):
        out = with_change(out, scorer, feature, F.lit(step), f"_y{i}")
    ys = [F.col(f"_y{i}") for i in range(len(steps))]

    def all_of(test) -> Column:
        flags = F.lit(True)
        for a, b in zip(ys, ys[1:]):
            flags = flags & test(a, b)
        return flags

    return out.withColumns({
        "profile": F.array(*ys), "rises": all_of(lambda a, b: b >= a), "falls": all_of(lambda a, b: b <= a),
        "net_change": ys[-1] - ys[0],
    }).drop(*[f"_y{i}" for i in range(len(steps))])


def directional_test(df: DataFrame, scorer: Scorer, feature: str, steps: list[float]) -> DataFrame:
    """Share of rows whose score never falls, never rises, and the mean net change."""
    return directional_profile(df, scorer, feature, steps).agg(
        F.lit(feature).alias("test_feature"), F.count(F.lit(1)).alias("test_samples"),
        F.avg(F.col("rises").cast("int")).alias("share_rising"), F.avg(F.col("falls").cast("int")).alias("share_falling"),
        F.avg("net_change").alias("mean_change"),
    )


def robustness_test(df: DataFrame, scorer: Scorer, features: list[str], noise: float = NOISE, seed: int = 42) -> DataFrame:
    """Share of rows whose score moves less than 0.1 under normal noise on every feature."""
    base = scorer(df, "_clean")
    kept = base.select("*", F.struct(*features).alias("_kept"))
    noisy = kept.withColumns({f: F.col(f) + F.randn(seed + i) * noise for i, f in enumerate(features)})
    moved = scorer(noisy, "_noisy").withColumn("abs_delta", F.abs(F.col("_clean") - F.col("_noisy")))
    return moved.agg(
        F.avg((F.col("abs_delta") < ROBUST_DELTA).cast("int")).alias("proportion_robust"),
        F.max("abs_delta").alias("max_change"), F.count(F.lit(1)).alias("test_samples"),
    )


def prototype_test(
    df: DataFrame, scorer: Scorer, features: list[str], n_clusters: int = PROTOTYPES, seed: int = 42
) -> DataFrame:
    """Scores of k-means centres: cluster, center (array), prediction. Only the k centres reach the driver."""
    assembled = VectorAssembler(inputCols=features, outputCol="_point").transform(df).select("_point")
    fitted = KMeans(k=n_clusters, seed=seed, featuresCol="_point").fit(assembled)
    rows = [(i, *map(float, c)) for i, c in enumerate(fitted.clusterCenters())]
    schema = "cluster int, " + ", ".join(f"`{f}` double" for f in features)
    centres = df.sparkSession.createDataFrame(rows, schema)
    return scorer(centres, "prediction").select(
        "cluster", F.array(*[F.col(f) for f in features]).alias("center"), "prediction"
    )
