import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsentry.operators import behave, explain, models, records
from logsentry.operators import evaluate as ev
from logsentry.session import pin

FEATURES = ["f1", "f2", "f3"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(42)
    rows = []
    for i in range(300):
        a, b, c = (rng.gauss(0, 1) for _ in range(3))
        rows.append((i, a, b, c, int(2 * a - 2 * b + 0.5 * rng.gauss(0, 1) > 0)))
    return pin(spark.createDataFrame(rows, "idx long, f1 double, f2 double, f3 double, y int"), "model-data")


@pytest.fixture(scope="module")
def model(data):
    return models.train(data, FEATURES, "y", {"num_iterations": 8, "max_depth": 3, "learning_rate": 0.3})


@pytest.fixture(scope="module")
def nodes(model):
    return explain.tree_nodes(model)


@pytest.fixture(scope="module")
def shap(model, data, nodes):
    pred = models.predictions(model, data, "y")
    return pin(explain.compute_shap_values(model, data, FEATURES, nodes).join(pred, "idx"), "shap")


def test_predictions(model, data):
    pred = models.predictions(model, data, "y")
    assert pred.columns == ["idx", "y_true", "y_prob"]
    r = pred.agg(F.min("y_prob"), F.max("y_prob"), F.count("*")).first()
    assert 0 <= r[0] <= r[1] <= 1 and r[2] == 300
    assert ev.weighted_scores(pred).first().accuracy > 0.8
    assert ev.rate_comparison(pred).first().abs_difference < 0.3


def test_parameter_mapping():
    settings, ignored = models.gbt_settings({"learning_rate": .1, "num_iterations": 7.0, "num_leaves": 5, "reg_alpha": 0, "colsample_bytree": .5,
                                             "scale_pos_weight": 2})
    assert settings == {"stepSize": .1, "maxIter": 7, "featureSubsetStrategy": "0.5"}
    assert ignored == ["num_leaves", "reg_alpha"]


def test_draws():
    rng = random.Random(1)
    for _ in range(50):
        p = models.draw(models.SEARCH_SPECS, rng)
        assert p["reg_alpha"] in (0, .01, .1, .5, 1) and isinstance(p["max_depth"], int) and 3 <= p["max_depth"] <= 10
        assert p["num_iterations"] % 50 == 0 and .001 <= p["learning_rate"] <= .3
    assert models.draw(models.SEARCH_SPECS, random.Random(3)) == models.draw(models.SEARCH_SPECS, random.Random(3))
    for spec in ({"type": "normal"}, {"type": "choice"}):
        with pytest.raises(ValueError):
            models.draw({"params": {"x": spec}}, rng)
    assert models.draw({"params": {"x": {"type": "choice", "choices": ["v"]}}}, rng) == {"x": "v"}


def test_search(data):
    specs = {"max_evals": 2, "override_schemas": {"max_depth": "int"}, "default_params": {"num_iterations": 2}, "params": {
        "max_depth": {"type": "quniform", "low": 1, "high": 3, "q": 1}, "learning_rate": {"type": "uniform", "low": .1, "high": .3}}}
    trials = models.search(data, FEATURES, "y", specs, folds=2)
    rows = trials.collect()
    assert len(rows) == 4
    for t in (0, 1):
        mine = [r for r in rows if r.trial == t]
        assert abs(mine[0].objective + sum(r.score for r in mine) / 2) < 1e-12
    best = models.best_params(trials)
    assert set(best) == {"max_depth", "learning_rate"}


def test_cv_on_test(data):
    folds = models.cv_on_test(data.filter("idx >= 200"), FEATURES, "y", {"num_iterations": 2}, 2)
    r = ev.fold_summary(folds).first()
    assert len(r.cv_scores) == 2 and 0 <= r.cv_mean_accuracy <= 1


def test_split_importance(nodes, model):
    imp = {r.feature: r.importance for r in explain.split_importance(nodes, FEATURES).collect()}
    assert set(imp) == set(FEATURES) and sum(imp.values()) == nodes.filter("left >= 0").count()
    assert imp["f1"] > imp["f3"] and imp["f2"] > imp["f3"]
    assert {r.feature for r in explain.gain_importance(model, FEATURES).collect()} == set(FEATURES)


def test_attributions_add_up(shap):
    off = shap.select(F.max(F.abs(
        F.col("base_value") + F.aggregate("shap", F.lit(0.0), lambda a, v: a + v) - F.log(F.col("y_prob") / (1 - F.col("y_prob")))))).first()[0]
    assert off < 1e-9


def test_attributions_are_shapley_values(nodes, shap):
    """Against the definition: the mean marginal payoff over all orderings, missing features averaged by cover."""
    trees = {}
    for r in nodes.collect():
        trees.setdefault(r.tree, {})[r.node] = r

    def payoff(x, known):
        def walk(t, at):
            n = t[at]
            if n.left < 0:
                return n.value * n.weight
            if n.feature in known:
                return walk(t, n.left if x[n.feature] <= n.threshold else n.right)
            return sum(walk(t, c) * t[c].cover / n.cover for c in (n.left, n.right))
        return 2 * sum(walk(t, 0) for t in trees.values())

    for row in shap.orderBy("idx").limit(12).collect():
        x = [row[f] for f in FEATURES]
        want = [0.0] * 3
        for order in itertools.permutations(range(3)):
            for i, f in enumerate(order):
                want[f] += (payoff(x, set(order[:i + 1])) - payoff(x, set(order[:i]))) / math.factorial(3)
        assert np.allclose(row["shap"], want, atol=1e-9)
        assert abs(row["base_value"] - payoff(x, set())) < 1e-9


def test_long_paths_skip_the_table():
    rng = np.random.default_rng(0)
    met, share = (rng.random((40, 5)) < .5).astype(float), rng.random(5)
    leaf = (np.arange(5), np.full(5, .5), np.full(5, np.inf), share, 1.3)
    direct = explain._attribute(met, [leaf], [None])
    assert np.allclose(direct, explain._attribute(met, [leaf], explain._tables([leaf])))
    total = met.prod(axis=1) - share.prod()
    assert np.allclose(direct.sum(axis=1), 2 * 1.3 * total)


def test_attribution_tables(shap, nodes, spark):
    rows = shap.collect()
    imp = explain.shap_importance(shap, FEATURES).collect()
    assert [r.importance for r in imp] == sorted((r.importance for r in imp), reverse=True)
    for r in imp:
        assert abs(r.importance - np.mean([abs(x["shap"][FEATURES.index(r.feature)]) for x in rows])) < 1e-12
    s = explain.shap_stats(shap).first()
    every = [abs(v) for x in rows for v in x["shap"]]
    assert abs(s.shap_values_mean_abs - np.mean(every)) < 1e-12 and s.shap_values_max_abs == max(every)
    dep = explain.shap_dependence(shap, FEATURES, ["f2", "nope"])
    assert dep.count() == 300 and {r.feature for r in dep.collect()} == {"f2"}
    local = {r.description: r for r in explain.local_interpretations(shap, FEATURES).collect()}
    hi = max(rows, key=lambda r: (r.y_prob, -r.idx))
    lo = min(rows, key=lambda r: (r.y_prob, r.idx))
    assert (local["highest_risk"]["index"], local["lowest_risk"]["index"]) == (hi.idx, lo.idx)
    top = local["highest_risk"].top_contributing_features
    assert [t.feature for t in top] == [f for _, f in sorted((-abs(v), f) for v, f in zip(hi["shap"], FEATURES))]
    assert top[0].impact == f"{top[0].direction} risk by {abs(top[0].shap_value):.3f}"
    assert local["highest_risk"].actual_label == ("Intrusion" if hi.y_true else "Normal")
    assert explain.local_lines(explain.local_interpretations(shap, FEATURES)).count() == 6


def test_importance_pair(spark):
    a = spark.createDataFrame([("f1", .5), ("f2", .3), ("f3", .2)], "feature string, importance double")
    b = spark.createDataFrame([("f1", .4), ("f2", .4), ("f9", .2)], "feature string, importance double")
    got = {r.feature: (r.model_importance, r.shap_importance) for r in explain.merge_importance(a, b).collect()}
    assert got == {"f1": (.5, .4), "f2": (.3, .4), "f3": (.2, 0), "f9": (0, .2)}
    assert explain.importance_comparison(a, b, 2).count() == 4
    s = explain.importance_stats(a).first()
    assert (s.n_features, s.max_feature_importance) == (3, .5)


def test_invariance(spark, data, model):
    score = models.scorer(model)
    r = behave.invariance_test(data.withColumn("f1", F.col("f1") + 3), score, "f1").first()
    assert r.test_feature == "f1" and 0 <= r.proportion_stable <= 1 and r.abs_delta_std >= 0
    with pytest.raises(ValueError, match="not found"):
        behave.invariance_test(data, score, "nope")
    with pytest.raises(ValueError, match="No data remains"):
        behave.invariance_test(data.withColumn("f1", F.lit(0.5)), score, "f1")


def test_direction(spark, model):
    score = models.scorer(model)
    zero = spark.createDataFrame([(0.0, 0.0, 0.0)], "f1 double, f2 double, f3 double")
    up = behave.directional_profile(zero, score, "f1", [-1.0, 0.0, 1.0]).first()
    down = behave.directional_profile(zero, score, "f2", [-1.0, 0.0, 1.0]).first()
    assert up.rises and up.profile[0] < up.profile[2] and down.falls and down.profile[0] > down.profile[2]
    assert behave.directional_test(zero, score, "f1", [0.0, 1.0]).first().share_rising == 1.0


def test_robust_and_duplicates(data, model):
    score = models.scorer(model)
    assert behave.robustness_test(data, score, FEATURES).first().proportion_robust > 0.9
    from logsentry.operators.store import append_row
    twice = score(append_row(data, data.filter("idx = 0")), "p").filter("idx = 0").collect()
    assert len(twice) == 2 and twice[0].p == twice[1].p
    reordered = models.train(data, FEATURES[::-1], "y", {"num_iterations": 8, "max_depth": 3, "learning_rate": 0.3})
    both = score(models.scorer(reordered)(data, "a"), "b")
    assert both.filter(F.abs(F.col("a") - F.col("b")) > 0.1).count() <= 3


def test_prototypes(data, model):
    got = behave.prototype_test(data, models.scorer(model), FEATURES, 4).collect()
    assert len(got) == 4 and all(len(r.center) == 3 and 0 <= r.prediction <= 1 for r in got)


def test_records(spark, tmp_path, data, model):
    pred = models.predictions(model, data, "y")
    folds = spark.createDataFrame([(0, .5), (1, .7)], "fold int, score double")
    path = str(tmp_path / "log")
    for run in ("a", "b"):
        records.append_log(records.metric_log(ev.evaluate(pred, folds), run), path)
    wide = records.compare_runs(spark.read.parquet(path)).collect()
    assert [r.run_id for r in sorted(wide)] == ["a", "b"]
    assert wide[0].true_positives + wide[0].true_negatives + wide[0].false_positives + wide[0].false_negatives == 300
    assert abs(wide[0].cv_mean_accuracy - .6) < 1e-12
    logged = {r.name: r.value for r in records.parameter_log(spark, "a", {"max_depth": 3}, 3, 20).collect()}
    assert logged == {"best_max_depth": "3", "cv_folds": "3", "max_evals": "20", "algorithm": "random"}
    mixed = spark.createDataFrame([(1, "x", 2.5)], "n int, s string, v double")
    assert {r.name: r.value for r in records.numeric_log(mixed, "a", "s", "t_").collect()} == {"t_n": 1.0, "t_v": 2.5}
