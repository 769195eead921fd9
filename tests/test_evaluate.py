import math
import random

import pytest

from logsentry.operators import evaluate as ev

TEN = ([0, 1] * 5, [.1, .9, .2, .8, .3, .7, .15, .85, .25, .75])


def predictions(spark, y, p):
    return spark.createDataFrame([(i, a, float(b)) for i, (a, b) in enumerate(zip(y, p))],
                                 "idx long, y_true int, y_prob double")


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(7)
    y = [int(rng.random() < 0.3) for _ in range(400)]
    p = [round(min(max(0.25 + 0.3 * a + rng.gauss(0, 0.2), 0), 1), 2) for a in y]
    return y, p, predictions(spark, y, p)


def test_perfect_ranking(spark):
    scores = ev.score_table(predictions(spark, *TEN))
    assert ev.roc_auc(scores).first()[0] == 1.0
    assert ev.pr_auc(scores).first()[0] == 1.0
    m = ev.evaluate(predictions(spark, *TEN)).first()
    assert (m.accuracy, m.precision, m.recall, m.f1_score) == (1.0, 1.0, 1.0, 1.0)
    assert m.confusion_matrix == [[5, 0], [0, 5]]
    s = ev.prediction_summary(predictions(spark, *TEN)).first()
    assert (s.test_size, s.intrusion_rate) == (10, 0.5)


def test_two_rows(spark):
    scores = ev.score_table(predictions(spark, [0, 1], [.3, .7]))
    curve = sorted((-r.threshold, r.fpr, r.tpr) for r in ev.roc_curve(scores).collect())
    assert curve == [(-math.inf, 0, 0), (-.7, 0, 1), (-.3, 1, 1)]
    assert {r["class"]: r.median for r in ev.density_summary(scores).collect()} == {0: .3, 1: .7}


def test_roc_auc_is_the_rank_statistic(noisy):
    y, p, pred = noisy
    pos, neg = [b for a, b in zip(y, p) if a], [b for a, b in zip(y, p) if not a]
    rank = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert abs(ev.roc_auc(ev.score_table(pred)).first()[0] - rank) < 1e-12


def test_curves_against_direct_counts(noisy):
    y, p, pred = noisy
    scores = ev.score_table(pred)
    levels = sorted(set(p), reverse=True)
    n_pos, n_neg = sum(y), len(y) - sum(y)
    tp = [sum(a for a, b in zip(y, p) if b >= t) for t in levels]
    fp = [sum(1 - a for a, b in zip(y, p) if b >= t) for t in levels]
    keep = [i for i in range(len(levels)) if i in (0, len(levels) - 1)
            or tp[i + 1] - 2 * tp[i] + tp[i - 1] or fp[i + 1] - 2 * fp[i] + fp[i - 1]]
    want = [(math.inf, 0.0, 0.0)] + [(levels[i], fp[i] / n_neg, tp[i] / n_pos) for i in keep]
    got = sorted([(r.threshold, r.fpr, r.tpr) for r in ev.roc_curve(scores).collect()], reverse=True)
    assert got == want
    assert ev.roc_curve(scores, drop_intermediate=False).count() == len(levels) + 1
    recall, precision = [0.0] + [t / n_pos for t in tp], [1.0] + [t / (t + f) for t, f in zip(tp, fp)]
    area = sum((recall[i] - recall[i - 1]) * (precision[i] + precision[i - 1]) / 2 for i in range(1, len(recall)))
    assert abs(ev.pr_auc(scores).first()[0] - area) < 1e-12
    got = {r.threshold: (r.precision, r.recall) for r in ev.pr_curve(scores).collect()}
    assert got[None] == (1.0, 0.0) and all(abs(got[t][0] - precision[i + 1]) < 1e-15 for i, t in enumerate(levels))


def test_range_count_does_not_change_curves(spark, noisy):
    want = sorted(map(tuple, ev.roc_curve(ev.score_table(noisy[2])).collect()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        many = ev.score_table(noisy[2])
        assert many.select("_part").distinct().count() > 3
        assert sorted(map(tuple, ev.roc_curve(many).collect())) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_confusion_scores(noisy):
    y, p, pred = noisy
    hat = [int(b > 0.5) for b in p]
    cell = {(a, b): sum(1 for u, v in zip(y, hat) if (u, v) == (a, b)) for a in (0, 1) for b in (0, 1)}
    assert {(r.actual, r.predicted): r.n for r in ev.confusion_matrix(pred).collect()} == cell
    per = []
    for c in (0, 1):
        pr = cell[c, c] / (cell[0, c] + cell[1, c])
        rc = cell[c, c] / (cell[c, 0] + cell[c, 1])
        per.append((pr, rc, 2 * pr * rc / (pr + rc), cell[c, 0] + cell[c, 1]))
    w = ev.weighted_scores(pred).first()
    for name, i in (("precision", 0), ("recall", 1), ("f1_score", 2)):
        assert abs(w[name] - sum(k[i] * k[3] for k in per) / len(y)) < 1e-12
        assert abs(ev.binary_scores(pred).first()[name] - per[1][i]) < 1e-12
    report = {r.label: r for r in ev.classification_report(pred).collect()}
    assert set(report) == {"Normal", "Intrusion", "accuracy", "macro avg", "weighted avg"}
    assert abs(report["macro avg"].precision - (per[0][0] + per[1][0]) / 2) < 1e-12


def test_no_predicted_positives(spark):
    s = ev.binary_scores(predictions(spark, [0, 1], [.1, .2])).first()
    assert (s.precision, s.recall, s.f1_score) == (0.0, 0.0, 0.0)


def test_calibration_edges(spark):
    pred = predictions(spark, [0, 1, 0, 1], [0.0, 0.05, 0.15, 1.0])
    assert {r.bin: r.n for r in ev.calibration_curve(pred).collect()} == {0: 2, 2: 1, 19: 1}


def test_quantiles_and_histogram(noisy):
    np = pytest.importorskip("numpy")
    y, p, pred = noisy
    scores = ev.score_table(pred)
    for r in ev.density_summary(scores).collect():
        mine = np.array([b for a, b in zip(y, p) if a == r["class"]])
        assert abs(r.median - np.median(mine)) < 1e-12 and abs(r.mean - mine.mean()) < 1e-12
    hist = ev.class_histogram(scores).orderBy("class", "bin").collect()
    for c in (0, 1):
        counts, edges = np.histogram(np.array([b for a, b in zip(y, p) if a == c]), bins="auto")
        mine = [r for r in hist if r["class"] == c]
        assert [r.n for r in mine] == list(counts)
        assert np.allclose([r.bin_start for r in mine], edges[:-1])


def test_flat_histogram(spark):
    hist = ev.class_histogram(ev.score_table(predictions(spark, [0, 0, 1], [.4, .4, .9]))).collect()
    assert {(r["class"], r.bin, r.n) for r in hist} == {(0, 0, 2), (1, 0, 1)}


def test_fold_summary(spark):
    folds = spark.createDataFrame([(1, .5), (0, 1.0)], "fold int, score double")
    r = ev.fold_summary(folds).first()
    assert (r.cv_scores, r.cv_mean_accuracy, r.cv_std_accuracy) == ([1.0, .5], .75, .25)


def test_training_stats(noisy):
    y, _, pred = noisy
    r = ev.training_stats(pred, "y_true", 17).first()
    assert (r.n_train_samples, r.class_0_count, r.class_1_count) == (400, y.count(0), y.count(1))
    assert r.class_balance_ratio == min(y.count(0), y.count(1)) / max(y.count(0), y.count(1))
