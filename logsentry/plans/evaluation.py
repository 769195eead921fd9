"""Queries of evaluation tables over rule scores and a smooth payload score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.operators import behave, records, splits
from logsentry.operators import evaluate as ev
from logsentry.plans.inputs import indexed_logs, payload_predictions, rounded, rule_predictions
from logsentry.plans.sql import INDEXED, LOG_SCORE, LOGS, PAYLOAD_PRED, PRED, r6, rule_score, with_
from logsentry.sources.network_logs import network_logs
from logsentry.sources.schemas import FEATURE_COLUMNS

STEPS = [0.0, 1.0, 5000.0, 20000.0]


def prediction_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.prediction_summary(rule_predictions(spark, sf_dir)))


def rate_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.rate_comparison(rule_predictions(spark, sf_dir)))


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.confusion_matrix(rule_predictions(spark, sf_dir))


def weighted_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.weighted_scores(rule_predictions(spark, sf_dir)))


def binary_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.binary_scores(rule_predictions(spark, sf_dir)))


def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.classification_report(rule_predictions(spark, sf_dir)))


def class_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = rule_predictions(spark, sf_dir)
    one_class = lambda y: F.avg(F.when(F.col("y_true") == y, F.col("y_prob")))
    return rounded(pred.agg(one_class(0).alias("mean_normal"), one_class(1).alias("mean_intrusion")))


def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.roc_curve(ev.score_table(rule_predictions(spark, sf_dir))))


def roc_curve_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.roc_curve(ev.score_table(payload_predictions(spark, sf_dir))))


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.roc_auc(ev.score_table(rule_predictions(spark, sf_dir))))


def roc_auc_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.roc_auc(ev.score_table(payload_predictions(spark, sf_dir))))


def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.pr_curve(ev.score_table(payload_predictions(spark, sf_dir))))


def pr_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.pr_auc(ev.score_table(rule_predictions(spark, sf_dir))))


def pr_auc_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.pr_auc(ev.score_table(payload_predictions(spark, sf_dir))))


def calibration_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.calibration_curve(payload_predictions(spark, sf_dir)))


def calibration_curve_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.calibration_curve(rule_predictions(spark, sf_dir), bins=10))


def density_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.density_summary(ev.score_table(payload_predictions(spark, sf_dir))))


def class_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.class_histogram(ev.score_table(payload_predictions(spark, sf_dir))))


def invariance_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = network_logs(spark, sf_dir)
    return rounded(behave.invariance_test(logs, behave.rule_scorer, check=False))


def invariance_test_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = network_logs(spark, sf_dir)
    return rounded(behave.invariance_test(logs, behave.rule_scorer, sample_std=True, check=False))


def directional_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(behave.directional_test(network_logs(spark, sf_dir), behave.rule_scorer, "Payload_Size", STEPS))


def prediction_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows only, as the chart has it; joined on the row position."""
    indexed = indexed_logs(spark, sf_dir, ["Port", "Payload_Size", "Protocol", "Status", "User_Agent", "Intrusion"])
    _, test = splits.split_time_series(indexed)
    pred = behave.rule_scorer(test).select("idx", F.col("Intrusion").alias("y_true"), "y_prob")
    return ev.prediction_timeline(pred, test)


def hourly_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = behave.rule_scorer(network_logs(spark, sf_dir)).withColumnRenamed("Intrusion", "y_true")
    return rounded(ev.hourly_timeline(ev.with_predicted(logs)))


def training_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = splits.split_time_series(indexed_logs(spark, sf_dir, ["Intrusion"]))
    return rounded(ev.training_stats(train, "Intrusion", len(FEATURE_COLUMNS)))


def fold_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of the rules on every test fold, in one pass over all folds."""
    indexed = indexed_logs(spark, sf_dir, ["Port", "Payload_Size", "Protocol", "Status", "User_Agent", "Intrusion"])
    pred = behave.rule_scorer(indexed).select("idx", F.col("Intrusion").alias("y_true"), "y_prob")
    folds = splits.time_folds(pred, 5, total_of=indexed).filter("role = 'test'")
    return rounded(ev.weighted_scores(folds, ["fold"]))


def cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = fold_accuracy(spark, sf_dir).select("fold", F.col("accuracy").alias("score"))
    return rounded(ev.fold_summary(folds).drop("cv_scores"))


def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(records.metric_log(ev.evaluate(rule_predictions(spark, sf_dir)), "rules"))


def run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = records.metric_log(ev.evaluate(rule_predictions(spark, sf_dir)), "rules").unionByName(
        records.metric_log(ev.evaluate(payload_predictions(spark, sf_dir)), "payload"))
    return rounded(records.compare_runs(runs, ["accuracy", "f1_score", "roc_auc", "pr_auc", "true_positives"]))


QUERIES = {f.__name__: f for f in (
    prediction_summary, rate_comparison, confusion_matrix, weighted_prf, binary_prf, classification_report,
    class_probabilities, roc_curve, roc_curve_smooth, roc_auc, roc_auc_smooth, pr_curve, pr_auc, pr_auc_smooth,
    calibration_curve, calibration_curve_rules, density_summary, class_histogram, invariance_test,
    invariance_test_sample, directional_test, prediction_timeline, hourly_timeline, training_stats, fold_accuracy,
    cv_summary, metric_log, run_comparison,
)}

_HALF = "CAST(0.5 AS DOUBLE)"
_CELLS = f"""cells AS (SELECT
    CAST(count(*) FILTER (WHERE y_true = 0 AND y_prob <= {_HALF}) AS DOUBLE) AS tn,
    CAST(count(*) FILTER (WHERE y_true = 0 AND y_prob > {_HALF}) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (WHERE y_true = 1 AND y_prob <= {_HALF}) AS DOUBLE) AS fn,
    CAST(count(*) FILTER (WHERE y_true = 1 AND y_prob > {_HALF}) AS DOUBLE) AS tp FROM pred),
  per AS (SELECT *, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
    coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f0, tn + fp AS s0,
    coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, tp + fn AS s1 FROM cells)"""
_ACCURACY = "(tn + tp) / (s0 + s1)"
_AVG = {n: f"({c}0 * s0 + {c}1 * s1) / (s0 + s1)" for n, c in (("precision", "p"), ("recall", "r"), ("f1_score", "f"))}

_STEPS_SQL = """levels AS (SELECT y_prob, CAST(count(*) FILTER (WHERE y_true = 1) AS DOUBLE) AS np,
    CAST(count(*) FILTER (WHERE y_true = 0) AS DOUBLE) AS nn FROM pred GROUP BY 1),
  steps AS (SELECT *, sum(np) OVER w AS cp, sum(nn) OVER w AS cn, lead(np) OVER o AS next_p, lead(nn) OVER o AS next_n,
    row_number() OVER o AS nth, (SELECT sum(np) FROM levels) AS all_p, (SELECT sum(nn) FROM levels) AS all_n
    FROM levels WINDOW o AS (ORDER BY y_prob DESC),
      w AS (ORDER BY y_prob DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
_ROC = f"""
  SELECT CAST('infinity' AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
  UNION ALL SELECT {r6('y_prob')}, {r6('cn / all_n')}, {r6('cp / all_p')} FROM steps
  WHERE nth = 1 OR next_p IS NULL OR next_p <> np OR next_n <> nn"""
# Areas from the curves' points, each with the point before it.
_ROC_AREA = """(SELECT sum((cn - coalesce(lag_n, 0)) / all_n * (cp + coalesce(lag_p, 0)) / all_p / 2)
    FROM (SELECT *, lag(cn) OVER (ORDER BY nth) AS lag_n, lag(cp) OVER (ORDER BY nth) AS lag_p FROM steps))"""
_PR_AREA = """(SELECT sum((recall - coalesce(lag_r, 0)) * (prec + coalesce(lag_prec, 1)) / 2) FROM (
    SELECT cp / all_p AS recall, cp / (cp + cn) AS prec, lag(cp / all_p) OVER (ORDER BY nth) AS lag_r,
      lag(cp / (cp + cn)) OVER (ORDER BY nth) AS lag_prec FROM steps))"""


def _calibration(bins: int) -> str:
    step = f"CAST({1.0 / bins} AS DOUBLE)"
    return f"""SELECT bin, {r6('avg(y_prob)')} AS mean_predicted, {r6('avg(y_true)')} AS fraction_positive, count(*) AS n
      FROM (SELECT *, (SELECT CAST(count(*) AS INTEGER) FROM range(1, {bins}) e(i) WHERE i * {step} < y_prob) AS bin FROM pred)
      GROUP BY 1"""


_SHAPE = """stats AS (SELECT y_true AS class, CAST(count(*) AS DOUBLE) AS n, min(y_prob) AS low, max(y_prob) AS high,
    quantile_cont(y_prob, 0.25) AS q25, quantile_cont(y_prob, 0.75) AS q75 FROM pred GROUP BY 1),
  shape AS (SELECT class, low, high, CAST(ceil((high - low) / least(2 * (q75 - q25) / pow(n, CAST(1 AS DOUBLE) / 3),
    (high - low) / (log2(n) + 1))) AS INTEGER) AS bins FROM stats),
  grid AS (SELECT class, low, high, bins, CAST(unnest(range(0, bins)) AS INTEGER) AS bin FROM shape),
  edges AS (SELECT class, bin, bins, low + bin * ((high - low) / bins) AS a, low + (bin + 1) * ((high - low) / bins) AS b FROM grid)"""

_UP, _DOWN = (rule_score("Port", f"(Payload_Size {d})", "Protocol", "Status", "User_Agent") for d in ("+ 1", "- 1"))
_DELTAS = LOGS + f""", deltas AS (
  SELECT abs({_DOWN} - {_UP}) AS d FROM logs WHERE Payload_Size > 1)"""


def _invariance(std: str) -> str:
    return with_(_DELTAS, f"""
        SELECT {r6(f'{std}(d)')} AS abs_delta_std, {r6('avg(CASE WHEN d < CAST(0.05 AS DOUBLE) THEN 1 ELSE 0 END)')} AS proportion_stable,
          'Payload_Size' AS test_feature, count(*) AS test_samples FROM deltas""")


_PROFILE = ", ".join(f"{rule_score('Port', f'(Payload_Size + {int(s)})', 'Protocol', 'Status', 'User_Agent')} AS y{i}"
                     for i, s in enumerate(STEPS))
_PAIRS = [(f"y{i}", f"y{i + 1}") for i in range(len(STEPS) - 1)]
_RULE_INDEXED = INDEXED + f", pred AS (SELECT *, Intrusion AS y_true, {LOG_SCORE} AS y_prob FROM indexed)"
_FOLDS = _RULE_INDEXED + """, folded AS (
  SELECT CAST(fold AS INTEGER) AS fold, CASE WHEN (y_prob > CAST(0.5 AS DOUBLE)) = (y_true = 1) THEN 1 ELSE 0 END AS hit, y_true, y_prob
  FROM pred, (SELECT count(*) AS n, count(*) // 6 AS size FROM logs), (SELECT unnest([0, 1, 2, 3, 4]) AS fold)
  WHERE idx >= n - (5 - fold) * size AND idx < n - (4 - fold) * size)"""
_FOLD_CELLS = _CELLS.replace("cells AS (SELECT", "cells AS (SELECT fold,").replace("FROM pred)", "FROM folded GROUP BY fold)")

_METRICS = f"""SELECT {r6(_ACCURACY)} AS accuracy, {r6(_AVG['f1_score'])} AS f1_score, {r6(_ROC_AREA)} AS roc_auc,
  {r6(_PR_AREA)} AS pr_auc, tp AS true_positives, {r6(_AVG['precision'])} AS "precision", {r6(_AVG['recall'])} AS recall,
  tn AS true_negatives, fp AS false_positives, fn AS false_negatives FROM per"""
_LOGGED = ["f1_score", "precision", "recall", "accuracy", "roc_auc", "pr_auc", "true_negatives", "false_positives",
           "false_negatives", "true_positives"]
_RUN = "SELECT '{run}' AS run_id, accuracy, f1_score, roc_auc, pr_auc, true_positives FROM ({metrics})"

ORACLES = {
    "prediction_summary": with_(PRED, f"SELECT count(*) AS test_size, {r6('avg(y_true)')} AS intrusion_rate FROM pred"),
    "rate_comparison": with_(PRED, f"""
        SELECT {r6('avg(y_prob)')} AS mean_predicted, {r6('avg(y_true)')} AS actual_rate,
          {r6('abs(avg(y_prob) - avg(y_true))')} AS abs_difference FROM pred"""),
    "confusion_matrix": with_(PRED + ", " + _CELLS, """
        SELECT 0 AS actual, 0 AS predicted, CAST(tn AS BIGINT) AS n FROM cells UNION ALL SELECT 0, 1, CAST(fp AS BIGINT) FROM cells
        UNION ALL SELECT 1, 0, CAST(fn AS BIGINT) FROM cells UNION ALL SELECT 1, 1, CAST(tp AS BIGINT) FROM cells"""),
    "weighted_prf": with_(PRED + ", " + _CELLS, f"""
        SELECT {r6(_ACCURACY)} AS accuracy, {r6(_AVG['precision'])} AS "precision", {r6(_AVG['recall'])} AS recall,
          {r6(_AVG['f1_score'])} AS f1_score FROM per"""),
    "binary_prf": with_(PRED + ", " + _CELLS, f"""
        SELECT {r6(_ACCURACY)} AS accuracy, {r6('p1')} AS "precision", {r6('r1')} AS recall, {r6('f1')} AS f1_score FROM per"""),
    "classification_report": with_(PRED + ", " + _CELLS, f"""
        SELECT 'Normal' AS label, {r6('p0')} AS "precision", {r6('r0')} AS recall, {r6('f0')} AS f1_score, CAST(s0 AS BIGINT) AS support FROM per
        UNION ALL SELECT 'Intrusion', {r6('p1')}, {r6('r1')}, {r6('f1')}, CAST(s1 AS BIGINT) FROM per
        UNION ALL SELECT 'accuracy', NULL, NULL, {r6(_ACCURACY)}, CAST(s0 + s1 AS BIGINT) FROM per
        UNION ALL SELECT 'macro avg', {r6('(p0 + p1) / 2')}, {r6('(r0 + r1) / 2')}, {r6('(f0 + f1) / 2')}, CAST(s0 + s1 AS BIGINT) FROM per
        UNION ALL SELECT 'weighted avg', {r6(_AVG['precision'])}, {r6(_AVG['recall'])}, {r6(_AVG['f1_score'])}, CAST(s0 + s1 AS BIGINT) FROM per"""),
    "class_probabilities": with_(PRED, f"""
        SELECT {r6('avg(y_prob) FILTER (WHERE y_true = 0)')} AS mean_normal,
          {r6('avg(y_prob) FILTER (WHERE y_true = 1)')} AS mean_intrusion FROM pred"""),
    "roc_curve": with_(PRED + ", " + _STEPS_SQL, _ROC),
    "roc_curve_smooth": with_(PAYLOAD_PRED + ", " + _STEPS_SQL, _ROC),
    "roc_auc": with_(PRED + ", " + _STEPS_SQL, f"SELECT {r6(_ROC_AREA)} AS roc_auc"),
    "roc_auc_smooth": with_(PAYLOAD_PRED + """, ranked AS (
        SELECT y_true, CAST(rank() OVER (ORDER BY y_prob) AS DOUBLE) + (count(*) OVER (PARTITION BY y_prob) - 1) / CAST(2 AS DOUBLE) AS r FROM pred),
        sizes AS (SELECT CAST(sum(y_true) AS DOUBLE) AS p, CAST(count(*) - sum(y_true) AS DOUBLE) AS n FROM pred)""", f"""
        SELECT {r6('((SELECT sum(r) FROM ranked WHERE y_true = 1) - p * (p + 1) / 2) / (p * n)')} AS roc_auc FROM sizes"""),
    "pr_curve": with_(PAYLOAD_PRED + ", " + _STEPS_SQL, f"""
        SELECT {r6('y_prob')} AS threshold, {r6('cp / (cp + cn)')} AS "precision", {r6('cp / all_p')} AS recall FROM steps
        UNION ALL SELECT NULL, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE)"""),
    "pr_auc": with_(PRED + ", " + _STEPS_SQL, f"SELECT {r6(_PR_AREA)} AS pr_auc"),
    "pr_auc_smooth": with_(PAYLOAD_PRED + ", " + _STEPS_SQL, f"SELECT {r6(_PR_AREA)} AS pr_auc"),
    "calibration_curve": with_(PAYLOAD_PRED, _calibration(20)),
    "calibration_curve_rules": with_(PRED, _calibration(10)),
    "density_summary": with_(PAYLOAD_PRED, f"""
        SELECT y_true AS class, count(*) AS n, {r6('avg(y_prob)')} AS mean, {r6('median(y_prob)')} AS median FROM pred GROUP BY 1"""),
    "class_histogram": with_(PAYLOAD_PRED + ", " + _SHAPE, f"""
        SELECT class, bin, {r6('a')} AS bin_start, {r6('b')} AS bin_end, count(y_prob) AS n
        FROM edges LEFT JOIN pred ON y_true = class AND y_prob >= a AND (y_prob < b OR bin = bins - 1)
        GROUP BY class, bin, a, b"""),
    "invariance_test": _invariance("stddev_pop"),
    "invariance_test_sample": _invariance("stddev_samp"),
    "directional_test": with_(LOGS + f", profile AS (SELECT {_PROFILE} FROM logs)", f"""
        SELECT 'Payload_Size' AS test_feature, count(*) AS test_samples,
          {r6('avg(CASE WHEN ' + ' AND '.join(f'{b} >= {a}' for a, b in _PAIRS) + ' THEN 1 ELSE 0 END)')} AS share_rising,
          {r6('avg(CASE WHEN ' + ' AND '.join(f'{b} <= {a}' for a, b in _PAIRS) + ' THEN 1 ELSE 0 END)')} AS share_falling,
          {r6(f'avg(y{len(STEPS) - 1} - y0)')} AS mean_change FROM profile"""),
    "prediction_timeline": with_(_RULE_INDEXED, f"""
        SELECT idx, "Timestamp", y_true, y_prob, CASE WHEN y_prob > {_HALF} THEN 1 ELSE 0 END AS y_pred FROM pred
        WHERE idx >= (SELECT CAST(floor(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) FROM logs)"""),
    "hourly_timeline": with_(_RULE_INDEXED, f"""
        SELECT CAST(date_trunc('hour', "Timestamp") AS TIMESTAMP) AS hour_start, count(*) AS n, {r6('avg(y_prob)')} AS mean_prob,
          CAST(sum(CASE WHEN y_prob > {_HALF} THEN 1 ELSE 0 END) AS BIGINT) AS predicted, CAST(sum(y_true) AS BIGINT) AS actual
        FROM pred GROUP BY 1"""),
    "training_stats": with_(INDEXED, f"""
        SELECT CAST(sum(n) AS BIGINT) AS n_train_samples, {len(FEATURE_COLUMNS)} AS n_features,
          CAST(sum(CASE WHEN Intrusion = 0 THEN n END) AS BIGINT) AS class_0_count,
          CAST(sum(CASE WHEN Intrusion = 1 THEN n END) AS BIGINT) AS class_1_count,
          {r6('CAST(min(n) AS DOUBLE) / max(n)')} AS class_balance_ratio
        FROM (SELECT Intrusion, count(*) AS n FROM indexed
          WHERE idx < (SELECT CAST(floor(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) FROM logs) GROUP BY 1)"""),
    "fold_accuracy": with_(_FOLDS + ", " + _FOLD_CELLS, f"""
        SELECT fold, {r6(_ACCURACY)} AS accuracy, {r6(_AVG['precision'])} AS "precision", {r6(_AVG['recall'])} AS recall,
          {r6(_AVG['f1_score'])} AS f1_score FROM per"""),
    "cv_summary": with_(_FOLDS, f"""
        SELECT {r6('avg(score)')} AS cv_mean_accuracy, {r6('stddev_pop(score)')} AS cv_std_accuracy
        FROM (SELECT fold, {r6('avg(hit)')} AS score FROM folded GROUP BY 1)"""),
    "metric_log": with_(PRED + ", " + _CELLS + ", " + _STEPS_SQL + f", m AS ({_METRICS})", " UNION ALL ".join(
        f"SELECT 'rules' AS run_id, 'model_evaluation' AS stage, '{n}' AS name, \"{n}\" AS value FROM m" for n in _LOGGED)),
    "run_comparison": " UNION ALL ".join(
        "SELECT * FROM (" + with_(p + ", " + _CELLS + ", " + _STEPS_SQL, _RUN.format(run=run, metrics=_METRICS)) + ")"
        for run, p in (("rules", PRED), ("payload", PAYLOAD_PRED))),
}
