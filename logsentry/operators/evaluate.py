"""Model evaluation as relational aggregates.

Input is a predictions table (idx, y_true INT, y_prob DOUBLE). Everything that
needs the scores in order works on the score table: one row per distinct score
with counts per class, so a score shared by a third of all rows is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsentry.functions.rules import INTRUSION_THRESHOLD
from logsentry.operators.order import next_value, prefix_sum
from logsentry.session import one_row

# Calibration bins, class names.
CALIBRATION_BINS = 20
CLASS_NAMES = ["Normal", "Intrusion"]


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division with 0/0 and x/0 giving 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / F.nullif(denominator, F.lit(0)))


def with_predicted(pred: DataFrame, threshold: float = INTRUSION_THRESHOLD) -> DataFrame:
    return pred.withColumn("y_pred", (F.col("y_prob") > F.lit(threshold)).cast("int"))


def prediction_summary(pred: DataFrame) -> DataFrame:
    return pred.agg(F.count(F.lit(1)).alias("test_size"), F.avg("y_true").alias("intrusion_rate"))


def rate_comparison(pred: DataFrame) -> DataFrame:
    """Mean predicted probability beside the actual rate."""
    return pred.agg(F.avg("y_prob").alias("mean_predicted"), F.avg("y_true").alias("actual_rate")).withColumn(
        "abs_difference", F.abs(F.col("mean_predicted") - F.col("actual_rate"))
    )


def _cells() -> list[Column]:
    cell = lambda y, p, name: F.count_if((F.col("y_true") == y) & (F.col("y_pred") == p)).alias(name)
    return [cell(0, 0, "tn"), cell(0, 1, "fp"), cell(1, 0, "fn"), cell(1, 1, "tp")]


def confusion_counts(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """tn, fp, fn, tp in one row (or one per group), combined on the map side."""
    return with_predicted(pred).groupBy(*(by or [])).agg(*_cells())


def confusion_matrix(pred: DataFrame) -> DataFrame:
    """Long form (actual, predicted, n), all four cells."""
    cells = [F.struct(F.lit(y).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
             for y, p, c in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]]
    return confusion_counts(pred).select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def nested_matrix() -> Column:
    """[[tn, fp], [fn, tp]]: rows true, columns predicted."""
    return F.array(F.array("tn", "fp"), F.array("fn", "tp"))


def _class_scores(label: int) -> dict[str, Column]:
    """Precision, recall, F1 and support of one class from the four counts."""
    hit, wrong, missed = [("tn", "fn", "fp"), ("tp", "fp", "fn")][label]
    hit, wrong, missed = F.col(hit), F.col(wrong), F.col(missed)
    return {
        "precision": ratio(hit, hit + wrong),
        "recall": ratio(hit, hit + missed),
        "f1_score": ratio(2 * hit, 2 * hit + wrong + missed),
        "support": hit + missed,
    }


def accuracy() -> Column:
    return ratio(F.col("tn") + F.col("tp"), F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp"))


def weighted(name: str) -> Column:
    """A class score averaged by true class size."""
    classes = [_class_scores(0), _class_scores(1)]
    total = classes[0]["support"] + classes[1]["support"]
    return ratio(classes[0][name] * classes[0]["support"] + classes[1][name] * classes[1]["support"], total)


def weighted_scores(pred: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1."""
    return confusion_counts(pred, by).select(
        *(by or []), accuracy().alias("accuracy"), weighted("precision").alias("precision"),
        weighted("recall").alias("recall"), weighted("f1_score").alias("f1_score"),
    )


def binary_scores(pred: DataFrame) -> DataFrame:
    """Precision, recall, F1 of the positive class."""
    scores = _class_scores(1)
    return confusion_counts(pred).select(
        accuracy().alias("accuracy"), *[scores[n].alias(n) for n in ("precision", "recall", "f1_score")]
    )


def classification_report(pred: DataFrame) -> DataFrame:
    """Rows Normal, Intrusion, accuracy, macro avg, weighted avg."""
    normal, intrusion = _class_scores(0), _class_scores(1)
    support = normal["support"] + intrusion["support"]
    names = ["precision", "recall", "f1_score"]
    lines = [
        (CLASS_NAMES[0], [normal[n] for n in names], normal["support"]),
        (CLASS_NAMES[1], [intrusion[n] for n in names], intrusion["support"]),
        ("accuracy", [F.lit(None).cast("double")] * 2 + [accuracy()], support),
        ("macro avg", [(normal[n] + intrusion[n]) / 2 for n in names], support),
        ("weighted avg", [weighted(n) for n in names], support),
    ]
    rows = [F.struct(F.lit(label).alias("label"), *[v.alias(n) for n, v in zip(names, values)], s.alias("support"))
            for label, values, s in lines]
    return confusion_counts(pred).select(F.explode(F.array(*rows)).alias("line")).select("line.*")


def score_table(pred: DataFrame) -> DataFrame:
    """Distinct scores, highest first, with class counts and their running totals."""
    counts = pred.groupBy("y_prob").agg(
        F.count_if(F.col("y_true") == 1).alias("n_pos"), F.count_if(F.col("y_true") == 0).alias("n_neg")
    )
    return prefix_sum(counts, [F.col("y_prob").desc()], ["n_pos", "n_neg"], tag="scores")


def _totals(scores: DataFrame) -> DataFrame:
    """Score rows with the class totals, taken from the same small table."""
    total = one_row(scores.agg(F.sum("n_pos").alias("pos"), F.sum("n_neg").alias("neg")))
    return scores.withColumn("_total", total).select("*", F.col("_total.pos").alias("_pos_all"), F.col("_total.neg").alias("_neg_all"))


def roc_curve(scores: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) from (inf, 0, 0) on.

    With ``drop_intermediate`` a point goes when the step to the next score adds
    exactly as many rows of each class as the step that led to it.
    """
    points = _totals(scores)
    if drop_intermediate:
        nxt = next_value(points, ["n_pos", "n_neg"])
        first = (F.col("cum_n_pos") == F.col("n_pos")) & (F.col("cum_n_neg") == F.col("n_neg"))
        points = nxt.filter(
            first | F.col("next_n_pos").isNull()
            | (F.col("next_n_pos") != F.col("n_pos")) | (F.col("next_n_neg") != F.col("n_neg"))
        )
    curve = points.select(
        F.col("y_prob").alias("threshold"),
        F.try_divide("cum_n_neg", "_neg_all").alias("fpr"), F.try_divide("cum_n_pos", "_pos_all").alias("tpr"),
    )
    start = curve.sparkSession.sql("SELECT double('infinity') AS threshold, 0D AS fpr, 0D AS tpr")
    return start.unionByName(curve)


def roc_auc(scores: DataFrame) -> DataFrame:
    """Area by trapezoids; equal scores share one step, so no neighbouring row is needed."""
    step = F.try_divide("n_neg", "_neg_all") * F.try_divide(2 * F.col("cum_n_pos") - F.col("n_pos"), F.col("_pos_all")) / 2
    return _totals(scores).agg(F.sum(step).alias("roc_auc"))


def pr_curve(scores: DataFrame) -> DataFrame:
    """(threshold, precision, recall), ending in (NULL, 1, 0). Recall is 1 throughout without positives."""
    curve = _totals(scores).select(
        F.col("y_prob").alias("threshold"),
        (F.col("cum_n_pos") / (F.col("cum_n_pos") + F.col("cum_n_neg"))).alias("precision"),
        F.when(F.col("_pos_all") == 0, F.lit(1.0)).otherwise(F.try_divide("cum_n_pos", "_pos_all")).alias("recall"),
    )
    end = curve.sparkSession.sql("SELECT CAST(NULL AS DOUBLE) AS threshold, 1D AS precision, 0D AS recall")
    return curve.unionByName(end)


def pr_auc(scores: DataFrame) -> DataFrame:
    """Trapezoids over the precision-recall points, from precision 1 at recall 0. Not average precision."""
    seen = F.col("cum_n_pos") + F.col("cum_n_neg")
    before = seen - F.col("n_pos") - F.col("n_neg")
    precision = F.col("cum_n_pos") / seen
    previous = F.when(before == 0, F.lit(1.0)).otherwise((F.col("cum_n_pos") - F.col("n_pos")) / F.nullif(before, F.lit(0)))
    area = F.try_divide("n_pos", "_pos_all") * (precision + previous) / 2
    return _totals(scores).agg(F.sum(area).alias("pr_auc"))


def calibration_curve(pred: DataFrame, bins: int = CALIBRATION_BINS) -> DataFrame:
    """Mean score and positive share in uniform bins (e, e'] of [0, 1]; the first includes 0, empty bins are absent.

    Inner edges are ``i * (1.0 / bins)``, the doubles an evenly spaced grid gives, and scores are compared with them.
    """
    edges = F.array(*[F.lit(i * (1.0 / bins)) for i in range(1, bins)])
    binned = pred.withColumn("_edges", edges).withColumn("bin", F.expr("size(filter(_edges, e -> e < y_prob))"))
    return binned.groupBy("bin").agg(
        F.avg("y_prob").alias("mean_predicted"), F.avg("y_true").alias("fraction_positive"),
        F.count(F.lit(1)).alias("n"),
    )


def _by_class(scores: DataFrame) -> DataFrame:
    """(class, y_prob, n, below): count of the class at a score and under it."""
    sides = [F.struct(F.lit(label).alias("class"), F.col(n).alias("n"), (F.col(total) - F.col(cum)).alias("below"),
                      F.col(total).alias("n_class"))
             for label, n, total, cum in [(0, "n_neg", "_neg_all", "cum_n_neg"), (1, "n_pos", "_pos_all", "cum_n_pos")]]
    return (
        _totals(scores).select("y_prob", F.explode(F.array(*sides)).alias("side")).select("y_prob", "side.*")
        .filter(F.col("n") > 0)
    )


def _quantile(q: float) -> Column:
    """Exact linear-interpolated quantile of a class from running counts: no value list is gathered."""
    at = (F.col("n_class") - 1) * F.lit(q)

    def value(position: Column) -> Column:
        return F.max(F.when((F.col("below") <= position) & (position < F.col("below") + F.col("n")), F.col("y_prob")))

    low, high = value(F.floor(at)), value(F.ceil(at))
    return low + (high - low) * F.max(at - F.floor(at))


def _class_stats(by_class: DataFrame) -> DataFrame:
    return by_class.groupBy("class").agg(
        F.sum("n").alias("n"), F.min("y_prob").alias("low"), F.max("y_prob").alias("high"),
        (F.sum(F.col("y_prob") * F.col("n")) / F.sum("n")).alias("mean"),
        _quantile(0.25).alias("q25"), _quantile(0.5).alias("median"), _quantile(0.75).alias("q75"),
    )


def density_summary(scores: DataFrame) -> DataFrame:
    """Per class: rows, mean and exact median of the score."""
    return _class_stats(_by_class(scores)).select("class", "n", "mean", "median")


def class_histogram(scores: DataFrame) -> DataFrame:
    """Score histogram per class with automatic bins, empty bins included.

    Bin width is the smaller of Sturges' and Freedman-Diaconis' rule (Sturges alone
    when the quartiles meet). Rows are binned as weighted distinct scores.
    """
    by_class = _by_class(scores)
    span = F.col("high") - F.col("low")
    sturges = span / (F.log2(F.col("n")) + 1)
    fd = 2 * (F.col("q75") - F.col("q25")) / F.pow(F.col("n"), F.lit(1.0 / 3.0))
    width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
    flat = span == 0
    # One row per class.
    shape = _class_stats(by_class).select(
        F.col("class").alias("_class"),
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("first"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("last"),
        F.when(flat, F.lit(1)).otherwise(F.ceil(F.try_divide(span, width))).cast("int").alias("bins"),
    )
    edge = lambda i: F.col("first") + i * ((F.col("last") - F.col("first")) / F.col("bins"))
    guess = F.least(
        F.floor((F.col("y_prob") - F.col("first")) / (F.col("last") - F.col("first")) * F.col("bins")), F.col("bins") - 1
    )
    placed = (
        by_class.join(F.broadcast(shape), F.col("class") == F.col("_class"))
        .withColumn("_guess", guess)
        .withColumn("bin", F.when(F.col("y_prob") < edge(F.col("_guess")), F.col("_guess") - 1)
                    .when((F.col("y_prob") >= edge(F.col("_guess") + 1)) & (F.col("_guess") < F.col("bins") - 1), F.col("_guess") + 1)
                    .otherwise(F.col("_guess")).cast("int"))
        .groupBy("class", "bin").agg(F.sum("n").alias("_n"))
    )
    grid = shape.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)))
    return grid.select(
        F.col("_class").alias("class"), "bin", edge(F.col("bin")).alias("bin_start"), edge(F.col("bin") + 1).alias("bin_end")
    ).join(placed, ["class", "bin"], "left").select(
        "class", "bin", "bin_start", "bin_end", F.coalesce("_n", F.lit(0)).alias("n")
    )


def fold_summary(fold_scores: DataFrame, score: str = "score") -> DataFrame:
    """Fold scores in order, their mean and population standard deviation."""
    return fold_scores.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("fold", score))), lambda s: s[score]).alias("cv_scores"),
        F.avg(score).alias("cv_mean_accuracy"), F.stddev_pop(score).alias("cv_std_accuracy"),
    )


def evaluate(pred: DataFrame, fold_scores: DataFrame | None = None) -> DataFrame:
    """One row with every metric; fold columns are present when ``fold_scores`` (fold, score) is given."""
    scores = score_table(pred)
    out = confusion_counts(pred).select(
        accuracy().alias("accuracy"), weighted("precision").alias("precision"), weighted("recall").alias("recall"),
        weighted("f1_score").alias("f1_score"), roc_auc(scores).scalar().alias("roc_auc"),
        pr_auc(scores).scalar().alias("pr_auc"), nested_matrix().alias("confusion_matrix"),
    )
    if fold_scores is not None:
        out = out.withColumn("_cv", one_row(fold_summary(fold_scores))).select("*", "_cv.*").drop("_cv")
    return out


def training_stats(train: DataFrame, label: str, n_features: int) -> DataFrame:
    """Training rows, features, rows per class and smallest/largest class."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.sum("n").alias("n_train_samples"), F.lit(n_features).alias("n_features"),
        F.coalesce(F.sum(F.when(F.col(label) == 0, F.col("n"))), F.lit(0)).alias("class_0_count"),
        F.coalesce(F.sum(F.when(F.col(label) == 1, F.col("n"))), F.lit(0)).alias("class_1_count"),
        (F.min("n") / F.max("n")).alias("class_balance_ratio"),
    )


def prediction_timeline(pred: DataFrame, logs: DataFrame, key: str = "idx") -> DataFrame:
    """Predictions with their time, joined on the row position (unique on both sides, so no skew)."""
    return logs.select(key, "Timestamp").join(with_predicted(pred), key)


def hourly_timeline(timeline: DataFrame) -> DataFrame:
    return timeline.groupBy(F.date_trunc("hour", "Timestamp").cast("timestamp_ntz").alias("hour_start")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("y_prob").alias("mean_prob"),
        F.sum("y_pred").alias("predicted"), F.sum("y_true").alias("actual"),
    )
