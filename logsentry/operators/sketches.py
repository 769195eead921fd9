"""Medians and AUC with bounds from quantile sketches, for logs with as many scores as rows.

Exact curves keep one row per distinct score. Here each day and class has one KLL sketch of its scores, some kilobytes
whatever the number of rows; sketches of days are merged, so a new day costs that day alone. A sketch of ``k`` knows
ranks up to an error that follows from k; ``CARE`` times that error is allowed for here, which the sketch exceeds by chance only
(the plain error holds with 99 %, errors are about normal). Bounds follow from it without looking at rows again.

Missing scores and labels are left out. A class without rows gives no bounds (null).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 1024
STEPS = 1000  # ranks of the positive class at which the negative one is looked up
CARE = 2.0


def rank_error(k: int = K) -> float:
    """Share of rows by which a rank may be off: the sketch's own bound, for one rank at a time, times ``CARE``."""
    return CARE * 2.296 / k**0.9723


def daily_sketches(pred: DataFrame, day: str | Column, k: int = K) -> DataFrame:
    """(day, y_true, n, sketch) of predictions (y_true, y_prob and a day). Partial sketches leave each task, not rows."""
    named = F.col(day) if isinstance(day, str) else day
    known = pred.filter(F.col("y_true").isNotNull() & F.col("y_prob").isNotNull())
    return known.groupBy(named.alias("day"), "y_true").agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col("y_prob").cast("double"), F.lit(k)).alias("sketch"))


def merged(sketches: DataFrame, k: int = K) -> DataFrame:
    """(y_true, n, sketch) over all days."""
    return sketches.groupBy("y_true").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def _array(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def sketched_summary(sketches: DataFrame, k: int = K) -> DataFrame:
    """One row: n_0, n_1, median_0, median_1, auc, each estimate with ``_low`` and ``_high``. ``sketches``: (day, y_true, n, sketch).

    With a sketch's rank error e, a quantile lies between those of ranks 0.5 - e and 0.5 + e. The AUC is the mean, over the positive class,
    of the share of negatives below (half of those equal). Of each of ``STEPS`` equal parts of the positives the lowest score is at
    least the quantile at its lower rank less e, and the negatives below that are a share known to e; likewise from above.
    Two rows, one per class, reach the driver twice, with ``STEPS`` numbers each.
    """
    e = rank_error(k)
    clip = lambda x: min(max(x, 0.0), 1.0)
    both = merged(sketches, k).filter("y_true IN (0, 1)")
    low, mid, high = ([clip(i / STEPS + d) for i in range(STEPS)] for d in (-e, 0.5 / STEPS, 1 / STEPS + e))
    ranks = [0.5, clip(0.5 - e), clip(0.5 + e), *low, *mid, *high]
    told = {r["y_true"]: r for r in both.select("y_true", "n", F.kll_sketch_get_quantile_double("sketch", _array(ranks)).alias("q")).collect()}
    row: dict[str, float | int | None] = {f"n_{c}": told[c]["n"] if c in told else 0 for c in (0, 1)}
    for c in (0, 1):
        q = told[c]["q"] if c in told else [None] * 3
        row |= {f"median_{c}": q[0], f"median_{c}_low": q[1], f"median_{c}_high": q[2]}
    row |= {"auc": None, "auc_low": None, "auc_high": None}
    if len(told) == 2:
        q = told[1]["q"]
        from_low, from_mid, from_high = q[3 : 3 + STEPS], q[3 + STEPS : 3 + 2 * STEPS], q[3 + 2 * STEPS :]
        # The rank of a score counts what is equal to it; that of the number just below counts what is smaller.
        asked = [*(math.nextafter(x, -math.inf) for x in from_low), *(math.nextafter(x, -math.inf) for x in from_mid), *from_mid, *from_high]
        shares = both.filter("y_true = 0").select(F.kll_sketch_get_rank_double("sketch", _array(asked)).alias("r")).first()["r"]
        lows, below, upto, highs = (shares[i * STEPS : (i + 1) * STEPS] for i in range(4))
        row |= {"auc": sum(a + b for a, b in zip(below, upto)) / (2 * STEPS), "auc_low": sum(clip(x - e) for x in lows) / STEPS,
                "auc_high": sum(clip(x + e) for x in highs) / STEPS}
    schema = ", ".join(f"{n} {'bigint' if n.startswith('n_') else 'double'}" for n in row)
    return sketches.sparkSession.createDataFrame([tuple(row.values())], schema)
