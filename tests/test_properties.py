import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from logsentry.operators import features as feat
from logsentry.operators.explain import path_attribution
from logsentry.operators.order import blocked, global_index
from logsentry.operators.splits import fold_bounds


@given(st.integers(1, 5).flatmap(lambda n: st.tuples(
    st.lists(st.booleans(), min_size=n, max_size=n), st.lists(st.floats(0.01, 0.99), min_size=n, max_size=n))))
@settings(max_examples=60, deadline=None)
def test_path_values_follow_the_definition(case):
    met, share = np.array([case[0]], dtype=float), np.array(case[1])
    n = len(share)

    def payoff(known):
        return math.prod(met[0][j] if j in known else share[j] for j in range(n))

    want = np.zeros(n)
    for order in itertools.permutations(range(n)):
        for i, j in enumerate(order):
            want[j] += (payoff(order[:i + 1]) - payoff(order[:i])) / math.factorial(n)
    assert np.allclose(path_attribution(met, share)[0], want)


@given(st.integers(2, 500), st.integers(2, 8))
@settings(max_examples=100, deadline=None)
def test_folds_are_adjacent_and_end_at_the_last_row(n, folds):
    if n < folds + 1:
        with pytest.raises(ValueError):
            fold_bounds(n, folds)
        return
    bounds = fold_bounds(n, folds)
    assert len(bounds) == folds and bounds[-1][1] == n and bounds[0][0] >= 1
    assert all(a[1] == b[0] for a, b in zip(bounds, bounds[1:])) and len({e - s for s, e in bounds}) == 1


def test_halo_rows_are_exactly_the_rows_before_a_block(spark):
    rows = blocked(global_index(spark.range(103), ["id"]), halo=4, block=10).collect()
    for blk in range(1, 11):
        assert sorted(r.idx for r in rows if r["_blk"] == blk and r["_halo"]) == list(range(blk * 10 - 4, blk * 10))
    assert sorted(r.idx for r in rows if not r["_halo"]) == list(range(103))


def test_one_key_and_one_time_may_hold_most_rows(spark):
    """A third of the rows share one timestamp and half of them one key."""
    hot = spark.range(3000).select(
        F.col("id").alias("tie"), (F.col("id") % 50).alias("Payload_Size"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("Request_Type"),
        F.when(F.col("id") % 3 == 0, F.lit("2025-01-05 00:00:00")).otherwise(
            F.concat(F.lit("2025-01-0"), (F.col("id") % 9 + 1).cast("string"), F.lit(" 01:02:03"))).cast("timestamp_ntz").alias("Timestamp"))
    indexed = feat.load_and_preprocess(hot, "tie")
    got = feat.create_ordered_features(indexed, block=64)
    w, k = Window.orderBy("Timestamp", "tie"), Window.partitionBy("Request_Type").orderBy("Timestamp", "tie")
    want = hot.select(
        "tie", (F.row_number().over(w) - 1).alias("i"), F.avg("Payload_Size").over(w.rowsBetween(-9, 0)).alias("m"),
        F.coalesce(F.timestamp_diff("SECOND", F.lag("Timestamp").over(k), F.col("Timestamp")).cast("double"), F.lit(0.0)).alias("t"))
    both = got.join(want, "tie")
    assert both.count() == 3000
    assert both.filter((F.col("i") != F.col("idx")) | (F.abs(F.col("m") - F.col("payload_rolling_mean")) > 1e-9)
                       | (F.col("t") != F.col("time_since_last"))).count() == 0
