import datetime as dt
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from logsentry.functions.calendar import create_time_features
from logsentry.operators import features as feat
from logsentry.operators.encode import apply_encoders, decode, fit_encoders, unseen_values
from logsentry.operators.order import blocked, global_index, prefix_sum, range_parts
from logsentry.operators.splits import mark_split, random_split, split_time_series, stratified_split, time_folds
from logsentry.sources.network_logs import network_logs
from logsentry.sources.schemas import CATEGORICAL_COLUMNS, FEATURE_COLUMNS
from tests.conftest import SF


@pytest.fixture(scope="module")
def indexed(spark):
    return feat.load_and_preprocess(network_logs(spark, SF), "log_id")


def rows(df, *cols):
    return [tuple(r) for r in df.orderBy("idx").select(*cols).collect()]


def test_three_row_log(three_logs):
    df = feat.load_and_preprocess(three_logs.withColumn("Timestamp", F.col("Timestamp").cast("string")), "Port")
    assert df.schema["Timestamp"].dataType.simpleString() == "timestamp_ntz"
    out = feat.create_ordered_features(create_time_features(df), window=2, lags=[1], block=2)
    got = rows(out, "hour", "day_of_week", "is_weekend", "is_business_hours", "payload_rolling_mean",
               "payload_lag_1", "time_since_last")
    assert got == [
        (10, 2, 0, 1, 1024.0, 1536.0, 0.0),
        (11, 2, 0, 1, 1536.0, 1024.0, 0.0),
        (12, 2, 0, 1, 1792.0, 2048.0, 7200.0),
    ]
    assert rows(out, "payload_rolling_std")[0] == (0.0,)


def test_bad_time_raises(three_logs):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        feat.load_and_preprocess(three_logs.withColumn("Timestamp", F.lit("yesterday-ish")), "Port").collect()


def test_missing_column_and_empty(three_logs):
    df = feat.load_and_preprocess(three_logs, "Port")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        feat.create_feature_matrix(df, ["no_such_column"])
    with pytest.raises(ValueError):
        feat.require_rows(three_logs.limit(0))


def test_single_row(three_logs):
    out, _ = feat.build_features(three_logs.filter("Port = 80"), "Port")
    row = out.collect()[0]
    assert (row.payload_rolling_mean, row.payload_rolling_std, row.payload_lag_5, row.time_since_last) == (
        1024.0, 0.0, 1024.0, 0.0)


def test_index_is_gap_free_and_sorted(indexed):
    got = rows(indexed, "idx", "Timestamp", "log_id")
    assert [g[0] for g in got] == list(range(len(got)))
    assert got == sorted(got, key=lambda g: (g[1], g[2]))


def test_index_splits_one_hot_timestamp(spark):
    hot = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("2025-01-01")).otherwise(F.concat(F.lit("2025-02-"), (F.col("id") % 9 + 1).cast("string")))
        .cast("timestamp_ntz").alias("ts"), F.hash("id").alias("tie"), "id")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r[0] for r in range_parts(hot, ["ts", "tie", "id"]).groupBy("_part").count().select("count").collect()]
        assert len(sizes) >= 6 and max(sizes) < 6000 / 4
        got = global_index(hot, ["ts", "tie", "id"])
        want = Window.orderBy("ts", "tie", "id")
        assert got.withColumn("w", F.row_number().over(want) - 1).filter("w <> idx").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_rows_of_a_task_do_not_follow_the_table(spark):
    """One shuffle partition: index and windows still spread a table longer than a task's share, with the same values."""
    n = 1_200_000
    log = spark.range(n).select((n - 1 - F.col("id")).alias("id")).select(
        "id", F.timestamp_seconds(F.col("id") * 2).cast("timestamp_ntz").alias("Timestamp"), (F.col("id") % 3).cast("string").alias("Request_Type"),
        (F.col("id") % 7).alias("Payload_Size"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        df = feat.load_and_preprocess(log, "id")
        out = feat.create_ordered_features(df)
        ranges = [r[0] for r in df.groupBy(F.input_file_name()).count().select("count").collect()]
        tasks = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        right = (F.col("idx") == F.col("id")) & (F.col("time_since_last") == F.when(F.col("id") < 3, 0.0).otherwise(6.0))
        for lag in (1, 5):
            right &= F.col(f"payload_lag_{lag}").eqNullSafe((F.col("id") - lag) % 7) | (F.col("id") < lag)
        right &= (F.abs(F.col("payload_rolling_mean") - sum((F.col("id") - k) % 7 for k in range(10)) / 10) < 1e-9) | (F.col("id") < 9)
        assert out.filter(right).count() == n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for sizes in (ranges, tasks):
        assert sum(sizes) == n and max(sizes) < n * 3 // 4


@pytest.mark.parametrize("block", [9, 100, 1 << 16])
def test_blocks_do_not_change_results(indexed, block):
    got = feat.create_ordered_features(indexed, block=block)
    w, k = Window.orderBy("idx"), Window.partitionBy("Request_Type").orderBy("idx")
    mean = indexed.agg(F.avg("Payload_Size")).first()[0]
    want = indexed.select(
        "idx", F.avg("Payload_Size").over(w.rowsBetween(-9, 0)).alias("m"),
        F.coalesce(F.stddev("Payload_Size").over(w.rowsBetween(-9, 0)), F.lit(0.0)).alias("s"),
        F.coalesce(F.lag("Payload_Size", 1).over(w), F.lit(mean)).alias("l1"),
        F.coalesce(F.lag("Payload_Size", 5).over(w), F.lit(mean)).alias("l5"),
        F.coalesce(F.timestamp_diff("MICROSECOND", F.lag("Timestamp").over(k), F.col("Timestamp")) / 1e6, F.lit(0.0)).alias("t"))
    diff = got.join(want, "idx").select(*[F.max(F.abs(F.col(a) - F.col(b))) for a, b in [
        ("payload_rolling_mean", "m"), ("payload_rolling_std", "s"), ("payload_lag_1", "l1"),
        ("payload_lag_5", "l5"), ("time_since_last", "t")]], F.count("*")).first()
    assert diff[5] == indexed.count()
    assert max(diff[:5]) < 1e-9


def test_block_smaller_than_halo_raises(indexed):
    with pytest.raises(ValueError):
        blocked(indexed, halo=9, block=8)


def test_missing_key_and_payload(spark):
    data = [(dt.datetime(2025, 1, 1, h), h, k, p) for h, (k, p) in enumerate(
        [("a", 10), (None, None), ("a", 30), (None, 50)])]
    df = spark.createDataFrame(data, "Timestamp timestamp_ntz, tie int, Request_Type string, Payload_Size long")
    out = feat.create_ordered_features(feat.load_and_preprocess(df, "tie"), window=2, lags=[1])
    assert rows(out, "time_since_last") == [(0.0,), (0.0,), (7200.0,), (0.0,)]
    assert rows(out, "payload_lag_1") == [(30.0,), (10.0,), (30.0,), (30.0,)]
    assert rows(out, "payload_rolling_mean") == [(10.0,), (10.0,), (30.0,), (40.0,)]


def test_ordered_features_plan(indexed):
    """One exchange for all windows, and none of the rows in a single partition."""
    plan = feat.create_ordered_features(indexed)._jdf.queryExecution().executedPlan().toString()
    by_block = re.findall(r"Exchange hashpartitioning\(_blk#\w+, \d+\)", plan)
    by_other = re.findall(r"Exchange hashpartitioning\(_blk#\w+, [A-Z]\w+#", plan)
    assert len(by_block) == 1
    assert len(by_other) <= 1  # the carry grid, not the log
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", plan)
    assert all(w for w in windows)


def test_encoders(indexed):
    mapping = fit_encoders(indexed, CATEGORICAL_COLUMNS)
    by_col = {}
    for r in mapping.collect():
        by_col.setdefault(r.column, {})[r.value] = r.code
    for codes in by_col.values():
        assert list(codes.values()) and [codes[v] for v in sorted(codes)] == list(range(len(codes)))
    coded = apply_encoders(indexed, mapping, CATEGORICAL_COLUMNS)
    back = decode(coded, mapping, "Protocol", "Protocol_encoded", "again")
    assert back.filter("again <> Protocol").count() == 0
    partial = mapping.filter("not (column = 'Protocol' and value = 'TCP')")
    assert [r.value for r in unseen_values(indexed, partial, ["Protocol"]).collect()] == ["TCP"]
    with pytest.raises(Exception, match="unseen value in column Protocol: TCP"):
        apply_encoders(indexed, partial, ["Protocol"]).collect()


def test_feature_matrix(spark):
    out, _ = feat.build_features(network_logs(spark, SF))
    matrix = feat.create_feature_matrix(out)
    assert matrix.columns == ["idx", *FEATURE_COLUMNS, "Intrusion"]
    nulls = matrix.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in matrix.columns]).first()
    assert sum(nulls) == 0


def test_chronological_split(spark):
    df = global_index(spark.range(5), ["id"])
    train, test = split_time_series(df, 0.6)
    assert (train.count(), test.count()) == (3, 2)
    assert mark_split(global_index(spark.range(7), ["id"]), 0.8).filter("is_train").count() == 5


def test_time_folds_follow_the_index(spark):
    n, k = 23, 3
    got = time_folds(global_index(spark.range(n), ["id"]), k).groupBy("fold", "role").agg(
        F.min("idx"), F.max("idx"), F.count("*")).collect()
    size = n // (k + 1)
    for fold in range(k):
        start = n - (k - fold) * size
        assert (fold, "train", 0, start - 1, start) in [tuple(r) for r in got]
        assert (fold, "test", start, start + size - 1, size) in [tuple(r) for r in got]


def test_random_and_stratified_splits(indexed):
    n = indexed.count()
    first = random_split(indexed, "log_id")
    assert first.filter("is_test").count() == -(-n * 3 // 10)
    assert first.filter("is_test").join(random_split(indexed, "log_id").filter("is_test"), "log_id").count() == -(-n * 3 // 10)
    for r in stratified_split(indexed, "Intrusion", "log_id").groupBy("Intrusion").agg(
            F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r.t == int(r.n * 0.3 + 0.5)


def test_prefix_sum(spark):
    df = spark.range(1000).select(F.hash("id").alias("k"), (F.col("id") % 7).alias("v"))
    got = prefix_sum(df, ["k"], ["v"])
    want = F.sum("v").over(Window.orderBy("k"))
    assert got.withColumn("w", want).filter("w <> cum_v").count() == 0


def test_increments_give_the_same_gaps(indexed):
    whole = {r.log_id: r.time_since_last for r in feat.create_time_since_features(indexed).collect()}
    seen, got = None, {}
    for low, high in ((0, 3), (3, 400), (400, 10 ** 9)):
        part = global_index(indexed.filter((F.col("idx") >= low) & (F.col("idx") < high)).drop("idx"), ["Timestamp", "log_id"])
        got |= {r.log_id: r.time_since_last for r in feat.create_time_since_features(part, block=50, last_seen=seen).collect()}
        seen = feat.update_last_seen(part, seen)
    assert got == whole
