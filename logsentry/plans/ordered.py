"""Queries of calendar, ordered and encoded features, splits and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.functions.calendar import create_time_features
from logsentry.operators import features as feat
from logsentry.operators import splits
from logsentry.operators.encode import apply_encoders, decode, fit_encoders, unseen_values
from logsentry.operators.order import global_index
from logsentry.plans.inputs import indexed_logs, rounded, table
from logsentry.plans.sql import INDEXED, LOGS, r6, with_
from logsentry.sources.network_logs import network_logs
from logsentry.sources.schemas import CATEGORICAL_COLUMNS

CALENDAR = ["hour", "day_of_week", "day", "month", "minute", "is_weekend", "is_business_hours"]
LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return create_time_features(network_logs(spark, sf_dir)).select("log_id", *CALENDAR)


def time_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = create_time_features(network_logs(spark, sf_dir).select("Timestamp", "Intrusion"))
    return rounded(logs.groupBy("is_weekend", "is_business_hours").agg(
        F.count(F.lit(1)).alias("n"), F.avg("Intrusion").alias("intrusion_rate")))


def load_preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = network_logs(spark, sf_dir).withColumn("Timestamp", F.col("Timestamp").cast("string"))
    return feat.load_and_preprocess(raw, "log_id")


def global_index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ORDER)
    return global_index(lines, LINE_ORDER, rows=lines.count()).select("l_shipdate", "l_orderkey", "l_linenumber", "idx")


def rolling_mean_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = feat.create_rolling_features(indexed_logs(spark, sf_dir, ["Payload_Size"]))
    return rounded(out.select("idx", "log_id", "payload_rolling_mean", "payload_rolling_std"))


def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = feat.create_lag_features(indexed_logs(spark, sf_dir, ["Payload_Size"]), [1, 5])
    return rounded(out.select("idx", "log_id", "payload_lag_1", "payload_lag_5"))


def lag_features_fit_on_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = indexed_logs(spark, sf_dir, ["Payload_Size"])
    train, _ = splits.split_time_series(indexed)
    out = feat.create_lag_features(indexed, [1, 5], fit_on=train)
    return rounded(out.select("idx", "payload_lag_1", "payload_lag_5"))


def time_since_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = feat.create_time_since_features(indexed_logs(spark, sf_dir, ["Request_Type"]))
    return rounded(out.select("idx", "log_id", "time_since_last"))


def time_since_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log in two increments, the second knowing only each key's last time in the first."""
    first, second = splits.split_time_series(indexed_logs(spark, sf_dir, ["Request_Type"]))
    seen = feat.update_last_seen(first)
    out = feat.create_time_since_features(first).unionByName(feat.create_time_since_features(second, last_seen=seen))
    return rounded(out.select("idx", "log_id", "time_since_last"))


def ordered_features_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ORDER, "l_returnflag")
    out = feat.create_ordered_features(
        global_index(lines, LINE_ORDER, rows=lines.count()), since="l_returnflag", value="l_quantity", ts="l_shipdate")
    return rounded(out.select("idx", "l_orderkey", "payload_rolling_mean", "payload_rolling_std", "payload_lag_1",
                              "payload_lag_5", "time_since_last"))


def encoder_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_encoders(network_logs(spark, sf_dir), [*CATEGORICAL_COLUMNS, "Source_Port"])


def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = network_logs(spark, sf_dir)
    out = apply_encoders(logs, fit_encoders(logs, CATEGORICAL_COLUMNS), CATEGORICAL_COLUMNS)
    return out.select("log_id", *[f"{c}_encoded" for c in CATEGORICAL_COLUMNS])


def label_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = network_logs(spark, sf_dir)
    mapping = fit_encoders(logs, ["User_Agent"])
    coded = apply_encoders(logs, mapping, ["User_Agent"]).select("log_id", "User_Agent_encoded")
    return decode(coded, mapping, "User_Agent", "User_Agent_encoded", "User_Agent")


def encode_unseen_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["Source_Port", "Protocol"]
    marked = splits.mark_split(indexed_logs(spark, sf_dir, columns))
    return unseen_values(marked, fit_encoders(marked.filter("is_train"), columns), columns)


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = network_logs(spark, sf_dir).select("log_id", "Timestamp", *CATEGORICAL_COLUMNS, "Payload_Size", "Intrusion")
    enriched, _ = feat.build_features(logs)
    return rounded(feat.create_feature_matrix(enriched))


def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = splits.mark_split(indexed_logs(spark, sf_dir, ["Intrusion"]))
    return rounded(marked.groupBy("is_train").agg(
        F.count(F.lit(1)).alias("n"), F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"),
        F.max("Timestamp").alias("last_time"), F.avg("Intrusion").alias("intrusion_rate")))


def time_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    folds = splits.time_folds(indexed_logs(spark, sf_dir, ["Intrusion"]))
    return rounded(folds.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n"), F.min("idx").alias("first_idx"), F.max("idx").alias("last_idx"),
        F.avg("Intrusion").alias("intrusion_rate")))


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.random_split(network_logs(spark, sf_dir).select("log_id"), "log_id")


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.stratified_split(network_logs(spark, sf_dir).select("log_id", "Intrusion"), "Intrusion", "log_id")


QUERIES = {f.__name__: f for f in (
    time_features, time_flags, load_preprocess, global_index_lines, rolling_mean_std, lag_features,
    lag_features_fit_on_train, time_since_last, time_since_increments, ordered_features_lines, encoder_mapping, label_encode, label_decode,
    encode_unseen_check, feature_matrix, chrono_split, time_folds, random_split, stratified_split,
)}

_CALENDAR = """CAST(hour("Timestamp") AS INTEGER) AS hour, CAST(isodow("Timestamp") - 1 AS INTEGER) AS day_of_week,
  CAST(day("Timestamp") AS INTEGER) AS day, CAST(month("Timestamp") AS INTEGER) AS month,
  CAST(minute("Timestamp") AS INTEGER) AS minute,
  CASE WHEN isodow("Timestamp") >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour("Timestamp") BETWEEN 9 AND 17 THEN 1 ELSE 0 END AS is_business_hours"""


def _gap(ts: str, key: str, order: str) -> str:
    return (f"coalesce(date_diff('microsecond', lag({ts}) OVER (PARTITION BY {key} ORDER BY {order}), {ts})"
            " / CAST(1000000 AS DOUBLE), CAST(0 AS DOUBLE))")


_WINDOW = "ORDER BY {o} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW"


def _rolling(value: str, order: str) -> str:
    over = _WINDOW.format(o=order)
    return (f"{r6(f'avg({value}) OVER ({over})')} AS payload_rolling_mean, "
            f"{r6(f'coalesce(stddev_samp({value}) OVER ({over}), CAST(0 AS DOUBLE))')} AS payload_rolling_std")


def _lags(value: str, order: str, mean: str) -> str:
    return ", ".join(
        f"{r6(f'coalesce(CAST(lag({value}, {n}) OVER (ORDER BY {order}) AS DOUBLE), {mean})')} AS payload_lag_{n}" for n in (1, 5))


def _code(column: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY {column}) - 1 AS INTEGER) AS {column}_encoded"


_CODES = ", ".join(_code(c) for c in CATEGORICAL_COLUMNS)
_MEAN = "(SELECT avg(Payload_Size) FROM logs)"
_LINES = f"lines AS (SELECT *, row_number() OVER (ORDER BY {', '.join(LINE_ORDER)}) - 1 AS idx FROM lineitem)"
_TRAIN_ROWS = "(SELECT CAST(floor(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT) FROM logs)"
_FIT = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM logs" for c in [*CATEGORICAL_COLUMNS, "Source_Port"])

ORACLES = {
    "time_features": with_(LOGS, f"SELECT log_id, {_CALENDAR} FROM logs"),
    "time_flags": with_(LOGS, f"""
        SELECT is_weekend, is_business_hours, count(*) AS n, {r6('avg(Intrusion)')} AS intrusion_rate
        FROM (SELECT {_CALENDAR}, Intrusion FROM logs) GROUP BY 1, 2"""),
    "load_preprocess": with_(INDEXED, """
        SELECT *, CASE WHEN Intrusion = 0 THEN 'Normal'
          WHEN (SELECT k FROM events_k e WHERE e.event_id = log_id) % 2 = 0 THEN 'Port_Scan' ELSE 'Brute_Force' END AS Scan_Type
        FROM indexed"""),
    "global_index_lines": with_(_LINES, "SELECT l_shipdate, l_orderkey, l_linenumber, idx FROM lines"),
    "rolling_mean_std": with_(INDEXED, f"SELECT idx, log_id, {_rolling('Payload_Size', 'idx')} FROM indexed"),
    "lag_features": with_(INDEXED, f"SELECT idx, log_id, {_lags('Payload_Size', 'idx', _MEAN)} FROM indexed"),
    "lag_features_fit_on_train": with_(INDEXED, f"""
        SELECT idx, {_lags('Payload_Size', 'idx', f'(SELECT avg(Payload_Size) FROM indexed WHERE idx < {_TRAIN_ROWS})')}
        FROM indexed"""),
    "time_since_last": with_(INDEXED, f"""
        SELECT idx, log_id, {r6(_gap('"Timestamp"', 'Request_Type', 'idx'))} AS time_since_last FROM indexed"""),
    "time_since_increments": with_(INDEXED, f"""
        SELECT idx, log_id, {r6(_gap('"Timestamp"', 'Request_Type', 'idx'))} AS time_since_last FROM indexed"""),
    "ordered_features_lines": with_(_LINES, f"""
        SELECT idx, l_orderkey, {_rolling('l_quantity', 'idx')},
          {_lags('l_quantity', 'idx', '(SELECT avg(l_quantity) FROM lineitem)')},
          {r6(_gap('l_shipdate', 'l_returnflag', 'idx'))} AS time_since_last FROM lines"""),
    "encoder_mapping": with_(LOGS, f"""
        SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT "column", value FROM ({_FIT}))"""),
    "label_encode": with_(LOGS, f"SELECT log_id, {_CODES} FROM logs"),
    "label_decode": with_(LOGS, f"SELECT log_id, {_code('User_Agent')}, User_Agent FROM logs"),
    "encode_unseen_check": with_(INDEXED, f"""
        SELECT "column", value, count(*) AS n_rows FROM (
          SELECT 'Source_Port' AS "column", CAST(Source_Port AS VARCHAR) AS value, idx FROM indexed
          UNION ALL SELECT 'Protocol', Protocol, idx FROM indexed)
        GROUP BY 1, 2 HAVING min(idx) >= {_TRAIN_ROWS}"""),
    "feature_matrix": with_(INDEXED, f"""
        SELECT idx, Payload_Size, {_CALENDAR}, {_rolling('Payload_Size', 'idx')}, {_lags('Payload_Size', 'idx', _MEAN)},
          {r6(_gap('"Timestamp"', 'Request_Type', 'idx'))} AS time_since_last, {_CODES}, Intrusion FROM indexed"""),
    "chrono_split": with_(INDEXED, f"""
        SELECT idx < {_TRAIN_ROWS} AS is_train, count(*) AS n, min(idx) AS first_idx, max(idx) AS last_idx,
          max("Timestamp") AS last_time, {r6('avg(Intrusion)')} AS intrusion_rate FROM indexed GROUP BY 1"""),
    "time_folds": with_(INDEXED, f"""
        SELECT fold, CASE WHEN idx < n - (3 - fold) * size THEN 'train' ELSE 'test' END AS role, count(*) AS n,
          min(idx) AS first_idx, max(idx) AS last_idx, {r6('avg(Intrusion)')} AS intrusion_rate
        FROM indexed, (SELECT count(*) AS n, count(*) // 4 AS size FROM logs),
          (SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS fold)
        WHERE idx < n - (2 - fold) * size GROUP BY 1, 2"""),
    "random_split": """
        SELECT event_id AS log_id, row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR)), event_id)
          <= (SELECT ceil(count(*) * CAST(0.3 AS DOUBLE)) FROM events) AS is_test FROM events""",
    "stratified_split": with_(LOGS, """
        SELECT log_id, Intrusion, row_number() OVER (PARTITION BY Intrusion ORDER BY md5(CAST(log_id AS VARCHAR)), log_id)
          <= round(count(*) OVER (PARTITION BY Intrusion) * CAST(0.3 AS DOUBLE)) AS is_test FROM logs"""),
}
