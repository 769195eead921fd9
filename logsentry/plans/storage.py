"""Queries that write tables in each format, read them back, or stream them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.operators import evaluate as ev
from logsentry.operators import validate
from logsentry.operators.encode import fit_encoders
from logsentry.plans.inputs import rounded, rule_predictions, table
from logsentry.plans.scoring import ORACLES as SCORING_SQL
from logsentry.plans.sql import LOGS, PRED, SCORED, r6, risk, with_
from logsentry.session import scratch_path
from logsentry.sources import files
from logsentry.sources.network_logs import from_events, network_logs
from logsentry.sources.requests import read_bodies
from logsentry.sources.schemas import CATEGORICAL_COLUMNS, RAW_LOG
from logsentry.streaming import scoring as streams


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    files.write_csv(network_logs(spark, sf_dir).select(*RAW_LOG.fieldNames()), path)
    return files.read_csv(spark, path)


def csv_scan_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As text columns except the named time column."""
    path = scratch_path(spark, "csv")
    logs = network_logs(spark, sf_dir).select("log_id", "Timestamp", "Status")
    files.write_csv(logs, path)
    schema = logs.withColumn("Timestamp", F.lit("")).schema
    return files.read_csv(spark, path, schema, dates=["Timestamp"])


def csv_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several parts in one folder, read as one table after a check of its columns."""
    path = scratch_path(spark, "parts")
    customers = table(spark, sf_dir, "customer")
    for part in range(3):
        files.write_csv(customers.filter(F.col("c_custkey") % 3 == part), path, mode="append")
    return files.read_csv_folder(spark, path, customers.schema, n_columns=5, required=["c_mktsegment"])


def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    metrics = ev.evaluate(rule_predictions(spark, sf_dir))
    files.write_json(metrics, path)
    back = files.read_json(spark, path, metrics.schema)
    cells = F.col("confusion_matrix")
    return rounded(back.select("accuracy", "f1_score", *[cells[y][p].alias(f"n_{y}{p}") for y in (0, 1) for p in (0, 1)]))


def json_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    pred = rule_predictions(spark, sf_dir)
    files.write_json(pred, path)
    return files.read_json(spark, path, pred.schema)


def versioned_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions are saved; loading gives the newer."""
    path = scratch_path(spark, "versions")
    logs = network_logs(spark, sf_dir).select("log_id", "Status")
    files.save_version(logs.withColumn("Status", F.lit("old")), path, "2025-01-01T00.00.00.000000Z")
    files.save_version(logs, path)
    return files.load_version(spark, path)


def encoders_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "saved-encoders")
    files.save_encoders(fit_encoders(network_logs(spark, sf_dir), CATEGORICAL_COLUMNS), path)
    return files.read_table(spark, path)


def partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "by-type")
    files.write_table(network_logs(spark, sf_dir).select("log_id", "Payload_Size", "Request_Type"), path, by=["Request_Type"])
    return files.read_table(spark, path).groupBy("Request_Type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("Payload_Size").alias("total"))


def memory_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    files.register(network_logs(spark, sf_dir).select("Protocol", "Intrusion"), "logsentry_memory_view")
    return spark.sql("SELECT Protocol, count(*) AS n, sum(Intrusion) AS intrusions FROM logsentry_memory_view GROUP BY Protocol")


def request_text_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request bodies written as text lines and scanned back."""
    path = scratch_path(spark, "bodies")
    record = F.to_json(F.struct(
        F.col("Timestamp").cast("string").alias("timestamp"), F.col("Source_IP").alias("source_ip"),
        F.col("Destination_IP").alias("destination_ip"), F.col("Source_Port").alias("source_port"),
        F.col("Port").alias("destination_port"), F.col("Protocol").alias("protocol"),
        F.col("Payload_Size").alias("payload_size"), F.col("User_Agent").alias("user_agent"), F.col("Status").alias("status")))
    network_logs(spark, sf_dir).select(F.concat(F.lit('{"data":['), record, F.lit("]}"))).write.text(path)
    scored = validate.score_batch(read_bodies(spark, path))
    return rounded(scored.groupBy("prediction.risk_level").agg(
        F.count(F.lit(1)).alias("n"), F.avg("prediction.confidence").alias("mean_score")))


# ---- streams


def _log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A stream source takes a folder or a pattern, not a single file name.
    path = f"{sf_dir}/events*.parquet"
    return from_events(streams.read_stream(spark, path, spark.read.parquet(path).schema))


def streaming_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = streams.score_stream(_log_stream(spark, sf_dir)).select("log_id", "y_prob", "is_intrusion", "risk_level")
    return streams.run_available(scored)


def streaming_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row arrives twice and is kept once."""
    key = ["Timestamp", "Source_IP", "Destination_IP"]
    twice = _log_stream(spark, sf_dir).union(_log_stream(spark, sf_dir))
    return streams.run_available(streams.reject_duplicates(twice, key).select("log_id", *key))


def streaming_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that the watermark has closed."""
    return rounded(streams.run_available(streams.alert_counts(_log_stream(spark, sf_dir))))


QUERIES = {f.__name__: f for f in (
    csv_scan, csv_scan_dates, csv_folder, json_scan, json_predictions, versioned_dataset, encoders_saved,
    partitioned_table, memory_view, request_text_scan, streaming_scores, streaming_duplicates, streaming_alerts,
)}

_CODED = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM logs" for c in CATEGORICAL_COLUMNS)

ORACLES = {
    "csv_scan": with_(LOGS, """
        SELECT "Timestamp", Source_IP, Destination_IP, Port, Request_Type, Protocol, Payload_Size, User_Agent, Status, Intrusion,
          CASE WHEN Intrusion = 0 THEN 'Normal' WHEN k % 2 = 0 THEN 'Port_Scan' ELSE 'Brute_Force' END AS Scan_Type
        FROM logs JOIN (SELECT event_id, k FROM events_k) ON event_id = log_id"""),
    "csv_scan_dates": with_(LOGS, 'SELECT log_id, "Timestamp", Status FROM logs'),
    "csv_folder": "SELECT * FROM customer",
    "json_scan": with_(PRED + """, c AS (SELECT y_true AS y, CASE WHEN y_prob > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS p FROM pred),
        m AS (SELECT count(*) FILTER (WHERE y = 0 AND p = 0) AS n_00, count(*) FILTER (WHERE y = 0 AND p = 1) AS n_01,
          count(*) FILTER (WHERE y = 1 AND p = 0) AS n_10, count(*) FILTER (WHERE y = 1 AND p = 1) AS n_11 FROM c)""", f"""
        SELECT {r6('CAST(n_00 + n_11 AS DOUBLE) / (n_00 + n_01 + n_10 + n_11)')} AS accuracy,
          {r6('''(CAST(2 * n_00 AS DOUBLE) / (2 * n_00 + n_01 + n_10) * (n_00 + n_01)
            + CAST(2 * n_11 AS DOUBLE) / (2 * n_11 + n_01 + n_10) * (n_10 + n_11)) / (n_00 + n_01 + n_10 + n_11)''')} AS f1_score,
          n_00, n_01, n_10, n_11 FROM m"""),
    "json_predictions": with_(PRED, "SELECT idx, y_true, y_prob FROM pred"),
    "versioned_dataset": with_(LOGS, "SELECT log_id, Status FROM logs"),
    "encoders_saved": with_(LOGS, f"""
        SELECT "column", value, CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS code
        FROM (SELECT DISTINCT "column", value FROM ({_CODED}))"""),
    "partitioned_table": with_(LOGS, """
        SELECT Request_Type, count(*) AS n, CAST(sum(Payload_Size) AS BIGINT) AS total FROM logs GROUP BY 1"""),
    "memory_view": with_(LOGS, "SELECT Protocol, count(*) AS n, CAST(sum(Intrusion) AS BIGINT) AS intrusions FROM logs GROUP BY 1"),
    "request_text_scan": with_(SCORED, f"""
        SELECT {risk('y_prob')} AS risk_level, count(*) AS n, {r6('avg(y_prob)')} AS mean_score FROM scored GROUP BY 1"""),
    "streaming_scores": SCORING_SQL["rule_score"],
    "streaming_duplicates": with_(LOGS, 'SELECT log_id, "Timestamp", Source_IP, Destination_IP FROM logs'),
    "streaming_alerts": with_(SCORED, f"""
        SELECT CAST(date_trunc('hour', "Timestamp") AS TIMESTAMP) AS window_start,
          CAST(date_trunc('hour', "Timestamp") + INTERVAL 1 HOUR AS TIMESTAMP) AS window_end, {risk('y_prob')} AS risk_level,
          count(*) AS n, {r6('avg(y_prob)')} AS mean_score FROM scored
        WHERE date_trunc('hour', "Timestamp") + INTERVAL 1 HOUR <= (SELECT max("Timestamp") FROM logs) - INTERVAL 10 MINUTE
        GROUP BY 1, 2, 3"""),
}
