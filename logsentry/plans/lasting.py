"""Queries over tables that last: a keyed table, a log that grows, and streams into them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.functions.rules import MODEL_VERSION
from logsentry.operators.dictionary import CodeDictionary
from logsentry.operators.keyed_table import KeyedTable
from logsentry.operators.segments import SegmentedLog
from logsentry.operators.sketches import daily_sketches, sketched_summary
from logsentry.plans.inputs import payload_predictions, rounded, table
from logsentry.plans.ordered import LINE_ORDER
from logsentry.plans.ordered import ORACLES as ORDERED_SQL
from logsentry.plans.scoring import ORACLES as SCORING_SQL
from logsentry.plans.scoring import bodies
from logsentry.plans.sql import INDEXED, LOGS, r6, with_
from logsentry.session import pin, scratch_path
from logsentry.sources.checked import Gate, save_checked, saved_metrics
from logsentry.sources.network_logs import as_requests, network_logs
from logsentry.streaming import bodies as body_stream
from logsentry.streaming.arrivals import reject_known
from logsentry.streaming.ordered import heartbeat, time_since_rows, time_since_stream
from logsentry.streaming.scoring import read_stream

CONNECTION = ["Source_IP", "Destination_IP", "Port"]
CODED = ["Source_Port", "User_Agent"]


def store_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts, patches and deletes in sequence against one stored table."""
    requests = as_requests(network_logs(spark, sf_dir))
    store = KeyedTable(spark, scratch_path(spark, "store"), requests.schema, splits=16)
    store.insert(requests.filter("log_id % 4 < 3"), "log_id", "first", 0)
    store.insert(requests.withColumn("status", F.lit("again")), "log_id", "second", 0)
    patches = requests.filter("log_id % 5 = 0").select(
        *store.key, F.col("log_id").alias("seq"), F.lit("patched").alias("status"), F.lit(None).cast("long").alias("payload_size"),
        F.when(F.col("log_id") % 10 == 0, F.array(F.lit("status"), F.lit("payload_size"))).otherwise(F.array(F.lit("status"))).alias("supplied"))
    store.update(patches, "seq")
    store.delete(requests.filter("log_id % 7 = 0"))
    return store.read().select("log_id", "timestamp", "source_ip", "payload_size", "status")


def first_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row ever of each connection, from a stream of files; it is stopped once and goes on."""
    path, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "arrivals-state")
    logs = network_logs(spark, sf_dir).select("log_id", "Timestamp", *CONNECTION)
    taken = KeyedTable(spark, scratch_path(spark, "connections"), logs.schema, CONNECTION, splits=16)
    low, high = logs.agg(F.min("log_id"), F.max("log_id")).first()
    for part in range(4):
        file = F.floor((F.col("log_id") - F.lit(low)) * 4 / F.lit(max(high - low, 0) + 1))
        logs.filter(file == part).coalesce(1).write.mode("append").parquet(path)
        if part % 2:
            reject_known(read_stream(spark, path, logs.schema, 1), taken, "logs", checkpoint, "log_id")
    return taken.read()


def time_since_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a stream of files whose rows are out of order by days, stopped once; then a row that moves the watermark past the end."""
    path, out, checkpoint = (scratch_path(spark, f"since-{x}") for x in ("in", "out", "state"))
    logs = network_logs(spark, sf_dir).select("log_id", "Timestamp", "Request_Type")
    day = F.unix_micros(F.col("Timestamp").cast("timestamp")) / F.lit(86_400_000_000)
    first = logs.agg(F.min(day)).first()[0]
    # Up to three days late; a file holds what arrives within eight days.
    arrives = logs.withColumn("file", F.least(F.floor((day - F.lit(first) + F.pmod(F.hash("log_id"), F.lit(3))) / 8), F.lit(3)))
    late = 0
    for part in range(4):
        arrives.filter(F.col("file") == part).drop("file").coalesce(1).write.mode("append").parquet(path)
        if part == 3:
            heartbeat(logs, "Timestamp", "2100-01-01 00:00:00").write.mode("append").parquet(path)
        if part % 2:
            stream = read_stream(spark, path, logs.schema, 1)
            late += time_since_stream(stream, "Request_Type", "Timestamp", "log_id", out, checkpoint, "4 days", 86_400)
    if late:
        raise ValueError(f"{late} rows came too late")
    return rounded(time_since_rows(spark, out).select(F.col("tie").alias("log_id"), "time_since_last"))


def index_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of all lines from three increments: the older ones, the newer ones, and some of these that come late."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ORDER)
    newer, late = F.col("l_shipdate") >= "1995-06-01", F.col("l_shipdate").between("1996-01-01", "1996-06-30") & (F.col("l_orderkey") % 20 == 0)
    log = SegmentedLog(spark, scratch_path(spark, "segments"), LINE_ORDER, 1 << 14)
    for part in (~newer, newer & ~late, late):
        log.add(lines.filter(part))
    return log.read().select("l_shipdate", "l_orderkey", "l_linenumber", "idx")


def ordered_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling and lag features of a log that came in three increments, the last of rows that are late."""
    logs = network_logs(spark, sf_dir).select("log_id", "Timestamp", "Payload_Size")
    newer, late = F.col("Timestamp") >= "2024-01-16", F.col("Timestamp").between("2024-01-09", "2024-01-11") & (F.col("log_id") % 3 == 0)
    log = SegmentedLog(spark, scratch_path(spark, "segments"), ["Timestamp", "log_id"], 1 << 12, "Payload_Size")
    for part in (~newer & ~late, newer & ~late, late):
        log.add(logs.filter(part))
    return rounded(log.read().select(
        "idx", "log_id", "payload_rolling_mean", "payload_rolling_std", "payload_lag_1", "payload_lag_5"))


def codes_of_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of a log that came in three increments: what an increment brings gets the next codes, the others stay."""
    logs = network_logs(spark, sf_dir).select("log_id", *CODED)
    codes = CodeDictionary(spark, scratch_path(spark, "codes"))
    for part in range(3):
        codes.add(logs.filter(F.col("log_id") % 3 == part), CODED)
    return codes.apply(logs, CODED).select("log_id", *[f"{c}_encoded" for c in CODED])


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """The batch bodies as a stream of files, stopped once; returns the folder of what became of them."""
    path, out, checkpoint = (scratch_path(spark, f"bodies-{x}") for x in ("in", "out", "state"))
    given = bodies(spark, sf_dir, batch=True)
    for part in range(3):
        given.filter(F.col("log_id") % 3 == part).write.mode("append").parquet(path)
        if part:
            body_stream.score_bodies(read_stream(spark, path, given.schema), out, checkpoint)
    return out


def streamed_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each body: refused as a whole, or how many items it had."""
    return body_stream.totals(spark, _streamed(spark, sf_dir)).withColumn("model_version", F.lit(MODEL_VERSION))


def streamed_body_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of all bodies, from both sinks."""
    out = _streamed(spark, sf_dir)
    items = body_stream.scores(spark, out).withColumn("error", F.lit(None).cast("string")).unionByName(
        body_stream.errors(spark, out), allowMissingColumns=True)
    return items.select("log_id", "index", "error", "prediction.is_intrusion", "prediction.confidence", "prediction.risk_level")


def checked_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics that were collected while the log was written behind a gate."""
    path = scratch_path(spark, "checked")
    logs = network_logs(spark, sf_dir).select("log_id", "User_Agent", "Payload_Size", "Intrusion")
    gate = Gate(columns=4, required=["Intrusion"], most_nulls={"User_Agent": 0.5}, label="Intrusion", least_balance=0.05)
    save_checked(logs, path, gate, ["Payload_Size"])
    told = {k: float(v) for k, v in saved_metrics(spark, path).items() if k != "version"}
    return rounded(spark.createDataFrame(list(told.items()), "name string, value double"))


def sketched_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medians and AUC with bounds, from one sketch per day and class."""
    pred = payload_predictions(spark, sf_dir)
    days = network_logs(spark, sf_dir).select(F.col("log_id").alias("idx"), F.to_date("Timestamp").alias("day"))
    return sketched_summary(pin(daily_sketches(pred.join(days, "idx"), "day"), "sketches"))


QUERIES = {f.__name__: f for f in (
    store_sequence, first_arrivals, time_since_streamed, index_increments, ordered_increments, codes_of_increments, streamed_bodies,
    streamed_body_scores, checked_write, sketched_curves,
)}

_OVER = "ORDER BY idx ROWS BETWEEN 9 PRECEDING AND CURRENT ROW"
_LAG = "coalesce(CAST(lag(Payload_Size, {n}) OVER (ORDER BY idx) AS DOUBLE), (SELECT avg(Payload_Size) FROM logs))"

ORACLES = {
    "store_sequence": with_(LOGS, """
        SELECT log_id, "Timestamp" AS "timestamp", Source_IP AS source_ip, CASE WHEN log_id % 10 = 0 THEN NULL ELSE Payload_Size END AS payload_size,
          CASE WHEN log_id % 5 = 0 THEN 'patched' WHEN log_id % 4 = 3 THEN 'again' ELSE Status END AS status
        FROM logs WHERE log_id % 7 <> 0"""),
    "first_arrivals": with_(LOGS, """
        SELECT log_id, "Timestamp", Source_IP, Destination_IP, Port FROM logs
        QUALIFY row_number() OVER (PARTITION BY Source_IP, Destination_IP, Port ORDER BY log_id) = 1"""),
    "time_since_streamed": f"SELECT log_id, time_since_last FROM ({ORDERED_SQL['time_since_last']})",
    "codes_of_increments": with_(LOGS, "SELECT log_id, " + ", ".join(f"""(
          SELECT CAST(code AS INTEGER) FROM (SELECT value, row_number() OVER (ORDER BY first, value) - 1 AS code FROM (
            SELECT CAST({c} AS VARCHAR) AS value, min(log_id % 3) AS first FROM logs GROUP BY 1)) WHERE value = CAST(l.{c} AS VARCHAR)
        ) AS {c}_encoded""" for c in CODED) + " FROM logs l"),
    "streamed_bodies": SCORING_SQL["batch_bodies"],
    "streamed_body_scores": SCORING_SQL["batch_scoring"],
    "checked_write": with_(LOGS, f"""
        SELECT 'rows' AS name, CAST(count(*) AS DOUBLE) AS value FROM logs
        UNION ALL SELECT 'mean_Payload_Size', {r6('avg(Payload_Size)')} FROM logs
        UNION ALL SELECT 'std_Payload_Size', {r6('stddev_pop(Payload_Size)')} FROM logs
        """ + "".join(f"UNION ALL SELECT 'nulls_{c}', CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) FROM logs "
                      for c in ("log_id", "User_Agent", "Payload_Size", "Intrusion"))
        + "".join(f"UNION ALL SELECT 'class_{c}', CAST(count(*) FILTER (Intrusion = {c}) AS DOUBLE) FROM logs " for c in (0, 1))),
    "index_increments": ORDERED_SQL["global_index_lines"],
    "ordered_increments": with_(INDEXED, f"""
        SELECT idx, log_id, {r6(f'avg(Payload_Size) OVER ({_OVER})')} AS payload_rolling_mean,
          {r6(f'coalesce(stddev_samp(Payload_Size) OVER ({_OVER}), CAST(0 AS DOUBLE))')} AS payload_rolling_std,
          {', '.join(f'{r6(_LAG.format(n=n))} AS payload_lag_{n}' for n in (1, 5))} FROM indexed"""),
}
