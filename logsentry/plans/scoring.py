"""Queries of rule scoring, request validation, the keyed store and table checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsentry.functions.rules import (
    failed_transport, score_logs, suspicious_agent, suspicious_port,
)
from logsentry.operators import quality, store, validate
from logsentry.plans.inputs import rounded, table
from logsentry.plans.sql import LOGS, LOG_SCORE, SCORED, r6, risk, rule_score, with_
from logsentry.sources.network_logs import as_requests, network_logs
from logsentry.sources.schemas import REQUEST_FIELDS


# ---- rules


def rule_score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_logs(network_logs(spark, sf_dir)).select("log_id", "y_prob", "is_intrusion", "risk_level")


def rule_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = network_logs(spark, sf_dir)
    return logs.groupBy(
        suspicious_port(F.col("Port")).alias("suspicious_port"),
        failed_transport(F.col("Protocol"), F.col("Status")).alias("failed_transport"),
        suspicious_agent(F.col("User_Agent")).alias("suspicious_agent"),
    ).agg(F.count(F.lit(1)).alias("n"))


def risk_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_logs(network_logs(spark, sf_dir))
    return rounded(scored.groupBy("risk_level", "is_intrusion").agg(
        F.count(F.lit(1)).alias("n"), F.min("y_prob").alias("low"), F.max("y_prob").alias("high")))


def risk_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_logs(network_logs(spark, sf_dir))
    return rounded(scored.groupBy(F.hour("Timestamp").alias("hour"), "risk_level").agg(
        F.count(F.lit(1)).alias("n"), F.avg("y_prob").alias("mean_score")))


# ---- requests: every log row becomes a well-formed record and one with a planted fault


def _json_text(column: Column) -> Column:
    return F.concat(F.lit('"'), column.cast("string"), F.lit('"'))


def _record(fields: dict[str, Column]) -> Column:
    """JSON text of a record; a NULL piece leaves the field out."""
    pieces = [F.concat(F.lit(f'"{name}":'), text) for name, text in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *pieces), F.lit("}"))


def _faulty(requests: DataFrame) -> tuple[Column, Column]:
    """The record as it is, and with fault number ``log_id % 9``."""
    fault = F.col("log_id") % 9
    fields = {
        "timestamp": _json_text(F.col("timestamp")), "source_ip": _json_text(F.col("source_ip")),
        "destination_ip": _json_text(F.col("destination_ip")), "source_port": F.col("source_port").cast("string"),
        "destination_port": F.col("destination_port").cast("string"), "protocol": _json_text(F.col("protocol")),
        "payload_size": F.col("payload_size").cast("string"), "user_agent": _json_text(F.col("user_agent")),
        "status": _json_text(F.col("status")),
    }
    broken = dict(fields)
    broken["destination_port"] = (
        F.when(fault == 0, F.lit('"invalid_port"')).when(fault == 5, F.concat(fields["destination_port"], F.lit(".0")))
        .otherwise(fields["destination_port"]))
    broken["user_agent"] = F.when(fault == 1, F.lit(None)).when(fault == 4, F.lit("null")).otherwise(fields["user_agent"])
    broken["source_port"] = F.when(fault == 2, F.lit("70000")).otherwise(fields["source_port"])
    broken["payload_size"] = (
        F.when(fault == 3, F.lit("-100")).when(fault == 6, F.lit("true")).otherwise(fields["payload_size"]))
    broken["status"] = F.when(fault == 7, F.lit('"FAILED"')).otherwise(fields["status"])
    return _record(fields), _record(broken)


def bodies(spark: SparkSession, sf_dir: str, batch: bool) -> DataFrame:
    requests = as_requests(network_logs(spark, sf_dir))
    good, broken = _faulty(requests)
    if not batch:
        return requests.select("log_id", broken.alias("body"))
    whole = F.concat(F.lit('{"data":['), good, F.lit(","), broken, F.lit("]}"))
    body = (F.when(F.col("log_id") % 10 == 7, F.concat(F.lit('{"rows":['), good, F.lit("]}")))
            .when(F.col("log_id") % 10 == 8, F.concat(F.lit('{"data":'), good, F.lit("}"))).otherwise(whole))
    return requests.select("log_id", body.alias("body"))


def _flat(scored: DataFrame, *first: str) -> DataFrame:
    return scored.select(*first, "error", "prediction.is_intrusion", "prediction.confidence", "prediction.risk_level")


def request_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = validate.validate_records(bodies(spark, sf_dir, batch=False))
    return out.select("log_id", F.array_join("missing", ",").alias("missing"), "has_fields", "valid_types")


def predict_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(validate.predict_one(bodies(spark, sf_dir, batch=False)), "log_id", "status_code", "model_version")


def record_reshape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The input fields handed back with each single score, as typed columns."""
    out = validate.predict_one(bodies(spark, sf_dir, batch=False)).filter("status_code = 200")
    types = {"source_port": "int", "destination_port": "int"}
    return out.select("log_id", *[
        F.try_variant_get(F.col(f"input_data.{f}"), "$", types.get(f, "string")).alias(f) for f in REQUEST_FIELDS])


def batch_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(validate.score_batch(bodies(spark, sf_dir, batch=True)), "log_id", "index")


def batch_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.body_errors(bodies(spark, sf_dir, batch=True))


# ---- keyed store: orders as the records, (customer, day, priority) as the key


_KEY = ["custkey", "day", "priority"]


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), F.date_trunc("month", "o_orderdate").cast("date").alias("day"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderkey").alias("arrival"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store with unique keys: the cheapest order of each key over all orders with status F."""
    return _orders(spark, sf_dir).filter("status = 'F'").groupBy(*_KEY).agg(
        F.min("price").alias("price"), F.lit("stored").alias("status"))


def store_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.insert_if_absent(_stored(spark, sf_dir), _orders(spark, sf_dir), "arrival", _KEY)[0]


def store_insert_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.insert_if_absent(_stored(spark, sf_dir), _orders(spark, sf_dir), "arrival", _KEY)[1].select("arrival", *_KEY)


def _patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order patches its key: the price always, the status on even arrivals, a new note field on every third."""
    supplied = F.array_compact(F.array(
        F.lit("price"), F.when(F.col("arrival") % 2 == 0, "status"), F.when(F.col("arrival") % 3 == 0, "note")))
    return _orders(spark, sf_dir).withColumn("note", F.when(F.col("arrival") % 6 == 0, "sixth")).withColumn("supplied", supplied)


def store_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.update_by_key(_stored(spark, sf_dir), _patches(spark, sf_dir), "arrival", key=_KEY)[0]


def store_update_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.update_by_key(_stored(spark, sf_dir), _patches(spark, sf_dir), "arrival", key=_KEY)[1]


def _deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).filter("price < 150000")


def store_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.delete_by_key(_stored(spark, sf_dir), _deletions(spark, sf_dir), _KEY)[0]


def store_delete_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.delete_by_key(_stored(spark, sf_dir), _deletions(spark, sf_dir), _KEY)[1]


def store_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.list_store(_stored(spark, sf_dir))


def append_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = network_logs(spark, sf_dir).select("log_id", "Port", "Payload_Size")
    both = store.append_row(logs, logs.filter("log_id = 0"))
    return both.groupBy("log_id", "Port").agg(F.count(F.lit(1)).alias("n"), F.sum("Payload_Size").alias("total"))


# ---- table checks and repairs


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with missing agents and payloads."""
    return network_logs(spark, sf_dir).select(
        "log_id", F.nullif("User_Agent", F.lit("curl/8.0")).alias("User_Agent"),
        F.nullif("Payload_Size", F.lit(0)).alias("Payload_Size"), "Port", "Status")


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(_gappy(spark, sf_dir))


def mean_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.mean_impute(_gappy(spark, sf_dir), ["Payload_Size"]).select("log_id", "Payload_Size"))


def unknown_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fill_unknown(_gappy(spark, sf_dir), ["User_Agent", "Port"]).select("log_id", "User_Agent", "Port")


def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.standard_scale(network_logs(spark, sf_dir).select("log_id", "Payload_Size", "Port"), ["Payload_Size", "Port"])
    return rounded(out.select("log_id", "Payload_Size_scaled", "Port_scaled"))


def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.class_balance(network_logs(spark, sf_dir), "Intrusion"))


def drop_and_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    kept = quality.check_schema(events, 6, ["event_type"]).drop("user_id", "props")
    return kept.select("event_id", "event_type", F.col("event_id").cast("string").alias("event_text"),
                       F.floor("value").cast("int").alias("value_int"))


def threshold_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return network_logs(spark, sf_dir).filter(F.col("Payload_Size") > 1).select("log_id", "Payload_Size")


QUERIES = {"rule_score": rule_score_rows} | {f.__name__: f for f in (
    rule_predicates, risk_level, risk_by_hour, request_validation, predict_single, record_reshape, batch_scoring, batch_bodies,
    store_insert, store_insert_rejects, store_update, store_update_unmatched, store_delete, store_delete_unmatched,
    store_list, append_row, null_profile, mean_impute, unknown_fill, standard_scale, class_balance, drop_and_cast,
    threshold_filter,
)}

# What the faults do: 0 port text, 1 agent missing, 2 port too large, 3 negative payload, 4 agent null,
# 5 port with a fraction, 6 payload true (counts as 1), 7 status FAILED, 8 none.
_FAULTY = """faulty AS (
  SELECT log_id, Port, Protocol, User_Agent, log_id % 9 AS fault,
    CASE WHEN log_id % 9 = 6 THEN 1 ELSE Payload_Size END AS payload,
    CASE WHEN log_id % 9 = 7 THEN 'FAILED' ELSE Status END AS status FROM logs)"""
_FAULT_SCORE = rule_score("Port", "payload", "Protocol", "status", "User_Agent")


def _verdict(missing: str, invalid: str) -> str:
    return (f"CASE WHEN fault = 1 THEN '{missing}' WHEN fault IN (0, 2, 3, 5) THEN '{invalid}' "
            "WHEN fault = 4 THEN '''NoneType'' object has no attribute ''lower''' END")


def _prediction(score: str, error: str) -> str:
    return (f"CASE WHEN {error} IS NULL THEN {score} > CAST(0.5 AS DOUBLE) END AS is_intrusion, "
            f"CASE WHEN {error} IS NULL THEN {score} END AS confidence, "
            f"CASE WHEN {error} IS NULL THEN {risk(score)} END AS risk_level")


_ORDERS = """orders_k AS (
  SELECT o_custkey AS custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS day, o_orderpriority AS priority,
    o_orderkey AS arrival, o_orderstatus AS status, o_totalprice AS price FROM orders),
stored AS (SELECT custkey, day, priority, min(price) AS price, 'stored' AS status
  FROM orders_k WHERE status = 'F' GROUP BY 1, 2, 3)"""
_FIRST = _ORDERS + """, arrived AS (
  SELECT *, row_number() OVER (PARTITION BY custkey, day, priority ORDER BY arrival) AS turn,
    EXISTS (SELECT 1 FROM stored s WHERE s.custkey = o.custkey AND s.day = o.day AND s.priority = o.priority) AS known
  FROM orders_k o)"""
_GAPPY = LOGS + """, gappy AS (
  SELECT log_id, nullif(User_Agent, 'curl/8.0') AS User_Agent, nullif(Payload_Size, 0) AS Payload_Size, Port, Status FROM logs)"""


def _nulls(column: str) -> str:
    return f"SELECT '{column}' AS \"column\", count(*) - count({column}) AS n_null, count(*) > count({column}) AS has_null FROM gappy"


ORACLES = {
    "rule_score": with_(SCORED, f"""
        SELECT log_id, y_prob, y_prob > CAST(0.5 AS DOUBLE) AS is_intrusion, {risk('y_prob')} AS risk_level FROM scored"""),
    "rule_predicates": with_(LOGS, """
        SELECT Port IN (22, 23, 135, 139, 445, 1433, 3389, 5432) AS suspicious_port,
          lower(Protocol) IN ('tcp', 'udp') AND lower(Status) IN ('failed', 'error', 'timeout') AS failed_transport,
          contains(lower(User_Agent), 'bot') OR contains(lower(User_Agent), 'crawler')
            OR contains(lower(User_Agent), 'scanner') OR contains(lower(User_Agent), 'exploit') AS suspicious_agent,
          count(*) AS n FROM logs GROUP BY 1, 2, 3"""),
    "risk_level": with_(SCORED, f"""
        SELECT {risk('y_prob')} AS risk_level, y_prob > CAST(0.5 AS DOUBLE) AS is_intrusion, count(*) AS n,
          {r6('min(y_prob)')} AS low, {r6('max(y_prob)')} AS high FROM scored GROUP BY 1, 2"""),
    "risk_by_hour": with_(SCORED, f"""
        SELECT CAST(hour("Timestamp") AS INTEGER) AS hour, {risk('y_prob')} AS risk_level, count(*) AS n,
          {r6('avg(y_prob)')} AS mean_score FROM scored GROUP BY 1, 2"""),
    "request_validation": with_(LOGS + ", " + _FAULTY, """
        SELECT log_id, CASE WHEN fault = 1 THEN 'user_agent' ELSE '' END AS missing, fault <> 1 AS has_fields,
          fault NOT IN (0, 2, 3, 5) AS valid_types FROM faulty"""),
    "predict_single": with_(LOGS + ", " + _FAULTY + f""", judged AS (
        SELECT *, {_verdict('Missing required fields for prediction.', 'Invalid data types or values.')} AS error,
          {_FAULT_SCORE} AS score FROM faulty)""", f"""
        SELECT log_id, CASE WHEN error IS NULL THEN 200 WHEN fault = 4 THEN 500 ELSE 400 END AS status_code,
          CASE WHEN error IS NULL THEN 'heuristic_v1.0' END AS model_version, error, {_prediction('score', 'error')}
        FROM judged"""),
    "record_reshape": with_(LOGS + ", " + _FAULTY, """
        SELECT f.log_id, CAST("Timestamp" AS VARCHAR) AS "timestamp", Source_IP AS source_ip,
          Destination_IP AS destination_ip, Source_Port AS source_port, f.Port AS destination_port, f.Protocol AS protocol,
          CASE WHEN fault = 6 THEN 'true' ELSE CAST(payload AS VARCHAR) END AS payload_size, f.User_Agent AS user_agent,
          f.status AS status
        FROM faulty f JOIN logs l ON f.log_id = l.log_id WHERE fault IN (6, 7, 8)"""),
    "batch_scoring": with_(LOGS + ", " + _FAULTY + f""", judged AS (
        SELECT log_id, 0 AS index, CAST(NULL AS VARCHAR) AS error, {LOG_SCORE} AS score FROM logs
        UNION ALL SELECT log_id, 1, {_verdict('Missing required fields', 'Invalid data types')}, {_FAULT_SCORE} FROM faulty)""", f"""
        SELECT log_id, index, error, {_prediction('score', 'error')} FROM judged WHERE log_id % 10 NOT IN (7, 8)"""),
    "batch_bodies": with_(LOGS, """
        SELECT log_id, CASE log_id % 10 WHEN 7 THEN 'Missing ''data'' field containing list of network connections.'
            WHEN 8 THEN '''data'' field must be a list.' END AS error,
          CASE WHEN log_id % 10 NOT IN (7, 8) THEN 2 END AS total_processed, 'heuristic_v1.0' AS model_version FROM logs"""),
    "store_insert": with_(_FIRST, """
        SELECT custkey, day, priority, price, status FROM stored
        UNION ALL SELECT custkey, day, priority, price, status FROM arrived WHERE turn = 1 AND NOT known"""),
    "store_insert_rejects": with_(_FIRST, "SELECT arrival, custkey, day, priority FROM arrived WHERE turn > 1 OR known"),
    "store_update": with_(_ORDERS + f""", merged AS (
        SELECT custkey, day, priority, arg_max(price, arrival) AS new_price,
          arg_max(status, arrival) FILTER (WHERE arrival % 2 = 0) AS new_status,
          max(arrival) FILTER (WHERE arrival % 3 = 0) AS note_from
        FROM orders_k GROUP BY 1, 2, 3)""", """
        SELECT s.custkey, s.day, s.priority, coalesce(new_price, price) AS price, coalesce(new_status, status) AS status,
          CASE WHEN note_from % 6 = 0 THEN 'sixth' END AS note
        FROM stored s LEFT JOIN merged m ON s.custkey = m.custkey AND s.day = m.day AND s.priority = m.priority"""),
    "store_update_unmatched": with_(_ORDERS, """
        SELECT DISTINCT custkey, day, priority FROM orders_k o WHERE NOT EXISTS (
          SELECT 1 FROM stored s WHERE s.custkey = o.custkey AND s.day = o.day AND s.priority = o.priority)"""),
    "store_delete": with_(_ORDERS, """
        SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM orders_k o WHERE price < 150000
          AND s.custkey = o.custkey AND s.day = o.day AND s.priority = o.priority)"""),
    "store_delete_unmatched": with_(_ORDERS, """
        SELECT DISTINCT custkey, day, priority FROM orders_k o WHERE price < 150000 AND NOT EXISTS (
          SELECT 1 FROM stored s WHERE s.custkey = o.custkey AND s.day = o.day AND s.priority = o.priority)"""),
    "store_list": with_(_ORDERS, "SELECT * FROM stored"),
    "append_row": with_(LOGS, """
        SELECT log_id, Port, CASE WHEN log_id = 0 THEN CAST(2 AS BIGINT) ELSE 1 END AS n,
          CASE WHEN log_id = 0 THEN 2 * Payload_Size ELSE Payload_Size END AS total FROM logs"""),
    "null_profile": with_(_GAPPY, " UNION ALL ".join(_nulls(c) for c in ("log_id", "User_Agent", "Payload_Size", "Port", "Status"))),
    "mean_impute": with_(_GAPPY, f"""
        SELECT log_id, {r6('coalesce(CAST(Payload_Size AS DOUBLE), (SELECT avg(Payload_Size) FROM gappy))')} AS Payload_Size FROM gappy"""),
    "unknown_fill": with_(_GAPPY, """
        SELECT log_id, coalesce(User_Agent, 'unknown') AS User_Agent, CAST(Port AS VARCHAR) AS Port FROM gappy"""),
    "standard_scale": with_(LOGS, f"""
        SELECT log_id, {r6('(Payload_Size - (SELECT avg(Payload_Size) FROM logs)) / (SELECT stddev_pop(Payload_Size) FROM logs)')}
            AS Payload_Size_scaled,
          {r6('(Port - (SELECT avg(Port) FROM logs)) / (SELECT stddev_pop(Port) FROM logs)')} AS Port_scaled FROM logs"""),
    "class_balance": with_(LOGS, f"""
        SELECT count(*) AS n_classes, max(n) AS largest, min(n) AS smallest,
          {r6('CAST(max(n) AS DOUBLE) / min(n)')} AS imbalance_ratio
        FROM (SELECT Intrusion, count(*) AS n FROM logs GROUP BY 1)"""),
    "drop_and_cast": """
        SELECT event_id, event_type, CAST(event_id AS VARCHAR) AS event_text, CAST(floor(value) AS INTEGER) AS value_int FROM events""",
    "threshold_filter": with_(LOGS, "SELECT log_id, Payload_Size FROM logs WHERE Payload_Size > 1"),
}
