"""SQL text shared by the check queries: the network log, scores and predictions."""

from __future__ import annotations

LOGS = """
events_k AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
logs AS (
  SELECT event_id AS log_id, ts AS "Timestamp",
    concat('192.168.1.', CAST(user_id % 10 AS VARCHAR)) AS Source_IP,
    concat('10.0.0.', CAST(event_id % 5 AS VARCHAR)) AS Destination_IP,
    CAST(1024 + event_id % 60000 AS INTEGER) AS Source_Port,
    CASE k % 7 WHEN 0 THEN 22 WHEN 1 THEN 80 WHEN 2 THEN 443 WHEN 3 THEN 445 WHEN 4 THEN 3306 WHEN 5 THEN 3389
      ELSE 8080 END AS Port,
    event_type AS Request_Type,
    CASE user_id % 4 WHEN 0 THEN 'HTTP' WHEN 1 THEN 'HTTPS' WHEN 2 THEN 'TCP' ELSE 'UDP' END AS Protocol,
    CASE WHEN k % 20 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(round(value * 100) AS BIGINT) END AS Payload_Size,
    CASE k % 5 WHEN 0 THEN 'Mozilla/5.0' WHEN 1 THEN 'Chrome/91.0' WHEN 2 THEN 'Safari/14.0' WHEN 3 THEN 'bot-scanner'
      ELSE 'curl/8.0' END AS User_Agent,
    CASE (user_id + k) % 4 WHEN 0 THEN 'Error' WHEN 1 THEN 'Timeout' ELSE 'Success' END AS Status,
    CASE WHEN (k % 7 IN (0, 3, 5) AND user_id % 4 >= 2) OR value > 150 OR event_id % 37 = 0 THEN 1 ELSE 0 END AS Intrusion
  FROM events_k)
"""


def rule_score(port: str, payload: str, protocol: str, status: str, agent: str) -> str:
    """The rule score as a DOUBLE expression, added in the fixed order."""
    d = lambda x: f"CAST({x} AS DOUBLE)"
    return (
        f"least(CASE WHEN {port} IN (22, 23, 135, 139, 445, 1433, 3389, 5432) THEN {d(0.3)} ELSE {d(0)} END"
        f" + CASE WHEN {payload} > 10000 THEN {d(0.2)} WHEN {payload} = 0 THEN {d(0.1)} ELSE {d(0)} END"
        f" + CASE WHEN lower({protocol}) IN ('tcp', 'udp') AND lower({status}) IN ('failed', 'error', 'timeout')"
        f" THEN {d(0.3)} ELSE {d(0)} END"
        f" + CASE WHEN regexp_matches(lower({agent}), 'bot|crawler|scanner|exploit') THEN {d(0.4)} ELSE {d(0)} END"
        f", {d(1)})"
    )


def risk(score: str) -> str:
    return (f"CASE WHEN {score} < CAST(0.3 AS DOUBLE) THEN 'low' WHEN {score} < CAST(0.7 AS DOUBLE) THEN 'medium' "
            "ELSE 'high' END")


LOG_SCORE = rule_score("Port", "Payload_Size", "Protocol", "Status", "User_Agent")

SCORED = LOGS + f", scored AS (SELECT *, {LOG_SCORE} AS y_prob FROM logs)"

INDEXED = LOGS + """, indexed AS (
  SELECT *, row_number() OVER (ORDER BY "Timestamp", log_id) - 1 AS idx FROM logs)"""

# Predictions: the fixed rules (few distinct scores) and a payload curve (nearly all distinct).
PRED = SCORED + ", pred AS (SELECT log_id AS idx, Intrusion AS y_true, y_prob FROM scored)"
PAYLOAD_PRED = LOGS + """, pred AS (
  SELECT log_id AS idx, Intrusion AS y_true,
    CAST(Payload_Size AS DOUBLE) / CAST(Payload_Size + 5000 AS DOUBLE) AS y_prob FROM logs)"""


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def r6(expression: str) -> str:
    return f"round({expression}, 6)"
