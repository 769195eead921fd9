"""Fixed-rule risk scoring as column expressions, the same in batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Thresholds, ports, protocols, statuses, agent words, weights, version.
INTRUSION_THRESHOLD = 0.5
LARGE_PAYLOAD_THRESHOLD = 10000
LOW_RISK_THRESHOLD = 0.3
MEDIUM_RISK_THRESHOLD = 0.7
SUSPICIOUS_PORTS = [22, 23, 135, 139, 445, 1433, 3389, 5432]
SUSPICIOUS_PROTOCOLS = ["tcp", "udp"]
FAILED_STATUSES = ["failed", "error", "timeout"]
SUSPICIOUS_AGENTS = ["bot", "crawler", "scanner", "exploit"]
PORT_WEIGHT = 0.3
LARGE_PAYLOAD_WEIGHT = 0.2
EMPTY_PAYLOAD_WEIGHT = 0.1
FAILED_TRANSPORT_WEIGHT = 0.3
AGENT_WEIGHT = 0.4
MODEL_VERSION = "heuristic_v1.0"


def _points(condition: Column, weight: float) -> Column:
    return F.when(condition, F.lit(weight)).otherwise(F.lit(0.0))


def suspicious_port(port: Column) -> Column:
    return port.isin(SUSPICIOUS_PORTS)


def failed_transport(protocol: Column, status: Column) -> Column:
    return F.lower(protocol).isin(SUSPICIOUS_PROTOCOLS) & F.lower(status).isin(FAILED_STATUSES)


def suspicious_agent(user_agent: Column) -> Column:
    return F.lower(user_agent).rlike("|".join(SUSPICIOUS_AGENTS))


def intrusion_score(port: Column, payload: Column, protocol: Column, status: Column, agent: Column) -> Column:
    """Sum of rule weights, at most 1.0. The addition order fixes the last bits of the double."""
    payload_points = (
        F.when(payload > LARGE_PAYLOAD_THRESHOLD, F.lit(LARGE_PAYLOAD_WEIGHT))
        .when(payload == 0, F.lit(EMPTY_PAYLOAD_WEIGHT))
        .otherwise(F.lit(0.0))
    )
    total = (
        _points(suspicious_port(port), PORT_WEIGHT)
        + payload_points
        + _points(failed_transport(protocol, status), FAILED_TRANSPORT_WEIGHT)
        + _points(suspicious_agent(agent), AGENT_WEIGHT)
    )
    return F.least(total, F.lit(1.0))


def is_intrusion(score: Column) -> Column:
    return score > F.lit(INTRUSION_THRESHOLD)


def risk_level(score: Column) -> Column:
    return (
        F.when(score < F.lit(LOW_RISK_THRESHOLD), "low")
        .when(score < F.lit(MEDIUM_RISK_THRESHOLD), "medium")
        .otherwise("high")
    )


def log_score() -> Column:
    """The rule score over network-log column names."""
    return intrusion_score(
        F.col("Port"), F.col("Payload_Size"), F.col("Protocol"), F.col("Status"), F.col("User_Agent")
    )


def request_score() -> Column:
    """The rule score over request column names."""
    return intrusion_score(
        F.col("destination_port"), F.col("payload_size"), F.col("protocol"), F.col("status"), F.col("user_agent")
    )


def score_logs(logs: DataFrame) -> DataFrame:
    """Add y_prob, is_intrusion and risk_level to network-log rows; map-only."""
    return (
        logs.withColumn("y_prob", log_score())
        .withColumn("is_intrusion", is_intrusion(F.col("y_prob")))
        .withColumn("risk_level", risk_level(F.col("y_prob")))
    )
