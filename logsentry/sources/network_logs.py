"""A network log seen through an event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def from_events(events: DataFrame) -> DataFrame:
    """Project events (event_id, ts, user_id, event_type, value, props) to network-log columns.

    A map-only projection: unused columns are pruned from the scan.
    """
    return events.withColumn("k", F.expr("CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)")).selectExpr(
        "event_id AS log_id", "ts AS Timestamp",
        "concat('192.168.1.', user_id % 10) AS Source_IP", "concat('10.0.0.', event_id % 5) AS Destination_IP",
        "CAST(1024 + event_id % 60000 AS INT) AS Source_Port",
        "CASE k % 7 WHEN 0 THEN 22 WHEN 1 THEN 80 WHEN 2 THEN 443 WHEN 3 THEN 445 WHEN 4 THEN 3306 WHEN 5 THEN 3389 "
        "ELSE 8080 END AS Port",
        "event_type AS Request_Type",
        "CASE user_id % 4 WHEN 0 THEN 'HTTP' WHEN 1 THEN 'HTTPS' WHEN 2 THEN 'TCP' ELSE 'UDP' END AS Protocol",
        "CASE WHEN k % 20 = 0 THEN 0L ELSE CAST(round(value * 100) AS BIGINT) END AS Payload_Size",
        "CASE k % 5 WHEN 0 THEN 'Mozilla/5.0' WHEN 1 THEN 'Chrome/91.0' WHEN 2 THEN 'Safari/14.0' WHEN 3 THEN 'bot-scanner' "
        "ELSE 'curl/8.0' END AS User_Agent",
        "CASE (user_id + k) % 4 WHEN 0 THEN 'Error' WHEN 1 THEN 'Timeout' ELSE 'Success' END AS Status",
        "CASE WHEN (k % 7 IN (0, 3, 5) AND user_id % 4 >= 2) OR value > 150 OR event_id % 37 = 0 THEN 1 ELSE 0 END AS Intrusion",
        "k",
    ).withColumn("Scan_Type", F.expr(
        "CASE WHEN Intrusion = 0 THEN 'Normal' WHEN k % 2 = 0 THEN 'Port_Scan' ELSE 'Brute_Force' END"
    )).drop("k")


def network_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def as_requests(logs: DataFrame) -> DataFrame:
    """Network-log rows in the shape of scoring requests."""
    return logs.selectExpr(
        "log_id", "Timestamp AS timestamp", "Source_IP AS source_ip", "Destination_IP AS destination_ip",
        "Source_Port AS source_port", "Port AS destination_port", "Protocol AS protocol",
        "Payload_Size AS payload_size", "User_Agent AS user_agent", "Status AS status",
    )
