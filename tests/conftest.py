import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from logsentry.session import build_session  # noqa: E402
from logsentry.sources.schemas import RAW_LOG  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[*]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def three_logs(spark):
    def row(hour, port, kind, protocol, size, agent, status, intrusion):
        return (dt.datetime(2025, 1, 1, hour), "192.168.1.1", "10.0.0.1", port, kind, protocol, size, agent,
                status, intrusion, "Normal")

    rows = [
        row(10, 80, "GET", "HTTP", 1024, "Mozilla/5.0", "Success", 0),
        row(11, 443, "POST", "HTTPS", 2048, "Chrome/91.0", "Error", 1),
        row(12, 8080, "GET", "HTTP", 1536, "Safari/14.0", "Success", 0),
    ]
    return spark.createDataFrame(rows, RAW_LOG)
