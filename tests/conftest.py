from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidegauge.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tidegauge-tests", **{
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir() -> str:
    return SF_DIR


RAW_DDL = ("user_id string, feature_name string, session_duration double, latency_ms double, crash_flag int, "
           "error_count int, feedback_score double, timestamp string")


@pytest.fixture
def events(spark):
    """Build raw events from partial rows; what a row leaves out gets a harmless value."""
    def build(*rows: dict, ddl: str = RAW_DDL):
        default = {"user_id": "u", "feature_name": "search", "session_duration": 100.0, "latency_ms": 200.0,
                   "crash_flag": 0, "error_count": 0, "feedback_score": 4.0, "timestamp": "2025-01-01 10:00:00"}
        names = [part.split()[0] for part in ddl.split(", ")]
        filled = [tuple({**default, **row}.get(n) for n in names) for row in rows]
        return spark.createDataFrame(filled, ddl)

    return build


@pytest.fixture
def sample_events(events):
    """A hundred hourly rows over four features."""
    names = ["search", "checkout", "login", "dashboard"]
    return events(*[
        {"user_id": f"u{i}", "feature_name": names[i % 4], "latency_ms": 80.0 + i * 5, "crash_flag": int(i % 20 == 0),
         "error_count": i % 10, "feedback_score": float(1 + i % 5), "session_duration": 10.0 + i,
         "timestamp": f"2025-01-{1 + i // 24:02d} {i % 24:02d}:00:00"}
        for i in range(100)
    ])
