from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from authwatch.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "authwatch-tests", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "6g", "spark.sql.maxMetadataStringLength": "10000", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture()
def events(spark):
    """Enriched rows from short tuples: (time, ip, error_type, level)."""
    import datetime as dt

    from authwatch.schema import ENRICHED

    def build(rows):
        full = []
        for number, (time, ip, error_type, level) in enumerate(rows):
            when = dt.datetime.fromisoformat(time) if time else None
            full.append((when, "h", f"key{number}", when, "/data/ssh-20240101.log", "20240101",
                         f"message {number}", "ssh", level, error_type, "", ip, None, when))
        return spark.createDataFrame(full, ENRICHED)

    return build
