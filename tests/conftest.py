from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from desklake.session import build_session  # noqa: E402
from desklake.sources.lake import Lake  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-")})
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def lake(spark):
    return Lake(spark, tempfile.mkdtemp(prefix="lake-"))
