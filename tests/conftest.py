from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from washline.settings import RECOMMENDED  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.default.parallelism", "2")
        .config("spark.driver.memory", "4g")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(params=["true", "false"], ids=["ansi", "no-ansi"])
def any_ansi(request, spark):
    """Runs a test in both ANSI settings, as no result may depend on it."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture
def csv_file(tmp_path):
    """Writes text to a new file, byte for byte, and returns its path."""

    def write(text: str) -> str:
        path = tmp_path / f"{uuid.uuid4().hex}.csv"
        path.write_bytes(text.encode("utf-8"))
        return str(path)

    return write
