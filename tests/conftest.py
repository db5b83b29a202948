import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from pulsewright.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    """Frames from rows with times given as text."""

    def build(rows, columns: str):
        raw, casts = [], []
        for part in columns.split(","):
            name, kind = part.split()
            text = kind in ("timestamp_ntz", "date")
            raw.append(f"{name} {'string' if text else kind}")
            casts.append(f"cast({name} as {kind}) as {name}")
        return spark.createDataFrame(rows, ", ".join(raw)).selectExpr(*casts)

    return build


@pytest.fixture(scope="session")
def hr(make):
    return lambda rows: make(rows, "pim_id bigint,heart_rate_datetime_loc timestamp_ntz,bpm bigint")
