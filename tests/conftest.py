import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from sensorloom.schema import READING  # noqa: E402

TESTDATA = Path("/root/testdata")

# The three-reading sample; `uuid` is absent.
SAMPLE = [
    {
        "sensor_id": 42,
        "temperature": 25.4,
        "humidity": 62.1,
        "location": {"latitude": 22.5, "longitude": 88.3},
        "status": "active",
        "event_type": "sensor_reading",
        "timestamp": 1704267600,
    },
    {
        "sensor_id": 37,
        "temperature": 33.1,
        "humidity": 55.7,
        "location": {"latitude": -10.2, "longitude": 120.8},
        "status": "faulty",
        "event_type": "alert",
        "timestamp": 1704267660,
    },
    {
        "sensor_id": 42,
        "temperature": 26.0,
        "humidity": 60.0,
        "location": {"latitude": 22.5, "longitude": 88.3},
        "status": "faulty",
        "event_type": "alert",
        "timestamp": 1704267720,
    },
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[8]")
        .appName("sensorloom tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Readings from dicts; absent fields are NULL."""

    def build(rows: list[dict]) -> DataFrame:
        return spark.createDataFrame([{name: row.get(name) for name in READING.names} for row in rows], READING)

    return build


@pytest.fixture
def sample(make) -> DataFrame:
    return make(SAMPLE)


@pytest.fixture
def json_lines(tmp_path) -> str:
    path = tmp_path / "lines.json"
    path.write_text("".join(json.dumps(row) + "\n" for row in SAMPLE))
    return str(path)


def tuples(df: DataFrame) -> list[tuple]:
    """Rows in a fixed order that NULLs do not upset."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
