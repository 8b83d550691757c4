"""Every registered query against DuckDB on the same tables, compared whole."""

import duckdb
import pytest

import __spark_entry__ as driver
from tests.conftest import TESTDATA, tuples

SF_DIR = str(TESTDATA / "sf0.01")
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert driver._own_queries().keys() <= driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", driver._own_queries())
def test_query_equals_oracle(spark, duck, name):
    wanted = duck.sql(driver.oracle_sql()[name])
    df = driver.queries()[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(wanted.columns)
    types = dict(zip(wanted.columns, map(str, wanted.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    rows = tuples(df.select(*wanted.columns))
    assert rows and rows == sorted(wanted.fetchall(), key=repr)


@pytest.mark.parametrize("length", [1, 999])
@pytest.mark.parametrize("name", ["json_array_scan", "json_pretty_scan"])
def test_arrays_of_any_length_are_read_whole(spark, monkeypatch, name, length):
    monkeypatch.setattr(driver, "READINGS_PER_LINE", length)
    monkeypatch.setattr(driver, "READINGS_PER_FILE", max(length, 100))
    sf_dir = str(TESTDATA / "sf0.001")
    flat = driver.readings(spark, sf_dir).select("*", "location.latitude", "location.longitude").drop("location")
    df = driver.queries()[name](spark, sf_dir)
    assert tuples(df) == tuples(flat.select(df.columns))


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["sensor_id", "faulty_count", "total_count", "faulty_pct"]
    assert df.count() == 15
