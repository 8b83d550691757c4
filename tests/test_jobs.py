import json
import os
import subprocess
import sys
import uuid
from dataclasses import replace
from pathlib import Path

import pytest

import sensorloom.__main__ as cli
from sensorloom import schema
from sensorloom.functions import with_day
from sensorloom.operators import kpis, quality
from sensorloom.plans import EmptyBronze, JobConfig, jobs, run_all, run_event_geo, run_sensor_health, run_temp_humidity
from sensorloom.session import iceberg_conf
from sensorloom import workspace
from sensorloom.sinks import list_tables
from sensorloom.sources import raw_path
from tests.conftest import ROOT, SAMPLE, tuples

TABLES = {
    "sensor_health": (kpis.sensor_health, schema.SENSOR_HEALTH),
    "status_health": (kpis.status_health, schema.STATUS_HEALTH),
    "temp_humidity_kpis": (kpis.temp_humidity, schema.TEMP_HUMIDITY),
    "event_geo_kpis_events": (kpis.event_counts, schema.EVENT_COUNTS),
    "event_geo_kpis_faulty_geo": (kpis.faulty_geo, schema.FAULTY_GEO),
}


@pytest.fixture
def target(spark, tmp_path):
    database = f"db_{uuid.uuid4().hex[:8]}"
    yield database, str(tmp_path / "warehouse")
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


@pytest.fixture
def bronze(sample, tmp_path):
    sample.write.parquet(str(tmp_path / "bronze" / "raw" / "2024" / "01"))
    return str(tmp_path / "bronze")


@pytest.fixture
def bronze_by_day(sample, tmp_path):
    with_day(sample).write.partitionBy("day").parquet(str(tmp_path / "by_day" / "raw"))
    return str(tmp_path / "by_day")


def content(spark, database):
    return {row["tableName"]: tuples(spark.table(f"{database}.{row['tableName']}"))
            for row in list_tables(spark, database).collect()}


@pytest.mark.parametrize("partitioned", [False, True])
def test_run_all_gives_the_five_tables_and_again_the_same(
    spark, sample, bronze, bronze_by_day, target, partitioned
):
    database, warehouse = target
    wanted = {name: tuples(operator(sample)) for name, (operator, _) in TABLES.items()}
    for _ in range(2):
        run_all(spark, bronze_by_day if partitioned else bronze, database, warehouse, partitioned=partitioned)
        assert content(spark, database) == wanted
    for name, (_, columns) in TABLES.items():
        assert spark.table(f"{database}.{name}").dtypes == [(f.name, f.dataType.simpleString()) for f in columns]


@pytest.mark.parametrize(
    "job, table, tables",
    [
        (run_sensor_health, "health", {"health", "status_health"}),
        (run_temp_humidity, "climate", {"climate"}),
        (run_event_geo, "geo", {"geo_events", "geo_faulty_geo"}),
    ],
)
def test_each_job_names_its_tables_after_its_argument(spark, bronze, target, job, table, tables):
    database, warehouse = target
    job(spark, JobConfig(bronze, database, table, warehouse))
    assert content(spark, database).keys() == tables
    place = spark.catalog.getDatabase(database).locationUri
    assert place.endswith(f"warehouse/{database}.db")


def test_new_readings_replace_the_result(spark, make, bronze, target):
    database, warehouse = target
    config = JobConfig(bronze, database, "sensor_health", warehouse)
    run_sensor_health(spark, config)
    make([SAMPLE[1]]).write.parquet(f"{bronze}/raw/2024/02")
    run_sensor_health(spark, config)
    assert tuples(spark.table(f"{database}.sensor_health")) == [(37, 2, 2, 1.0), (42, 1, 2, 0.5)]


def test_empty_bronze_keeps_the_tables(spark, make, bronze, target, tmp_path):
    database, warehouse = target
    run_sensor_health(spark, JobConfig(bronze, database, "sensor_health", warehouse))
    before = content(spark, database)
    make([]).write.parquet(str(tmp_path / "none" / "raw"))
    none = JobConfig(str(tmp_path / "none"), database, "sensor_health", warehouse)
    with pytest.raises(EmptyBronze, match="no reading"):
        run_sensor_health(spark, none)
    assert content(spark, database) == before
    run_sensor_health(spark, replace(none, allow_empty=True))
    assert content(spark, database) == {"sensor_health": [], "status_health": []}


def test_a_result_without_rows_replaces_the_old_one(spark, make, target, tmp_path):
    """Bronze has readings, none of them faulty any more."""
    database, warehouse = target
    bronze = str(tmp_path / "b")
    for status in ("faulty", "active"):
        make([{**SAMPLE[0], "status": status}]).write.mode("overwrite").parquet(f"{bronze}/raw")
        run_event_geo(spark, JobConfig(bronze, database, "geo", warehouse))
    assert content(spark, database)["geo_faulty_geo"] == []
    assert len(content(spark, database)["geo_events"]) == 1


def test_health_counts_give_what_the_readings_give(make):
    rows = [{"sensor_id": s, "status": t} for s in (1, 2, None) for t in ("faulty", "active", None) for _ in range(3)]
    rows += [{"sensor_id": None, "status": "lost"}]
    readings = make(rows)
    counts = kpis.health_counts(readings)
    assert tuples(kpis.sensor_health_of(counts)) == tuples(kpis.sensor_health(readings))
    assert tuples(kpis.status_health_of(counts)) == tuples(kpis.status_health(readings))


def test_health_job_scans_bronze_once_and_leaves_nothing(spark, bronze, target, monkeypatch):
    database, warehouse = target
    places, scans = [], []
    monkeypatch.setattr(jobs, "fresh_directory", lambda s: places.append(workspace.fresh_directory(s)) or places[-1])
    real = jobs.health_counts
    monkeypatch.setattr(jobs, "health_counts", lambda df: scans.append(df) or real(df))
    run_sensor_health(spark, JobConfig(bronze, database, "sensor_health", warehouse))
    assert len(scans) == 1 and not Path(places[0].removeprefix("file:")).exists()


def test_failing_job_is_repeated_once_and_stops_the_rest(spark, bronze, target, monkeypatch):
    database, warehouse = target
    ran = []

    def job(name, failures=0):
        def run(spark, config):
            ran.append((name, config.table))
            if sum(n == name for n, _ in ran) <= failures:
                raise RuntimeError(name)

        return run

    monkeypatch.setattr(jobs, "STEPS", ((job("a"), "ta"), (job("b", 1), "tb"), (job("c"), "tc")))
    run_all(spark, bronze, database, warehouse)
    assert ran == [("a", "ta"), ("b", "tb"), ("b", "tb"), ("c", "tc")]

    ran.clear()
    monkeypatch.setattr(jobs, "STEPS", ((job("a"), "ta"), (job("b", 2), "tb"), (job("c"), "tc")))
    with pytest.raises(RuntimeError, match="b"):
        run_all(spark, bronze, database, warehouse)
    assert ran == [("a", "ta"), ("b", "tb"), ("b", "tb")]


def test_config_names_everything_missing(spark):
    with pytest.raises(ValueError, match="bronze, table$"):
        run_temp_humidity(spark, JobConfig("", "db", ""))
    with pytest.raises(ValueError, match="warehouse"):
        JobConfig("b", "db", "t", catalog="lake").validate()
    assert JobConfig("b", "db", "t").validate().table_format == "parquet"
    lake = JobConfig("b", "db", "t", "s3://w/", "lake").validate()
    assert (lake.full_database, lake.table_format) == ("lake.db", "iceberg")


def test_iceberg_settings():
    glue = iceberg_conf("lake", "s3://w/")
    assert glue["spark.sql.catalog.lake"] == "org.apache.iceberg.spark.SparkCatalog"
    assert glue["spark.sql.catalog.lake.catalog-impl"] == "org.apache.iceberg.aws.glue.GlueCatalog"
    assert glue["spark.sql.catalog.lake.warehouse"] == "s3://w/"
    assert iceberg_conf("local", "s3a://w", "hadoop")["spark.sql.catalog.local.type"] == "hadoop"
    with pytest.raises(ValueError):
        iceberg_conf("lake", None, "other")


def command(*args, cwd):
    # A process of its own: it builds, and stops, its own session.
    return subprocess.run(
        [sys.executable, "-m", "sensorloom", *args],
        cwd=cwd,
        env={**os.environ, "PYTHONPATH": str(ROOT)},
        capture_output=True,
        text=True,
        timeout=300,
    )


def test_command_line_from_lines_to_tables(spark, sample, tmp_path, monkeypatch):
    source, bronze, warehouse = tmp_path / "source", str(tmp_path / "bronze"), tmp_path / "warehouse"
    source.mkdir()
    (source / "a").write_text("".join(json.dumps(row) + "\n" for row in SAMPLE) + "{broken\n")
    session = spark.newSession()
    monkeypatch.setattr(cli, "build_session", lambda app, conf: session)
    monkeypatch.setattr(session, "stop", lambda: None)
    cli.main(["ingest", str(source), bronze, str(tmp_path / "checkpoint"), "--once"])
    assert spark.read.text(f"{bronze}/errors").collect() == [("{broken",)]

    local = ["--conf", "spark.master=local[2]", "--conf", "spark.ui.enabled=false"]
    done = command("all", bronze, "analytics", str(warehouse), "--partitioned", *local, cwd=tmp_path)
    assert done.returncode == 0, done.stderr
    for name, (operator, columns) in TABLES.items():
        versions = sorted(Path(warehouse / "analytics.db" / name).glob("v-*"))
        assert tuples(spark.read.schema(columns).parquet(str(versions[-1]))) == tuples(operator(sample))


def test_profile_writes_its_tables(spark, sample, bronze, tmp_path):
    paths = cli.profile_tables(spark, bronze, str(tmp_path / "profile"))
    assert len(paths) == 5
    assert tuples(spark.read.parquet(paths[3])) == tuples(quality.validate(sample))


def test_command_line_refuses_missing_arguments():
    with pytest.raises(SystemExit):
        cli.main(["sensor-health", "bronze", "db"])
    with pytest.raises(ValueError, match="no value for bronze"):
        cli.main(["sensor-health", "", "db", "t"])


@pytest.mark.parametrize("job, table", [(run_sensor_health, "t"), (run_temp_humidity, "t"), (run_event_geo, "t_events")])
def test_scorecard_from_the_jobs_own_scan(spark, make, tmp_path, job, table):
    """Equal to `validate`; too low a share publishes nothing and leaves what was there."""
    from sensorloom.operators.quality import validate
    from sensorloom.plans import RejectedReadings

    name = f"db_{uuid.uuid4().hex[:8]}"
    rows = [{**SAMPLE[0], "temperature": 20.0 if i % 10 else 500.0, "sensor_id": i} for i in range(50)]
    make(rows).write.parquet(raw_path(str(tmp_path / "bronze")))
    config = JobConfig(str(tmp_path / "bronze"), name, "t", str(tmp_path / "warehouse"), min_valid_pct=90)
    try:
        scores = job(spark, config)
        assert sorted(scores) == tuples(validate(make(rows)))
        before = tuples(spark.table(f"{name}.{table}"))
        make([{**SAMPLE[1], "temperature": 999.0}] * 20).write.mode("append").parquet(raw_path(config.bronze))
        with pytest.raises(RejectedReadings, match="temp_in_range"):
            job(spark, config)
        assert tuples(spark.table(f"{name}.{table}")) == before
        assert job(spark, replace(config, min_valid_pct=None)) is None
        assert tuples(spark.table(f"{name}.{table}")) != before
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
