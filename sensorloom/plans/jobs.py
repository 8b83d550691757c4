"""The three jobs, and all of them in order. Every run recomputes from the whole of bronze and replaces its tables."""

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorloom import schema
from sensorloom.operators.kpis import (
    event_counts,
    faulty_geo,
    health_counts,
    sensor_health_of,
    status_health_of,
    temp_humidity,
)
from sensorloom.operators.quality import observed, scorecard
from sensorloom.sinks import ensure_database, ensure_table, replace_table
from sensorloom.sources import read_bronze
from sensorloom.workspace import fresh_directory, remove

log = logging.getLogger(__name__)

STATUS_HEALTH_TABLE = "status_health"


@dataclass(frozen=True)
class JobConfig:
    """What a job reads and writes.

    With a `catalog`, tables are Iceberg tables of that catalog; without, Parquet tables of the built-in one, under
    `warehouse` when given. `partitioned` says that bronze has `day=` directories (our own ingest's layout). A bronze
    without any reading fails the job, as the path may be mistyped; with `allow_empty` it empties the tables.

    With `min_valid_pct`, the job keeps a scorecard (`operators.quality.default_rules`) of the readings that it scans anyway,
    and publishes nothing where a rule holds for a smaller share of them.
    """

    bronze: str
    database: str
    table: str
    warehouse: str | None = None
    catalog: str | None = None
    partitioned: bool = False
    allow_empty: bool = False
    min_valid_pct: float | None = None

    def validate(self) -> "JobConfig":
        missing = [name for name in ("bronze", "database", "table") if not getattr(self, name)]
        if self.catalog and not self.warehouse:
            missing.append("warehouse")
        if missing:
            raise ValueError(f"no value for {', '.join(missing)}")
        return self

    @property
    def full_database(self) -> str:
        return f"{self.catalog}.{self.database}" if self.catalog else self.database

    @property
    def table_format(self) -> str:
        return "iceberg" if self.catalog else "parquet"


class EmptyBronze(ValueError):
    """A bronze without readings, for a job that is not to empty its tables."""


class RejectedReadings(ValueError):
    """A bronze in which too few readings meet a rule."""


Scorecard = list[tuple[str, int, int, float, bool]]


def run_sensor_health(spark: SparkSession, config: JobConfig) -> Scorecard | None:
    """Replaces `<table>` (per sensor) and `status_health` (per status). Returns the scorecard, if one is asked for.

    Bronze is scanned once: readings are counted per sensor and status, the counts written to the shared folder, and both
    tables made from them.
    """
    readings, observation = _observed(_readings(spark, config), config)
    with _written(health_counts(readings)) as counts:
        scores = _accepted(config, observation)
        _publish(spark, config, config.table, schema.SENSOR_HEALTH, sensor_health_of(counts))
        _publish(spark, config, STATUS_HEALTH_TABLE, schema.STATUS_HEALTH, status_health_of(counts))
    return scores


def run_temp_humidity(spark: SparkSession, config: JobConfig) -> Scorecard | None:
    """Replaces `<table>`: temperature and humidity per day and location. Returns the scorecard, if one is asked for."""
    readings, observation = _observed(_readings(spark, config), config)
    result = temp_humidity(readings, _day(config))
    if observation is None:
        _publish(spark, config, config.table, schema.TEMP_HUMIDITY, result)
        return None
    with _written(result) as result:
        scores = _accepted(config, observation)
        _publish(spark, config, config.table, schema.TEMP_HUMIDITY, result)
    return scores


def run_event_geo(spark: SparkSession, config: JobConfig) -> Scorecard | None:
    """Replaces `<table>_events` and `<table>_faulty_geo`. Returns the scorecard, if one is asked for; the first scan keeps
    it.

    The two scans share no column, so reading bronze once for both would save nothing.
    """
    readings = _readings(spark, config)
    events, places = f"{config.table}_events", f"{config.table}_faulty_geo"
    kept, observation = _observed(readings, config)
    result, scores = event_counts(kept, _day(config)), None
    if observation is None:
        _publish(spark, config, events, schema.EVENT_COUNTS, result)
    else:
        with _written(result) as result:
            scores = _accepted(config, observation)
            _publish(spark, config, events, schema.EVENT_COUNTS, result)
    _publish(spark, config, places, schema.FAULTY_GEO, faulty_geo(readings))
    return scores


def _observed(readings: DataFrame, config: JobConfig) -> tuple[DataFrame, Observation | None]:
    return observed(readings) if config.min_valid_pct is not None else (readings, None)


@contextmanager
def _written(df: DataFrame) -> Iterator[DataFrame]:
    """The frame from a scratch directory in the shared folder."""
    place = fresh_directory(df.sparkSession)
    try:
        df.write.parquet(place)
        yield df.sparkSession.read.schema(df.schema).parquet(place)
    finally:
        remove(df.sparkSession, place)


def _accepted(config: JobConfig, observation: Observation | None) -> Scorecard | None:
    if observation is None:
        return None
    scores = scorecard(observation)
    bad = [f"{rule} {pct:.2f} %" for rule, _, total, pct, _ in scores if total and pct < config.min_valid_pct]
    if bad:
        raise RejectedReadings(f"{config.bronze}: {', '.join(bad)} valid, {config.min_valid_pct} % wanted")
    return scores


# The jobs in their order, and the table argument each is run with.
STEPS: tuple[tuple[Callable[[SparkSession, JobConfig], object], str], ...] = (
    (run_sensor_health, "sensor_health"),
    (run_temp_humidity, "temp_humidity_kpis"),
    (run_event_geo, "event_geo_kpis"),
)


def run_all(
    spark: SparkSession,
    bronze: str,
    database: str,
    warehouse: str | None = None,
    catalog: str | None = None,
    partitioned: bool = False,
    retries: int = 1,
    allow_empty: bool = False,
    min_valid_pct: float | None = None,
) -> None:
    """Runs the three jobs in order in one session. A job that still fails after `retries` stops the rest."""
    base = JobConfig(bronze, database, STEPS[0][1], warehouse, catalog, partitioned, allow_empty, min_valid_pct)
    for job, table in STEPS:
        _with_retries(lambda job=job, table=table: job(spark, replace(base, table=table)), job.__name__, retries)


def _with_retries(action: Callable[[], None], name: str, retries: int) -> None:
    for attempt in range(retries + 1):
        try:
            return action()
        except ValueError:
            raise  # a wrong setting stays wrong
        except Exception:
            if attempt == retries:
                raise
            log.warning("%s failed, running it again", name, exc_info=True)


def _readings(spark: SparkSession, config: JobConfig) -> DataFrame:
    config.validate()
    readings = read_bronze(spark, config.bronze, config.partitioned)
    if not config.allow_empty and readings.isEmpty():
        raise EmptyBronze(f"{config.bronze} holds no reading")
    return readings


def _day(config: JobConfig):
    return F.col("day") if config.partitioned else None


def _publish(spark: SparkSession, config: JobConfig, name: str, columns: StructType, result: DataFrame) -> None:
    table = f"{config.full_database}.{name}"
    ensure_database(spark, config.full_database, None if config.catalog else config.warehouse)
    ensure_table(spark, table, columns, config.table_format)
    # The input is known to be right: an empty result (no reading is faulty, say) is a result.
    replace_table(result, table, allow_empty=True)
    log.info("%s replaced", table)
