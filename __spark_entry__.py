"""

Every query reads the whole `events` table as sensor readings. The source, sink, stream and job queries first have Spark
write those readings to a fresh directory in the form under test (JSON, Parquet, lines to ingest), run the feature on
them, and return what it produced.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sensorloom import schema  # noqa: E402
from sensorloom.functions import event_time, with_day  # noqa: E402
from sensorloom.operators import kpis, profile, quality  # noqa: E402
from sensorloom.plans import (  # noqa: E402
    JobConfig,
    increments,
    run_all,
    run_event_geo,
    run_sensor_health,
    run_temp_humidity,
)
from sensorloom.sinks import (  # noqa: E402
    ConcurrentReplace,
    ensure_table,
    list_tables,
    replace_table,
    sample_table,
    write_parquet,
)
from sensorloom.sources import (  # noqa: E402
    compact_bronze,
    raw_path,
    read_bronze,
    read_json,
    read_json_array,
    readings_from_events,
    write_bronze,
)
from sensorloom.sources.bronze import errors_path  # noqa: E402
from sensorloom.streaming import (  # noqa: E402
    closed_event_counts,
    count_days,
    deliver_by_size_or_time,
    delivered_errors,
    ingest_bronze,
    ingest_errors,
    ingest_once,
    missed_event_counts,
    read_delivered,
)
from sensorloom.workspace import fresh_database, fresh_directory  # noqa: E402

try:
    from sensorloom.llm import entry as llm  # noqa: E402
except ImportError:
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

CUT = 0.318309886

SMOKE_DIR = "/root/testdata/sf0.001"


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def entry(spark: SparkSession) -> DataFrame:
    """Fault ratio per sensor."""
    return kpis.sensor_health(readings(spark, SMOKE_DIR))


# ---------------------------------------------------------------------------------------------------------------------
# Queries straight over the readings


def _over(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(readings(spark, sf_dir))


def _rounded(*columns: str) -> Callable[[DataFrame], DataFrame]:
    """Averages depend on the order of summation in their last digits, so they are compared to six places. Cut where no
    mean of short decimals lies: half-way values do occur, and the last digit would decide them."""
    return lambda df: df.withColumns({c: F.floor(F.col(c) * 1e6 + CUT) / 1e6 for c in columns})


def _temp_humidity(df: DataFrame, day: Column | None = None) -> DataFrame:
    return _rounded("avg_temp", "avg_humidity")(kpis.temp_humidity(df, day))


def _describe(df: DataFrame) -> DataFrame:
    return _rounded("mean", "stddev")(profile.describe_numeric(df))


def _days(df: DataFrame) -> DataFrame:
    back = F.unix_seconds(event_time("timestamp")).alias("event_second")
    return with_day(df).select("uuid", "day", back)


def _faulty(df: DataFrame) -> DataFrame:
    return _flat(kpis.faulty(df))


def _value_domains(df: DataFrame) -> DataFrame:
    rules = {"status_in_domain": F.col("status").isin(*schema.STATUSES)}
    rules |= {f"{c}_numeric": F.col(c).isNotNull() for c in ("temperature", "humidity")}
    return quality.validate(df, rules)


def _flat(df: DataFrame, *extra: Column) -> DataFrame:
    return df.select(
        "sensor_id",
        "temperature",
        "humidity",
        "location.latitude",
        "location.longitude",
        "status",
        "event_type",
        "timestamp",
        "uuid",
        *extra,
    )


# ---------------------------------------------------------------------------------------------------------------------
# Sources: written by Spark in the form under test, then read back


def _json_text(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias("value"))


# Readings per array: bounds that no chunk exceeds, whatever its keys, as chunks are runs of consecutive rows of a scan
# task. A pretty-printed array is a file of its own, and files should not outnumber what a file system takes.
READINGS_PER_LINE = 5_000
READINGS_PER_FILE = 200_000


def _line_arrays(df: DataFrame) -> DataFrame:
    chunk = F.floor(F.monotonically_increasing_id() / READINGS_PER_LINE).alias("chunk")
    arrays = df.groupBy(chunk).agg(F.collect_list(F.struct(*schema.READING.names)).alias("readings"))
    return arrays.select(F.to_json("readings").alias("value"))


def _file_arrays(df: DataFrame) -> DataFrame:
    """Rows that, written in order to one file per chunk, make a pretty-printed array; none is held in memory whole."""
    element = F.to_json(F.struct(*schema.READING.names), {"pretty": "true"}).alias("element")
    rows = df.select(element, F.monotonically_increasing_id().alias("position"))
    order = Window.partitionBy("chunk").orderBy("position")
    before = F.when(F.lag("position").over(order).isNull(), "[").otherwise(",")
    after = F.when(F.lead("position").over(order).isNull(), "]").otherwise("")
    chunked = rows.withColumn("chunk", F.floor(F.col("position") / READINGS_PER_FILE))
    return chunked.select("chunk", F.concat(before, "element", after).alias("value"))


def _json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_directory(spark)
    _json_text(readings(spark, sf_dir)).write.text(path)
    return _flat(read_json(spark, path))


def _json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_directory(spark)
    _line_arrays(readings(spark, sf_dir)).write.text(path)
    return _flat(read_json(spark, path))


def _json_pretty_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_directory(spark)
    _file_arrays(readings(spark, sf_dir)).write.partitionBy("chunk").text(path)
    return _flat(read_json(spark, path, multiline=True))


def _json_split_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, each read by several tasks."""
    path = fresh_directory(spark)
    _file_arrays(readings(spark, sf_dir)).write.partitionBy("chunk").text(path)
    return _flat(read_json_array(spark, path))


def _write_bronze(spark: SparkSession, sf_dir: str, partitioned: bool = False) -> str:
    bronze = fresh_directory(spark)
    rows = readings(spark, sf_dir)
    if partitioned:
        write_bronze(with_day(rows), bronze)
    else:
        # Nested directories that mean nothing, as a delivery service leaves them.
        delivered = rows.withColumn("delivered_as", F.col("event_type")).hint("rebalance", "delivered_as")
        delivered.write.partitionBy("delivered_as").parquet(raw_path(bronze))
    return bronze


def _bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(read_bronze(spark, _write_bronze(spark, sf_dir)))


def _bronze_partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _write_bronze(spark, sf_dir, partitioned=True)
    return _flat(read_bronze(spark, bronze, partitioned=True), F.col("day").cast("string").alias("day"))


def _bronze_compacted_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of many small files per day, compacted."""
    bronze, target = fresh_directory(spark), fresh_directory(spark)
    with_day(readings(spark, sf_dir)).repartition(16).write.partitionBy("day").parquet(raw_path(bronze))
    compact_bronze(spark, bronze, target)
    return _flat(read_bronze(spark, target, partitioned=True), F.col("day").cast("string").alias("day"))


def _partitioned_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _write_bronze(spark, sf_dir, partitioned=True)
    return kpis.event_counts(read_bronze(spark, bronze, partitioned=True), F.col("day"))


def _partitioned_temp_humidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _write_bronze(spark, sf_dir, partitioned=True)
    return _temp_humidity(read_bronze(spark, bronze, partitioned=True), F.col("day"))


# ---------------------------------------------------------------------------------------------------------------------
# Sinks


def _replace_table_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replaced twice, the second time with the columns in another order: same content, no doubled rows."""
    result = kpis.sensor_health(readings(spark, sf_dir))
    table = f"{fresh_database(spark)}.sensor_health"
    ensure_table(spark, table, schema.SENSOR_HEALTH)
    replace_table(result, table)
    replace_table(result.select(*reversed(result.columns)), table)
    return spark.table(table)


def _replace_table_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty result leaves the old content."""
    result = kpis.status_health(readings(spark, sf_dir))
    table = f"{fresh_database(spark)}.status_health"
    ensure_table(spark, table, schema.STATUS_HEALTH)
    replace_table(result, table)
    replace_table(result.where("status is null"), table)
    return spark.table(table)


def _replace_table_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs at once, each with other content and both whole: one is committed, and the other is told or follows."""
    table = f"{fresh_database(spark)}.status_health"
    ensure_table(spark, table, schema.STATUS_HEALTH)
    result = kpis.status_health(readings(spark, sf_dir))

    def run(wanted: str) -> bool:
        try:
            return replace_table(result, table, on_conflict=wanted)
        except ConcurrentReplace:
            return False

    with ThreadPoolExecutor(3) as pool:
        committed = list(pool.map(run, ["raise", "raise", "retry"]))
    # The one that retries is always among them.
    return spark.table(table).where(F.lit(committed[-1]))


def _parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice to one place."""
    root = fresh_directory(spark)
    result = kpis.event_counts(readings(spark, sf_dir))
    write_parquet(result, root, "event_counts")
    return spark.read.schema(schema.EVENT_COUNTS).parquet(write_parquet(result, root, "event_counts"))


def _list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables all jobs leave, each with its number of rows."""
    database = fresh_database(spark)
    run_all(spark, _write_bronze(spark, sf_dir), database)
    names = [row["tableName"] for row in list_tables(spark, database).collect()]
    counts = [spark.table(f"{database}.{n}").agg(F.lit(n).alias("table_name"), F.count("*").alias("n")) for n in names]
    union = counts[0]
    for part in counts[1:]:
        union = union.unionByName(part)
    return union


def _sample_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows a sample holds is open; counted are the table's rows that it holds."""
    table = f"{fresh_database(spark)}.sensor_health"
    ensure_table(spark, table, schema.SENSOR_HEALTH)
    replace_table(kpis.sensor_health(readings(spark, sf_dir)), table)
    # Five rows, so broadcast.
    sample, whole = F.broadcast(sample_table(spark, table)).alias("s"), spark.table(table).alias("t")
    same = F.lit(True)
    for column in schema.SENSOR_HEALTH.names:
        same &= F.col(f"s.{column}").eqNullSafe(F.col(f"t.{column}"))
    return whole.join(sample, same, "left_semi").agg(F.count("*").alias("sampled"))


# ---------------------------------------------------------------------------------------------------------------------
# Ingest


# What may follow a reading instead of its closing brace: nothing, and ways to close more than the reading.
BROKEN_ENDS = ("", "}]} garbage", "}]}", '}],"x":[{}', '}],"x":[2', '}],"r":[{"sensor_id":5}')


def _lines_to_ingest(spark: SparkSession, sf_dir: str) -> str:
    """The readings as JSON lines: those of faulty sensors with a text where a number belongs, those of inactive ones
    broken in one of six ways, by uuid, those of `view` events followed by a blank line."""
    source = fresh_directory(spark)
    line = F.to_json(F.struct("*"))
    short = F.to_json(F.struct("sensor_id", "status", "uuid"))
    mistyped = F.to_json(F.struct(F.lit("n/a").alias("temperature"), "status", "uuid"))
    broken = F.lit(None).cast("string")
    for i, end in enumerate(BROKEN_ENDS):
        chosen = F.pmod(F.col("uuid").cast("bigint"), F.lit(len(BROKEN_ENDS))) == i
        broken = F.when(chosen, F.concat(F.expr("substring(short, 1, length(short) - 1)"), F.lit(end))).otherwise(broken)
    value = (
        F.when(F.col("status") == "faulty", mistyped)
        .when(F.col("status") == "inactive", broken)
        .when(F.col("event_type") == "view", F.concat("line", F.lit("\n")))
        .otherwise(F.col("line"))
    )
    lines = readings(spark, sf_dir).withColumns({"line": line, "short": short})
    lines.select(value.alias("value")).write.text(source)
    return source


def _ingest_twice(start: Callable, spark: SparkSession, source: str) -> str:
    """The second run finds nothing new."""
    bronze, checkpoint = fresh_directory(spark), fresh_directory(spark)
    for _ in range(2):
        start(spark, source, bronze, checkpoint, {"availableNow": True}).awaitTermination()
    return bronze


def _bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _ingest_twice(ingest_bronze, spark, _lines_to_ingest(spark, sf_dir))
    return _flat(read_bronze(spark, bronze, partitioned=True), F.col("day").cast("string").alias("day"))


def _bronze_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _ingest_twice(ingest_errors, spark, _lines_to_ingest(spark, sf_dir))
    return spark.read.text(errors_path(bronze))


def _ingested_once(spark: SparkSession, source: str, **options) -> str:
    bronze, checkpoint = fresh_directory(spark), fresh_directory(spark)
    for _ in range(2):
        ingest_once(spark, source, bronze, checkpoint, {"availableNow": True}, **options).awaitTermination()
    return bronze


def _ingest_once_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = _ingested_once(spark, _lines_to_ingest(spark, sf_dir))
    return _flat(read_delivered(spark, bronze), F.col("day").cast("string").alias("day"))


def _ingest_once_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivered_errors(spark, _ingested_once(spark, _lines_to_ingest(spark, sf_dir)))


def _ingest_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading sent twice, those of inactive sensors without a uuid: they cannot be told and come twice."""
    source = fresh_directory(spark)
    rows = readings(spark, sf_dir).withColumn("uuid", F.when(F.col("status") != "inactive", F.col("uuid")))
    _json_text(rows.unionByName(rows)).write.text(source)
    return _flat(read_delivered(spark, _ingested_once(spark, source, resent_within="1 day")))


def _ingest_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bursts, each above the size that opens a batch; a day's time limit plays no part."""
    source, bronze, checkpoint = (fresh_directory(spark) for _ in range(3))
    rows = _json_text(readings(spark, sf_dir))
    rows.where(F.xxhash64("value") % 2 == 0).write.text(source)
    taken = []

    def start(trigger):
        if not taken:
            rows.where(F.xxhash64("value") % 2 != 0).write.mode("append").text(source)
        taken.append(trigger)
        return ingest_once(spark, source, bronze, checkpoint, trigger)

    until = lambda: len(taken) > 1
    deliver_by_size_or_time(spark, source, start, until, size=1, seconds=86_400, poll=0.05)
    return _flat(read_delivered(spark, bronze), F.col("day").cast("string").alias("day"))


def _counted_days(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Closed days, and all readings that were sent: first all but those of `error` events before the newest day, then one
    of this moment, which closes every day before, then the readings held back, all too late."""
    source, counts, checkpoint = (fresh_directory(spark) for _ in range(3))
    rows = with_day(readings(spark, sf_dir))
    newest = rows.agg(F.max("day")).first()[0]
    late = (F.col("event_type") == "error") & (F.col("day") < newest)
    now = rows.limit(1).withColumns({"event_type": F.lit("closing"), "timestamp": F.unix_timestamp()})
    for sent in (rows.where(~late), now, rows.where(late)):
        _json_text(sent.drop("day")).write.mode("append").text(source)
        count_days(spark, source, counts, checkpoint, {"availableNow": True}).awaitTermination()
    return closed_event_counts(spark, counts), rows


def _streamed_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted_days(spark, sf_dir)[0]


def _streamed_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missed_event_counts(*_counted_days(spark, sf_dir))


# ---------------------------------------------------------------------------------------------------------------------
# Jobs


def _incremental(figures: Callable[[SparkSession, str], DataFrame]) -> Query:
    """Bronze in two deliveries, counted one after the other."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bronze, state = fresh_directory(spark), fresh_directory(spark)
        rows = with_day(readings(spark, sf_dir)).withColumn("half", F.pmod(F.xxhash64("uuid"), F.lit(2)))
        for half in (0, 1):
            part = rows.where(F.col("half") == half).drop("half").hint("rebalance", "day")
            part.write.mode("append").partitionBy("day").parquet(raw_path(bronze))
            increments.update(spark, bronze, state)
        return figures(spark, state)

    return query


def _incremental_temp_humidity(spark: SparkSession, state: str) -> DataFrame:
    return _rounded("avg_temp", "avg_humidity")(increments.temp_humidity(spark, state))


def _job_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorecard that a job keeps while it scans."""
    config = JobConfig(_write_bronze(spark, sf_dir), fresh_database(spark), "sensor_health", min_valid_pct=0)
    scores = run_sensor_health(spark, config)
    return spark.createDataFrame(scores, "rule string, valid_count bigint, total bigint, pct double, passed boolean")


def _job(job: Callable[[SparkSession, JobConfig], None], table: str, result: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        database = fresh_database(spark)
        job(spark, JobConfig(_write_bronze(spark, sf_dir), database, table))
        return spark.table(f"{database}.{result}")

    return query


def _job_temp_humidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _job(run_temp_humidity, "temp_humidity_kpis", "temp_humidity_kpis")(spark, sf_dir)
    return _rounded("avg_temp", "avg_humidity")(stored)


def _job_faulty_geo_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults that bronze no longer has leave the table, too; counted, so that there is a row to compare."""
    database, bronze = fresh_database(spark), fresh_directory(spark)
    rows = readings(spark, sf_dir)
    for status in (F.col("status"), F.lit("active")):
        rows.withColumn("status", status).write.mode("overwrite").parquet(raw_path(bronze))
        run_event_geo(spark, JobConfig(bronze, database, "event_geo_kpis"))
    stale = spark.table(f"{database}.event_geo_kpis_faulty_geo").agg(F.count("*").alias("faulty_places"))
    events = spark.table(f"{database}.event_geo_kpis_events").agg(F.sum("event_count").alias("readings"))
    return stale.withColumn("readings", F.lit(events.first()["readings"]).cast("bigint"))


def _run_all_on_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines ingested, all jobs run on the bronze that gives, twice over; the daily figures returned."""
    source, database = fresh_directory(spark), fresh_database(spark)
    _json_text(readings(spark, sf_dir)).write.text(source)
    bronze = _ingest_twice(ingest_bronze, spark, source)
    for _ in range(2):
        run_all(spark, bronze, database, partitioned=True)
    return _rounded("avg_temp", "avg_humidity")(spark.table(f"{database}.temp_humidity_kpis"))


def queries() -> dict[str, Query]:
    return _own_queries() | (llm.queries() if llm else {})


def _own_queries() -> dict[str, Query]:
    return {
        "sensor_health": _over(kpis.sensor_health),
        "status_health": _over(kpis.status_health),
        "temp_humidity_kpis": _over(_temp_humidity),
        "event_counts": _over(kpis.event_counts),
        "faulty_geo": _over(kpis.faulty_geo),
        "reading_days": _over(_days),
        "faulty_readings": _over(_faulty),
        "status_distribution": _over(lambda df: profile.distribution(df, "status")),
        "event_type_distribution": _over(lambda df: profile.distribution(df, "event_type", "event_count")),
        "row_count": _over(profile.row_counts),
        "describe_numeric": _over(_describe),
        "validate": _over(quality.validate),
        "completeness": _over(quality.completeness),
        "value_domains": _over(_value_domains),
        "json_scan": _json_scan,
        "json_array_scan": _json_array_scan,
        "json_pretty_scan": _json_pretty_scan,
        "json_split_array_scan": _json_split_array_scan,
        "bronze_scan": _bronze_scan,
        "bronze_partitioned_scan": _bronze_partitioned_scan,
        "bronze_compacted_scan": _bronze_compacted_scan,
        "partitioned_event_counts": _partitioned_event_counts,
        "partitioned_temp_humidity": _partitioned_temp_humidity,
        "replace_table_rerun": _replace_table_rerun,
        "replace_table_empty": _replace_table_empty,
        "replace_table_conflict": _replace_table_conflict,
        "parquet_sink": _parquet_sink,
        "list_tables": _list_tables,
        "sample_table": _sample_table,
        "bronze_ingest": _bronze_ingest,
        "bronze_errors": _bronze_errors,
        "ingest_once_parsed": _ingest_once_parsed,
        "ingest_once_errors": _ingest_once_errors,
        "ingest_resent": _ingest_resent,
        "ingest_by_size": _ingest_by_size,
        "streamed_event_counts": _streamed_event_counts,
        "streamed_late_counts": _streamed_late_counts,
        "incremental_event_counts": _incremental(increments.event_counts),
        "incremental_temp_humidity": _incremental(_incremental_temp_humidity),
        "job_scorecard": _job_scorecard,
        "job_sensor_health": _job(run_sensor_health, "sensor_health", "sensor_health"),
        "job_status_health": _job(run_sensor_health, "sensor_health", "status_health"),
        "job_temp_humidity": _job_temp_humidity,
        "job_event_counts": _job(run_event_geo, "event_geo_kpis", "event_geo_kpis_events"),
        "job_faulty_geo": _job(run_event_geo, "event_geo_kpis", "event_geo_kpis_faulty_geo"),
        "job_faulty_geo_cleared": _job_faulty_geo_cleared,
        "run_all_on_ingested": _run_all_on_ingested,
    }


# ---------------------------------------------------------------------------------------------------------------------
# The same in SQL

_READINGS = """
WITH r AS (
  SELECT user_id AS sensor_id, value AS temperature,
         TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity,
         CAST(user_id % 15 AS DOUBLE) - 7.0 AS latitude, CAST(user_id % 12 AS DOUBLE) * 10.0 AS longitude,
         CASE event_type WHEN 'error' THEN 'faulty' WHEN 'signup' THEN 'inactive' ELSE 'active' END AS status,
         event_type, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp", CAST(event_id AS VARCHAR) AS uuid,
         strftime(ts, '%Y-%m-%d') AS "day"
  FROM events)
"""

_FLAT = 'sensor_id, temperature, humidity, latitude, longitude, status, event_type, "timestamp", uuid'

_SENSOR_HEALTH = """
SELECT sensor_id, count(*) FILTER (status = 'faulty') AS faulty_count, count(*) AS total_count,
       count(*) FILTER (status = 'faulty') / count(*) AS faulty_pct
FROM r GROUP BY sensor_id
"""

_STATUS_HEALTH = "SELECT status, count(sensor_id) AS sensor_count FROM r GROUP BY status"

_EVENT_COUNTS = 'SELECT "day", event_type, count(*) AS event_count FROM r GROUP BY "day", event_type'

_FAULTY_GEO = """
SELECT latitude, longitude, count(sensor_id) AS faulty_count FROM r WHERE status = 'faulty' GROUP BY latitude, longitude
"""



def _cut(figure: str) -> str:
    return f"floor({figure} * 1e6 + {CUT}) / 1e6"


_TEMP_HUMIDITY = f"""
SELECT "day", latitude, longitude,
       {_cut("avg(temperature)")} AS avg_temp, min(temperature) AS min_temp, max(temperature) AS max_temp,
       {_cut("avg(humidity)")} AS avg_humidity, min(humidity) AS min_humidity, max(humidity) AS max_humidity
FROM r GROUP BY "day", latitude, longitude
"""


def _scorecard(rules: dict[str, str]) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER ({condition}) AS valid_count, count(*) AS total FROM r"
        for rule, condition in rules.items()
    )
    pct = "CASE WHEN total > 0 THEN valid_count / total * 100 ELSE 0.0::DOUBLE END"
    return f"{_READINGS}, s AS ({rows}) SELECT rule, valid_count, total, {pct} AS pct, {pct} = 100 AS passed FROM s"


_IN_DOMAIN = "status IN ('active', 'faulty', 'inactive')"

_VALIDATE = {
    "sensor_id_positive": "sensor_id > 0",
    "temp_in_range": "temperature BETWEEN -50 AND 100",
    "humidity_in_range": "humidity BETWEEN 0 AND 100",
    "valid_status": _IN_DOMAIN,
    "timestamp_positive": '"timestamp" > 0',
}

_VALUE_DOMAINS = {
    "status_in_domain": _IN_DOMAIN,
    "temperature_numeric": "temperature IS NOT NULL",
    "humidity_numeric": "humidity IS NOT NULL",
}

_MISSING = {
    "sensor_id": "sensor_id IS NULL",
    "temperature": "temperature IS NULL",
    "humidity": "humidity IS NULL",
    "location": "false",
    "location.latitude": "latitude IS NULL",
    "location.longitude": "longitude IS NULL",
    "status": "status IS NULL",
    "event_type": "event_type IS NULL",
    "timestamp": '"timestamp" IS NULL',
}


def _completeness() -> str:
    return " UNION ALL ".join(
        f"SELECT '{field}' AS field, count(*) FILTER ({condition}) AS missing_count, count(*) AS total FROM r"
        for field, condition in _MISSING.items()
    )


def _summary() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n, {_cut(f"avg({c})")} AS mean, {_cut(f"stddev_samp({c})")} AS stddev,
            CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM r"""
        for c in profile.NUMERIC_COLUMNS
    )


def _errors() -> str:
    ends = " ".join(f"WHEN {i} THEN '{end}'" for i, end in enumerate(BROKEN_ENDS))
    uuid = """',"status":"' || status || '","uuid":"' || uuid || '"'"""
    return f"""
SELECT '{{"temperature":"n/a"' || {uuid} || '}}' AS value FROM r WHERE status = 'faulty'
UNION ALL
SELECT '{{"sensor_id":' || sensor_id || {uuid} || CASE CAST(uuid AS BIGINT) % {len(BROKEN_ENDS)} {ends} END AS value
FROM r WHERE status = 'inactive'
"""


def _resent() -> str:
    known = _FLAT.replace("uuid", "CASE WHEN status <> 'inactive' THEN uuid END AS uuid")
    return f"SELECT {known} FROM r UNION ALL SELECT {known} FROM r WHERE status = 'inactive'"


def _table_sizes() -> str:
    groups = {
        "sensor_health": _SENSOR_HEALTH,
        "status_health": _STATUS_HEALTH,
        "temp_humidity_kpis": _TEMP_HUMIDITY,
        "event_geo_kpis_events": _EVENT_COUNTS,
        "event_geo_kpis_faulty_geo": _FAULTY_GEO,
    }
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM ({q})" for n, q in groups.items())


def oracle_sql() -> dict[str, str]:
    flat = f"SELECT {_FLAT} FROM r"
    flat_with_day = f'SELECT {_FLAT}, "day" FROM r'
    over_readings = {
        "sensor_health": _SENSOR_HEALTH,
        "status_health": _STATUS_HEALTH,
        "temp_humidity_kpis": _TEMP_HUMIDITY,
        "event_counts": _EVENT_COUNTS,
        "faulty_geo": _FAULTY_GEO,
        "reading_days": 'SELECT uuid, "day", "timestamp" AS event_second FROM r',
        "faulty_readings": f"{flat} WHERE status = 'faulty'",
        "status_distribution": 'SELECT status, count(*) AS "count" FROM r GROUP BY status',
        "event_type_distribution": "SELECT event_type, count(*) AS event_count FROM r GROUP BY event_type",
        "row_count": "SELECT count(*) AS row_count FROM r",
        "describe_numeric": _summary(),
        "completeness": _completeness(),
        "json_scan": flat,
        "json_array_scan": flat,
        "json_pretty_scan": flat,
        "json_split_array_scan": flat,
        "bronze_scan": flat,
        "bronze_partitioned_scan": flat_with_day,
        "bronze_compacted_scan": flat_with_day,
        "partitioned_event_counts": _EVENT_COUNTS,
        "partitioned_temp_humidity": _TEMP_HUMIDITY,
        "replace_table_rerun": _SENSOR_HEALTH,
        "replace_table_empty": _STATUS_HEALTH,
        "replace_table_conflict": _STATUS_HEALTH,
        "parquet_sink": _EVENT_COUNTS,
        "list_tables": _table_sizes(),
        "sample_table": "SELECT least(5, count(DISTINCT sensor_id)) AS sampled FROM r",
        "bronze_ingest": f"{flat_with_day} WHERE status = 'active'",
        "bronze_errors": _errors(),
        "ingest_once_parsed": f"{flat_with_day} WHERE status = 'active'",
        "ingest_once_errors": _errors(),
        "ingest_resent": _resent(),
        "ingest_by_size": flat_with_day,
        "streamed_event_counts": f"""{_EVENT_COUNTS}
            HAVING event_type <> 'error' OR "day" = (SELECT max("day") FROM r)""",
        "streamed_late_counts": """SELECT "day", event_type, count(*) AS missed FROM r
            WHERE event_type = 'error' AND "day" < (SELECT max("day") FROM r) GROUP BY "day", event_type""",
        "incremental_event_counts": _EVENT_COUNTS,
        "incremental_temp_humidity": _TEMP_HUMIDITY,
        "job_sensor_health": _SENSOR_HEALTH,
        "job_status_health": _STATUS_HEALTH,
        "job_temp_humidity": _TEMP_HUMIDITY,
        "job_event_counts": _EVENT_COUNTS,
        "job_faulty_geo": _FAULTY_GEO,
        "job_faulty_geo_cleared": "SELECT 0::BIGINT AS faulty_places, count(*) AS readings FROM r",
        "run_all_on_ingested": _TEMP_HUMIDITY,
    }
    scorecards = {"validate": _scorecard(_VALIDATE), "job_scorecard": _scorecard(_VALIDATE), "value_domains": _scorecard(_VALUE_DOMAINS)}
    own = {name: f"{_READINGS}{sql}" for name, sql in over_readings.items()} | scorecards
    return own | (llm.oracle_sql() if llm else {})
