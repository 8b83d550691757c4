import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sensorloom.functions import with_day
from sensorloom.operators import kpis
from sensorloom.schema import READING
from sensorloom.sources import read_bronze
from sensorloom.sources.bronze import errors_path
from sensorloom.streaming import ingest_bronze, ingest_errors
from sensorloom.streaming.ingest import BUFFER_BYTES, INGEST_CONF, errors_of, read_lines, readings_of
from tests.conftest import SAMPLE, plan, tuples

ONCE = {"availableNow": True}


def reading(sensor: int, second: int) -> dict:
    return {**SAMPLE[0], "sensor_id": sensor, "timestamp": second, "uuid": f"u{sensor}"}


LINES = [
    json.dumps(reading(1, 1704267600)),
    json.dumps(reading(2, 1704267601)),
    '{"sensor_id": "abc", "temperature": 1.0}',
    "{broken",
    "",
    json.dumps(reading(3, 1704353999)),
    '{"sensor_id": 4, "extra": 1}',
]


@pytest.fixture
def place(tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    return str(source), str(tmp_path / "bronze"), str(tmp_path / "checkpoint")


def put(source: str, name: str, lines: list[str]) -> None:
    # Written elsewhere first: a directory being watched must only ever show whole files.
    part = Path(source).parent / name
    part.write_text("".join(line + "\n" for line in lines))
    part.rename(Path(source) / name)


def run(spark, source, bronze, checkpoint):
    for start in (ingest_bronze, ingest_errors):
        start(spark, source, bronze, checkpoint, ONCE).awaitTermination()


def stored(spark, bronze):
    days = read_bronze(spark, bronze, partitioned=True)
    return tuples(days.select("sensor_id", F.col("day").cast("string"), "uuid"))


def rejected(spark, bronze):
    return tuples(spark.read.text(errors_path(bronze)))


def test_lines_are_routed_once(spark, place):
    source, bronze, checkpoint = place
    put(source, "a", LINES)
    wanted = sorted(
        [(1, "2024-01-03", "u1"), (2, "2024-01-03", "u2"), (3, "2024-01-04", "u3"), (4, None, None)], key=repr
    )
    bad = sorted([(LINES[2],), (LINES[3],)], key=repr)
    for _ in range(2):
        run(spark, source, bronze, checkpoint)
        assert stored(spark, bronze) == wanted
        assert rejected(spark, bronze) == bad
    put(source, "b", [json.dumps(reading(5, 0)), "nonsense"])
    run(spark, source, bronze, checkpoint)
    assert stored(spark, bronze) == sorted([*wanted, (5, "1970-01-01", "u5")], key=repr)
    assert rejected(spark, bronze) == sorted([*bad, ("nonsense",)], key=repr)


def test_bronze_is_snappy_parquet_by_day_and_reads_both_ways(spark, place):
    source, bronze, checkpoint = place
    put(source, "a", LINES)
    run(spark, source, bronze, checkpoint)
    files = list(Path(bronze).glob("raw/day=*/*.parquet"))
    assert files and all(".snappy." in file.name for file in files)
    whole = read_bronze(spark, bronze)
    assert whole.schema == READING
    assert tuples(whole) == tuples(read_bronze(spark, bronze, partitioned=True).drop("day"))
    assert tuples(whole.where("sensor_id = 1")) == tuples(
        spark.createDataFrame([reading(1, 1704267600)], READING)
    )


def test_a_late_file_older_than_the_rest_is_not_skipped(spark, place):
    import os

    source, bronze, checkpoint = place
    put(source, "new", [json.dumps(reading(1, 0))])
    run(spark, source, bronze, checkpoint)
    put(source, "old", [json.dumps(reading(2, 0))])
    long_ago = 1_600_000_000
    os.utime(Path(source) / "old", (long_ago, long_ago))
    run(spark, source, bronze, checkpoint)
    assert [row[0] for row in stored(spark, bronze)] == [1, 2]


def test_taken_files_can_be_archived(spark, place, tmp_path):
    source, bronze, checkpoint = place
    archive = tmp_path / "archive"
    for i in range(3):
        put(source, f"f{i}", [json.dumps(reading(i, 0))])
        lines = read_lines(spark, source, max_file_age="7d", archive=str(archive))
        ingest_bronze(spark, lines, bronze, checkpoint, ONCE).awaitTermination()
    assert [row[0] for row in stored(spark, bronze)] == [0, 1, 2]
    moved, left = {p.name for p in archive.rglob("f?")}, {p.name for p in Path(source).glob("f?")}
    assert moved and moved | left == {"f0", "f1", "f2"} and not moved & left


def test_a_batch_whose_commit_was_lost_is_not_doubled(spark, place):
    """One file per batch; the driver is gone after the last sink write and before the checkpoint's commit."""
    source, bronze, checkpoint = place
    for i in range(4):
        put(source, f"f{i}", [json.dumps(reading(i, 1704267600)), f"bad {i}"])

    def deliver():
        for start in (ingest_bronze, ingest_errors):
            lines = read_lines(spark, source, max_bytes_per_trigger=1)
            start(spark, lines, bronze, checkpoint, ONCE).awaitTermination()

    deliver()
    for route in ("raw", "errors"):
        commits = sorted(Path(checkpoint, route, "commits").glob("[0-9]*"), key=lambda path: int(path.name))
        assert len(commits) == 4
        commits[-1].unlink()
        commits[-1].with_name(f".{commits[-1].name}.crc").unlink()
    put(source, "f4", [json.dumps(reading(4, 1704267600)), "bad 4"])
    deliver()
    assert [row[0] for row in stored(spark, bronze)] == [0, 1, 2, 3, 4]
    assert rejected(spark, bronze) == [(f"bad {i}",) for i in range(5)]


def test_files_of_a_failed_batch_are_not_read(spark, place):
    source, bronze, checkpoint = place
    put(source, "a", LINES)
    run(spark, source, bronze, checkpoint)
    before = stored(spark, bronze)
    written = next(Path(bronze).glob("raw/day=2024-01-04/*.parquet"))
    (written.parent / "part-left-over.snappy.parquet").write_bytes(written.read_bytes())
    assert stored(spark, bronze) == before
    assert read_bronze(spark, bronze).count() == len(before)


def test_any_stream_of_values_is_a_source(spark, place):
    source, bronze, checkpoint = place
    put(source, "a", LINES)
    lines = read_lines(spark, source).withColumn("key", F.lit(1))
    ingest_bronze(spark, lines, bronze, checkpoint, ONCE).awaitTermination()
    assert len(stored(spark, bronze)) == 4


# Line to whether it holds one reading.
ROUTES = {
    "{}": True,
    ' {"sensor_id": 7} ': True,
    '{"temperature": 25}': True,
    '{"sensor_id": null}': True,
    '{"extra": {"a": [1, {}]}, "sensor_id": 1}': True,
    '{"status": "} {"}': True,
    "null": False,
    "[]": False,
    "123": False,
    '"text"': False,
    '[{"sensor_id": 1}]': False,
    '{"sensor_id": 1} trailing': False,
    '{"sensor_id": 1}}': False,
    '{"sensor_id": 1}{"sensor_id": 2}': False,
    '{"sensor_id": 1},{"sensor_id": 2}': False,
    '{"sensor_id": 1.5}': False,
    '{"sensor_id": 99999999999999999999}': False,
    '{"temperature": "25.4"}': False,
    '{"timestamp": "2024-01-03"}': False,
    '{"location": [1, 2]}': False,
    '{"location": {"latitude": "north"}}': False,
    '{"sensor_id": 1, "temperature": "x", "status": "late"}': False,
    '{"sensor_id":2}]} garbage': False,
    '{"sensor_id":3}]}': False,
    '{"sensor_id":1}],"x":[{}': False,
    '{"sensor_id":7}],"x":[2': False,
    '{"sensor_id":4}],"r":[{"sensor_id":5}': False,
    '{"sensor_id":4}],"r":[{"__end":1},{"sensor_id":5}': False,
    '{"sensor_id": 1, "__end": 7}': False,
    '{"sensor_id": 1},{"__end": 7}': False,
    '{"sensor_id": 1, "__end": null}': True,
    '{"__end": 7},{"sensor_id": 1}': False,
}


def test_every_filled_line_takes_exactly_one_route(spark):
    lines = spark.createDataFrame([(line,) for line in [*ROUTES, "", "  ", "\t"]], "value string")
    assert tuples(errors_of(lines)) == sorted([(line,) for line, good in ROUTES.items() if not good], key=repr)
    assert readings_of(lines).count() == sum(ROUTES.values())


def test_many_lines_against_a_parser_of_its_own(spark):
    """Random good, cut and joined lines; Python's parser is the judge."""
    rng = random.Random(5)
    lines = []
    for i in range(2_000):
        line = json.dumps(reading(i, rng.randrange(2**31)))
        kind = rng.randrange(5)
        end = rng.choice(["]}", '],"r":[' + line, '],"r":[{"__end":1},{}', '],"x":[', "]} {", "],[{}"])
        lines.append(
            line[: rng.randrange(1, len(line))] if kind == 0 else line + line if kind == 1 else line + end if kind == 2 else line
        )

    def single(line):
        try:
            return isinstance(json.loads(line), dict)
        except ValueError:
            return False

    df = spark.createDataFrame([(line,) for line in lines], "value string")
    good = [json.loads(line) for line in lines if single(line)]
    assert tuples(readings_of(df)) == tuples(spark.createDataFrame(good, READING))
    assert tuples(errors_of(df)) == sorted([(line,) for line in lines if not single(line)], key=repr)


def test_each_route_parses_a_line_once(spark, tmp_path):
    (tmp_path / "lines").write_text("{}\n")
    lines = spark.read.text(str(tmp_path / "lines"))
    for route in (with_day(readings_of(lines)), errors_of(lines)):
        text = plan(route)
        assert text.count("from_json") == 1
        assert "Python" not in text


def test_ingest_files_follow_the_buffer_not_the_cores(spark, place):
    """Under the ingest settings a small interval gives one file per day, however many cores there are."""
    source, bronze, checkpoint = place
    for i in range(8):
        put(source, f"f{i}", [json.dumps(reading(i, 1704267600))] * 50)
    session = spark.newSession()
    for key, value in INGEST_CONF.items():
        session.conf.set(key, value)
    ingest_bronze(session, source, bronze, checkpoint, ONCE).awaitTermination()
    assert len(list(Path(bronze).glob("raw/day=*/*.parquet"))) == 1
    assert INGEST_CONF["spark.sql.files.maxPartitionBytes"] == str(BUFFER_BYTES) == "67108864"


def test_key_figures_of_ingested_readings(spark, sample, place):
    source, bronze, checkpoint = place
    put(source, "a", [json.dumps(row) for row in SAMPLE])
    run(spark, source, bronze, checkpoint)
    readings = read_bronze(spark, bronze, partitioned=True)
    assert tuples(kpis.sensor_health(readings)) == tuples(kpis.sensor_health(sample))
    assert tuples(kpis.temp_humidity(readings, F.col("day"))) == tuples(kpis.temp_humidity(sample))
