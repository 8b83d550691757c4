import json

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import kpis
from sensorloom.schema import READING
from sensorloom.streaming import closed_event_counts, count_days, missed_event_counts
from tests.conftest import tuples
from tests.test_ingest import ONCE, place, put  # noqa: F401

DAY = 86_400
START = 19_725 * DAY  # 2024-01-03


def line(second, kind="view", **more):
    return json.dumps({"sensor_id": 1, "event_type": kind, "timestamp": second, **more})


@pytest.fixture
def run(spark, place):  # noqa: F811
    source, counts, checkpoint = place

    def send(name, lines, **options):
        put(source, name, lines)
        count_days(spark, source, counts, checkpoint, ONCE, **options).awaitTermination()
        return tuples(closed_event_counts(spark, counts))

    send.counts, send.source = counts, source
    return send


def batch(spark, run):
    """The same readings, read as a batch."""
    return spark.read.schema(READING).json(run.source)


def test_nothing_is_closed_before_the_first_start(spark, tmp_path):
    assert closed_event_counts(spark, str(tmp_path / "none")).collect() == []


def test_days_close_when_the_watermark_passes_and_equal_the_batch(spark, run):
    first = [line(START + i * 3_000, "view" if i % 3 else None) for i in range(57)]  # most of two days
    assert run("a", first) == []
    assert run("b", [line(START + 2 * DAY - 1)]) == []
    day = [("2024-01-03", "view", 19), ("2024-01-03", None, 10)]
    assert run("c", [line(START + 2 * DAY + 10), "{broken"]) == sorted(day, key=repr)
    got = run("d", [line(START + 30 * DAY, "closing")])
    wanted = kpis.event_counts(batch(spark, run).where("timestamp is not null")).where("event_type is null or event_type != 'closing'")
    assert got == tuples(wanted)
    # Another run finds nothing new, and each row is there once.
    assert run("e", [""]) == got


def test_the_end_of_a_day_is_utc_in_any_session(spark, run):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        run("a", [line(START - 1), line(START), line(START + DAY - 1), line(-1, "old")])
        got = run("b", [line(START + 9 * DAY, "closing")])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [("2024-01-02", "view", 1), ("2024-01-03", "view", 2)]
    # Every watermark starts at 1970, so what is older is late from the start.
    assert tuples(missed_event_counts(closed_event_counts(spark, run.counts), batch(spark, run))) == [("1969-12-31", "old", 1)]


def test_late_and_timeless_readings_are_missed_and_found(spark, run):
    run("a", [line(START, "view"), line(START + 5, "click"), line(None, "lost"), line(None, None)])
    run("b", [line(START + 9 * DAY, "closing")])
    closed = run("c", [line(START + 6, "view"), line(START + 7, "view"), line(START + 8, None), line(START + 10 * DAY, "open")])
    assert closed == [("2024-01-03", "click", 1), ("2024-01-03", "view", 1)]
    counts = closed_event_counts(spark, run.counts)
    missed = missed_event_counts(counts, batch(spark, run))
    late = [("2024-01-03", "view", 2), ("2024-01-03", None, 1), (None, "lost", 1), (None, None, 1)]
    assert tuples(missed) == sorted(late, key=repr)
    # Together they are the batch's counts of the closed days and of no day.
    both = counts.union(missed).groupBy("day", "event_type").agg(F.sum("event_count").alias("n"))
    assert tuples(both) == tuples(kpis.event_counts(batch(spark, run)).where("day is null or day < '2024-01-12'"))


def test_a_clock_that_runs_ahead_closes_nothing(spark, run):
    assert run("a", [line(START), line(START * 1_000, "milliseconds"), line(2**62, "far")]) == []
    assert run("b", [line(START + 1)]) == []
    assert run("c", [line(START + 9 * DAY, "closing")]) == [("2024-01-03", "view", 2)]


def test_a_run_that_dies_counts_nothing_twice(spark, place, run):  # noqa: F811
    """The sink cannot be written at first; the batch is repeated from the checkpoint."""
    source, counts, checkpoint = place
    put(source, "a", [line(START), line(START + 9 * DAY, "closing")])
    blocked = f"{counts}/_spark_metadata"
    from pathlib import Path

    Path(counts).mkdir()
    Path(blocked).write_text("in the way")
    with pytest.raises(Exception):
        count_days(spark, source, counts, checkpoint, ONCE).awaitTermination()
    assert Path(blocked).is_file()
    Path(blocked).unlink()
    assert run("b", [line(START + 9 * DAY + 1, "closing")]) == [("2024-01-03", "view", 1)]
