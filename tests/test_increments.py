import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sensorloom.commits import CommitLog
from sensorloom.functions import with_day
from sensorloom.operators import kpis
from sensorloom.plans import increments
from sensorloom.sources import raw_path, read_bronze
from tests.conftest import tuples

DAY = 86_400


def readings(make, seed: int, days: list, count: int = 200):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        day = rng.choice(days)
        place = rng.choice([None, {"latitude": 1.5, "longitude": 2.0}, {"latitude": None, "longitude": 3.0}])
        rows.append(
            {
                "sensor_id": i,
                "temperature": rng.choice([None, rng.randrange(100) / 4]),
                "humidity": rng.choice([None, rng.randrange(100) / 4]) if day != 1 else None,
                "location": place,
                "event_type": rng.choice([None, "a", "b"]),
                "timestamp": None if day is None else day * DAY + rng.randrange(DAY),
            }
        )
    return make(rows)


def check(spark, bronze, state):
    whole = read_bronze(spark, bronze)
    assert tuples(increments.event_counts(spark, state)) == tuples(kpis.event_counts(whole))
    assert tuples(increments.temp_humidity(spark, state)) == tuples(kpis.temp_humidity(whole))


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "bronze"), str(tmp_path / "state")


def put(make, bronze, seed, days, partitioned=True):
    df = with_day(readings(make, seed, days))
    (df.write.mode("append").partitionBy("day") if partitioned else df.drop("day").write.mode("append")).parquet(raw_path(bronze))


def test_updates_equal_one_run_over_all(spark, make, place):
    bronze, state = place
    assert increments.event_counts(spark, state).collect() == []
    put(make, bronze, 1, [0, 1, 5, None])
    assert increments.update(spark, bronze, state) > 0
    check(spark, bronze, state)
    put(make, bronze, 2, [1, 7, None])
    put(make, bronze, 3, [7])
    assert increments.update(spark, bronze, state) > 0
    check(spark, bronze, state)
    assert increments.update(spark, bronze, state) == 0
    check(spark, bronze, state)


def test_days_not_touched_keep_their_files(spark, make, place):
    bronze, state = place
    put(make, bronze, 1, [0, 1, 5])
    increments.update(spark, bronze, state)
    files = lambda: {p: p.stat().st_mtime_ns for p in Path(state).glob("sums/generation=*/day=*/*.parquet")}
    before = files()
    put(make, bronze, 2, [5])
    increments.update(spark, bronze, state)
    after = files()
    assert before.items() <= after.items()
    assert {p.parent.name for p in after.keys() - before.keys()} == {"day=1970-01-06"}
    check(spark, bronze, state)


def test_a_run_that_dies_counts_nothing(spark, make, place, monkeypatch):
    bronze, state = place
    put(make, bronze, 1, [0, 1])
    increments.update(spark, bronze, state)
    wanted = tuples(increments.event_counts(spark, state))
    put(make, bronze, 2, [1, 2])
    create = CommitLog.create
    monkeypatch.setattr(CommitLog, "create", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        increments.update(spark, bronze, state)
    monkeypatch.setattr(CommitLog, "create", create)
    assert tuples(increments.event_counts(spark, state)) == wanted
    increments.update(spark, bronze, state)
    check(spark, bronze, state)


def test_of_two_runs_at_once_one_commits(spark, make, place, monkeypatch):
    bronze, state = place
    put(make, bronze, 1, [0, 1])
    create = CommitLog.create
    monkeypatch.setattr(CommitLog, "create", lambda log, n, value: create(log, n, {}) and create(log, n, value))
    with pytest.raises(increments.ConcurrentUpdate):
        increments.update(spark, bronze, state)


def test_any_layout(spark, make, place):
    bronze, state = place
    put(make, bronze, 1, [0, 3], partitioned=False)
    increments.update(spark, bronze, state)
    put(make, bronze, 2, [3], partitioned=False)
    increments.update(spark, bronze, state)
    check(spark, bronze, state)
    assert current_days(spark, state) == {"1970-01-01", "1970-01-04"}


def current_days(spark, state):
    return {str(r["day"]) for r in increments.current_sums(spark, state).select(F.col("day")).distinct().collect()}
