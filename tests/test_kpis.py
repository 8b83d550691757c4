import random
from collections import defaultdict
from statistics import fmean

import pytest
from pyspark.sql import functions as F

from sensorloom import schema
from sensorloom.functions import with_day
from sensorloom.operators import kpis
from tests.conftest import plan, tuples


def test_status_health_on_sample(sample):
    assert tuples(kpis.status_health(sample)) == [("active", 1), ("faulty", 2)]


def test_sensor_health_on_sample(sample):
    assert tuples(kpis.sensor_health(sample)) == [(37, 1, 1, 1.0), (42, 1, 2, 0.5)]


def test_event_counts_on_sample(sample):
    assert tuples(kpis.event_counts(sample)) == [("2024-01-03", "alert", 2), ("2024-01-03", "sensor_reading", 1)]


def test_faulty_geo_on_sample(sample):
    assert tuples(kpis.faulty_geo(sample)) == [(-10.2, 120.8, 1), (22.5, 88.3, 1)]


def test_temp_humidity_on_sample(sample):
    first, second = tuples(kpis.temp_humidity(sample))
    assert first == ("2024-01-03", -10.2, 120.8, 33.1, 33.1, 33.1, 55.7, 55.7, 55.7)
    assert second == pytest.approx(("2024-01-03", 22.5, 88.3, 25.7, 25.4, 26.0, 61.05, 60.0, 62.1))


def test_faulty_on_sample(sample):
    assert [row["timestamp"] for row in kpis.faulty(sample).orderBy("timestamp").collect()] == [1704267660, 1704267720]


@pytest.mark.parametrize(
    "operator, expected",
    [
        (kpis.sensor_health, schema.SENSOR_HEALTH),
        (kpis.status_health, schema.STATUS_HEALTH),
        (kpis.temp_humidity, schema.TEMP_HUMIDITY),
        (kpis.event_counts, schema.EVENT_COUNTS),
        (kpis.faulty_geo, schema.FAULTY_GEO),
    ],
)
def test_columns_and_types(sample, operator, expected):
    assert operator(sample).dtypes == [(f.name, f.dataType.simpleString()) for f in expected]


@pytest.mark.parametrize(
    "operator", [kpis.sensor_health, kpis.status_health, kpis.temp_humidity, kpis.event_counts, kpis.faulty_geo]
)
def test_no_readings_no_rows(make, operator):
    assert operator(make([])).collect() == []


NULLS = [
    {"sensor_id": 1},
    {"status": "faulty"},
    {},
    {"sensor_id": 1, "status": "faulty"},
]


def test_null_sensor_and_status(make):
    df = make(NULLS)
    assert tuples(kpis.status_health(df)) == sorted([(None, 1), ("faulty", 1)], key=repr)
    assert tuples(kpis.sensor_health(df)) == sorted([(1, 1, 2, 0.5), (None, 1, 2, 0.5)], key=repr)


def test_null_day_event_and_place_form_groups(make):
    df = make(NULLS)
    assert tuples(kpis.event_counts(df)) == [(None, None, 4)]
    assert tuples(kpis.faulty_geo(df)) == [(None, None, 1)]
    assert tuples(kpis.temp_humidity(df)) == [(None,) * 9]


def test_group_without_any_sensor_id_stays_at_zero(make):
    df = make([{"status": "faulty", "location": {"latitude": 1.0, "longitude": 2.0}}])
    assert tuples(kpis.status_health(df)) == [("faulty", 0)]
    assert tuples(kpis.faulty_geo(df)) == [(1.0, 2.0, 0)]


def test_null_measurements_are_skipped(make):
    place = {"latitude": 1.0, "longitude": 2.0}
    df = make([{"location": place, "timestamp": 0, "temperature": t} for t in (None, 4.0, 8.0)])
    assert tuples(kpis.temp_humidity(df)) == [("1970-01-01", 1.0, 2.0, 6.0, 4.0, 8.0, None, None, None)]


def test_negative_zero_is_the_same_place(make):
    df = make(
        [{"sensor_id": 1, "status": "faulty", "location": {"latitude": z, "longitude": 1.0}} for z in (0.0, -0.0)]
    )
    assert tuples(kpis.faulty_geo(df)) == [(0.0, 1.0, 2)]


def test_given_day_is_used_as_it_is(sample):
    by_day = with_day(sample).withColumn("timestamp", F.lit(None).cast("bigint"))
    as_date = by_day.withColumn("day", F.col("day").cast("date"))
    for df in (by_day, as_date):
        assert tuples(kpis.event_counts(df, F.col("day"))) == tuples(kpis.event_counts(sample))
        assert tuples(kpis.temp_humidity(df, F.col("day"))) == tuples(kpis.temp_humidity(sample))


def _random_readings(n: int) -> list[dict]:
    """A third of the readings come from one sensor, place and day; any field may be missing."""
    rng = random.Random(11)
    rows = []
    for i in range(n):
        hot = rng.random() < 1 / 3
        k = 0 if hot else rng.randrange(40)
        row = {
            "sensor_id": k,
            "temperature": rng.randrange(-600, 1200) / 10,
            "humidity": rng.randrange(0, 1000) / 10,
            "location": {"latitude": k % 5 / 2, "longitude": k % 3 / 4},
            "status": rng.choice(schema.STATUSES),
            "event_type": rng.choice(["alert", "sensor_reading"]),
            "timestamp": 1_704_067_200 + (0 if hot else rng.randrange(5 * 86_400)),
        }
        if not hot:
            row = {name: value for name, value in row.items() if rng.random() > 0.05}
        rows.append(row)
    return rows


def test_against_brute_force(make):
    rows = _random_readings(6_000)
    df = make(rows).repartition(8)
    sensors, statuses, events, places = (defaultdict(int) for _ in range(4))
    faults, climate = defaultdict(int), defaultdict(lambda: ([], []))
    for row in rows:
        sensor, status, second = row.get("sensor_id"), row.get("status"), row.get("timestamp")
        place = (row.get("location") or {}).get("latitude"), (row.get("location") or {}).get("longitude")
        day = None if second is None else f"2024-01-{1 + (second - 1_704_067_200) // 86_400:02d}"
        sensors[sensor] += 1
        faults[sensor] += status == "faulty"
        statuses[status] += sensor is not None
        events[day, row.get("event_type")] += 1
        if status == "faulty":
            places[place] += sensor is not None
        for values, name in zip(climate[(day, *place)], ("temperature", "humidity")):
            if row.get(name) is not None:
                values.append(row[name])

    def in_order(rows):
        return sorted(rows, key=repr)

    assert tuples(kpis.sensor_health(df)) == in_order((s, faults[s], n, faults[s] / n) for s, n in sensors.items())
    assert tuples(kpis.status_health(df)) == in_order(statuses.items())
    assert tuples(kpis.event_counts(df)) == in_order((*key, n) for key, n in events.items())
    assert tuples(kpis.faulty_geo(df)) == in_order((*key, n) for key, n in places.items())
    figures = {row[:3]: row[3:] for row in tuples(kpis.temp_humidity(df))}
    assert figures.keys() == climate.keys()
    for key, (temperatures, humidities) in climate.items():
        wanted = [f(v) if v else None for v in (temperatures, humidities) for f in (fmean, min, max)]
        assert figures[key] == pytest.approx(tuple(wanted))


@pytest.fixture
def stored(sample, tmp_path):
    path = str(tmp_path / "readings")
    sample.write.parquet(path)
    return sample.sparkSession.read.schema(schema.READING).parquet(path)


@pytest.mark.parametrize(
    "operator, columns",
    [
        (kpis.status_health, "sensor_id:bigint,status:string"),
        (kpis.sensor_health, "sensor_id:bigint,status:string"),
        (kpis.event_counts, "event_type:string,timestamp:bigint"),
        (kpis.faulty_geo, "sensor_id:bigint,location:struct<latitude:double,longitude:double>,status:string"),
        (
            kpis.temp_humidity,
            "temperature:double,humidity:double,location:struct<latitude:double,longitude:double>,timestamp:bigint",
        ),
    ],
)
def test_plan_is_one_pruned_scan_and_a_two_step_hash_aggregate(stored, operator, columns):
    text = plan(operator(stored))
    assert f"ReadSchema: struct<{columns}>" in text
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details
    assert text.count("Arguments: hashpartitioning") == 1
    assert "partial_" in text
    for word in ("SortAggregate", "ObjectHashAggregate", "Python", "Join", "Sort ("):
        assert word not in text


def test_fault_filter_reaches_the_scan(stored):
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,faulty)]" in plan(kpis.faulty_geo(stored))


def test_days_are_grouped_as_numbers(stored):
    """Date text is made from the groups, after the aggregate, not from every row."""
    text = plan(kpis.event_counts(stored))
    project = text[text.index("(2) Project") : text.index("(3) HashAggregate")]
    assert "date_from_unix_date" not in project and "date_from_unix_date" in text
