import json
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from sensorloom.functions import with_day
from sensorloom.operators import kpis
from sensorloom.schema import READING
from sensorloom.sources import compact_bronze, read_bronze, read_json, write_bronze
from tests.conftest import SAMPLE, plan, tuples


def _odd_readings(n):
    tricky = ['a "quoted" {', "}]", "\\", '\\"', "[[{", "é日本", "", "line\nfeed", "tab\t}, {"]
    return [
        {**SAMPLE[i % 3], "sensor_id": i, "uuid": tricky[i % len(tricky)] + str(i), "extra": {"deep": [{"x": [1, {"y": "}"}]}]}}
        for i in range(n)
    ]


@pytest.mark.parametrize("indent", [None, 0, 1, 4, "lines"])
@pytest.mark.parametrize("split", [64, 700, 1 << 20])
def test_array_split_anywhere(spark, tmp_path, indent, split):
    """However an array is laid out, and wherever it is cut, its elements are those of a plain reader."""
    from sensorloom.sources import read_json_array

    rows = _odd_readings(60)
    if indent == "lines":
        text = "[\n" + ",\n".join(json.dumps(r) for r in rows) + "\n]\n"
    else:
        text = json.dumps(rows, indent=indent, ensure_ascii=False)
    (tmp_path / "a.json").write_text(text, encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps(rows[:7], indent=2).replace("},\n  {", "}, {"))
    (tmp_path / "one.json").write_text(json.dumps(rows[8], indent=2))
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text("[\n]\n")
    (tmp_path / "mixed.json").write_text('[1,\n null, "{", [{"sensor_id": 3}],\n {"sensor_id": 5}\n]')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = tuples(read_json_array(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    names = [*READING.names]
    wanted = []
    for r in [*rows, *rows[:7], rows[8], {"sensor_id": 5}]:
        place = r.get("location")
        wanted.append(tuple((place and Row(**place)) if n == "location" else r.get(n) for n in names))
    assert found == sorted(wanted, key=repr)


def test_an_array_is_read_by_many_tasks(spark, tmp_path):
    from sensorloom.sources import read_json_array

    (tmp_path / "a.json").write_text(json.dumps(_odd_readings(4_000), indent=2))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        from sensorloom.sources.json_arrays import json_elements

        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        assert json_elements(spark, str(tmp_path)).count() == 4_000
        assert read_json_array(spark, str(tmp_path)).agg({"sensor_id": "sum"}).first()[0] == sum(range(4_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_only_elements_over_a_split_are_shuffled(spark, tmp_path):
    """What reaches the shuffles are numbers per split and two fragments of each, not text, lines or brackets."""
    from sensorloom.sources.json_arrays import json_elements

    rows = [{"sensor_id": i, "uuid": "x" * 40} for i in range(20_000)]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=2))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        splits = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        found = json_elements(spark, str(tmp_path))
        assert {json.loads(r["element"])["sensor_id"] for r in found.collect()} == set(range(20_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    records = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            records.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(found._jdf.queryExecution().executedPlan())
    assert splits > 10 and records and max(records) <= 2 * splits


def test_nested_arrays_and_long_elements_over_many_splits(spark, tmp_path):
    """An element longer than several splits; arrays as elements, which are skipped; a string that holds brackets and an open
    quote on a line of its own."""
    from sensorloom.sources import read_json_array

    nested = [[{"sensor_id": -1, "uuid": "n" * 30}] * 9, [[]]]
    long = {"sensor_id": 2, "extra": [{"x": i, "y": ["}", "[{"]} for i in range(200)], "uuid": "long"}
    rows = [{"sensor_id": 1, "uuid": "first"}, *nested, long, *nested, {"sensor_id": 3, "uuid": 'a "{" b'}, nested]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "cut.json").write_text('[\n{"sensor_id": 4,\n "uuid": "whole"},\n{"sensor_id": 5, "uuid": "open')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for split in (100, 1 << 20):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            found = read_json_array(spark, str(tmp_path)).select("sensor_id", "uuid").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        whole = {(r["sensor_id"], r["uuid"]) for r in found if r["uuid"]}
        assert whole == {(1, "first"), (2, "long"), (3, 'a "{" b'), (4, "whole")} and len(found) == 5


def test_json_lines(spark, sample, json_lines):
    df = read_json(spark, json_lines)
    assert df.schema == READING
    assert tuples(df) == tuples(sample)


def test_json_array_on_one_line(spark, sample, tmp_path):
    path = tmp_path / "array.json"
    path.write_text(json.dumps(SAMPLE))
    assert tuples(read_json(spark, str(path))) == tuples(sample)


def test_pretty_json_array(spark, sample, tmp_path):
    path = tmp_path / "pretty.json"
    path.write_text(json.dumps(SAMPLE, indent=2))
    assert tuples(read_json(spark, str(path), multiline=True)) == tuples(sample)


def test_json_directory(spark, sample, tmp_path):
    for i, row in enumerate(SAMPLE):
        (tmp_path / f"{i}.json").write_text(json.dumps(row))
    assert tuples(read_json(spark, str(tmp_path))) == tuples(sample)


def test_json_whole_numbers_and_unknown_fields(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"sensor_id": 1, "temperature": 25, "extra": [1]}\n')
    assert tuples(read_json(spark, str(path)).select("sensor_id", "temperature", "uuid")) == [(1, 25.0, None)]


def test_json_corrupt_text_is_kept_on_request(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"sensor_id": 1}\n{broken\n')
    df = read_json(spark, str(path), corrupt_column="bad")
    assert tuples(df.cache().select("sensor_id", "bad")) == sorted([(1, None), (None, "{broken")], key=repr)
    assert kpis.sensor_health(read_json(spark, str(path))).count() == 2


def test_bronze_reads_any_depth_with_or_without_slash(spark, sample, tmp_path):
    sample.withColumn("year", F.lit(2024)).withColumn("hour", F.col("sensor_id")).write.partitionBy(
        "year", "hour"
    ).parquet(str(tmp_path / "raw"))
    sample.write.parquet(str(tmp_path / "raw" / "2024" / "01" / "03"))
    for bronze in (str(tmp_path), f"{tmp_path}/"):
        df = read_bronze(spark, bronze)
        assert df.schema == READING
        assert tuples(df) == tuples(sample.unionByName(sample))


def test_bronze_files_without_uuid_and_with_narrow_types(spark, tmp_path):
    narrow = spark.createDataFrame([(1, 2.5)], "sensor_id int, temperature float")
    narrow.write.parquet(str(tmp_path / "raw"))
    assert tuples(read_bronze(spark, str(tmp_path)).select("sensor_id", "temperature", "uuid")) == [(1, 2.5, None)]


def test_bronze_of_an_incompatible_type_fails(spark, tmp_path):
    spark.createDataFrame([(7,)], "status int").write.parquet(str(tmp_path / "raw"))
    with pytest.raises(Exception, match="status"):
        read_bronze(spark, str(tmp_path)).select("status").collect()


@pytest.fixture
def by_day(make, tmp_path):
    rows = [{**row, "timestamp": t} for row in SAMPLE for t in (None, 1704267600, 1704353999, 1704440000)]
    df = make(rows)
    with_day(df).write.partitionBy("day").parquet(str(tmp_path / "raw"))
    return df, str(tmp_path)


def test_partitioned_bronze_has_the_day(spark, by_day):
    df, bronze = by_day
    read = read_bronze(spark, bronze, partitioned=True)
    assert tuples(read.withColumn("day", F.col("day").cast("string"))) == tuples(with_day(df))
    assert tuples(read_bronze(spark, bronze)) == tuples(df)


def test_partitioned_bronze_prunes_days_and_needs_no_timestamp(spark, by_day):
    df, bronze = by_day
    read = read_bronze(spark, bronze, partitioned=True)
    text = plan(kpis.event_counts(read.where("day = '2024-01-03'"), F.col("day")))
    assert "PartitionFilters: [isnotnull(day" in text
    assert "ReadSchema: struct<event_type:string>" in text
    assert tuples(kpis.event_counts(read, F.col("day"))) == tuples(kpis.event_counts(df))
    assert tuples(kpis.temp_humidity(read, F.col("day"))) == tuples(kpis.temp_humidity(df))


def test_day_is_a_date_whatever_the_directories(spark, make, tmp_path):
    with_day(make([{**SAMPLE[0], "timestamp": None}])).write.partitionBy("day").parquet(str(tmp_path / "undated" / "raw"))
    (tmp_path / "none" / "raw").mkdir(parents=True)
    for name, wanted in (("undated", [(42, None)]), ("none", []), ("missing", [])):
        read = read_bronze(spark, str(tmp_path / name), partitioned=True)
        assert dict(read.dtypes)["day"] == "date"
        assert tuples(read.select("sensor_id", "day")) == wanted


def files_per_day(bronze):
    return {p.name: len(list(p.glob("*.parquet"))) for p in Path(bronze).glob("raw/day=*")}


def test_files_of_a_day_do_not_follow_the_tasks(spark, make, tmp_path):
    rows = with_day(make([{**SAMPLE[0], "timestamp": 1704267600 + 86_400 * (i % 3)} for i in range(60)]))
    for tasks in (1, 30):
        write_bronze(rows.repartition(tasks), str(tmp_path / f"b{tasks}"))
    assert files_per_day(tmp_path / "b1") == files_per_day(tmp_path / "b30")
    assert set(files_per_day(tmp_path / "b30").values()) == {1}


def test_compacted_bronze_is_the_same_in_fewer_files(spark, make, tmp_path):
    rows = with_day(make([{**SAMPLE[0], "timestamp": 1704267600 + 86_400 * (i % 3), "uuid": str(i)} for i in range(60)]))
    rows.repartition(12).write.partitionBy("day").parquet(str(tmp_path / "old" / "raw"))
    before = tuples(read_bronze(spark, str(tmp_path / "old"), partitioned=True))
    compact_bronze(spark, str(tmp_path / "old"), str(tmp_path / "new"))
    assert tuples(read_bronze(spark, str(tmp_path / "new"), partitioned=True)) == before
    assert sum(files_per_day(tmp_path / "new").values()) == 3 < sum(files_per_day(tmp_path / "old").values())


def test_partitioned_bronze_must_be_partitioned_by_day(spark, sample, tmp_path):
    sample.write.parquet(str(tmp_path / "raw"))
    with pytest.raises(ValueError, match="not partitioned by day"):
        read_bronze(spark, str(tmp_path), partitioned=True)
