"""Each key figure as first written down against the form chosen here, on the events replicated BENCH_COPIES times.

"""

import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sensorloom.functions import day_number, day_text  # noqa: E402
from sensorloom.operators import kpis, profile  # noqa: E402
from sensorloom.schema import READING  # noqa: E402
from sensorloom.sources import raw_path, read_bronze, readings_from_events  # noqa: E402
from sensorloom.streaming.ingest import readings_of  # noqa: E402
from sensorloom.workspace import fresh_directory, release  # noqa: E402


def discard(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def plain_describe(df: DataFrame) -> None:
    values = [(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in profile.NUMERIC_COLUMNS]
    pairs = F.array(*[F.struct(*value) for value in values])
    figures = [f("v") for f in (F.count, F.avg, F.stddev_samp, F.min, F.max)]
    discard(df.select(F.inline(pairs)).groupBy("c").agg(*figures))


def two_scans(df: DataFrame) -> None:
    discard(kpis.sensor_health(df))
    discard(kpis.status_health(df))


def one_scan(df: DataFrame) -> None:
    counts, place = kpis.health_counts(df), fresh_directory(df.sparkSession)
    counts.write.parquet(place)
    counts = df.sparkSession.read.schema(counts.schema).parquet(place)
    discard(kpis.sensor_health_of(counts))
    discard(kpis.status_health_of(counts))


def four_scans(df: DataFrame) -> None:
    """All five tables as the jobs make them: the health pair from one scan, the others from one each."""
    one_scan(df)
    for figure in (kpis.temp_humidity, kpis.event_counts, kpis.faulty_geo):
        discard(figure(df))


def grouping_sets(df: DataFrame) -> None:
    """All five tables from one scan: partial figures of three sets of keys, written once, then rolled up."""
    keys = [day_number("timestamp").alias("day"), "sensor_id", "status", "event_type"]
    place = [F.col(f"location.{c}").alias(c) for c in ("latitude", "longitude")]
    rows = df.select(*keys, *place, "temperature", "humidity")
    sets = [["sensor_id", "status"], ["day", "event_type"], ["day", "latitude", "longitude"]]
    names = ["day", "sensor_id", "status", "event_type", "latitude", "longitude"]
    means = [f(c).alias(f"{n}_{c}") for c in ("temperature", "humidity") for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max))]
    partial = rows.groupingSets([[F.col(c) for c in s] for s in sets], *names).agg(
        F.grouping_id().alias("keys"),
        F.count("*").alias("n"),
        F.count(F.when(F.col("status") == "faulty", F.col("sensor_id"))).alias("faulty"),
        *means,
    )
    written = fresh_directory(df.sparkSession)
    partial.write.partitionBy("keys").parquet(written)
    partial = df.sparkSession.read.parquet(written)
    # Bits of the keys that a set leaves out, in the order of `names`.
    of = [partial.where(F.col("keys") == sum(1 << 5 - i for i, c in enumerate(names) if c not in s)) for s in sets]
    discard(kpis.sensor_health_of(of[0]))
    discard(kpis.status_health_of(of[0]))
    discard(of[1].select(day_text("day"), "event_type", "n"))
    discard(of[2].select(day_text("day"), "latitude", "longitude", *(f"{n}_{c}" for c in ("temperature", "humidity") for n in ("avg", "min", "max"))))
    discard(of[2].groupBy("latitude", "longitude").agg(F.sum("faulty").alias("faulty_count")).where("faulty_count > 0"))


def plain_parse(lines: DataFrame) -> None:
    schema = StructType([*READING.fields]).add("_corrupt_record", StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = lines.select(F.from_json("value", schema, options).alias("r"))
    discard(parsed.where("r._corrupt_record IS NULL").select("r.*"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("BENCH_COPIES", "200"))
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bronze, text = fresh_directory(spark), fresh_directory(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").repartition(32)
    copied = events.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    # Copies of a sensor are that sensor, so its readings grow with the rows; or each copy has sensors of its own.
    own = F.col("copy") * (1_500 if os.environ.get("BENCH_SENSORS") == "many" else 0)
    readings_from_events(copied.withColumn("user_id", F.col("user_id") + own)).write.parquet(raw_path(bronze))
    df = read_bronze(spark, bronze)
    lines_of = df.where(F.col("status") != "active").select(F.to_json(F.struct("*")).alias("value"))
    lines_of.write.text(text)
    lines = spark.read.text(text)

    pairs = {
        "describe_numeric": (lambda: plain_describe(df), lambda: discard(profile.describe_numeric(df))),
        "health pair": (lambda: two_scans(df), lambda: one_scan(df)),
        "five tables": (lambda: grouping_sets(df), lambda: four_scans(df)),
        "parse lines": (lambda: plain_parse(lines), lambda: discard(readings_of(lines))),
    }
    print(f"rows {df.count()}, lines {lines.count()}")
    only = os.environ.get("BENCH_PAIRS")
    for name, forms in pairs.items():
        if only and name not in only.split(","):
            continue
        plain, ours = (_median(form) for form in forms)
        print(f"{name:18s} plain {plain:6.2f}  ours {ours:6.2f}  ratio {plain / ours:5.2f}", flush=True)
    release(spark)
    spark.stop()


def _median(form, runs: int = 3) -> float:
    seconds = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        form()
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds[1:])


if __name__ == "__main__":
    main()
