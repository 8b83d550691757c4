"""The five key figures.

Each is one hash aggregate: Spark folds the rows of a key inside every map task, so a hot key (one sensor or one day
with a third of all readings) reaches the shuffle as one row per task, and no group is ever gathered as rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import day_number, day_text, is_faulty


def faulty(readings: DataFrame) -> DataFrame:
    """Readings whose status is `faulty`; a NULL status is not faulty."""
    return readings.where(is_faulty())


def status_health(readings: DataFrame) -> DataFrame:
    """Readings per status. Counts readings, not distinct sensors, and skips those without a sensor_id."""
    return readings.groupBy("status").agg(F.count("sensor_id").alias("sensor_count"))


def sensor_health(readings: DataFrame) -> DataFrame:
    """Faulty and total readings per sensor, and their ratio (0..1). Readings with a NULL status count in the total."""
    counts = readings.groupBy("sensor_id").agg(
        F.count_if(is_faulty()).alias("faulty_count"),
        F.count("*").alias("total_count"),
    )
    # A group has at least one row, so the divisor is never zero.
    return counts.withColumn("faulty_pct", F.col("faulty_count") / F.col("total_count"))


def health_counts(readings: DataFrame) -> DataFrame:
    """Readings per sensor and status, from which both health figures follow."""
    return readings.groupBy("sensor_id", "status").agg(F.count("*").alias("n"))


def status_health_of(counts: DataFrame) -> DataFrame:
    """`status_health` from `health_counts`."""
    known = F.when(F.col("sensor_id").isNotNull(), F.col("n")).otherwise(F.lit(0))
    return counts.groupBy("status").agg(F.sum(known).alias("sensor_count"))


def sensor_health_of(counts: DataFrame) -> DataFrame:
    """`sensor_health` from `health_counts`."""
    failed = F.when(is_faulty(), F.col("n")).otherwise(F.lit(0))
    sums = counts.groupBy("sensor_id").agg(F.sum(failed).alias("faulty_count"), F.sum("n").alias("total_count"))
    return sums.withColumn("faulty_pct", F.col("faulty_count") / F.col("total_count"))


def event_counts(readings: DataFrame, day: Column | None = None) -> DataFrame:
    """Readings per day and event type.

    `day` replaces the day taken from `timestamp`: pass the `day` column of a partitioned bronze, and the scan need not
    read `timestamp`.
    """
    return _by_day(readings, day, ["event_type"], [F.count("*").alias("event_count")])


def faulty_geo(readings: DataFrame) -> DataFrame:
    """Faulty readings per exact location; counts readings, not distinct sensors, and skips those without sensor_id."""
    return (
        faulty(readings)
        .groupBy("location.latitude", "location.longitude")
        .agg(F.count("sensor_id").alias("faulty_count"))
    )


def temp_humidity(readings: DataFrame, day: Column | None = None) -> DataFrame:
    """Mean, least and greatest temperature and humidity per day and exact location. `day` as in `event_counts`."""
    figures = [
        figure(column).alias(f"{name}_{short}")
        for column, short in (("temperature", "temp"), ("humidity", "humidity"))
        for name, figure in (("avg", F.avg), ("min", F.min), ("max", F.max))
    ]
    return _by_day(readings, day, ["location.latitude", "location.longitude"], figures)


def _by_day(readings: DataFrame, day: Column | None, keys: list[str], figures: list[Column]) -> DataFrame:
    # Grouped on the day number (or the partition value) and turned into text afterwards, once per group.
    key, as_text = (day_number("timestamp"), day_text) if day is None else (day, lambda c: F.col(c).cast("string"))
    grouped = readings.groupBy(key.alias("day"), *keys).agg(*figures)
    return grouped.withColumn("day", as_text("day"))
