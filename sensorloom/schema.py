"""Declared schemas: the reading every source yields and the five result tables.

Nothing in the package infers a schema. Inference costs a pass over the input and lets one odd file decide a column's
type for the whole read.
"""

from pyspark.sql.types import DoubleType, LongType, StringType, StructType

LOCATION = StructType().add("latitude", DoubleType()).add("longitude", DoubleType())

READING = (
    StructType()
    .add("sensor_id", LongType())
    .add("temperature", DoubleType())
    .add("humidity", DoubleType())
    .add("location", LOCATION)
    .add("status", StringType())
    .add("event_type", StringType())
    .add("timestamp", LongType())  # epoch seconds
    .add("uuid", StringType())
)

# Fields a complete reading carries; `uuid` is optional.
REQUIRED_FIELDS = (
    "sensor_id",
    "temperature",
    "humidity",
    "location",
    "location.latitude",
    "location.longitude",
    "status",
    "event_type",
    "timestamp",
)

STATUSES = ("active", "faulty", "inactive")

SENSOR_HEALTH = (
    StructType()
    .add("sensor_id", LongType())
    .add("faulty_count", LongType())
    .add("total_count", LongType())
    .add("faulty_pct", DoubleType())
)

STATUS_HEALTH = StructType().add("status", StringType()).add("sensor_count", LongType())

TEMP_HUMIDITY = (
    StructType()
    .add("day", StringType())
    .add("latitude", DoubleType())
    .add("longitude", DoubleType())
    .add("avg_temp", DoubleType())
    .add("min_temp", DoubleType())
    .add("max_temp", DoubleType())
    .add("avg_humidity", DoubleType())
    .add("min_humidity", DoubleType())
    .add("max_humidity", DoubleType())
)

EVENT_COUNTS = StructType().add("day", StringType()).add("event_type", StringType()).add("event_count", LongType())

FAULTY_GEO = (
    StructType().add("latitude", DoubleType()).add("longitude", DoubleType()).add("faulty_count", LongType())
)
