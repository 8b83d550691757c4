"""Column expressions: built-in functions only, so they stay inside the JVM and inside code generation."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400
# The widest epoch second a Spark timestamp (microseconds in a bigint) can hold. A bigint-to-timestamp cast saturates
# there; so do we, since one reading stamped in the wrong unit must not fail a whole job.
MAX_EPOCH_SECOND = 9_223_372_036_854


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _saturated(seconds: Column) -> Column:
    # Not least/greatest: those skip NULLs and would turn a missing timestamp into a bound.
    return (
        F.when(seconds > MAX_EPOCH_SECOND, F.lit(MAX_EPOCH_SECOND))
        .when(seconds < -MAX_EPOCH_SECOND, F.lit(-MAX_EPOCH_SECOND))
        .otherwise(seconds)
    )


def day_number(seconds: Column | str = "timestamp") -> Column:
    """Days since 1970-01-01 UTC as an int, NULL for NULL. The session time zone plays no part.

    This is the form to group on: an int key is fixed-width, and no date text is built per row.
    """
    return F.floor(_saturated(_col(seconds)) / SECONDS_PER_DAY).cast("int")


def day_text(number: Column | str) -> Column:
    """`yyyy-MM-dd` text of a day number."""
    return F.date_from_unix_date(_col(number)).cast("string")


def utc_day(seconds: Column | str = "timestamp") -> Column:
    """`yyyy-MM-dd` text of the UTC day of an epoch second."""
    return day_text(day_number(seconds))


def event_time(seconds: Column | str = "timestamp") -> Column:
    """Epoch seconds as a true timestamp."""
    return F.timestamp_seconds(_saturated(_col(seconds)))


def is_faulty() -> Column:
    """NULL for a NULL status, so filters drop it and counts skip it."""
    return F.col("status") == "faulty"


def with_day(readings: DataFrame) -> DataFrame:
    """Adds `day`, the UTC day of `timestamp` as text."""
    return readings.withColumn("day", utc_day("timestamp"))
