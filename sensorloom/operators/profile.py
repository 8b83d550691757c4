"""Profiles of readings: value distributions, row count, numeric summary."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NUMERIC_COLUMNS = ("sensor_id", "temperature", "humidity")


def distribution(readings: DataFrame, column: str, name: str = "count") -> DataFrame:
    """Rows per value of one column; NULL is a value."""
    return readings.groupBy(column).agg(F.count("*").alias(name))


def row_counts(readings: DataFrame) -> DataFrame:
    """Number of rows, as a frame of one row; reads no column."""
    return readings.agg(F.count("*").alias("row_count"))


def row_count(readings: DataFrame) -> int:
    """Number of rows."""
    return row_counts(readings).first()["row_count"]


def describe_numeric(readings: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Count, mean, sample standard deviation, least and greatest value per column, as doubles, in one pass.

    All figures of all columns are computed in a single aggregate row, which is only then split into one row per column.
    """
    summaries = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    return readings.agg(F.array(*summaries).alias("summaries")).select(F.inline("summaries"))
