"""Data-quality scorecards. Each is one pass whatever the number of rules."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sensorloom.schema import REQUIRED_FIELDS, STATUSES

_TOTAL = "all readings"


def default_rules() -> dict[str, Column]:
    """Rule name to the condition a valid reading meets."""
    # The accepted ranges and the status domain.
    return {
        "sensor_id_positive": F.col("sensor_id") > 0,
        "temp_in_range": F.col("temperature").between(-50, 100),
        "humidity_in_range": F.col("humidity").between(0, 100),
        "valid_status": F.col("status").isin(*STATUSES),
        "timestamp_positive": F.col("timestamp") > 0,
    }


def validate(readings: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Per rule: readings that meet it, all readings, percent (0 for no readings), and whether all of them do.

    A NULL condition is not met.
    """
    rules = default_rules() if rules is None else rules
    scores = [
        F.struct(F.lit(rule).alias("rule"), F.count_if(condition).alias("valid_count"), F.count("*").alias("total"))
        for rule, condition in rules.items()
    ]
    pct = F.when(F.col("total") > 0, F.col("valid_count") / F.col("total") * 100).otherwise(F.lit(0.0))
    return (
        readings.agg(F.array(*scores).alias("scores"))
        .select(F.inline("scores"))
        .withColumn("pct", pct)
        .withColumn("passed", F.col("pct") == 100)
    )


def observed(readings: DataFrame, rules: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """The same readings, and an observation that keeps the scorecard while some action reads them: no scan of its own.

    Put it right after the source, as filters above it are not pushed below it. `scorecard` reads it after the action.
    """
    rules = default_rules() if rules is None else rules
    observation = Observation()
    counts = [F.count_if(condition).alias(rule) for rule, condition in rules.items()]
    return readings.observe(observation, F.count("*").alias(_TOTAL), *counts), observation


def scorecard(observation: Observation) -> list[tuple[str, int, int, float, bool]]:
    """The rows of `validate`, from what was observed."""
    counts = dict(observation.get)
    total = counts.pop(_TOTAL)
    pct = {rule: n / total * 100 if total else 0.0 for rule, n in counts.items()}
    return [(rule, n, total, pct[rule], pct[rule] == 100) for rule, n in counts.items()]


def completeness(readings: DataFrame, fields: Sequence[str] = REQUIRED_FIELDS) -> DataFrame:
    """Per required field: readings that lack it (absent or null), and all readings."""
    scores = [
        F.struct(
            F.lit(field).alias("field"),
            F.count_if(F.col(field).isNull()).alias("missing_count"),
            F.count("*").alias("total"),
        )
        for field in fields
    ]
    return readings.agg(F.array(*scores).alias("scores")).select(F.inline("scores"))
