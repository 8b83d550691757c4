"""Events per day and type while they arrive, and what came too late for that.

Days are event-time windows under a watermark: a day's counts are kept as state until the newest reading is `lateness` past
the day's end, then written once and forgotten. So the state is the open days times the event types, however much comes in.

The watermark follows the newest reading, so a single clock that runs ahead would close all days at once. Readings stamped
more than `ahead` after their arrival are therefore not counted here. Neither they, nor readings that come after their day
was closed (those of before 1970 always do, as a watermark starts there), nor those without a time are lost: ingest delivers
them, and `missed_event_counts` finds them in bronze.
"""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sensorloom.functions import event_time, utc_day
from sensorloom.operators.kpis import event_counts
from sensorloom.streaming.ingest import BUFFER_INTERVAL, lines_of, readings_of

LATENESS, AHEAD = "1 day", "1 hour"

_CLOSED = StructType(
    [StructField("day", StringType()), StructField("event_type", StringType()), StructField("event_count", LongType())]
)


def daily_event_counts(readings: DataFrame, lateness: str = LATENESS, ahead: str = AHEAD) -> DataFrame:
    """`event_counts` of a stream of readings: a row per UTC day and event type, once the day is closed."""
    at = readings.select(event_time("timestamp").alias("at"), "event_type")
    timed = at.where(F.col("at") <= F.current_timestamp() + F.expr(f"interval {ahead}")).withWatermark("at", lateness)
    counts = timed.groupBy(F.window("at", "1 day").alias("w"), "event_type").agg(F.count("*").alias("event_count"))
    return counts.select(utc_day(F.unix_seconds("w.start")).alias("day"), "event_type", "event_count")


def count_days(
    spark: SparkSession,
    source: str | DataFrame,
    counts: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    lateness: str = LATENESS,
    ahead: str = AHEAD,
) -> StreamingQuery:
    """Starts counting; closed days go to the directory `counts`, each row exactly once. Arguments as `ingest_bronze`.

    The number of state partitions is fixed by `spark.sql.shuffle.partitions` at the first start. The state is small: set
    a few, not the thousands of a batch job.
    """
    days = daily_event_counts(readings_of(lines_of(spark, source)), lateness, ahead)
    trigger = {"processingTime": BUFFER_INTERVAL} if trigger is None else trigger
    place = f"{checkpoint.rstrip('/')}/days"
    return days.writeStream.format("parquet").option("checkpointLocation", place).trigger(**trigger).start(counts)


def closed_event_counts(spark: SparkSession, counts: str) -> DataFrame:
    """The counts of closed days; none before the query's first start has made the directory."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(counts)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _CLOSED)
    return spark.read.schema(_CLOSED).parquet(counts)


def missed_event_counts(closed: DataFrame, readings: DataFrame) -> DataFrame:
    """Per `day` and `event_type`, the readings of bronze that the stream has not counted (`missed`): those of days up to the
    last closed one that came too late, and those without a time (`day` null). Days still open are not listed.

    What the stream counted and this together are `event_counts` of those days. As it reads bronze after the counts, run it
    when ingest has taken what the stream has.
    """
    last = closed.agg(F.max("day")).first()[0]
    all_ = event_counts(readings).where(F.col("day").isNull() | (F.col("day") <= F.lit(last)))
    seen = closed.select(F.col("day").alias("_day"), F.col("event_type").alias("_type"), F.col("event_count").alias("_n"))
    same = F.col("day").eqNullSafe(F.col("_day")) & F.col("event_type").eqNullSafe(F.col("_type"))
    missed = F.col("event_count") - F.coalesce("_n", F.lit(0))
    return all_.join(seen, same, "left").select("day", "event_type", missed.alias("missed")).where("missed > 0")
