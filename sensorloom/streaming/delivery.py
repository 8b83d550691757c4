"""Ingest with one parse for both routes, delivery by size or time, and resent records.

A batch of lines is parsed once and written once, readings and rejected lines side by side as directories of one table:

    <bronze>/delivered/batch=<n>/route=raw/day=<day>/...      <bronze>/delivered/batch=<n>/route=errors/...

and then committed: readers take batches up to the last commit, so what a run that died left half written is not seen. The
same batch, run again after a failure, replaces its own directory; a batch that is committed is not written again.
"""

import logging
import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from sensorloom.commits import CommitLog
from sensorloom.functions import utc_day
from sensorloom.schema import READING
from sensorloom.sources.bronze import READING_OF_DAY
from sensorloom.streaming.ingest import BUFFER_BYTES, lines_of, routed

log = logging.getLogger(__name__)

RAW, ERRORS = "raw", "errors"
# Fixed value: the delivery buffer's other bound, in seconds.
BUFFER_SECONDS = 60.0

_DELIVERED = StructType(
    [
        *READING.fields,
        StructField("value", StringType()),
        StructField("batch", LongType()),
        StructField("route", StringType()),
        StructField("day", DateType()),
    ]
)


def _place(bronze: str) -> str:
    return f"{bronze.rstrip('/')}/delivered"


def _log(spark: SparkSession, bronze: str) -> CommitLog:
    return CommitLog(spark, f"{bronze.rstrip('/')}/_delivered")


def ingest_once(
    spark: SparkSession,
    source: str | DataFrame,
    bronze: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
    resent_within: str | None = None,
) -> StreamingQuery:
    """Starts delivery of readings and rejected lines, each line parsed once. Arguments as `ingest_bronze`; a bronze belongs
    to one checkpoint. With `resent_within`, readings sent again within that time are dropped (`drop_resent`).
    """
    rows = routed(lines_of(spark, source))
    if resent_within:
        rows = drop_resent(rows, resent_within)
    commits = _log(spark, bronze)

    def deliver(batch: DataFrame, number: int) -> None:
        if commits.last() > number:
            return  # committed before Spark could note that the batch is done
        batch.withColumn("day", utc_day("timestamp")).write.mode("overwrite").partitionBy("route", "day").option(
            "compression", "snappy"
        ).parquet(f"{_place(bronze)}/batch={number}")
        # Batches count from 0, commits from 1. Without a commit between, as a batch without rows leaves, readers still
        # take all that came before.
        commits.create(number + 1, {"batch": number})

    place = f"{checkpoint.rstrip('/')}/delivered"
    trigger = {"processingTime": f"{BUFFER_SECONDS:.0f} seconds"} if trigger is None else trigger
    return rows.writeStream.foreachBatch(deliver).option("checkpointLocation", place).trigger(**trigger).start()


def _read(spark: SparkSession, bronze: str, route: str) -> DataFrame:
    last = _log(spark, bronze).last()
    if not last:
        return spark.createDataFrame([], _DELIVERED)
    rows = spark.read.schema(_DELIVERED).parquet(_place(bronze))
    return rows.where((F.col("batch") < last) & (F.col("route") == route))


def read_delivered(spark: SparkSession, bronze: str) -> DataFrame:
    """All delivered readings, with their `day`."""
    return _read(spark, bronze, RAW).select(*READING_OF_DAY.names)


def delivered_errors(spark: SparkSession, bronze: str) -> DataFrame:
    """All delivered lines that were not readings, unchanged (`value`)."""
    return _read(spark, bronze, ERRORS).select("value")


def drop_resent(rows: DataFrame, within: str) -> DataFrame:
    """The stream without readings whose `uuid` has come before, within that time of the first.

    Time is that of arrival, so no reading is too late to be taken, however old its own timestamp is; keys are
    forgotten when `within` has passed. Readings without a uuid, and rejected lines, are never dropped.
    """
    key = F.coalesce(F.concat(F.lit("="), "uuid"), F.expr("uuid()"))
    keyed = rows.withColumns({"_arrived": F.current_timestamp(), "_key": key})
    return keyed.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_key"]).drop("_arrived", "_key")


def deliver_by_size_or_time(
    spark: SparkSession,
    source: str,
    start: Callable[[Mapping[str, object]], StreamingQuery],
    until: Callable[[], bool],
    size: int = BUFFER_BYTES,
    seconds: float = BUFFER_SECONDS,
    poll: float = 1.0,
) -> int:
    """Delivers whenever `size` bytes wait under `source`, or `seconds` after the first of them came, whichever is earlier;
    returns the number of deliveries once `until()` holds and the rest is delivered.

    `start` starts the query with the trigger it is given, one that takes what is there and ends. What is taken, and that
    nothing is lost or doubled when this is stopped and called again, is the query's own checkpoint; only when to look is
    decided here, from the directory's listing. So what an earlier call took may cause one delivery of nothing.
    """
    known: set[str] = set()
    waiting_since, count = None, 0
    while True:
        ending = until()
        files = _files(spark, source)
        waiting = {path: length for path, length in files.items() if path not in known}
        now = time.monotonic()
        if not waiting:
            waiting_since = None
        elif waiting_since is None:
            waiting_since = now
        due = waiting and (ending or sum(waiting.values()) >= size or now - waiting_since >= seconds)
        if due:
            start({"availableNow": True}).awaitTermination()
            # Files that came meanwhile may have been taken, too: they cause a delivery of their own, of nothing.
            known = set(files)
            waiting_since, count = None, count + 1
        elif ending:
            return count
        else:
            time.sleep(poll)


def _files(spark: SparkSession, path: str) -> dict[str, int]:
    """Files at any depth with their lengths, hidden ones apart."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found: dict[str, int] = {}
    if fs.exists(root):
        listing = fs.listFiles(root, True)
        while listing.hasNext():
            status = listing.next()
            if not status.getPath().getName().startswith(("_", ".")):
                found[status.getPath().toString()] = status.getLen()
    return found
