"""Continuous ingest: JSON lines to typed Parquet bronze, and the lines that do not convert to a prefix of their own.

The two routes are two queries, each with its own checkpoint. A file sink delivers exactly once by itself; one
`foreachBatch` writing to both places would not. The price is that every line is parsed by both.

Delivery is by time or size, whichever comes first. The time is the trigger. The size is that of a read task: run the
queries in a session made by `build_session(..., conf=INGEST_CONF)`, and every task, hence every file it writes, holds
at most 64 MB of input, however much an interval brings. Capping the *interval* at 64 MB instead would throttle the
whole ingest to 64 MB a minute.
"""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from sensorloom.functions import with_day
from sensorloom.schema import READING
from sensorloom.sources.bronze import errors_path, raw_path

# The delivery buffer.
BUFFER_BYTES = 64 * 1024 * 1024
BUFFER_INTERVAL = "60 seconds"

INGEST_CONF = {
    "spark.sql.files.maxPartitionBytes": str(BUFFER_BYTES),
    # Otherwise a small interval is cut into as many files as the cluster has cores.
    "spark.sql.files.minPartitionNum": "1",
    # The sink's log names every file ever written; merging it less often keeps the driver's share of a batch small.
    "spark.sql.streaming.fileSink.log.compactInterval": "100",
}

# Defaults of the file source. A backlog is taken in steps of at most this much, so that a lost step is cheap to repeat;
# later steps take the rest.
MAX_BYTES_PER_TRIGGER = 16_384 * BUFFER_BYTES
# A file is taken however late it shows up; the source's own default would skip one a week older than the newest. The
# driver remembers every file that young: where late files have a bound, pass it.
MAX_FILE_AGE = "36500d"

_CORRUPT = "_corrupt_record"
_END = "__end"
_MARKED = StructType([*READING.fields, StructField(_END, LongType())])
_PARSED = StructType().add("r", ArrayType(_MARKED)).add(_CORRUPT, StringType())


def read_lines(
    spark: SparkSession,
    path: str,
    max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER,
    max_file_age: str = MAX_FILE_AGE,
    archive: str | None = None,
) -> DataFrame:
    """Streaming `value` lines of the files under a directory.

    With `archive`, files move there once they are taken, so that the source stays small to list. Two queries over one
    directory must not both move its files: archive with a single one, or give each a directory of its own.
    """
    reader = spark.readStream.option("maxBytesPerTrigger", max_bytes_per_trigger).option("maxFileAge", max_file_age)
    if archive:
        # A source that archives its files cannot look for them at any depth.
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    else:
        reader = reader.option("recursiveFileLookup", True)
    return reader.text(path)


def readings_of(lines: DataFrame) -> DataFrame:
    """Readings of the lines that hold exactly one reading of the declared types.

    Absent fields are NULL, unknown fields are ignored, blank lines are dropped.
    """
    return _parsed(lines).where(_converted()).select(F.col("r")[1].alias("r")).select(*(f"r.{c}" for c in READING.names))


def errors_of(lines: DataFrame) -> DataFrame:
    """The other lines, unchanged: broken text, a value of the wrong type, more than one object, a field `__end`."""
    return _parsed(lines).where(~_converted()).select("value")


def routed(lines: DataFrame) -> DataFrame:
    """Every line, parsed once: `route` is `raw`, with the reading's columns, or `errors`, with the line in `value`."""
    good = F.coalesce(_converted(), F.lit(False))
    rows = _parsed(lines).select(good.alias("good"), F.col("r")[1].alias("r"), "value")
    readings = [F.when(F.col("good"), F.col(f"r.{c}")).alias(c) for c in READING.names]
    value = F.when(~F.col("good"), F.col("value")).alias("value")
    return rows.select(*readings, value, F.when(F.col("good"), "raw").otherwise("errors").alias("route"))


def ingest_bronze(
    spark: SparkSession,
    source: str | DataFrame,
    bronze: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Starts delivery of readings to `<bronze>/raw`, Snappy Parquet partitioned by UTC `day`.

    `source` is a directory of text files or any streaming frame with a `value` string column. `trigger` takes the
    arguments of `DataStreamWriter.trigger`.
    """
    stream = with_day(readings_of(lines_of(spark, source))).writeStream.format("parquet").partitionBy("day")
    return _start(stream.option("compression", "snappy"), raw_path(bronze), f"{checkpoint.rstrip('/')}/raw", trigger)


def ingest_errors(
    spark: SparkSession,
    source: str | DataFrame,
    bronze: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Starts delivery of the lines that do not convert to `<bronze>/errors`, as text. Arguments as `ingest_bronze`."""
    stream = errors_of(lines_of(spark, source)).writeStream.format("text")
    return _start(stream, errors_path(bronze), f"{checkpoint.rstrip('/')}/errors", trigger)


def lines_of(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """The lines of a directory, or of a streaming frame."""
    return read_lines(spark, source) if isinstance(source, str) else source.select("value")


def _parsed(lines: DataFrame) -> DataFrame:
    # The line is parsed as the middle element of an array: alone, a parser stops at the end of the first object and never
    # sees what follows it on the line. The elements around it hold the line's own hash, so a line that closes the array
    # by itself cannot put others in their place. As a generator's output, the result is computed once; as a projected
    # column it would be pushed into the filter and computed for both.
    mark = F.concat(F.lit(f'{{"{_END}":'), F.xxhash64("value").cast("string"), F.lit("}"))
    wrapped = F.concat(F.lit('{"r":['), mark, F.lit(","), F.col("value"), F.lit(","), mark, F.lit("]}"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    filled = lines.where(F.col("value").rlike(r"\S"))
    return filled.select("value", F.inline(F.array(F.from_json(wrapped, _PARSED, options))))


def _converted():
    own, element = F.xxhash64("value"), lambda i: F.get("r", i)
    marked = (element(0)[_END] == own) & (element(2)[_END] == own) & (F.size("r") == 3)
    single = marked & element(1).isNotNull() & element(1)[_END].isNull()
    return F.col(_CORRUPT).isNull() & F.coalesce(single, F.lit(False))


def _start(stream, path: str, checkpoint: str, trigger: Mapping[str, object] | None) -> StreamingQuery:
    trigger = {"processingTime": BUFFER_INTERVAL} if trigger is None else trigger
    return stream.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)
