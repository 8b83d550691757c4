"""Daily figures kept up to date: only bronze files not counted yet are read, and only days they touch are written.

Counts, sums, least and greatest values of disjoint sets of readings add up, so a day's figures are kept as such partial
sums. An update is a generation:

    <state>/counted/generation=<n>/...             the names of the bronze files it counted
    <state>/sums/generation=<n>/day=<day>/...      the partial sums of the days it touched, earlier ones included

and then commits. Readers take each day from the last committed generation that has it. A run that dies before its commit
is not seen and its directory is replaced; of two runs at once, one commits and the other raises, so nothing is counted
twice. Directories of days that an update does not touch stay as they are.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from sensorloom.commits import CommitLog
from sensorloom.functions import day_number
from sensorloom.sources import read_bronze
from sensorloom.workspace import remove

_VALUES = {"temp": "temperature", "humidity": "humidity"}
_KEYS = ["day", "latitude", "longitude", "event_type"]
_SUMS = StructType(
    [
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("event_type", StringType()),
        StructField("n", LongType()),
        *(
            StructField(f"{figure}_{short}", LongType() if figure == "n" else DoubleType())
            for short in _VALUES
            for figure in ("n", "sum", "min", "max")
        ),
        StructField("generation", LongType()),
        StructField("day", DateType()),
    ]
)


class ConcurrentUpdate(RuntimeError):
    """Another run has updated the same state meanwhile."""


def _log(spark: SparkSession, state: str) -> CommitLog:
    return CommitLog(spark, f"{state.rstrip('/')}/_generations")


def update(spark: SparkSession, bronze: str, state: str) -> int:
    """Counts the bronze files that are new since the last update; says how many there were.

    Bronze files are taken as they are named: one that is rewritten under its name is not counted again, and one that was
    compacted into another would be counted twice, so a compacted bronze needs a new state.
    """
    commits = _log(spark, state)
    last = commits.last()
    names = read_bronze(spark, bronze).inputFiles()
    files = spark.createDataFrame([(name,) for name in sorted(names)], "file string")
    if last:
        files = files.join(_counted(spark, state, last), "file", "left_anti")
    new = sorted(row["file"] for row in files.collect())
    if not new:
        return 0
    # By name, at any depth and whatever the directories mean; each day is the reading's own.
    readings = spark.read.schema(read_bronze(spark, bronze).schema).option("recursiveFileLookup", True).parquet(*new)
    place = lambda kind: f"{state.rstrip('/')}/{kind}/generation={last + 1}"
    files = spark.createDataFrame([(name,) for name in new], "file string")
    files.coalesce(1).write.mode("overwrite").parquet(place("counted"))
    fresh = _sums_of(readings)
    if last:
        # Read twice: for the days, and for the sums.
        fresh.write.mode("overwrite").parquet(place("fresh"))
        fresh = spark.read.schema(fresh.schema).parquet(place("fresh"))
        days = fresh.select("day").distinct()
        # A null day is a day, too.
        earlier = _sums(spark, state, last).alias("e").join(days.alias("d"), F.expr("e.day <=> d.day"), "left_semi")
        fresh = _merged(fresh.unionByName(earlier.select(*fresh.columns)))
    fresh.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(place("sums"))
    if last:
        remove(spark, place("fresh"))
    if not commits.create(last + 1, {"files": len(new)}):
        raise ConcurrentUpdate(f"{state} was updated by another run")
    return len(new)


def event_counts(spark: SparkSession, state: str) -> DataFrame:
    """`operators.kpis.event_counts` of all bronze files counted so far."""
    sums = current_sums(spark, state).groupBy("day", "event_type").agg(F.sum("n").alias("event_count"))
    return sums.withColumn("day", F.col("day").cast("string"))


def temp_humidity(spark: SparkSession, state: str) -> DataFrame:
    """`operators.kpis.temp_humidity` of all bronze files counted so far; sums of doubles in another order."""
    grouped = _merged(current_sums(spark, state), ["day", "latitude", "longitude"])
    figures: list[Column] = []
    for short in _VALUES:
        average = F.col(f"sum_{short}") / F.when(F.col(f"n_{short}") > 0, F.col(f"n_{short}"))
        figures += [average.alias(f"avg_{short}"), F.col(f"min_{short}"), F.col(f"max_{short}")]
    return grouped.select(F.col("day").cast("string").alias("day"), "latitude", "longitude", *figures)


def current_sums(spark: SparkSession, state: str) -> DataFrame:
    """The partial sums of all days, by day, place and event type."""
    last = _log(spark, state).last()
    if not last:
        return spark.createDataFrame([], _SUMS).drop("generation")
    return _sums(spark, state, last)


def _sums(spark: SparkSession, state: str, last: int) -> DataFrame:
    """Each day from the last generation that has it: directories say which, so the others' files are not read."""
    rows = spark.read.schema(_SUMS).parquet(f"{state.rstrip('/')}/sums").where(F.col("generation") <= last)
    newest = rows.groupBy("day").agg(F.max("generation").alias("newest"))
    joined = rows.alias("r").join(newest.alias("n"), F.expr("r.day <=> n.day and r.generation = n.newest"), "left_semi")
    return joined.drop("generation")


def _counted(spark: SparkSession, state: str, last: int) -> DataFrame:
    rows = spark.read.schema("file string, generation bigint").parquet(f"{state.rstrip('/')}/counted")
    return rows.where(F.col("generation") <= last).select("file")


def _sums_of(readings: DataFrame) -> DataFrame:
    figures = [F.count("*").alias("n")]
    for short, column in _VALUES.items():
        named = {"n": F.count(column), "sum": F.sum(column), "min": F.min(column), "max": F.max(column)}
        figures += [figure.alias(f"{name}_{short}") for name, figure in named.items()]
    places = [F.col("location.latitude").alias("latitude"), F.col("location.longitude").alias("longitude")]
    grouped = readings.groupBy(day_number("timestamp").alias("day"), *places, "event_type").agg(*figures)
    return grouped.withColumn("day", F.date_from_unix_date("day"))


def _merged(sums: DataFrame, keys: list[str] = _KEYS) -> DataFrame:
    figures = [F.sum("n").alias("n")]
    for short in _VALUES:
        named = {"n": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
        figures += [figure(f"{name}_{short}").alias(f"{name}_{short}") for name, figure in named.items()]
    return sums.groupBy(*keys).agg(*figures)
