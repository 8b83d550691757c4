"""Bronze: typed Parquet readings under `<bronze>/raw`."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DateType, StructField, StructType

from sensorloom.schema import READING

READING_OF_DAY = StructType([*READING.fields, StructField("day", DateType())])


def raw_path(bronze: str) -> str:
    return f"{bronze.rstrip('/')}/raw"


def errors_path(bronze: str) -> str:
    return f"{bronze.rstrip('/')}/errors"


def read_bronze(spark: SparkSession, bronze: str, partitioned: bool = False) -> DataFrame:
    """Readings under `<bronze>/raw`.

    By default every file at any depth is read, whatever the directories mean. That switches off partition discovery, so
    a layout written by our own ingest is better read with `partitioned=True`: the frame then has the directory value as
    `day` too (a date), filters on it prune directories, and it can be passed to the daily key figures. A bronze that
    nothing was written to yet is an empty frame.
    """
    if not partitioned:
        return spark.read.schema(READING).option("recursiveFileLookup", True).parquet(raw_path(bronze))
    names = _names(spark, raw_path(bronze))
    if not any(name.startswith("day=") for name in names):
        if any(not name.startswith(("_", ".")) for name in names):
            raise ValueError(f"{raw_path(bronze)} is not partitioned by day")
        return spark.createDataFrame([], READING_OF_DAY)
    return spark.read.schema(READING_OF_DAY).parquet(raw_path(bronze))


def write_bronze(readings: DataFrame, bronze: str) -> None:
    """Writes readings with a `day` column as a new partitioned bronze.

    Rows are brought together by day first, so a day's files follow its size, not the number of tasks: small days share
    none, and a day with most of the rows is split over many tasks. Each wrongly stamped day opens a directory of its own.
    """
    readings.hint("rebalance", "day").write.partitionBy("day").parquet(raw_path(bronze))


def compact_bronze(spark: SparkSession, bronze: str, target: str) -> None:
    """Writes the readings of a partitioned bronze, of however many small files, to a new bronze at `target`.

    The old one is left as it is, so its readers see no change; whoever starts on `target` sees the new one alone. Point
    jobs at `target` when this returns, and ingest too, with a new checkpoint, if it goes on.
    """
    write_bronze(read_bronze(spark, bronze, partitioned=True), target)


def _names(spark: SparkSession, path: str) -> list[str]:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []
