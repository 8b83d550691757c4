"""JSON readings: one object per line, one array per line, or a pretty-printed array per file."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from sensorloom.schema import READING


def read_json(
    spark: SparkSession, path: str, multiline: bool = False, corrupt_column: str | None = None
) -> DataFrame:
    """Readings of a file or directory.

    Lines holding an object give one row, lines holding an array one row per element. `multiline=True` reads each file
    as one document; such a file cannot be split over tasks, so large inputs belong in the line form.
    With `corrupt_column`, that column holds the text of records that do not parse, otherwise they are NULL rows.
    """
    reader = spark.read.option("multiLine", multiline)
    if corrupt_column is None:
        return reader.schema(READING).json(path)
    schema = StructType([*READING.fields]).add(corrupt_column, StringType())
    return reader.schema(schema).option("columnNameOfCorruptRecord", corrupt_column).json(path)
