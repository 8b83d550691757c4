"""Small helpers that all operators share."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.workspace import fresh_directory

# White space as the contracts name it: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"


def text_of(column: str):
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def quoted(name: str) -> str:
    """A column's name as Spark takes it, whatever characters it holds."""
    return f"`{name.replace('`', '``')}`"


def whole_row(df: DataFrame):
    """All columns as one struct: beside it, columns of our own clash with none of them."""
    return F.struct(*(F.col(quoted(c)).alias(c) for c in df.columns))


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: lineage ends here, and what reads it more than
    once computes it once."""
    path = path or fresh_directory(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
