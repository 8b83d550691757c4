"""Spark sessions for the jobs."""

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Starting point of every adaptive shuffle. Adaptive execution merges small partitions but never adds any, so on a big
# input the number has to start high; three per core keeps all cores busy to the end.
MIN_INITIAL_PARTITIONS = 2_000
PARTITIONS_PER_CORE = 3

SCAN_CONF = {
    # The jobs read two to five of nine columns: larger splits give a task as many bytes to read as usual.
    "spark.sql.files.maxPartitionBytes": "256MB",
}

_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(
    app: str,
    catalog: str | None = None,
    warehouse: str | None = None,
    conf: Mapping[str, str] | None = None,
    catalog_type: str = "glue",
) -> SparkSession:
    """Session with an optional named Iceberg catalog; whatever `conf` says wins.

    The session time zone is left alone: no figure depends on it.
    """
    settings = dict(SCAN_CONF)
    if catalog:
        settings |= iceberg_conf(catalog, warehouse, catalog_type)
    elif warehouse:
        settings["spark.sql.warehouse.dir"] = warehouse
    settings |= conf or {}
    spark = SparkSession.builder.appName(app).config(map=settings).getOrCreate()
    if spark.conf.get(_INITIAL, None) is None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(_INITIAL, str(max(MIN_INITIAL_PARTITIONS, PARTITIONS_PER_CORE * cores)))
    return spark


def iceberg_conf(catalog: str, warehouse: str | None, catalog_type: str = "glue") -> dict[str, str]:
    """Settings of a named Iceberg catalog: `glue` (on S3) or `hadoop` (a directory). Needs the Iceberg runtime jar."""
    prefix = f"spark.sql.catalog.{catalog}"
    settings = {
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
    }
    if warehouse:
        settings[f"{prefix}.warehouse"] = warehouse
    if catalog_type == "glue":
        settings[f"{prefix}.catalog-impl"] = "org.apache.iceberg.aws.glue.GlueCatalog"
        settings[f"{prefix}.io-impl"] = "org.apache.iceberg.aws.s3.S3FileIO"
    elif catalog_type == "hadoop":
        settings[f"{prefix}.type"] = "hadoop"
    else:
        raise ValueError(f"unknown catalog type: {catalog_type}")
    return settings
