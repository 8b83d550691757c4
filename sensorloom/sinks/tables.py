"""Catalog tables whose whole content each run replaces.

Two kinds of table are served:

* snapshot formats (Iceberg): `writeTo(...).overwritePartitions()`, which commits atomically;
* Parquet tables: every run writes a fresh version directory beside the earlier ones, commits it under the next number and
  then repoints the table with one catalog call. Readers see the old content or the new, never a mixture; a failed run
  leaves the table alone; and a frame opened before the swap keeps reading its version as long as that is kept. Of two
  runs at once, one gets the number. The other raises, or commits its own whole result after it; either way the table
  ends on the version of the last commit, whoever makes the catalog call last, and no version is forgotten.
"""

import logging
import re
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorloom.commits import CommitLog

log = logging.getLogger(__name__)

_VERSION = re.compile(r"v-(\d{8}T\d{12})-[0-9a-f]{8}")
_VERSION_TIME = "%Y%m%dT%H%M%S%f"


class ConcurrentReplace(RuntimeError):
    """Another run replaced the table while this one was writing."""


def ensure_database(spark: SparkSession, database: str, warehouse: str | None = None) -> None:
    """Creates the database if absent; in the built-in catalog, under `warehouse` when one is given."""
    parts = database.split(".")
    place = f" LOCATION '{_literal(warehouse.rstrip('/'))}/{parts[-1]}.db'" if warehouse and len(parts) == 1 else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{place}")


def ensure_table(spark: SparkSession, table: str, schema: StructType, fmt: str = "parquet") -> None:
    """Creates the table if absent, with exactly the declared columns, unpartitioned."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    place = ""
    if fmt == "parquet" and not spark.catalog.tableExists(_quoted(table)):
        # A first version without files, so that the table never points at the directory holding the versions.
        first = f"{_table_root(spark, table)}/{_new_version()}"
        path, fs = _hadoop_path(spark, first)
        fs.mkdirs(path)
        place = f" LOCATION '{_literal(first)}'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({columns}) USING {fmt}{place}")


def replace_table(
    df: DataFrame,
    table: str,
    allow_empty: bool = False,
    keep: int = 2,
    min_age: timedelta = timedelta(days=1),
    on_conflict: str = "retry",
) -> bool:
    """Makes `df` the whole content of an existing table; says whether it did.

    Columns are matched by name and cast to the table's types. An empty result keeps the old content, as a mistyped
    input path must not wipe a table, unless `allow_empty`; a job that has looked at its input passes that. For Parquet
    tables, the frame is evaluated once.

    A Parquet table keeps its newest `keep` versions, the current one among them. An older one goes once it was superseded
    `min_age` ago, which gives readers that still hold it time to end. Only versions that were published and superseded
    are ever removed, however old others are: a version that is being written is none of these. What failed runs left
    behind goes by `remove_leftovers`.

    Where another run has replaced the table since this one began, `on_conflict="raise"` raises `ConcurrentReplace` and
    leaves that run's content; with "retry", this run's content follows it, as if it had begun later.
    """
    if on_conflict not in ("retry", "raise"):
        raise ValueError(f"on_conflict is retry or raise, not {on_conflict}")
    spark = df.sparkSession
    target = spark.table(_quoted(table)).schema
    df = df.select(*(F.col(f"`{field.name}`").cast(field.dataType).alias(field.name) for field in target))
    described = _describe(spark, table)
    if described.get("Provider", "").lower() == "parquet":
        return _replace_version(spark, df, table, described["Location"], allow_empty, keep, min_age, on_conflict)
    return _replace_snapshot(df, table, allow_empty)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of the database, without the session's temporary views."""
    return spark.sql(f"SHOW TABLES IN {_quoted(database)}").where(~F.col("isTemporary"))


def sample_table(spark: SparkSession, table: str, n: int = 5) -> DataFrame:
    """Any `n` rows of the table; they are gathered in one task, so `n` has to be small."""
    return spark.table(_quoted(table)).limit(n)


def _replace_version(
    spark: SparkSession,
    df: DataFrame,
    table: str,
    location: str,
    allow_empty: bool,
    keep: int,
    min_age: timedelta,
    on_conflict: str,
) -> bool:
    root = _version_root(location)
    commits = _commits(spark, root)
    number = commits.last() + 1
    target = f"{root}/{_new_version()}"
    df.write.parquet(target)
    if not allow_empty and spark.read.schema(df.schema).parquet(target).isEmpty():
        log.warning("%s: empty result, old content kept", table)
        _delete(spark, target)
        return False
    before = location.rstrip("/").rpartition("/")[2]
    commit = {"version": target.rpartition("/")[2], "before": before if _VERSION.fullmatch(before) else None}
    while not commits.create(number, commit | {"second": datetime.now(timezone.utc).timestamp()}):
        if on_conflict == "raise":
            _delete(spark, target)
            raise ConcurrentReplace(f"{table} was replaced by another run")
        number = max(commits.last(), number) + 1
    _point(spark, table, root, commits, number)
    _drop_superseded(spark, root, commits, keep, min_age)
    return True


def _point(spark: SparkSession, table: str, root: str, commits: CommitLog, number: int) -> None:
    """Points the table at the last commit's version. Whoever committed looks again after its call: a call that was
    overtaken is made good by the run that made it."""
    while True:
        version = commits.read(number)["version"]
        spark.sql(f"ALTER TABLE {_quoted(table)} SET LOCATION '{_literal(f'{root}/{version}')}'")
        last = commits.last()
        if last == number:
            return
        number = last


def _commits(spark: SparkSession, root: str) -> CommitLog:
    parent, _, name = root.rpartition("/")
    return CommitLog(spark, f"{parent}/_commits/{name}")


def _replace_snapshot(df: DataFrame, table: str, allow_empty: bool) -> bool:
    if not allow_empty and df.isEmpty():
        log.warning("%s: empty result, old content kept", table)
        return False
    df.writeTo(_quoted(table)).overwritePartitions()
    return True


def _drop_superseded(spark: SparkSession, root: str, commits: CommitLog, keep: int, min_age: timedelta) -> None:
    """Removes the versions that were superseded long enough ago, and their commits. The next commit says when."""
    try:
        found = [(number, commits.read(number)) for number in commits.numbers()]
    except Exception:
        log.info("%s: another run is cleaning up", root)
        return
    published = [(None, found[0][1]["before"]), *((number, commit["version"]) for number, commit in found)]
    limit = datetime.now(timezone.utc).timestamp() - min_age.total_seconds()
    old = published[: max(len(published) - keep, 0)]
    for (number, version), (_, following) in zip(old, found):
        if following["second"] > limit:
            break
        if version:
            _delete(spark, f"{root}/{version}")
        if number:
            commits.remove(number)


def remove_leftovers(spark: SparkSession, table: str) -> list[str]:
    """Removes version directories that the table neither points at nor a commit names, and names them: what
    failed runs left. For maintenance, while nothing writes to the table: a running write cannot be told from a dead one.
    """
    location = _describe(spark, table)["Location"]
    root, known = _version_root(location), {location.rstrip("/").rpartition("/")[2]}
    commits = _commits(spark, root)
    for number in commits.numbers():
        commit = commits.read(number)
        known |= {commit["version"], commit["before"]}
    path, fs = _hadoop_path(spark, root)
    names = [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []
    gone = sorted(name for name in names if _VERSION.fullmatch(name) and name not in known)
    for name in gone:
        _delete(spark, f"{root}/{name}")
    return gone


def _new_version() -> str:
    return f"v-{datetime.now(timezone.utc).strftime(_VERSION_TIME)}-{uuid.uuid4().hex[:8]}"


def _version_root(location: str) -> str:
    parent, _, name = location.rstrip("/").rpartition("/")
    # A table somebody else created lies in a directory of its own; versions then go beside that directory.
    return parent if _VERSION.fullmatch(name) else f"{location.rstrip('/')}_versions"


def _table_root(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    place = spark.catalog.getDatabase(_quoted(database) if database else spark.catalog.currentDatabase()).locationUri
    return f"{place.rstrip('/')}/{name}"


def _describe(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").collect()
    # The table's own entries follow its columns, one of which might bear such a name.
    return {row["col_name"]: row["data_type"] for row in rows if row["col_name"] in ("Provider", "Location")}


def _hadoop_path(spark: SparkSession, path: str):
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(context._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _hadoop_path(spark, path)
    fs.delete(hadoop_path, True)


def _quoted(name: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def _literal(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
