"""Fresh directories and databases for written intermediate data, and their removal."""

import atexit
import logging
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

from sensorloom.sinks import ensure_database

log = logging.getLogger(__name__)

_SHARED = "spark.checkpoint.dir"
_made: dict[str, list[str]] = {"directory": [], "database": []}


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in `spark.checkpoint.dir`. Where none is set, a temporary one, but only with a
    local master: on a cluster, each executor would write to its own disk and read back a part."""
    root = spark.conf.get(_SHARED, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {_SHARED} to a folder that the driver and all executors share (master is {master})")
    return _local_root()


def fresh_directory(spark: SparkSession) -> str:
    """A path nobody has used, not created yet."""
    path = f"{shared_root(spark)}/sensorloom/{uuid.uuid4().hex}"
    _made["directory"].append(path)
    return path


def fresh_database(spark: SparkSession) -> str:
    """A new, empty database under the shared folder."""
    name = f"sensorloom_{uuid.uuid4().hex[:12]}"
    ensure_database(spark, name, fresh_directory(spark))
    _made["database"].append(name)
    return name


def remove(spark: SparkSession, place: str) -> None:
    """Removes a directory, if it is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> int:
    """Removes what this process got from `fresh_directory` and `fresh_database`, and says how many there were. For the
    end of a session, or whenever no frame over them is in use any more."""
    count = 0
    for name in _made["database"]:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    for place in _made["directory"]:
        try:
            remove(spark, place)
        except Exception:
            log.warning("%s is left", place, exc_info=True)  # a store that is not to be reached any more
    for made in _made.values():
        count += len(made)
        made.clear()
    return count


def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="sensorloom-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root
