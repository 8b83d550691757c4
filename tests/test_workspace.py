from pathlib import Path
from types import SimpleNamespace

import pytest

from sensorloom import workspace


def session(conf: dict, checkpoint: str | None = None, master: str = "local[2]"):
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: checkpoint, master=master))


def test_the_folder_the_cluster_names_is_used():
    named = session({"spark.checkpoint.dir": "hdfs://shared/checkpoints/"})
    first, second = workspace.fresh_directory(named), workspace.fresh_directory(named)
    assert first != second
    assert first.startswith("hdfs://shared/checkpoints/sensorloom/")
    assert workspace.shared_root(session({}, "hdfs://set/in/context")) == "hdfs://set/in/context"


def test_a_temporary_folder_only_where_none_is_named():
    assert "/sensorloom-" in workspace.shared_root(session({}))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            workspace.shared_root(session({}, master=master))


def test_release_leaves_nothing(spark):
    path, name = workspace.fresh_directory(spark), workspace.fresh_database(spark)
    spark.range(3).write.parquet(path)
    spark.range(3).write.saveAsTable(f"{name}.t")
    place = spark.catalog.getDatabase(name).locationUri.removeprefix("file:")
    assert workspace.release(spark) >= 3
    assert not Path(path.removeprefix("file:")).exists() and not Path(place).exists()
    assert not spark.catalog.databaseExists(name)
    assert workspace.release(spark) == 0


def test_fresh_databases_are_empty_and_lie_in_the_folder(spark):
    first, second = workspace.fresh_database(spark), workspace.fresh_database(spark)
    assert first != second
    for name in (first, second):
        assert spark.sql(f"SHOW TABLES IN {name}").where("NOT isTemporary").count() == 0
        place = spark.catalog.getDatabase(name).locationUri.removeprefix("file:")
        assert place.startswith(workspace.shared_root(spark).removeprefix("file:"))
        spark.sql(f"DROP DATABASE {name}")
