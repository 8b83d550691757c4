"""Numbered commits: files that are created once and never changed, in a directory of their own.

A commit is written under a name nobody else uses and then renamed to its number, which fails where that number is taken. So
of two writers that both saw number `n` as the last, one becomes `n + 1` and the other is told. What a rename guarantees
is the file system's affair: HDFS makes it atomic; a local disk checks and then renames; object stores need a committer
that makes the same promise.
"""

import json
import uuid

from pyspark.sql import SparkSession

_DIGITS = 12


class CommitLog:
    """The commits under a directory, each a JSON value."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark, self.directory = spark, directory.rstrip("/")

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.directory}/{name}")

    def _fs(self):
        return self._path("x").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """All commits in order."""
        directory = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.directory)
        fs = self._fs()
        names = [s.getPath().getName() for s in fs.listStatus(directory)] if fs.exists(directory) else []
        return sorted(int(name) for name in names if name.isdigit())

    def last(self) -> int:
        """The last commit's number; 0 for none."""
        return max(self.numbers(), default=0)

    def read(self, number: int):
        stream = self._fs().open(self._path(f"{number:0{_DIGITS}d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def create(self, number: int, value) -> bool:
        """Makes this commit, unless somebody has made it or a later one: then nothing changes, and the answer is false."""
        jvm = self.spark.sparkContext._jvm
        part, target = self._path(f"_{uuid.uuid4().hex}"), self._path(f"{number:0{_DIGITS}d}")
        fs = self._fs()
        if self.last() >= number:  # this one may have been made and removed since
            return False
        stream = fs.create(part, False)
        stream.write(json.dumps(value).encode())
        stream.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(rename, 1)
        none[0] = rename.NONE
        try:
            files.rename(fs.makeQualified(part), fs.makeQualified(target), none)
        except Exception:
            fs.delete(part, False)
            if fs.exists(target):
                return False
            raise
        return True

    def remove(self, number: int) -> None:
        self._fs().delete(self._path(f"{number:0{_DIGITS}d}"), False)
