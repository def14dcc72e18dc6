"""Small files of a run's bookkeeping, through Spark's own file systems."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Folder:
    """A folder on any Hadoop file system, seen from the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._jpath(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jpath(f"{self.path}/{name}")

    def names(self, sub: str) -> list[str]:
        """Names of the files and folders in ``sub``; none if it is not there."""
        where = self._at(sub)
        return [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []

    def read_json(self, name: str) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/{name}", wholetext=True).first()["value"])

    def write_json(self, name: str, value: dict) -> None:
        """Written beside and renamed: the file is there whole or not at all."""
        sub, _, last = name.rpartition("/")
        draft = self._at(f"{sub}/_{last}")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(value).encode()))
        finally:
            out.close()
        self._fs.delete(self._at(name), False)
        if not self._fs.rename(draft, self._at(name)):
            raise OSError(f"could not write {self.path}/{name}")

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def status(self, file: str) -> list | None:
        """[modification time in ms, length] of any file; None if it is gone."""
        path = self._jpath(file)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return None
        s = fs.getFileStatus(path)
        return [s.getModificationTime(), s.getLen()]
