"""A folder seen from the driver through Hadoop's FileSystem, so it works
wherever Spark writes.

Listing decides whether something exists; any other error is raised, never
taken for "not there".
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._jvm, conf = jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(conf)

    @property
    def is_local(self) -> bool:
        return self._fs.getScheme() == "file"

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Names in a folder; empty if the folder does not exist."""
        if not self._fs.exists(self._at(name)):
            return []
        paths = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(self._fs.listStatus(self._at(name)))
        joined = self._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(paths).mkString("\0")   # one call for all
        return sorted(p.rsplit("/", 1)[-1] for p in joined.split("\0")) if joined else []

    def read(self, name: str) -> dict:
        stream = self._fs.open(self._at(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def write(self, name: str, value: dict) -> None:
        """Write a small file anew or over an old one."""
        stream = self._fs.create(self._at(name), True)
        try:
            stream.write(bytearray(json.dumps(value).encode("utf-8")))
        finally:
            stream.close()

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)
