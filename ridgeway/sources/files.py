"""Small files in a folder that Spark reaches: listed, read and committed through Hadoop's file system API."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class SharedFolder:
    """Driver-side only: names and small texts, never data."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def names(self) -> list[str]:
        """Committed files, in name order; one listing."""
        if not self._fs.exists(self._root):
            return []
        return sorted(n for n in (s.getPath().getName() for s in self._fs.listStatus(self._root)) if not n.startswith(("_", ".")))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def commit(self, name: str, text: str) -> None:
        """Write under another name, then rename: a file is there whole or not at all."""
        self._fs.mkdirs(self._root)
        if self._fs.exists(self._at(name)):
            raise FileExistsError(f"{self.path}/{name}")
        temp = self._at(f"_{uuid.uuid4().hex}")
        out = self._fs.create(temp, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        if not self._fs.rename(temp, self._at(name)):
            raise OSError(f"could not commit {self.path}/{name}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), False)
