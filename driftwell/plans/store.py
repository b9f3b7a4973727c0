"""Small text files beside tables, by way of Spark's own file systems."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        p, fs = self._path(path)
        return fs.exists(p)

    def read(self, path: str) -> str:
        p, fs = self._path(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Written aside, then moved into place."""
        aside, fs = self._path(f"{path}.{uuid.uuid4().hex}")
        fs.mkdirs(aside.getParent())
        stream = fs.create(aside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        p, _ = self._path(path)
        if not fs.rename(aside, p):  # some file systems don't replace
            fs.delete(p, False)
            fs.rename(aside, p)

    def touch(self, path: str) -> None:
        """An empty file, where nobody looks yet."""
        p, fs = self._path(path)
        fs.create(p, True).close()

    def make(self, path: str) -> None:
        p, fs = self._path(path)
        fs.mkdirs(p)

    def delete(self, path: str) -> None:
        p, fs = self._path(path)
        fs.delete(p, True)

    def rename(self, old: str, new: str) -> None:
        p, fs = self._path(old)
        q, _ = self._path(new)
        fs.mkdirs(q.getParent())
        if fs.exists(q) or not fs.rename(p, q):  # onto a folder would be into it
            raise OSError(f"{old} can't be moved to {new}")

    def names(self, path: str) -> list[str]:
        p, fs = self._path(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
