"""The few file system calls the snapshot table needs, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        if not self._fs.exists(self._path(path)):
            return []
        return sorted(entry.getPath().getName() for entry in self._fs.listStatus(self._path(path)))

    def size(self, path: str) -> int:
        return int(self._fs.getContentSummary(self._path(path)).getLength())

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a new file whole; False if there is one already."""
        draft = self._path(f"{path}.{self._jvm.java.util.UUID.randomUUID()}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if self._fs.exists(self._path(path)) or not self._fs.rename(draft, self._path(path)):
            self._fs.delete(draft, False)
            return False
        return True

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
