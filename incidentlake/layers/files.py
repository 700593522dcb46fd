"""Small files and folders of any Hadoop file system, from the driver.

Only listings of one folder and files of a few kilobytes go through here; data
files are read and written by Spark's tasks.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The file system that holds ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        context = spark.sparkContext
        self._jvm = context._jvm
        self._fs = self.path(root).getFileSystem(context._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none where there is no such folder."""
        if not self.exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.path(folder)))

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self._fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> bool:
        return self._fs.rename(self.path(old), self.path(new))

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)
