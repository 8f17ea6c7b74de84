"""Small text files (manifests, ledger entries) on any Hadoop file system.

They are read and written by the driver through the file system that Spark uses
for the same path, so object stores and remote paths work as they do for tables.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder of small files.  ``path`` may be any path that Spark can read."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._at("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Names in the folder, sorted; none if there is no such folder."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at(name)))

    def size(self) -> int:
        """Bytes of all files at or under the path (a pattern may name several)."""
        found = self._fs.globStatus(self._at("")) or []
        return sum(int(self._fs.getContentSummary(s.getPath()).getLength()) for s in found)

    def files(self) -> list[tuple[str, int, int]]:
        """(path below the folder, bytes, time changed) of all data files at any depth;
        names that begin with _ or . are not data.  Of a file: the file itself."""
        if not self.exists():
            return []
        root = self._fs.makeQualified(self._at("")).toUri().getPath()
        found, left = [], self._fs.listFiles(self._at(""), True)
        while left.hasNext():
            status = left.next()
            name = status.getPath().toUri().getPath()[len(root) :].lstrip("/")
            if not any(part[:1] in ("_", ".") for part in name.split("/")):
                found.append((name, int(status.getLen()), int(status.getModificationTime())))
        return sorted(found)

    def modified(self, name: str) -> float:
        """When the file or folder last changed, in seconds since 1970."""
        return self._fs.getFileStatus(self._at(name)).getModificationTime() / 1000

    def read(self, name: str) -> str | None:
        """The file's text, or None if there is no such file; empty if its writer
        was stopped and the file system finds it damaged."""
        if not self.exists(name):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        except Py4JJavaError as error:
            if "ChecksumException" in error.java_exception.getClass().getName():
                return ""
            raise
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False (and nothing written) if the name is taken."""
        if self.exists(name):
            return False
        try:
            stream = self._fs.create(self._at(name), False)
        except Exception:
            if self.exists(name):  # another writer was first
                return False
            raise
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
