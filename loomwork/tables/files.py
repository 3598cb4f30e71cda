"""Files of a table through Hadoop's file systems, so that any shared store works."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class File:
    path: str
    size: int


class Store:
    """A folder on whatever file system its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path.rstrip("/")
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name if "/" in name and self._absolute(name) else f"{self.path}/{name}")

    @staticmethod
    def _absolute(name: str) -> bool:
        return name.startswith("/") or ":" in name.split("/", 1)[0]

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def files(self, name: str = "") -> list[File]:
        """Data files below a folder, without hidden ones and those in hidden folders, by path."""
        root = self._at(name) if name else self._root
        if not self._fs.exists(root):
            return []
        found = []
        listing = self._fs.listFiles(root, True)
        prefix = self._fs.makeQualified(root).toString().rstrip("/") + "/"
        while listing.hasNext():
            status = listing.next()
            path = status.getPath().toString()
            inside = path[len(prefix) :] if path.startswith(prefix) else path.rsplit("/", 1)[-1]
            if not any(part[:1] == "." or part[:1] == "_" and "=" not in part for part in inside.split("/")):
                found.append(File(path, status.getLen()))
        return sorted(found, key=lambda f: f.path)

    def names(self, name: str) -> list[str]:
        """Names directly below a folder."""
        folder = self._at(name)
        if not self._fs.exists(folder):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(folder))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a small file that must not exist yet; False if it does.

        The file appears with its content or not at all: it is written aside and
        renamed, and renaming onto a file fails.
        """
        place = self._at(name)
        self._fs.mkdirs(place.getParent())
        if self._fs.exists(place):
            return False
        unique = self._jvm.java.util.UUID.randomUUID().toString()
        aside = self._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}-{unique}")
        stream = self._fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._fs.rename(aside, place):
            return True
        self._fs.delete(aside, False)
        return False

    def move(self, source: str, target: str) -> bool:
        place = self._at(target)
        self._fs.mkdirs(place.getParent())
        return self._fs.rename(self._at(source), place)

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
