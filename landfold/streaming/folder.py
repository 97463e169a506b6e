"""Small files and listings on whatever file system a path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder seen through Spark's own file system client."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._root = self._hadoop.Path(path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(self._root, name) if name else self._root

    def names(self, name: str = "") -> list[str]:
        at = self._at(name)
        if not self._fs.exists(at):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at))

    def ages(self, name: str = "") -> dict[str, float]:
        """When each entry last changed, in seconds since 1970."""
        at = self._at(name)
        if not self._fs.exists(at):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self._fs.listStatus(at)}

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def size(self, name: str = "") -> int:
        return self._fs.getContentSummary(self._at(name)).getLength()

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write a file that appears whole or not at all, and never replaces another."""
        target = self._at(name)
        draft = self._at(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        if self._fs.exists(target) or not self._fs.rename(draft, target):
            self._fs.delete(draft, False)
            raise FileExistsError(f"{target} was written by someone else")

    def move(self, name: str, to: str, at: float | None = None) -> None:
        """Give an entry another name, and if asked for another modification time (seconds since 1970)."""
        target = self._at(to)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self._at(name), target):
            raise FileNotFoundError(f"cannot move {name} to {target}")
        if at is not None:
            self._fs.setTimes(target, int(at * 1000), -1)

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
