"""Files and folders on any file system Spark can write to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """The few file operations that committing needs; names are relative to the folder."""

    def __init__(self, spark: SparkSession, path: str):
        self._files = spark._jvm.org.apache.hadoop.fs
        self._spark = spark
        self.path = self._files.Path(path)
        self.system = self.path.getFileSystem(spark._jsc.hadoopConfiguration())
        self.root = self.system.makeQualified(self.path).toString()

    def at(self, name: str):
        return self._files.Path(f"{self.root}/{name}")

    def names(self, name: str = "") -> list[str]:
        path = self.at(name) if name else self.path
        if not self.system.exists(path):
            return []
        return [x.getPath().getName() for x in self.system.listStatus(path)]

    def files(self, name: str) -> list[str]:
        """Paths of all files below a folder, relative to it."""
        path = self.at(name)
        if not self.system.exists(path):
            return []
        found, within = [], len(path.toString()) + 1
        left = self.system.listFiles(path, True)
        while left.hasNext():
            found.append(left.next().getPath().toString()[within:])
        return found

    def size(self, name: str) -> int:
        return self.system.getContentSummary(self.at(name)).getLength()

    def read(self, name: str) -> str:
        stream = self.system.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file appears whole, under a name that must be new."""
        part = self.at(f"_part-{uuid.uuid4().hex}")
        stream = self.system.create(part, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(part, self.at(name))

    def move(self, source, target) -> None:
        self.system.mkdirs(target.getParent())
        if self.system.exists(target):
            raise FileExistsError(target.toString())
        self.rename(source, target)

    def make(self, name: str) -> None:
        self.system.mkdirs(self.at(name))

    def rename(self, source, target) -> None:
        if not self.system.rename(source, target):
            raise OSError(f"{source.toString()} could not be moved to {target.toString()}")

    def delete(self, name: str) -> None:
        self.system.delete(self.at(name), True)
