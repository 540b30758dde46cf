"""Small files next to tables, in whatever store Spark reads."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder in whatever store Spark reads."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.hadoop = self.jvm.org.apache.hadoop.fs
        self.settings = spark._jsc.hadoopConfiguration()
        self.files = self.at().getFileSystem(self.settings)

    def at(self, name: str = ""):
        return self.hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "", folders: bool = False) -> list[str]:
        """Files (or folders) directly below, none if there is nothing."""
        if not self.files.exists(self.at(name)):
            return []
        found = self.files.listStatus(self.at(name))
        return sorted(s.getPath().getName() for s in found if s.isDirectory() == folders)

    def read(self, name: str) -> str:
        stream = self.files.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write a file and move it into place, over one of that name."""
        new = self.at(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.files.create(new)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        place = getattr(self.hadoop, "Options$Rename")
        options = self.jvm.java.lang.reflect.Array.newInstance(place.OVERWRITE.getClass(), 1)
        options[0] = place.OVERWRITE
        context = self.hadoop.FileContext.getFileContext(self.files.getUri(), self.settings)
        context.rename(self.files.makeQualified(new), self.files.makeQualified(self.at(name)), options)

    def delete(self, name: str) -> None:
        self.files.delete(self.at(name), True)
