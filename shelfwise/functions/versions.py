"""Numbered versions of a folder: each is published once, against the one it was built on."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class StaleVersion(RuntimeError):
    """Another writer published first; nothing of it was changed."""


class Versions:
    """Small JSON entries ``<folder>/versions/<number>.json``; the highest number is current.

    An entry is created exclusively, so of several writers that read the same version one
    publishes the next and the others raise. This needs a file system with exclusive creation (HDFS
    and local ones have it).
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm = spark.sparkContext._jvm
        self.new_array = spark.sparkContext._gateway.new_array
        self.folder = self.jvm.org.apache.hadoop.fs.Path(f"{folder}/versions")
        self.fs = self.folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _entry(self, number: int):
        return self.jvm.org.apache.hadoop.fs.Path(self.folder, f"{number:09d}.json")

    def latest(self) -> tuple[int, dict]:
        """Number and content of the current version; 0 and nothing before the first."""
        names = [f.getPath().getName() for f in self.fs.listStatus(self.folder)
                 ] if self.fs.exists(self.folder) else []
        numbers = sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()),
                         reverse=True)
        for number in numbers:
            stream = self.fs.open(self._entry(number))
            try:
                text = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
            if text:  # else its writer is at it just now
                return number, json.loads(text)
        return 0, {}

    def publish(self, base: int, content: dict) -> int:
        """Make ``content`` the version after ``base``."""
        entry, data = self._entry(base + 1), json.dumps(content).encode()
        self.fs.mkdirs(self.folder)
        if self.latest()[0] != base:
            raise StaleVersion(f"version {base} is no longer the latest of {self.folder}")
        try:
            if self.fs.getScheme() == "file":
                path = self.jvm.java.nio.file.Paths.get(entry.toUri().getPath(), self._array([]))
                self.jvm.java.nio.file.Files.write(path, data, self._array(
                    [self.jvm.java.nio.file.StandardOpenOption.CREATE_NEW,
                     self.jvm.java.nio.file.StandardOpenOption.WRITE],
                    self.jvm.java.nio.file.OpenOption))
            else:
                stream = self.fs.create(entry, False)
                stream.write(data)
                stream.close()
        except Exception as error:
            if self.fs.exists(entry):
                raise StaleVersion(f"version {base + 1} of {self.folder} is taken") from error
            raise
        return base + 1

    def _array(self, items: list, kind=None):
        array = self.new_array(kind or self.jvm.java.lang.String, len(items))
        for i, item in enumerate(items):
            array[i] = item
        return array
