"""Folders and small records on the tables' file system, through Spark's own file system client."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


class Store:
    """The file system that holds a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._at = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none where there is no such folder."""
        path = self._at(folder)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def files(self, folder: str) -> dict[str, int]:
        """Whole paths and sizes of the data files in a folder; hidden ones are passed over."""
        path = self._at(folder)
        found = self._fs.listStatus(path) if self._fs.exists(path) else []
        return {f.getPath().toString(): f.getLen() for f in found if f.isFile() and f.getPath().getName()[0] not in "._"}

    def path_of(self, uri: str) -> str:
        """The path behind a file's URI as scans report it, in which odd characters are escaped."""
        return self._at(self._jvm.java.net.URI(uri)).toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._at(path))

    def is_folder(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self._at(path)).isDirectory()

    def remove(self, path: str) -> None:
        """Remove a file or folder; nothing happens where it is gone already."""
        self._fs.delete(self._at(path), True)

    def move(self, source: str, target: str) -> None:
        """Rename to a place that is free; its parent is made if missing."""
        parent = self._at(target).getParent()
        self._fs.mkdirs(parent)
        if not self._fs.rename(self._at(source), self._at(target)):
            raise OSError(f"cannot move {source} to {target}")

    def write_new(self, path: str, record: dict) -> bool:
        """Write a record that does not exist yet; False where another has written it first."""
        try:
            out = self._fs.create(self._at(path), False)
        except Exception as error:  # the client's own exception class differs by store
            if self.exists(path):
                return False
            raise error
        try:
            out.write(json.dumps(record).encode())
        finally:
            out.close()
        return True

    def replace(self, path: str, record: dict) -> None:
        """Write a record over an older one. A reader finds one of the two, or, between the steps, the new one beside its place."""
        fresh = f"{path}.new"
        self.remove(fresh)
        self.write_new(fresh, record)
        self.remove(path)
        self.move(fresh, path)

    def read(self, path: str) -> dict | None:
        """The record, that of an unfinished replace() included, or None."""
        for place in (path, f"{path}.new"):
            if self.exists(place):
                text = self._text(place)
                try:
                    return json.loads(text)
                except ValueError:  # its writer was lost before it was whole
                    continue
        return None

    def _text(self, path: str) -> str:
        stream = self._fs.open(self._at(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
