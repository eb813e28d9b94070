"""Small files and folder listings, in whatever file system Spark's paths lie."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


class Files:
    """The driver's view of a store, through the Hadoop client that Spark itself uses."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def names(self, folder: str) -> list[str]:
        """What a folder holds; nothing if there is none."""
        fs, where = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def read(self, path: str) -> str:
        fs, where = self._at(path)
        stream = fs.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Make a file appear whole under a name nobody has taken; False if it is taken.

        The text is written aside first. Locally a hard link takes the name, elsewhere
        a rename that the file system refuses if the name exists.
        """
        folder, _, name = path.rpartition("/")
        fs, aside = self._at(f"{folder}/.{name}.{uuid.uuid4().hex}")
        stream = fs.create(aside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        _, where = self._at(path)
        if fs.getScheme() != "file":
            done = not fs.exists(where) and fs.rename(aside, where)
        else:
            try:
                os.link(aside.toUri().getPath(), where.toUri().getPath())
                done = True
            except FileExistsError:
                done = False
        fs.delete(aside, False)
        return done

    def size(self, path: str) -> int:
        """Bytes of all files under a folder."""
        fs, where = self._at(path)
        return fs.getContentSummary(where).getLength()

    def remove(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)
