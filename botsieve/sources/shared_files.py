"""Small files in the shared folder, through the cluster's own file systems.

Manifests and markers are read and written by the driver with Hadoop's
``FileSystem``, so any path Spark can write to works, not only local ones.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class SharedFiles:
    """File operations below any path Spark can reach."""

    def __init__(self, spark: SparkSession):
        self.gateway = spark.sparkContext._gateway
        self.jvm = self.gateway.jvm
        self.conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.conf), where

    def names(self, path: str) -> dict[str, int]:
        """What lies directly below a folder, with the time of its last change in
        milliseconds; nothing if the folder is not there."""
        fs, where = self._at(path)
        return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(where)} if fs.exists(where) else {}

    def read(self, path: str) -> str:
        fs, where = self._at(path)
        stream = fs.open(where)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """``path`` with ``text``, whole or not at all; False if it is already
        there. The text goes to a file of its own first, which then gets its
        name without overwriting: by a rename (one step on a file system such
        as HDFS) or, on a local or mounted folder, by a hard link."""
        fs, where = self._at(path)
        draft = self.jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}.{uuid.uuid4().hex}")
        fs.mkdirs(where.getParent())
        stream = fs.create(draft, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        try:
            if fs.getScheme() == "file":
                files, plain = self.jvm.java.nio.file, self.gateway.new_array(self.jvm.java.lang.String, 0)
                files.Files.createLink(*(files.Paths.get(p.toUri().getPath(), plain) for p in (where, draft)))
            else:
                rename = self.jvm.org.apache.hadoop.fs.Options.Rename
                once = self.gateway.new_array(rename, 1)
                once[0] = rename.NONE
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), self.conf).rename(draft, where, once)
            return True
        except Py4JJavaError as exc:
            if "FileAlreadyExists" in exc.java_exception.getClass().getName():
                return False
            raise
        finally:
            fs.delete(draft, False)

    def delete(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)
