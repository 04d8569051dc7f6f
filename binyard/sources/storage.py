"""Small files beside the data - commit markers, manifests - through Hadoop's
file systems, so that any storage Spark can write is reached the same way."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder in shared storage."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _fs(self, path):
        return path.getFileSystem(self._conf)

    def names(self, name: str = "") -> list[str]:
        """Entries of a sub-folder; none if it does not exist."""
        path = self._path(name)
        fs = self._fs(path)
        if not fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(path))

    def read(self, name: str) -> str | None:
        path = self._path(name)
        fs = self._fs(path)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a file that appears whole or not at all; ``FileExistsError``
        if another writer was first."""
        path = self._path(name)
        fs = self._fs(path)
        fs.mkdirs(path.getParent())
        draft = self._jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{uuid.uuid4().hex}.tmp")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        none = self.spark.sparkContext._gateway.new_array(rename, 0)
        whole = self._fs(path).makeQualified
        try:
            if fs.exists(path):
                raise FileExistsError(name)
            context.rename(whole(draft), whole(path), none)
        except FileExistsError:
            fs.delete(draft, False)
            raise
        except Exception as exc:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(exc):
                raise FileExistsError(name) from exc
            raise

    def replace(self, name: str, text: str) -> None:
        """Write a file over any older one (a manifest, by one writer)."""
        path = self._path(name)
        fs = self._fs(path)
        fs.mkdirs(path.getParent())
        out = fs.create(path, True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def delete(self, name: str) -> None:
        path = self._path(name)
        self._fs(path).delete(path, True)
