"""Small file-system helper for folders, on whatever store the path names.

Goes through Hadoop's FileSystem, so local, HDFS and cloud paths behave alike.
Only names and small text files pass through the driver, never table rows.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class AlreadyThere(Exception):
    """The target of an exclusive operation exists."""


class Files:
    def __init__(self, spark: SparkSession, root: str):
        context = spark.sparkContext
        self._hadoop = context._jvm.org.apache.hadoop
        self._commons = context._jvm.org.apache.commons.io.IOUtils
        self._gateway = context._gateway
        self._conf = context._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")

    def _path(self, relative: str):
        full = f"{self.root}/{relative}" if relative else self.root
        return self._hadoop.fs.Path(full)

    def _system(self, path):
        return path.getFileSystem(self._conf)

    def exists(self, relative: str = "") -> bool:
        path = self._path(relative)
        return self._system(path).exists(path)

    def names(self, relative: str = "") -> list[str]:
        """Names directly below a folder, hidden ones left out."""
        path = self._path(relative)
        system = self._system(path)
        if not system.exists(path):
            return []
        found = (status.getPath().getName() for status in system.listStatus(path))
        return sorted(name for name in found if name[0] not in "._")

    def make_folder(self, relative: str) -> None:
        path = self._path(relative)
        self._system(path).mkdirs(path)

    def delete(self, relative: str = "") -> bool:
        path = self._path(relative)
        return self._system(path).delete(path, True)

    def move(self, source: str, target: str) -> None:
        """Rename; raises AlreadyThere instead of replacing the target."""
        rename = self._hadoop.fs.Options.Rename
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        target_path = self._path(target)
        context = self._hadoop.fs.FileContext.getFileContext(target_path.toUri(), self._conf)
        try:
            context.rename(self._path(source), target_path, options)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                raise AlreadyThere(target) from error
            raise

    def read_text(self, relative: str) -> str:
        path = self._path(relative)
        stream = self._system(path).open(path)
        try:
            return self._commons.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, relative: str, text: str) -> None:
        """Create a text file in one step: written aside, then renamed into place."""
        folder, _, name = relative.rpartition("/")
        aside = f"{folder}/.{name}.{uuid.uuid4().hex}" if folder else f".{name}.{uuid.uuid4().hex}"
        path = self._path(aside)
        stream = self._system(path).create(path, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        try:
            self.move(aside, relative)
        except AlreadyThere:
            self.delete(aside)
            raise
