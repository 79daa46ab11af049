"""File access shared by the driver and the tasks.

The driver sees files as Spark does, through Hadoop: ``qualified`` turns a path into a URI
with a scheme, whatever the default file system is. Tasks have no Hadoop, so the archive
source opens such URIs with pyarrow.
"""

from __future__ import annotations

import errno
import fnmatch
import os
import posixpath
import uuid

from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.sql import SparkSession

#: Hadoop schemes that pyarrow knows by another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def pyarrow_uri(uri: str) -> str:
    """A URI as pyarrow spells it; a path without a scheme stays as it is.

    ``hdfs:/path`` and ``file:/path`` have no authority; Hadoop writes them with one slash.
    """
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme or not scheme:
        return uri
    if not rest.startswith("//"):
        rest = "//" + rest
    return f"{_SCHEMES.get(scheme, scheme)}:{rest}"


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it."""
    uri = pyarrow_uri(path)
    if "://" in uri and not uri.startswith("file://"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri.removeprefix("file://")


def list_files(directory: str, pattern: str = "*") -> list[str]:
    """Full names of the files of a directory that match a glob, in name order."""
    system, path = resolve(directory)
    entries = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    names = (entry.base_name for entry in entries if entry.is_file)
    return [posixpath.join(directory, name) for name in sorted(fnmatch.filter(names, pattern))]


class Files:
    """Files as Spark sees them; for the driver."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        path = self._jvm.org.apache.hadoop.fs.Path(path)
        return path.getFileSystem(self._conf), path

    def qualified(self, path: str) -> str:
        system, path = self._at(path)
        return system.makeQualified(path).toString().rstrip("/")

    def exists(self, path: str) -> bool:
        system, path = self._at(path)
        return system.exists(path)

    def _entries(self, directory: str):
        system, path = self._at(directory)
        if not system.exists(path):
            return []
        try:
            return list(system.listStatus(path))
        except Py4JJavaError as error:  # another writer may have removed it
            if "FileNotFound" in error.java_exception.getClass().getName():
                return []
            raise

    def names(self, directory: str, pattern: str = "*") -> list[str]:
        """Base names of the files that match a glob, in order."""
        found = [e.getPath().getName() for e in self._entries(directory) if e.isFile()]
        return sorted(fnmatch.filter(found, pattern))

    def directories(self, directory: str) -> list[str]:
        """Base names of the sub-directories, in order."""
        return sorted(e.getPath().getName() for e in self._entries(directory) if e.isDirectory())

    def delete(self, path: str) -> None:
        """Remove a file or a directory; no error when it is not there."""
        system, path = self._at(path)
        system.delete(path, True)

    def read_text(self, path: str) -> str | None:
        """A small text file, or None."""
        system, path = self._at(path)
        if not system.exists(path):
            return None
        stream = system.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_new(self, path: str, text: str) -> bool:
        """Write a small text file unless there is one; False if there is.

        The file appears whole or not at all: it is written aside, then given its name by a
        step that fails when the name is taken.
        """
        aside = f"{path}.{uuid.uuid4().hex}.new"
        system, target = self._at(aside)
        stream = system.create(target, False)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        try:
            return self._name(aside, path, os.link)
        finally:
            self.delete(aside)

    def rename_new(self, source: str, target: str) -> bool:
        """Rename a folder in one step, unless the new name is taken; False if it is."""
        return not self.exists(target) and self._name(source, target, os.rename)

    def _name(self, source: str, target: str, locally) -> bool:
        if target.startswith("file:"):
            try:
                locally(*("/" + p.removeprefix("file:").lstrip("/") for p in (source, target)))
            except OSError as error:
                if error.errno in (errno.EEXIST, errno.ENOTEMPTY):
                    return False
                raise
            return True
        fs = self._jvm.org.apache.hadoop.fs
        (_, old), (_, new) = self._at(source), self._at(target)
        option = getattr(fs, "Options$Rename")
        options = self._gateway.new_array(option, 1)
        options[0] = option.NONE
        try:
            fs.FileContext.getFileContext(new.toUri(), self._conf).rename(old, new, options)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True
