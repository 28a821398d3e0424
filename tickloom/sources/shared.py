"""Files and folders of a store that all executors and drivers share, and leases on its parts."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: A lease that is older was left by a driver that died.
LEASE_SECONDS = 3600


class Busy(RuntimeError):
    """Another driver holds the lease."""


class Shared:
    """The Hadoop file system of a folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def matching(self, pattern: str) -> list[str]:
        return [str(s.getPath().toString()) for s in self._fs.globStatus(self._path(pattern)) or []]

    def data_files(self, folder: str) -> list[str]:
        """Finished data files right in a folder."""
        return sorted(f for f in self.matching(f"{folder}/*") if not re.search(r"/[._][^/]*$", f))

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def rename(self, old: str, new: str) -> None:
        """Moves a folder in one step; what is there already is never merged with."""
        if self.exists(new) or not self._fs.rename(self._path(old), self._path(new)):
            raise FileExistsError(new)

    def modified(self, path: str) -> float:
        """Seconds since the epoch."""
        return self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def write_text(self, path: str, text: str, replace: bool = True) -> bool:
        """Writes a small file; without ``replace`` only the first of several writers succeeds."""
        try:
            out = self._fs.create(self._path(path), replace)
        except Exception as e:
            if "FileAlreadyExists" in str(e) or self.exists(path):
                return False
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    @contextmanager
    def lease(self, path: str) -> Iterator[None]:
        """Holds a part of the store against other drivers; raises :class:`Busy` where it is held."""
        mine = uuid.uuid4().hex
        if not self.write_text(path, mine, replace=False):
            if self.exists(path) and time.time() - self.modified(path) < LEASE_SECONDS:
                raise Busy(path)
            self.delete(path)
            if not self.write_text(path, mine, replace=False):
                raise Busy(path)
        try:
            yield
        finally:
            if self.exists(path) and self.read_text(path) == mine:
                self.delete(path)
