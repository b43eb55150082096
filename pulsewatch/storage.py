"""Small files next to a table (state, manifests, proofs) through the file system that Spark uses.

Data goes through Spark's writers; these helpers only move a few bytes of bookkeeping on the
driver, on any storage Spark can reach.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Deletions in flight at once, and how many names the driver holds for them.
DELETE_THREADS = 16
DELETE_CHUNK = 2_000


class AlreadyThere(RuntimeError):
    """A file that was to be created exclusively exists."""


class Files:
    """Names, reads, exclusive creation and deletion under one Spark session."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, path: str):  # noqa: ANN202 - a JVM object
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path):  # noqa: ANN001, ANN202
        return path.getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        path = self._path(folder)
        fs = self._fs(path)
        if not fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(path))

    def matching(self, pattern: str) -> list[str]:
        """Full paths that match a glob pattern."""
        path = self._path(pattern)
        found = self._fs(path).globStatus(path)
        return sorted(s.getPath().toString() for s in found) if found else []

    def read_json(self, file: str) -> dict | None:
        """The file's content; None if there is no such file."""
        path = self._path(file)
        fs = self._fs(path)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write_json(self, file: str, content: dict, exclusive: bool = False) -> None:
        """Write a file so that it appears whole; with ``exclusive`` never over another one."""
        target = self._path(file)
        ready = self._path(f"{file.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
        fs = self._fs(target)
        fs.mkdirs(target.getParent())
        out = fs.create(ready, False)
        try:
            out.write(bytearray((json.dumps(content, sort_keys=True) + "\n").encode()))
        finally:
            out.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE if exclusive else rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf)
        try:
            context.rename(ready, target, options)
        except Py4JJavaError as e:
            fs.delete(ready, False)
            if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
                raise AlreadyThere(file) from None
            raise

    def delete(self, paths: Iterable[str]) -> int:
        """Delete folders or files, several at a time; the names are taken in bounded chunks."""
        names, done = iter(paths), 0

        def one(name: str) -> None:
            path = self._path(name)
            self._fs(path).delete(path, True)

        with ThreadPoolExecutor(DELETE_THREADS) as pool:
            while chunk := list(islice(names, DELETE_CHUNK)):
                done += sum(1 for _ in pool.map(one, chunk))
        return done
