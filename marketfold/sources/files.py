"""File-system calls by path (local or remote), through Spark's Hadoop client."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class FileSystem:
    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def list(self, path: str) -> list[str]:
        """Names in a folder; none if it does not exist."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def age_seconds(self, path: str) -> float:
        fs, p = self._at(path)
        return (self.jvm.java.lang.System.currentTimeMillis() - fs.getFileStatus(p).getModificationTime()) / 1000

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, content: bytes) -> bool:
        """Create a file with this content unless it exists; whether this call
        made it.  The content is written aside and then put in place in one
        step that fails if the name is taken (a hard link on a local disk, else
        the file system's rename), so of several callers one succeeds and
        nobody sees half a file."""
        fs, p = self._at(path)
        aside = self.jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_aside-{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        try:
            out.write(bytearray(content))
        finally:
            out.close()
        try:
            if fs.getUri().getScheme() == "file":
                at = self.jvm.java.io.File
                self.jvm.java.nio.file.Files.createLink(at(p.toUri().getPath()).toPath(), at(aside.toUri().getPath()).toPath())
                return True
            return not fs.exists(p) and fs.rename(aside, p)
        except Py4JJavaError as error:
            if fs.exists(p):
                return False
            raise error
        finally:
            fs.delete(aside, False)


class CommitLog:
    """Numbered entries (small JSON files) of what has been written completely.

    An entry's number can be taken once, so concurrent writers are put in an
    order, and what a crashed writer left behind is in no entry."""

    def __init__(self, files: FileSystem, path: str):
        self.files, self.path, self._known = files, path, {}

    def entries(self) -> list[dict]:
        for name in self.files.list(self.path):
            if name.endswith(".json") and name not in self._known:
                self._known[name] = json.loads(self.files.read(f"{self.path}/{name}"))
        return [self._known[n] for n in sorted(self._known)]

    def append(self, entry: dict, since: int, conflicts: Callable[[dict], bool]) -> bool:
        """Add an entry that was made when the log had ``since`` entries; false
        if one of the entries added meanwhile conflicts with it."""
        while True:
            added = self.entries()[since:]
            if any(conflicts(e) for e in added):
                return False
            n = since + len(added)
            if self.files.create(f"{self.path}/{n:012d}.json", json.dumps({**entry, "n": n}).encode()):
                return True
