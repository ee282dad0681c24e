"""Which folders of a table are valid: numbered manifests, each a text file that names them.

The manifest of the highest number holds. A new one is created only if no file
of its number is there, so of two writers one wins and the other reads again;
its last line tells that it is whole. Folders are written once and never
changed, so a reader that has taken its folders' names is not disturbed by what
is published after.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from py4j.protocol import Py4JJavaError

MANIFESTS, WHOLE = "_manifests", "end"


class _Files:
    """Hadoop's file system of a table's path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark.sparkContext._jvm, path
        self.fs = self.at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> dict[str, int]:
        """Names in a folder, each with the time of its last change in milliseconds; none if it is not there."""
        if not self.fs.exists(self.at(name)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self.fs.listStatus(self.at(name))}

    def lines(self, name: str) -> list[str]:
        stream = self.fs.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
        finally:
            stream.close()

    def create(self, name: str, lines: list[str]) -> bool:
        """Write a file that is not there yet; whether it was not."""
        try:
            stream = self.fs.create(self.at(name), False)
        except (Py4JJavaError, PySparkException) as fault:
            if "FileAlreadyExists" in str(fault) or "already exists" in str(fault):
                return False
            raise
        stream.write(bytearray("".join(f"{x}\n" for x in lines).encode()))
        stream.close()
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def folder(first: int, last: int | None = None) -> str:
    """A new name for the folder of a batch, or of batches first to last."""
    return f"v{first}-{first if last is None else last}-{uuid.uuid4().hex[:12]}"


def batches_of(name: str) -> tuple[int, int]:
    first, last, _ = name.removeprefix("v").split("-")
    return int(first), int(last)


def _newest(files: _Files) -> tuple[int, list[str]]:
    """The number and folders of the last manifest that is whole; 0 and none before the first."""
    for n in sorted((int(x) for x in files.names(MANIFESTS) if x.isdigit()), reverse=True):
        said = files.lines(f"{MANIFESTS}/{n}")
        if said[-1:] == [WHOLE]:
            return n, said[:-1]
    return 0, []


def live(spark: SparkSession, path: str) -> list[str]:
    """The table's valid folders."""
    return _newest(_Files(spark, path))[1]


def publish(spark: SparkSession, path: str, change: Callable[[list[str]], list[str]], tries: int = 50) -> None:
    """Put change(valid folders) in place of the valid folders, in one step; done again on what another writer has published meanwhile."""
    files = _Files(spark, path)
    for _ in range(tries):
        number, folders = _newest(files)
        taken = max([number, *(int(x) for x in files.names(MANIFESTS) if x.isdigit())])
        if files.create(f"{MANIFESTS}/{taken + 1}", [*change(folders), WHOLE]):
            return
    raise RuntimeError(f"{path}: other writers came first {tries} times")


def vacuum(spark: SparkSession, path: str, hours: float) -> list[str]:
    """Delete folders that no manifest of the last hours has named, and the manifests before; returns the folders' names.

    No read begun within these hours loses a file, nor does one that a writer is
    still writing.
    """
    files, before = _Files(spark, path), (time.time() - hours * 3600) * 1000
    manifests = {int(n): t for n, t in files.names(MANIFESTS).items() if n.isdigit()}
    newest, folders = _newest(files)
    # a manifest holds until the next is there, so the last one before the time still counts
    kept = {newest, *(n for n, t in manifests.items() if t >= before), *[max((n for n, t in manifests.items() if t < before), default=newest)]}
    named = set(folders).union(*[files.lines(f"{MANIFESTS}/{n}") for n in kept if n])
    gone = [f for f, t in files.names("").items() if f.startswith("v") and f not in named and t < before]
    for f in gone:
        files.delete(f)
    for n in set(manifests) - kept:
        files.delete(f"{MANIFESTS}/{n}")
    return sorted(gone)
