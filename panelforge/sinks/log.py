"""A log of snapshots: what belongs to a table, or to several, at one time, under one pointer."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from panelforge.storage import at_path, exists, remove


class Conflict(RuntimeError):
    """Somebody else has committed since the snapshot that a commit is based on."""


class SnapshotLog:
    """Snapshots under ``root``, numbered from 1; the one with the highest number is in force.

    A commit renames a whole file to the next number, which fails if that is
    taken: of two writers that started from one snapshot the later one gets a
    :class:`Conflict`, and no reader ever meets half a commit.  This wants a
    file system whose renames are atomic; on an object store without them
    there may be one writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _path(self, number: int) -> str:
        return f"{self.root}/{number:010d}.json"

    def numbers(self) -> list[int]:
        files, where = at_path(self.spark, self.root)
        names = [x.getPath().getName() for x in files.listStatus(where) if x.isFile()] if files.exists(where) else []
        return sorted(int(x.removesuffix(".json")) for x in names if x.endswith(".json"))

    def read(self, number: int | None = None) -> tuple[int, dict]:
        """(number, content) of a snapshot, the one in force if none is given; (0, {}) before the first commit."""
        if number is None:
            number = max(self.numbers(), default=0)
        if not number:
            return 0, {}
        if not exists(self.spark, self._path(number)):
            raise LookupError(f"{self.root} has no snapshot {number}")
        return number, json.loads(self.spark.read.text(self._path(number), wholetext=True).first()[0])

    def commit(self, after: int, content: dict) -> int:
        """Put ``content`` in force, if ``after`` still is; its number."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        files, pending = at_path(self.spark, f"{self.root}/pending/{uuid.uuid4().hex}")
        out = files.create(pending, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        target = at_path(self.spark, self._path(after + 1))[1]
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(pending).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(files.makeQualified(pending), files.makeQualified(target), gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as e:
            if "FileAlreadyExistsException" not in str(e):
                raise
            remove(self.spark, f"{self.root}/pending")
            raise Conflict(f"snapshot {after + 1} of {self.root} is there already") from None
        return after + 1

    def forget(self, keep: int) -> list[int]:
        """Remove all but the last ``keep`` snapshots, and commits that broke off; the numbers removed."""
        gone = self.numbers()[: -max(keep, 1)]
        for number in gone:
            remove(self.spark, self._path(number))
        remove(self.spark, f"{self.root}/pending")
        return gone
