"""Dump files that are read once: a ledger of files, however often and from wherever a month is tried again.

The listing is one of Spark's file source, so any file system that Spark reads
will do.  A batch of files is written into a folder of its own, and counts
once one row of the ledger names it; what a crash leaves behind is not named
and is never read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.sinks.files import append_row, read_or_empty
from panelforge.storage import folders_in, remove

BATCHES = "batch long, folder string, files array<struct<name: string, length: long, modified: timestamp>>"


def _below(path: Column, landing: str) -> Column:
    """A path without the landing folder's part, however both spell their scheme."""
    bare = F.regexp_replace(path, "^[a-z0-9]+:/+", "/")
    root = "/" + re.sub("^[a-z0-9]+:/+", "", landing).strip("/") + "/"
    own = F.regexp_extract(bare, "^.*?" + re.sub(r"([^\w/])", r"\\\1", root) + "(.*)$", 1)
    return F.when(own != "", own).otherwise(bare)


class FileLedger:
    """Rows of the files of a landing folder, gathered batch by batch under ``root``.

    A file is known by its path below the landing folder, its length and its
    time of modification.  One that lands again under the same path with
    another length or time takes the place of its former self: the rows of a
    path are those of the batch that read it last.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def batches(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/batches", BATCHES)

    def files(self) -> DataFrame:
        """``name``, ``length``, ``modified`` and ``batch`` of each file that was read, as it was when it was read last."""
        rows = self.batches().select("batch", F.explode("files").alias("f")).select("batch", "f.*")
        return rows.groupBy("name").agg(F.max_by(F.struct("length", "modified", "batch"), "batch").alias("f")).select("name", "f.*")

    def listing(self, landing: str) -> DataFrame:
        """``path``, ``name`` below the folder, ``length`` and ``modified`` of all files in it; nothing is read but the listing."""
        found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
        return found.select("path", _below(F.col("path"), landing).alias("name"), "length", F.col("modificationTime").alias("modified"))

    def new(self, landing: str) -> DataFrame:
        """The files that no batch has read as they are now."""
        return self.listing(landing).join(self.files(), ["name", "length", "modified"], "left_anti")

    def take(self, landing: str, read: Callable[[list[str]], DataFrame]) -> int:
        """Read the new files with ``read``, which gets their paths; the number of files.  A crash anywhere leaves them new.

        ``read`` gives in a column ``file`` the path that each row is of.
        """
        files = self.new(landing).orderBy("name").collect()  # names of files
        if not files:
            return 0
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        read([f["path"] for f in files]).withColumn("file", _below(F.col("file"), landing)).write.parquet(folder)
        last = self.batches().agg(F.max("batch")).first()[0] or 0
        append_row(self.spark, f"{self.root}/batches", BATCHES, (last + 1, folder, [(f["name"], f["length"], f["modified"]) for f in files]))
        return len(files)

    def rows(self) -> DataFrame:
        """All rows, each file's from the batch that read it last, with ``file``, the path below the landing folder."""
        batches = self.batches().select("batch", "folder").orderBy("batch").collect()  # one row a batch
        if not batches:
            raise LookupError(f"{self.root} has no batch")
        out, current = None, self.files().select("name", "batch")
        for b in batches:
            own = current.where(F.col("batch") == b["batch"]).select(F.col("name").alias("file"))
            rows = self.spark.read.parquet(b["folder"]).join(own, "file", "left_semi")
            out = rows if out is None else out.unionByName(rows)
        return out

    def vacuum(self) -> list[str]:
        """Remove the folders that no batch names; no batch may be under way."""
        known = {r["folder"].rsplit("/", 1)[-1] for r in self.batches().select("folder").collect()}
        gone = [x for x in folders_in(self.spark, f"{self.root}/data") if x.rsplit("/", 1)[-1] not in known]
        for folder in gone:
            remove(self.spark, folder)
        return gone
