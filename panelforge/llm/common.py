"""Helpers that several corpus operators share."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a Python operator hands back to Spark at a time; those it gets come in batches that Spark bounds by their bytes.
OUT_ROWS = 128
#: Bytes of texts that an operator whose memory follows them works on at a time, unless one text has more.
OUT_BYTES = 1 << 22
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``; where it is unset and the master is local, a fresh temporary one.

    A cluster without that setting is refused, as its executors share no local folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelforge-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which is removed when the driver process ends."""
    path = f"{shared_dir(spark)}/panelforge/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


class Scratch:
    """Intermediate tables of one job: lineage ends at each, so a lost executor costs no rework.

    ``clear`` removes what the job is done with; what its result reads stays
    until the driver process ends.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.path = spark, fresh_path(spark, name)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as the table ``name`` and read it back."""
        df.write.mode("overwrite").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def clear(self, *names: str) -> None:
        for name in names:
            _remove(self.spark, f"{self.path}/{name}")

    def drop(self) -> None:
        """Remove all its tables."""
        _remove(self.spark, self.path)


def written(df: DataFrame, name: str) -> DataFrame:
    """A single intermediate table that a result goes on to read."""
    return Scratch(df.sparkSession, name).write(df, "table")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session may be gone by now; the folder is temporary anyway
        pass


def sized(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """A written table of short keys, to be broadcast if it has at most so many rows, and joined by a shuffle if more."""
    return F.broadcast(df) if df.count() <= most else df


def fitting(keys: DataFrame, most: int) -> DataFrame:
    """A written table of keys of any type, to be broadcast if it has at most so many bytes, and joined by a shuffle if more."""
    size = keys.agg(*[F.sum(F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16) for c in keys.columns]).first()
    return F.broadcast(keys) if sum(x or 0 for x in size) <= most else keys


def slices(batch: pa.RecordBatch, at_text: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of ``OUT_ROWS`` rows, fewer where the texts in that column have more than ``OUT_BYTES``; a longer text is a slice of its own."""
    ends = np.cumsum(pc.binary_length(batch.column(at_text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = min(at + OUT_ROWS, max(at + 1, int(np.searchsorted(ends, before + OUT_BYTES, side="right"))))
        yield batch.slice(at, stop - at)
        at = stop


_forgets: list[Callable[[], None]] = []


def begins(forget: Callable[[], None]) -> None:
    """An operator that remembers things between tasks begins in this worker: what another one remembered goes, by its ``forget``.

    Spark hands the workers of one stage to the next, and they have no room
    for the memory of several operators.
    """
    if _forgets and _forgets[0] is not forget:
        _forgets.pop()()
        gc.collect()
        pa.default_memory_pool().release_unused()
    _forgets[:] = [forget]


def without(keep: list[str], *results: str) -> list[str]:
    """``keep`` without the columns that are named like results, which take their place."""
    return [c for c in keep if c.lower() not in results]


def held_out(key: Column) -> Column:
    """True for the rows that no classifier learns from; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def lower_ascii(text: str) -> bytes:
    """UTF-8 of ``text`` with A-Z (only) in lower case."""
    return text.encode("utf-8", "replace").translate(_LOWER)
