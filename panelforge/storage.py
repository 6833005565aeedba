"""Where intermediate tables are written: the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset and the master is local, a temporary folder that is set here.

    A cluster without that setting is refused, as its executors share no local folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="panelforge-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which is removed when the driver process ends."""
    path = f"{shared_dir(spark)}/panelforge-core/{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it and the session are still there."""
    try:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  at the end of the process nothing is left to be told
        pass


def at_path(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = at_path(spark, path)
    return files.exists(where)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Paths of the folders right in a folder; none if it is not there."""
    files, where = at_path(spark, path)
    return sorted(x.getPath().toString() for x in files.listStatus(where) if x.isDirectory()) if files.exists(where) else []


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that its lineage ends here; it is removed when the driver process ends."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
