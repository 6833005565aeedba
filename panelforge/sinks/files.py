"""Writers: panels by month, side outputs, CSV exports, and keyed tables in versions."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.schemas import ESTABLISHMENT_KEY, SIDE_OUTPUTS
from panelforge.storage import exists, folders_in, remove


def write_panel(panel: DataFrame, base: str, keys: list[str] = ESTABLISHMENT_KEY, files_per_month: int | None = None) -> None:
    """Snappy parquet by month, sorted by key in each file; months that are written replace themselves, others stay.

    A month's files hold ranges of keys that do not meet, whose boundaries
    Spark samples, so that no task has a month of any size: about
    ``files_per_month`` if months are equally large, else as many as the
    session's partition size asks for.  With 1 a task sorts each month.  The
    files' bounds are kept beside them (:func:`read_bounds`).
    """
    by = ["reference_month", *keys]
    if files_per_month == 1:
        rows = panel.repartition("reference_month")
    elif files_per_month is None:
        rows = panel.repartitionByRange(*by)
    else:
        rows = panel.repartitionByRange(files_per_month * max(1, panel.select("reference_month").distinct().count()), *by)
    replacing = {"partitionOverwriteMode": "dynamic", "compression": "snappy"}
    rows.sortWithinPartitions(*by).write.mode("overwrite").options(**replacing).partitionBy("reference_month").parquet(base)
    _write_bounds(panel.sparkSession, base, keys)


def _files_of(spark: SparkSession, folder: str) -> DataFrame:
    """``file`` and ``path`` of all files of a folder, the first as Spark names a row's file; nothing is read but the listing."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder).select(F.col("_metadata.file_path").alias("file"), "path")


def _write_bounds(spark: SparkSession, base: str, keys: list[str]) -> None:
    """Add the bounds of those files of a panel that have none yet; bounds of files that are gone go."""
    known, files = f"{base}/_bounds", _files_of(spark, base)
    kept = read_bounds(spark, base) if exists(spark, known) else None
    new = files if kept is None else files.join(kept, "file", "left_anti")
    names = sorted(r["path"] for r in new.select("path").collect())  # names of files
    if not names:
        return
    file, key = F.col("_metadata.file_path").alias("file"), F.struct(*keys)
    found = spark.read.option("basePath", base).parquet(*names).groupBy(file).agg(F.min(key).alias("lower"), F.max(key).alias("upper"), F.count("*").alias("n_rows"))
    found = found.select(F.regexp_extract("file", "reference_month=([^/]*)/", 1).alias("reference_month"), "*")
    before, folder = folders_in(spark, known), f"{known}/{uuid.uuid4().hex}"
    (found if kept is None else kept.unionByName(found)).coalesce(1).write.parquet(folder)
    for old in before:
        remove(spark, old)


def read_bounds(spark: SparkSession, base: str) -> DataFrame:
    """``reference_month``, ``file``, least and greatest key (``lower``, ``upper``) and ``n_rows`` of each file of a panel."""
    bounds = spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/_bounds")
    return bounds.join(_files_of(spark, base), "file", "left_semi").distinct()


def read_key(spark: SparkSession, base: str, month: str, **key: object) -> DataFrame:
    """A month's rows with a key, or with the first columns of one: only files whose bounds hold it are opened.

    Values of the key are not null.  A file without bounds, as a writer that
    broke off may leave one, is opened always.
    """
    folder, rows = f"{base}/reference_month={month}", None
    if exists(spark, f"{base}/_bounds") and exists(spark, folder):
        bounds = read_bounds(spark, base).where(F.col("reference_month") == month)
        kinds = {f.name: f.dataType for f in bounds.schema["lower"].dataType}
        wanted = F.struct(*[F.lit(v).cast(kinds[k]).alias(k) for k, v in key.items()])
        lower, upper = (F.struct(*[F.col(f"{side}.{k}").alias(k) for k in key]) for side in ("lower", "upper"))
        held = bounds.select("file", ((lower <= wanted) & (wanted <= upper)).alias("holds"))
        files = _files_of(spark, folder).join(held, "file", "left").where(F.coalesce("holds", F.lit(True)))
        names = sorted({r["path"] for r in files.select("path").collect()})  # the few files that can hold the key
        rows = spark.read.option("basePath", base).parquet(*names) if names else spark.createDataFrame([], spark.read.parquet(base).schema)
    if rows is None:
        rows = spark.read.parquet(base).where(F.col("reference_month") == month)
    for k, v in key.items():
        rows = rows.where(F.col(k) == v)
    return rows


def write_side_outputs(tables: dict[str, DataFrame], month: str, base: str, only_if_absent: bool = False) -> None:
    """The columns that change detection ignores, a dataset each, by month."""
    for name, columns in SIDE_OUTPUTS.items():
        rows = tables[name.removesuffix("_enderecos")].select(*columns).withColumn("reference_month", F.lit(month))
        mode = "ignore" if only_if_absent else "overwrite"
        rows.drop("reference_month").write.mode(mode).option("compression", "snappy").parquet(f"{base}/{name}/reference_month={month}")


def write_csv(rows: DataFrame, path: str, headers: list[str] | None = None, order: list[Column | str] | None = None, limit: int | None = None, single: bool = False) -> None:
    """CSV with a header line; with ``limit`` the first rows of the order, nulls last."""
    if order:
        rows = rows.orderBy(*[F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order])
    if limit is not None:
        rows = rows.limit(limit)
    rows = rows.toDF(*headers) if headers else rows
    (rows.coalesce(1) if single else rows).write.mode("overwrite").csv(path, header=True)


def append_row(spark: SparkSession, path: str, schema: str, row: tuple) -> None:
    """Add one row to a small table; it is there as a whole or not at all."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or no rows if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


MARKER = "reference_month string, n_rows long, folder string, landing long"


def mark_complete(spark: SparkSession, landing: str, month: str, n_rows: int, folder: str) -> None:
    """Say that all files of a month are in ``folder``, and how many rows they have; of a month's markers the last one counts."""
    try:
        before = spark.read.schema(MARKER).json(f"{landing}/complete").where(F.col("reference_month") == month).agg(F.max("landing")).first()[0] or 0
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        before = 0
    spark.createDataFrame([(month, n_rows, folder, before + 1)], MARKER).coalesce(1).write.mode("append").json(f"{landing}/complete")


def land_month(rows: DataFrame, landing: str, month: str) -> str:
    """Write a month's rows into a folder of this landing's own, and mark the month complete; the folder.

    Until its marker is there, a landing does not exist for any reader; one
    that breaks off is simply done again, and a later one takes the place of
    an earlier one.
    """
    folder = f"{landing}/data/{month}/{uuid.uuid4().hex}"
    rows.write.parquet(folder)
    mark_complete(rows.sparkSession, landing, month, rows.sparkSession.read.parquet(folder).count(), folder)
    return folder


class KeyedTable:
    """A table that is rewritten as a whole: each version is a folder of its own, and counts once it is in the manifest.

    A run that breaks off leaves the version before it in force.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def version(self) -> int:
        return read_or_empty(self.spark, f"{self.root}/manifest", "version int").agg(F.max("version")).first()[0] or 0

    def read(self, default: DataFrame | None = None) -> DataFrame:
        n = self.version()
        if not n:
            if default is None:
                raise LookupError(f"{self.root} has no version")
            return default
        return self.spark.read.parquet(f"{self.root}/version={n}")

    def write(self, rows: DataFrame) -> int:
        n = self.version() + 1
        rows.write.mode("overwrite").parquet(f"{self.root}/version={n}")
        append_row(self.spark, f"{self.root}/manifest", "version int", (n,))
        return n

    def change(self, how: Callable[[DataFrame], DataFrame], default: DataFrame | None = None) -> int:
        """Write what ``how`` makes of the present version."""
        return self.write(how(self.read(default)))
