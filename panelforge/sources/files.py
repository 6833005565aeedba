"""Readers for dump files: headerless registry CSV, zipped dumps, lookups with headers, coordinates, panels.

Everything is an ordinary partitioned scan.  A large file is split by Spark,
so there is no paging, and each row is read once.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.expr import clean_token, coordinate_is_valid, as_double, decimal_comma, missing_to_null, postcode, zfill
from panelforge.schemas import FAMILIES, GEOLOC, ROUTES
from panelforge.sources.records import Joiner, open_pattern, read_records, turns_of

_BAD = "_corrupt_record"


def route(name: str, any_case: bool = True) -> str | None:
    """The family of a file by its name: the first substring of ``ROUTES`` that is in it."""
    name = name.upper() if any_case else name
    return next((family for part, family in ROUTES.items() if part in name), None)


def _fields(record: Column, sep: str) -> Column:
    """Number of fields of a raw record, separators in quotes not counted."""
    return F.regexp_count(F.regexp_replace(record, r'"(?:[^"]|"")*"', ""), F.lit(sep)) + 1


def _typed(rows: DataFrame, schema: T.StructType, decimals: tuple[str, ...], *more: Column) -> DataFrame:
    return rows.select(*more, *[(decimal_comma(missing_to_null(F.col(f.name))) if f.name in decimals else missing_to_null(F.col(f.name)).cast(f.dataType)).alias(f.name) for f in schema])


def _whole_rows(spark: SparkSession) -> DataFrameReader:
    """A reader that parses every field of a row: one that skips fields does not see that a row has a wrong number of them."""
    return spark.read.option("columnPruning", False)


def read_dump(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ";", encoding: str = "ISO-8859-1", multiline: bool = False, decimals: tuple[str, ...] = ("capital_social",), file: bool = False) -> DataFrame:
    """A headerless dump with columns by position.

    Missing-value tokens become null, decimals may have a comma.  A row with
    too few fields is filled up with nulls, one with too many is dropped.
    ``multiline`` allows line breaks in quotes; files are split all the same
    (:func:`panelforge.sources.records.read_records`).  With ``file`` the path
    of each row's file is added.
    """
    if multiline:
        return _parsed(read_records(spark, path, sep, encoding), schema, sep, decimals, file)
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(_BAD, T.StringType())])
    rows = _whole_rows(spark).csv(path, schema=raw, sep=sep, header=False, encoding=encoding, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD)
    # always true, but Spark refuses to count rows by the record column alone
    some = F.length(F.coalesce(F.col(schema[0].name), F.lit(""))) >= 0
    fits = F.col(_BAD).isNull() | (_fields(F.col(_BAD), sep) <= len(schema))
    return _typed(rows.where(some & fits), schema, decimals, *[F.col("_metadata.file_path").alias("file")] * file)


def _parsed(lines: DataFrame, schema: T.StructType, sep: str, decimals: tuple[str, ...], file: bool) -> DataFrame:
    """Rows of ``file`` and ``line``, a record each, by the rules of :func:`read_dump`."""
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema] + [T.StructField(_BAD, T.StringType())])
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    line, most = F.col("line"), len(schema) - 1
    few = F.length(line) - F.length(F.replace(line, F.lit(sep))) <= most  # then none needs to be looked for in quotes
    rows = lines.where(few | (_fields(line, sep) <= len(schema))).select(F.from_csv("line", raw.simpleString()[7:-1].replace(":", " "), options).alias("r"), "file").select("r.*", "file")
    return _typed(rows, schema, decimals, *[F.col("file")] * file)


def _opened(path: str) -> zipfile.ZipFile:
    """A local zip file, read where it lies and piece by piece."""
    return zipfile.ZipFile(fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/")))


def _split(paths: list[str]) -> tuple[list[str], list[str]]:
    """Local paths, and those of other file systems, which Spark reads."""
    local = [p for p in paths if p.startswith(("file:", "/"))]
    return local, [p for p in paths if p not in local]


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with _opened(path) as z:
                names = [x for x in z.namelist() if not x.endswith("/")]
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(names), pa.string()), pa.array(names, pa.string())], ["path", "entry"])


def _lines_of(z: zipfile.ZipFile, path: str, name: str, sep: str | None) -> Iterator[pa.RecordBatch]:
    """The lines of an entry or, with ``sep``, its records with line breaks in quotes."""
    records = Joiner()

    def made(part: list[str]) -> Iterator[pa.RecordBatch]:
        if part:
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(part)), pa.array([x.removesuffix("\r") for x in part], pa.string())], ["file", "line"])

    def joined(part: list[str]) -> list[str]:
        if sep is None or not part:
            return part
        lines = pa.array(part, pa.string())
        alone, several, _ = records.feed(lines, turns_of(lines, open_pattern(sep)))
        return alone.to_pylist() + several

    with z.open(name) as f:  # a wrong checksum raises when the end is read
        part = []
        for line in io.TextIOWrapper(f, "iso-8859-1", newline="\n"):
            part.append(line.removesuffix("\n"))
            if len(part) == 20_000:
                yield from made(joined(part))
                part = []
        yield from made(joined(part))
    if (rest := records.rest()) is not None:
        yield from made([rest])


def _lines(sep: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with _opened(path) as z:
                    yield from _lines_of(z, path, name, sep)

    return run


def _content_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as z:
                names = [x for x in z.namelist() if not x.endswith("/")]
            yield pa.RecordBatch.from_arrays([pa.array([path.as_py()] * len(names), pa.string()), pa.array(names, pa.string())], ["path", "entry"])


def _content_lines(family: str | None, sep: str | None):
    """Lines of the entries of whole zip files, of one family if asked, which names tell as in :func:`_routed`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as z:
                    names = [x for x in z.namelist() if not x.endswith("/")]
                    own = {x: route(posixpath.basename(x)) for x in names}
                    if not any(own.values()):
                        own = dict.fromkeys(names, route(posixpath.basename(path.as_py())))
                    for name in names:
                        if family is None or own[name] == family:
                            yield from _lines_of(z, path.as_py(), name, sep)

    return run


def files_in(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path`` of every file at or anywhere under the given ones; nothing is read but the listing."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")


def zip_entries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path`` and ``entry`` of what is in zip files; only their directories are read."""
    local, other = _zips(spark, path)
    found = spark.createDataFrame([(p,) for p in local], "path string").repartition("path").mapInArrow(_entries, "path string, entry string")
    if other:
        found = found.unionByName(spark.read.format("binaryFile").load(other).select("path", "content").mapInArrow(_content_entries, "path string, entry string"))
    return found


def _zips(spark: SparkSession, path: str | list[str]) -> tuple[list[str], list[str]]:
    return _split(sorted(r[0] for r in files_in(spark, path).where(F.lower("path").endswith(".zip")).collect()))  # names of files


def read_zipped(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = ";", decimals: tuple[str, ...] = ("capital_social",), family: str | None = None, file: bool = False, multiline: bool = False) -> DataFrame:
    """Dumps inside zip files; a damaged archive fails the job.  Records are one line each but for line breaks in quotes with ``multiline``.

    A local archive has a task for each entry, which is read as a stream, so
    that its size is of no matter.  Archives of any other file system come
    through Spark's own reader, one task and one row each, of 2 GB at most.
    With ``file`` the path of each row's archive is added.  With
    ``family`` only entries of that family are read, by their own names or, if
    none in the archive has a name that tells, by the archive's.
    """
    local, other = _zips(spark, path)
    entries = spark.createDataFrame([], "path string, entry string") if not local else zip_entries(spark, local)
    if family is not None:
        entries = _routed(entries).where(F.col("family") == family)
    lines = entries.repartition("path", "entry").mapInArrow(_lines(sep if multiline else None), "file string, line string")
    if other:
        lines = lines.unionByName(spark.read.format("binaryFile").load(other).select("path", "content").mapInArrow(_content_lines(family, sep if multiline else None), "file string, line string"))
    lines = lines.where(F.col("line") != "")
    return _parsed(lines, schema, sep, decimals, file)


def _family(name: Column) -> Column:
    """The family of a file by its name, as :func:`route` finds it."""
    return F.coalesce(*[F.when(F.contains(F.upper(name), F.lit(part)), family) for part, family in ROUTES.items()])


def _routed(entries: DataFrame) -> DataFrame:
    own, of_zip = (_family(F.element_at(F.split(c, "/"), -1)) for c in ("entry", "path"))
    told = F.max(F.col("own").isNotNull()).over(Window.partitionBy("path"))
    return entries.withColumn("own", own).withColumn("family", F.coalesce("own", F.when(~told, of_zip))).drop("own")


def of_month(paths: list[str], month: str) -> list[str]:
    """Those of the paths that are of a month: by the innermost folder that is named like one; files in none are of any month."""

    def named(path: str) -> str | None:
        return next((x for x in reversed(path.split("/")[:-1]) if re.fullmatch(r"\d{4}-\d{2}", x)), None)

    return [p for p in paths if named(p) in (None, month)]


def read_registry(spark: SparkSession, directory: str, month: str | None = None, multiline: bool = False) -> dict[str, DataFrame]:
    """All families of a landing folder, plain files and zips, in nested folders too; families without files are left out.

    With ``month``, files in folders named after other months are not read;
    with ``multiline``, quoted fields may have line breaks.
    """
    paths = sorted(r["path"] for r in files_in(spark, directory).collect())  # names of files
    paths = paths if month is None else of_month(paths, month)
    plain: dict[str, list[str]] = {}
    for path in paths:
        # a dump that a cluster wrote is a folder of parts, named like the file
        if not path.lower().endswith(".zip") and (family := route(posixpath.basename(path)) or route(posixpath.basename(posixpath.dirname(path)))):
            plain.setdefault(family, []).append(path)
    found = {family: read_dump(spark, of, FAMILIES[family], multiline=multiline) for family, of in plain.items()}
    zips = [path for path in paths if path.lower().endswith(".zip")]
    if zips:
        for family in sorted(r[0] for r in _routed(zip_entries(spark, zips)).select("family").distinct().collect() if r[0]):
            rows = read_zipped(spark, zips, FAMILIES[family], family=family, multiline=multiline)
            found[family] = found[family].unionByName(rows) if family in found else rows
    return found


def read_lookup(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A comma-separated file with a header, whose names may have spaces around them."""
    rows = spark.read.csv(path, header=True, sep=",")
    rows = rows.toDF(*[c.strip() for c in rows.columns])
    return rows.select(*[F.trim(F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema])


def read_places(spark: SparkSession, path: str | list[str], counts: Observation | None = None) -> DataFrame:
    """Coordinates of companies, cleansed: rows with another number of fields or with coordinates that are no numbers are dropped.

    Roots and postcodes are filled up to eight digits; ``nan`` and empty text
    become null, tabs become spaces, undecodable bytes go.  The first action on
    the rows fills ``counts`` with ``n_read`` and ``n_skipped``.
    """
    rows, valid = _raw_places(spark, path)
    if counts is not None:
        rows, valid = rows.select("*", valid.alias("__valid")).observe(counts, *_counts("__valid")), F.col("__valid")
    text = {f.name: F.coalesce(F.regexp_replace(F.col(f.name), "�", ""), F.lit("")) for f in GEOLOC}
    made = {"cnpj_basico": zfill(F.trim(text["cnpj_basico"]), 8), "cep": postcode(text["cep"]), "latitude": as_double(F.trim(text["latitude"])), "longitude": as_double(F.trim(text["longitude"]))}
    return rows.where(valid).select(*[made.get(f.name, clean_token(text[f.name])).alias(f.name) for f in GEOLOC])


def _raw_places(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, Column]:
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in GEOLOC] + [T.StructField(_BAD, T.StringType())])
    rows = _whole_rows(spark).csv(path, schema=raw, header=True, sep=",", quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, enforceSchema=True)
    latitude, longitude = (F.coalesce(F.regexp_replace(F.col(c), "�", ""), F.lit("")) for c in ("latitude", "longitude"))
    return rows, F.col(_BAD).isNull() & coordinate_is_valid(latitude) & coordinate_is_valid(longitude)


def _counts(valid: str) -> list[Column]:
    return [F.count_if(valid).alias("n_read"), F.count_if(~F.col(valid)).alias("n_skipped")]


def count_places(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row: how many rows of coordinates :func:`read_places` reads and how many it skips."""
    rows, valid = _raw_places(spark, path)
    return rows.select("*", valid.alias("__valid")).agg(*_counts("__valid"))


def read_tail(spark: SparkSession, path: str, skip: int, column: int = 0, sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """One field of the records after the first ``skip`` of each file, with its line number ``line`` in the file.

    Lines are numbered by counting those of the file's splits before, so a
    file is read in parallel and nothing is gathered but one count a split.
    """
    split = ["file_path", "file_block_start"]
    lines = spark.read.option("encoding", encoding).text(path).select("value", *[f"_metadata.{c}" for c in split], F.monotonically_increasing_id().alias("id"))
    sizes = lines.groupBy(*split).agg(F.count("*").alias("n"), F.min("id").alias("first"))
    earlier = Window.partitionBy("file_path").orderBy("file_block_start").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    rows = lines.join(before, split).select((F.col("before") + F.col("id") - F.col("first")).alias("line"), F.regexp_replace(F.split("value", sep)[column], '"', "").alias("value"))
    return rows.where(F.col("line") >= skip)


def union_places(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Two files under one order of columns; all rows of both."""
    return a.select(*columns).unionByName(b.select(*columns))


def read_month(spark: SparkSession, base: str, month: str) -> DataFrame:
    """One month of a panel; other months' folders are not read."""
    return spark.read.parquet(base).where(F.col("reference_month") == month)
