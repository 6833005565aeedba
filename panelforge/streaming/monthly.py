"""Monthly change detection: one table, all tables of the registry, and the stream that drives them.

A month's ledger and overlay are written into a folder of the attempt's own,
and count once one row of the run table names that folder.  The state a month
is compared with is always that of the last month before it that ended well,
so a run that breaks off anywhere leaves nothing behind that a re-run sees.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators.cdc import apply_events, count_events, detect
from panelforge.operators.checks import require_rows
from panelforge.operators.dedup import dedup_establishments, dedup_fiscal, quarantine, resolve_companies
from panelforge.operators.keyed import upsert
from panelforge.operators.summary import partner_summary
from panelforge.schemas import SPECS, TableSpec
from panelforge.sinks.files import MARKER, KeyedTable, append_row, read_or_empty, write_side_outputs
from panelforge.storage import exists, folders_in, remove

RUNS = "month string, tabela string, status string, inserts long, updates long, deletes long, folder string, attempt long, finished timestamp"
#: What makes a table's dump of a month one row per key.
DEDUP = {"empresa": resolve_companies, "estabelecimento": dedup_establishments, "socios": partner_summary, "simples": dedup_fiscal}


def empty_overlay(spark: SparkSession, schema: T.StructType, spec: TableSpec) -> DataFrame:
    columns = ", ".join([*(f"{c} {schema[c].dataType.simpleString()}" for c in [*spec.keys, *spec.tracked]), "is_deleted boolean", "last_updated_month string"])
    return spark.createDataFrame([], columns)


class Runs:
    """The run table: a row is added for every attempt, and the last one of a month, by its number, counts."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def attempts(self) -> DataFrame:
        """All attempts of all months."""
        return read_or_empty(self.spark, self.path, RUNS)

    def read(self) -> DataFrame:
        rows = self.attempts()
        return rows.groupBy("month", "tabela").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("month", "tabela")]), "attempt").alias("r")).select("month", "tabela", "r.*")

    def note(self, month: str, table: str, status: str, counts: tuple[int, int, int] = (0, 0, 0), folder: str | None = None) -> None:
        before = self.attempts().where((F.col("month") == month) & (F.col("tabela") == table)).agg(F.max("attempt")).first()[0] or 0
        append_row(self.spark, self.path, RUNS, (month, table, status, *counts, folder, before + 1, datetime.now()))

    def folders(self) -> dict[str, str | None]:
        """Folder of each month that ended well, oldest first."""
        return {r["month"]: r["folder"] for r in self.read().where("status = 'SUCCESS'").orderBy("month").collect()}  # months, not data


class MonthlyChanges:
    """Runs change detection of one table month by month; everything is kept under ``root``."""

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, baseline: DataFrame, dedup: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        self.spark, self.root, self.spec, self.baseline, self.dedup = spark, root, spec, baseline, dedup
        self.runs = Runs(spark, f"{root}/runs")

    def done(self, month: str) -> bool:
        return month in self.runs.folders()

    def overlay(self, before: str | None = None) -> DataFrame:
        """The overlay after the last month that ended well, or the last one before a month."""
        found = [folder for month, folder in self.runs.folders().items() if before is None or month < before]
        return self.spark.read.parquet(f"{found[-1]}/overlay") if found else empty_overlay(self.spark, self.baseline.schema, self.spec)

    def ledger(self) -> DataFrame:
        """Events of all months that ended well."""
        folders = self.runs.folders().values()
        if not folders:
            raise LookupError(f"{self.root} has no month")
        return self.spark.read.parquet(*[f"{x}/ledger" for x in folders])

    def run(self, staging: DataFrame, month: str) -> bool:
        """Detect and apply one month; False if it was done before.

        A failure is noted and raised.  Months go forward: one that is older
        than a month that ended well is refused.
        """
        folders = self.runs.folders()
        if month in folders:
            return False
        try:
            if folders and max(folders) > month:
                raise ValueError(f"{month} of {self.spec.name} is older than {max(folders)}, which ended well")
            rows = self.dedup(require_rows(staging, f"{self.spec.name} of {month}"))
            folder, latest = f"{self.root}/attempts/{month}-{uuid.uuid4().hex}", self.overlay(month)
            detect(rows, latest, self.baseline, self.spec, month).write.parquet(f"{folder}/ledger")
            events = self.spark.read.parquet(f"{folder}/ledger")
            apply_events(latest, events, self.spec).write.parquet(f"{folder}/overlay")
            counted = count_events(events).first()
            self.runs.note(month, self.spec.name, "SUCCESS", (counted["inserts"], counted["updates"], counted["deletes"]) if counted else (0, 0, 0), folder)
        except Exception:
            self.runs.note(month, self.spec.name, "FAILED")
            raise
        return True

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove what no reader needs: attempts that no run names, and the overlays of all but the last ``keep`` months that ended well; the folders removed.

        Ledgers of months that ended well stay.  No run may be under way.
        """
        named = self.runs.folders()
        old = [f"{folder}/overlay" for folder in list(named.values())[:-keep or None] if folder]
        found = folders_in(self.spark, f"{self.root}/attempts")
        known = {folder.rstrip("/").rsplit("/", 1)[-1] for folder in named.values() if folder}
        gone = [x for x in found if x.rsplit("/", 1)[-1] not in known] + [x for x in old if exists(self.spark, x)]
        for folder in gone:
            remove(self.spark, folder)
        return gone

    def follow(self, landing: str) -> list[str]:
        """Process all months whose marker has landed (see ``sinks.files.land_month``), oldest first, and stop; the months that could not be done.

        The stream is one of markers, and its checkpoint remembers them; each
        batch is noted in ``root/markers``, and of a month the last marker
        counts.  Only the folder that it names is read.  If this has not as
        many rows as the marker says, or anything else goes wrong, the month
        is noted as failed and the next call tries it again, with a newer
        marker if there is one; the batch itself never fails, so that a wrong
        landing can be corrected.  Months after a failed one wait, as each is
        compared with the one before it.  Without its marker a month waits.
        """

        def batch(markers: DataFrame, number: int) -> None:
            # a batch that is done again replaces itself
            markers.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/markers/batch={number}")

        stream = self.spark.readStream.schema(MARKER).json(f"{landing}/complete")
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{self.root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        known = read_or_empty(self.spark, f"{self.root}/markers", MARKER).groupBy("reference_month").agg(F.max_by(F.struct("n_rows", "folder"), F.struct("landing", "folder")).alias("m"))
        open_months = [r for r in known.select("reference_month", "m.*").orderBy("reference_month").collect() if not self.done(r["reference_month"])]  # months, not data
        for k, row in enumerate(open_months):
            month = row["reference_month"]
            try:
                rows = self.spark.read.parquet(row["folder"])
                if rows.count() != row["n_rows"]:
                    raise ValueError(f"{month} of {self.spec.name} has not {row['n_rows']} rows")
            except Exception:  # noqa: BLE001  whatever is wrong with a landing, a newer marker may mend it
                self.runs.note(month, self.spec.name, "FAILED")
                return [r["reference_month"] for r in open_months[k:]]
            try:
                self.run(rows, month)
            except Exception:  # noqa: BLE001  noted by the run
                return [r["reference_month"] for r in open_months[k:]]
        return []


class RegistryMonths:
    """A month of the whole registry: side outputs, quarantine and the change detection of the four tables, in their order, under one status row."""

    def __init__(self, spark: SparkSession, root: str, baseline: dict[str, DataFrame]) -> None:
        """``baseline`` has the dumps of the first month."""
        self.spark, self.root = spark, root
        self.tables = {t: MonthlyChanges(spark, f"{root}/{t}", SPECS[t], DEDUP[t](baseline[t]), DEDUP[t]) for t in SPECS}
        self.runs, self.held = Runs(spark, f"{root}/runs"), KeyedTable(spark, f"{root}/quarantine")

    def run(self, dumps: dict[str, DataFrame], month: str) -> bool:
        """False if the month was done before.  After a failure a re-run goes on with the tables that were not done."""
        if month in self.runs.folders():
            return False
        try:
            for table in self.tables:
                require_rows(dumps[table], f"{table} of {month}")
            write_side_outputs(dumps, month, f"{self.root}/ignored")
            found = quarantine(dumps["empresa"], month, "staging")
            self.held.change(lambda rows: upsert(rows.where(F.col("reference_month") != month), found, ["cnpj_basico"]), found.where("false"))
            for table, job in self.tables.items():
                job.run(dumps[table], month)
            of_month = self.counts(month).first()
            self.runs.note(month, "*", "SUCCESS", (of_month["inserts"], of_month["updates"], of_month["deletes"]))
        except Exception:
            self.runs.note(month, "*", "FAILED")
            raise
        return True

    def counts(self, month: str) -> DataFrame:
        """One row: the month's events over all tables."""
        rows = None
        for job in self.tables.values():
            own = job.runs.read().where(F.col("month") == month)
            rows = own if rows is None else rows.unionByName(own)
        return rows.groupBy("month").agg(*[F.sum(c).alias(c) for c in ("inserts", "updates", "deletes")])
