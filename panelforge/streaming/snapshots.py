"""Change detection of several tables with one commit a month, over states kept in hash buckets.

The state of a table is one Spark table, bucketed by its key and partitioned
by attempt: the baseline is its first attempt, and a month adds the rows of
the keys that changed, into their buckets only.  A snapshot names, bucket by
bucket, the attempts that count, and of a key the row of the last one does.
So a month's state comes from one bucketed scan without a shuffle, a month
writes as many rows as it has events, and buckets that no event touches are
left alone.  A bucket with ``depth`` attempts beside the baseline is merged
into one.

Events, counts, states and what else a month makes (quarantine, side outputs)
are named by the same snapshot, for all tables: a reader that holds one never
sees a table of a month without the others.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.cdc import changes
from panelforge.operators.checks import require_rows
from panelforge.operators.dedup import quarantine
from panelforge.schemas import SIDE_OUTPUTS, TableSpec
from panelforge.sinks.log import Conflict, SnapshotLog
from panelforge.storage import folders_in, remove

Dumps = dict[str, DataFrame]


def registry_extras(dumps: Dumps, month: str) -> Dumps:
    """What a month of the registry makes beside its events: companies in conflict, and the columns that change detection ignores."""
    side = {name: dumps[name.removesuffix("_enderecos")].select(*columns) for name, columns in SIDE_OUTPUTS.items()}
    return {"quarantine": quarantine(dumps["empresa"], month, "staging"), **side}


class SnapshotMonths:
    """Months of the tables ``specs`` under ``root``, one after the other.

    ``baseline`` has the rows of the first month, and is read when ``root`` is
    new.  ``dedup`` makes a table's dump one row a key; keys are never null.
    ``buckets`` is fixed when ``root`` is new: enough that a bucket of the
    largest table fits in a task.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        specs: dict[str, TableSpec],
        baseline: Dumps,
        dedup: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
        extras: Callable[[Dumps, str], Dumps] | None = None,
        buckets: int = 256,
        depth: int = 6,
    ) -> None:
        self.spark, self.root, self.specs, self.dedup, self.extras, self.depth = spark, root, specs, dedup or {}, extras, depth
        self.log = SnapshotLog(spark, f"{root}/log")
        self._known: dict[str, frozenset[str]] = {}
        number, now = self.log.read()
        self.buckets = now.get("buckets", buckets)
        if not number:
            now = {"buckets": buckets, "baseline": {}, "tables": {}, "months": {}}
            for table in specs:
                rows = self._dedup(table, baseline[table])
                self._create(table, rows)
                now["baseline"][table], now["tables"][table] = self._attempt(0), {}
                self._write(table, rows.withColumns({"is_deleted": F.lit(False), "last_updated_month": F.lit(None).cast("string")}), now["baseline"][table])
            self.log.commit(0, now)

    def _dedup(self, table: str, rows: DataFrame) -> DataFrame:
        return self.dedup[table](rows) if table in self.dedup else rows

    def _name(self, table: str) -> str:
        return f"panelforge_{hashlib.md5(f'{self.root}/{table}'.encode()).hexdigest()}"

    def _attempt(self, number: int) -> str:
        return f"{number + 1:010d}-{uuid.uuid4().hex}"

    def _bucket(self, table: str) -> Column:
        # what Spark itself deals rows to the buckets of a table by
        return F.pmod(F.hash(*self.specs[table].keys), F.lit(self.buckets))

    def _columns(self, table: str) -> list[str]:
        return [*self.specs[table].keys, *self.specs[table].tracked, "is_deleted", "last_updated_month", "bucket"]

    def _create(self, table: str, like: DataFrame | None = None) -> str:
        """The table in this session's catalog; its files are Spark's and outlive the session."""
        name, spec = self._name(table), self.specs[table]
        if not self.spark.catalog.tableExists(name):
            path = f"{self.root}/{table}/state"
            like = self.spark.read.parquet(path) if like is None else like
            types = ", ".join(f"`{c}` {like.schema[c].dataType.simpleString()}" for c in [*spec.keys, *spec.tracked])
            keys = ", ".join(f"`{c}`" for c in spec.keys)
            self.spark.sql(f"CREATE TABLE {name} ({types}, is_deleted BOOLEAN, last_updated_month STRING, bucket INT, attempt STRING) USING parquet PARTITIONED BY (attempt) CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return name

    def _write(self, table: str, rows: DataFrame, attempt: str, dealt: bool = False) -> None:
        """Add rows as an attempt, a file a bucket; ``dealt``: they are by bucket already."""
        rows = rows if dealt else rows.repartition(self.buckets, *self.specs[table].keys)
        rows.withColumn("bucket", self._bucket(table)).select(*self._columns(table), F.lit(attempt).alias("attempt")).write.insertInto(self._create(table))

    def snapshot(self, number: int | None = None) -> dict:
        """What is in force, or was under a number that is kept."""
        return self.log.read(number)[1]

    def _rows(self, table: str, now: dict, only: list[int] | None = None) -> DataFrame:
        """State rows of a snapshot, one a key, by bucket; of ``only`` some buckets, without the baseline, to merge them."""
        name, named = self._create(table), now["tables"][table]
        attempts: dict[str, list[int]] = {}
        for bucket, found in named.items():
            for attempt in found:
                if only is None or int(bucket) in only:
                    attempts.setdefault(attempt, []).append(int(bucket))
        first = now["baseline"][table]
        if not self._known.get(table, frozenset()) >= {first, *attempts}:
            self.spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
            self._known[table] = frozenset({first, *attempts})
        counts = F.lit(False) if only is not None else F.col("attempt") == first
        for attempt, of in sorted(attempts.items()):
            counts = counts | ((F.col("attempt") == attempt) & F.col("bucket").isin(*of))
        spec = self.specs[table]
        rest = [c for c in self._columns(table) if c not in spec.keys]
        last = self.spark.table(name).where(counts).groupBy(*spec.keys).agg(F.max_by(F.struct(*rest), "attempt").alias("__last"))
        return last.select(*spec.keys, *[F.col(f"__last.{c}").alias(c) for c in rest])

    def state(self, table: str, number: int | None = None) -> DataFrame:
        """Every key ever seen with its tracked columns, ``is_deleted`` and ``last_updated_month`` (null: as in the baseline)."""
        return self._rows(table, self.snapshot(number)).drop("bucket")

    def overlay(self, table: str, number: int | None = None) -> DataFrame:
        """The state of the keys that any month changed."""
        return self.state(table, number).where(F.col("last_updated_month").isNotNull())

    def _folders(self, kind: str, name: str, number: int | None) -> DataFrame:
        folders = [m[kind][name]["folder"] for m in self.snapshot(number)["months"].values() if name in m[kind]]
        if not folders:
            raise LookupError(f"{self.root} has no month of {name}")
        return self.spark.read.parquet(*[f"{self.root}/{x}" for x in folders])

    def ledger(self, table: str, number: int | None = None) -> DataFrame:
        """Events of all months of a snapshot."""
        return self._folders("tables", table, number).drop("own", "bucket")

    def extra(self, name: str, number: int | None = None) -> DataFrame:
        """What ``extras`` made under a name, all months of a snapshot, with ``reference_month``."""
        return self._folders("extras", name, number)

    def counts(self, number: int | None = None) -> dict[str, dict[str, tuple[int, int, int]]]:
        """Inserts, updates and deletes by month and table."""
        months = self.snapshot(number)["months"]
        return {m: {t: tuple(x["counts"]) for t, x in of["tables"].items()} for m, of in months.items()}

    def run(self, dumps: Dumps, month: str) -> bool:
        """Detect a month of all tables and commit it as one; False if it is there already.

        A run that breaks off, or loses against another writer
        (:class:`Conflict`), has changed nothing and can
        be run again.  Months go forward.
        """
        number, now = self.log.read()
        if month in now["months"]:
            return False
        if any(m > month for m in now["months"]):
            raise ValueError(f"{month} is older than {max(now['months'])}")
        for table in self.specs:
            require_rows(dumps[table], f"{table} of {month}")
        attempt, of_month = self._attempt(number), {"tables": {}, "extras": {}}
        for table in self.specs:
            of_month["tables"][table] = self._detect(table, now, self._dedup(table, dumps[table]), month, attempt)
        for name, rows in (self.extras(dumps, month) if self.extras else {}).items():
            of_month["extras"][name] = {"folder": f"extras/{name}/{attempt}"}
            rows.withColumn("reference_month", F.lit(month)).write.parquet(f"{self.root}/extras/{name}/{attempt}")
        now["months"][month] = of_month
        self.log.commit(number, now)
        try:
            self.merge()
        except Conflict:
            pass  # the month stands; a later one merges
        return True

    def _detect(self, table: str, now: dict, rows: DataFrame, month: str, attempt: str) -> dict:
        spec, folder = self.specs[table], f"{table}/ledger/{attempt}"
        known = self._rows(table, now).withColumn("own", F.col("last_updated_month").isNotNull())
        changes(rows, known, spec, month, ["own"]).withColumn("bucket", self._bucket(table)).write.parquet(f"{self.root}/{folder}")
        events = self.spark.read.parquet(f"{self.root}/{folder}")
        # at most three rows a bucket
        found = events.groupBy("bucket", "tipo_alteracao").count().collect()
        if found:
            gone = F.col("tipo_alteracao") == "DELETE"
            values = [F.when(~gone, F.col(f"novo.{c}")).when(F.coalesce("own", F.lit(False)), F.col(f"anterior.{c}")).otherwise(F.lit(spec.defaults.get(c))).alias(c) for c in spec.tracked]
            self._write(table, events.select(*spec.keys, *values, gone.alias("is_deleted"), F.lit(month).alias("last_updated_month")), attempt)
        for bucket in {r["bucket"] for r in found}:
            now["tables"][table].setdefault(str(bucket), []).append(attempt)
        return {"folder": folder, "counts": [sum(r["count"] for r in found if r["tipo_alteracao"] == k) for k in ("INSERT", "UPDATE", "DELETE")]}

    def merge(self) -> list[str]:
        """Merge the attempts of buckets that have ``depth`` of them; the tables it was done for.  States stay the same."""
        number, now = self.log.read()
        attempt, done = self._attempt(number), []
        for table in self.specs:
            deep = [int(b) for b, found in now["tables"][table].items() if len(found) >= self.depth]
            if deep:
                self._write(table, self._rows(table, now, deep), attempt, dealt=True)
                now["tables"][table].update({str(b): [attempt] for b in deep})
                done.append(table)
        if done:
            self.log.commit(number, now)
        return done

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove all but the last ``keep`` snapshots and the folders that none of these names; the folders.  No run may be under way."""
        self.log.forget(keep)
        kept = [self.log.read(n)[1] for n in self.log.numbers()]
        used = {x["folder"] for now in kept for m in now["months"].values() for kind in m.values() for x in kind.values()}
        gone = []
        for table in self.specs:
            live = {now["baseline"][table] for now in kept} | {x for now in kept for found in now["tables"][table].values() for x in found}
            gone += [x for x in folders_in(self.spark, f"{self.root}/{table}/state") if x.rsplit("attempt=", 1)[-1] not in live and "attempt=" in x]
            gone += [x for x in folders_in(self.spark, f"{self.root}/{table}/ledger") if "/".join(x.rsplit("/", 3)[1:]) not in used]
            self._known.pop(table, None)
        for name in folders_in(self.spark, f"{self.root}/extras"):
            gone += [x for x in folders_in(self.spark, name) if "/".join(x.rsplit("/", 3)[1:]) not in used]
        for folder in gone:
            remove(self.spark, folder)
        return gone
