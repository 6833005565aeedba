"""Validity intervals that grow by a month at a time.

An interval can only change while its run is open.  So a month meets the open
intervals, at most a run a key, and those that it ends are set aside for good.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.functions.expr import any_differs
from panelforge.sinks.files import append_row, read_or_empty
from panelforge.storage import folders_in, remove

MANIFEST = "month string, folder string"


def _since(earlier, later):
    return F.months_between(F.to_date(F.concat(later, F.lit("-01"))), F.to_date(F.concat(earlier, F.lit("-01"))))


def extend(open_now: DataFrame, rows: DataFrame, keys: list[str], watched: list[str], carried: list[str], month: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(ended, open) after the rows of a month, which is later than all before and has a row a key at most.

    As in :func:`panelforge.operators.temporal.intervals`: a change in a
    watched column ends a key's run, one in a carried column opens an interval
    within it, and a value that comes back within the run goes on with its
    former interval.  With ``strict`` a month without the key ends its run.
    """
    columns = [*watched, *[c for c in carried if c not in watched]]
    now = rows.select(*keys, *columns, F.lit(month).alias("valid_from_month"), F.lit(month).alias("valid_to_month"))
    met = open_now.join(now.select(*keys, F.struct(*watched).alias("__now")), keys, "left")
    ends = F.col("__now").isNotNull() & any_differs((F.col(c), F.col(f"__now.{c}")) for c in watched)
    if strict:
        last = F.max("valid_to_month").over(Window.partitionBy(*keys))
        met = met.withColumn("__last", last)
        ends = ends | (_since(F.col("__last"), F.lit(month)) > 1)
    met = met.withColumn("__ends", ends)
    ended = met.where("__ends").select(open_now.columns)
    still = met.where("NOT __ends").select(*keys, *columns, "valid_from_month", "valid_to_month").unionByName(now)
    return ended, still.groupBy(*keys, *columns).agg(F.min("valid_from_month").alias("valid_from_month"), F.max("valid_to_month").alias("valid_to_month"))


class Periods:
    """The intervals of a panel under ``root``, a month after the other; a month counts once one row of the manifest names its folder."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], watched: list[str], carried: list[str], strict: bool = False) -> None:
        self.spark, self.root, self.how = spark, root, (keys, watched, carried)
        self.strict = strict

    def months(self) -> dict[str, str]:
        """Folder of each month, oldest first."""
        return {r["month"]: r["folder"] for r in read_or_empty(self.spark, f"{self.root}/manifest", MANIFEST).orderBy("month").collect()}  # months, not data

    def add(self, rows: DataFrame, month: str) -> bool:
        """Take in a month; False if it was there before.  Months go forward."""
        known = self.months()
        if month in known:
            return False
        if known and max(known) > month:
            raise ValueError(f"{month} is older than {max(known)}")
        keys, watched, carried = self.how
        columns = [*keys, *watched, *[c for c in carried if c not in watched]]
        schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in columns) + ", valid_from_month string, valid_to_month string"
        before = self.spark.read.parquet(f"{known[max(known)]}/open") if known else self.spark.createDataFrame([], schema)
        folder = f"{self.root}/data/{month}-{uuid.uuid4().hex}"
        ended, still = extend(before, rows, keys, watched, carried, month, self.strict)
        ended.write.parquet(f"{folder}/ended")
        still.write.parquet(f"{folder}/open")
        append_row(self.spark, f"{self.root}/manifest", MANIFEST, (month, folder))
        return True

    def read(self) -> DataFrame:
        """All intervals, those that may still grow included."""
        folders = list(self.months().values())
        if not folders:
            raise LookupError(f"{self.root} has no month")
        return self.spark.read.parquet(*[f"{x}/ended" for x in folders], f"{folders[-1]}/open")

    def vacuum(self) -> list[str]:
        """Remove what the manifest does not name, and open intervals of months before the last; no month may be under way."""
        folders = list(self.months().values())
        known = {x.rsplit("/", 1)[-1] for x in folders}
        gone = [x for x in folders_in(self.spark, f"{self.root}/data") if x.rsplit("/", 1)[-1] not in known]
        gone += [f"{x}/open" for x in folders[:-1] if any(y.endswith("/open") for y in folders_in(self.spark, x))]
        for folder in gone:
            remove(self.spark, folder)
        return gone
