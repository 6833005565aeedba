"""Changes to keyed tables as joins; each gives a new DataFrame and leaves its inputs alone.

``rows`` and ``changes`` have unique keys.  All of these are equi-joins on the
key, so tables that are bucketed or partitioned by it need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(rows: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows replaced by the changes with their key, and the other changes added."""
    return rows.join(changes.select(*keys), keys, "left_anti").select(*rows.columns).unionByName(changes.select(*rows.columns))


def insert_ignore(rows: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, and of the new ones those whose key is not there yet; of several new ones with a key the first by all other columns."""
    missing = new.select(*rows.columns).join(rows.select(*keys), keys, "left_anti")
    others = [c for c in rows.columns if c not in keys]
    first = missing.groupBy(*keys).agg(F.min(F.struct(*[x for c in others for x in (F.col(c).isNull().alias(f"{c}__null"), F.col(c))])).alias("__first")) if others else missing.distinct()
    return rows.unionByName(first.select(*[F.col(c) if c in keys else F.col(f"__first.{c}").alias(c) for c in rows.columns]))


def delete_keys(rows: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among those gone."""
    return rows.join(gone.select(*keys), keys, "left_anti").select(*rows.columns)


def keep_keys(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is wanted (semi-join)."""
    return rows.join(wanted.select(*keys), keys, "left_semi").select(*rows.columns)


def update_from(rows: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows with ``columns`` taken from the change with their key, nulls included; rows without one stay as they are."""
    new = changes.select(*keys, F.struct(*columns).alias("__new"))
    out = rows.join(new, keys, "left")
    return out.select(*[F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in rows.columns])


def overlay(latest: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    """The latest rows, and of the baseline those whose key has no latest row: the baseline is looked at per key, not per column."""
    return latest.unionByName(baseline.join(latest.select(*keys), keys, "left_anti").select(*latest.columns))


def as_of(keys_: DataFrame, events: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """``keys_`` with the values of each key's last event by ``order``; keys without one get nulls."""
    last = events.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("__last"))
    return keys_.join(last, keys, "left").select(*keys_.columns, *[F.col(f"__last.{v}").alias(v) for v in values])
