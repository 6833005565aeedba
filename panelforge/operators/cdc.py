"""Change detection between a month's dump and the known state, and the overlay that follows from it.

The known state of a key is its overlay row if there is one, else its baseline
row; baselines are never changed.  One full outer join on the key gives all
inserts, updates and deletes at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.expr import any_differs, differs
from panelforge.operators.keyed import overlay
from panelforge.schemas import TableSpec


def known_state(latest: DataFrame, baseline: DataFrame, spec: TableSpec) -> DataFrame:
    """Key, tracked columns and ``is_deleted`` of every key seen so far."""
    columns = [*spec.keys, *spec.tracked, "is_deleted"]
    return overlay(latest.select(*columns), baseline.withColumn("is_deleted", F.lit(False)).select(*columns), spec.keys)


def _change(found: Column, known: Column, deleted: Column, differ: Column) -> Column:
    live = known & ~deleted
    return F.when(found & ~live, "INSERT").when(found & live & differ, "UPDATE").when(~found & live, "DELETE")


def detect(staging: DataFrame, latest: DataFrame, baseline: DataFrame, spec: TableSpec, month: str) -> DataFrame:
    """The month's events: key, ``tipo_alteracao``, ``mes_referencia``, and the images ``anterior`` and ``novo`` as structs of the tracked columns.

    A key that is new or was deleted is an INSERT (with the tombstone's values
    as the image before), one with any tracked column changed, to or from null
    too, an UPDATE, and a live one that the dump lacks a DELETE.  Keys must be
    unique in all three inputs; columns that are not tracked play no part.
    """
    return changes(staging, known_state(latest, baseline, spec), spec, month)


def changes(staging: DataFrame, known: DataFrame, spec: TableSpec, month: str, keep: list[str] | None = None) -> DataFrame:
    """As :func:`detect`, against the known state itself, whose columns ``keep`` go with the events."""
    image = F.struct(*[F.col(c) for c in spec.tracked])
    new = staging.select(*spec.keys, image.alias("novo"))
    old = known.select(*spec.keys, image.alias("anterior"), "is_deleted", *(keep or []))
    found, seen = F.col("novo").isNotNull(), F.col("is_deleted").isNotNull()
    differ = any_differs((F.col(f"novo.{c}"), F.col(f"anterior.{c}")) for c in spec.tracked)
    kind = _change(found, seen, F.coalesce("is_deleted", F.lit(False)), differ).alias("tipo_alteracao")
    events = new.join(old, spec.keys, "full_outer").select(*spec.keys, kind, "anterior", "novo", *(keep or []))
    return events.where(F.col("tipo_alteracao").isNotNull()).withColumns({"tabela": F.lit(spec.name), "mes_referencia": F.lit(month)})


def apply_events(latest: DataFrame, events: DataFrame, spec: TableSpec) -> DataFrame:
    """The overlay after a month: inserted and updated keys take the new values, deleted keys become tombstones.

    A tombstone keeps the overlay's values if the key had a row there; else
    it has nulls, or the defaults of ``spec``.
    """
    own = latest.select(*spec.keys, F.struct(*spec.tracked).alias("__own"), "is_deleted", "last_updated_month")
    both = own.join(events.select(*spec.keys, "tipo_alteracao", "novo", "mes_referencia"), spec.keys, "full_outer")
    kind = F.col("tipo_alteracao")

    def value(c: str) -> Column:
        unseen = F.when(F.col("__own").isNull(), F.lit(spec.defaults.get(c)))
        return F.when(kind.isin("INSERT", "UPDATE"), F.col(f"novo.{c}")).otherwise(F.coalesce(F.col(f"__own.{c}"), unseen)).alias(c)

    deleted = F.when(kind.isNull(), F.col("is_deleted")).otherwise(kind == "DELETE")
    return both.select(*spec.keys, *[value(c) for c in spec.tracked], deleted.alias("is_deleted"), F.coalesce("mes_referencia", "last_updated_month").alias("last_updated_month"))


def count_events(events: DataFrame) -> DataFrame:
    """Inserts, updates and deletes per month and table."""
    kinds = {"inserts": "INSERT", "updates": "UPDATE", "deletes": "DELETE"}
    return events.groupBy("mes_referencia", "tabela").agg(*[F.count_if(F.col("tipo_alteracao") == k).alias(n) for n, k in kinds.items()])


def as_json(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Events with key and images as JSON objects that keep nulls, the ledger's form at the boundary."""
    options = {"ignoreNullFields": "false"}
    images = {"chave": F.struct(*spec.keys), "conteudo_anterior": F.col("anterior"), "conteudo_novo": F.col("novo")}
    return events.select("tabela", *spec.keys, *[F.to_json(x, options).alias(n) for n, x in images.items()], "tipo_alteracao", "mes_referencia")


def from_json(ledger: DataFrame, image: str) -> DataFrame:
    """Ledger rows with their JSON images read back as structs of the schema ``image``; keys that are missing are null."""
    return ledger.withColumn("anterior", F.from_json("conteudo_anterior", image)).withColumn("novo", F.from_json("conteudo_novo", image))


def detect_against_ledger(staging: DataFrame, baseline: DataFrame, ledger: DataFrame, spec: TableSpec, month: str, scope: list[str] | None = None) -> DataFrame:
    """The older rule set, kept for ledgers that were made with it.

    A key in the baseline is updated only if it differs from the baseline
    *and* from its last event, so a return to the baseline's values goes
    unseen.  One that is in neither baseline nor ledger is an INSERT, and a
    changed one that only the ledger knows is logged as an INSERT again.
    Deletes are looked for only where ``scope`` is given: keys of the baseline
    that the dump lacks, although it has others with the same ``scope``
    columns.  ``ledger`` has ``novo`` and an ordering column ``id``.
    """
    image = F.struct(*[F.col(c) for c in spec.tracked])
    last = ledger.where(F.col("novo").isNotNull()).groupBy(*spec.keys).agg(F.max_by("novo", "id").alias("logged"))
    new, old = staging.select(*spec.keys, image.alias("novo")), baseline.select(*spec.keys, image.alias("anterior"))
    rows = new.join(old, spec.keys, "left").join(last, spec.keys, "left")
    unlike = lambda c: differs(F.to_json("novo", {"ignoreNullFields": "false"}), F.to_json(c, {"ignoreNullFields": "false"}))
    based = F.col("anterior").isNotNull()
    kind = F.when(based & unlike("anterior") & (F.col("logged").isNull() | unlike("logged")), "UPDATE").when(~based & unlike("logged"), "INSERT")
    events = rows.withColumn("tipo_alteracao", kind).where(F.col("tipo_alteracao").isNotNull()).select(*spec.keys, "tipo_alteracao", "anterior", "novo")
    if scope:
        gone = old.join(staging.select(*scope).distinct(), scope, "left_semi").join(new.select(*spec.keys), spec.keys, "left_anti")
        events = events.unionByName(gone.select(*spec.keys, F.lit("DELETE").alias("tipo_alteracao"), "anterior", F.lit(None).cast(new.schema["novo"].dataType).alias("novo")))
    return events.withColumns({"tabela": F.lit(spec.name), "mes_referencia": F.lit(month)})
