"""Replay without months: events become validity intervals, and one expansion gives all months, in either direction.

The number of joins and shuffles does not depend on the number of months.
Months are places in a list here: 0 is the first, and an interval goes from a
month up to, but not including, another one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelforge.functions.expr import month_end_int, month_range
from panelforge.operators.dedup import latest_status, quarantine, resolve_companies
from panelforge.operators.keyed import upsert
from panelforge.plans.replay import ROOT, company_attributes, finish
from panelforge.schemas import COMPANY_FIELDS, ESTABLISHMENT_FIELDS, ESTABLISHMENT_KEY, FISCAL_FIELDS, PARTNER_FIELDS, PARTNER_ZERO
from panelforge.storage import materialise

_TABLES = [("empresa", COMPANY_FIELDS), ("simples", FISCAL_FIELDS), ("socios", PARTNER_FIELDS)]


def _placed(events: DataFrame, months: list[str]) -> DataFrame:
    """Events with ``at``, the place of their month; those of the first month, or of none, are left out."""
    at = F.array_position(F.array(*[F.lit(m) for m in months]), F.col("mes_referencia")).cast("int") - 1
    return events.withColumn("at", at).where("at > 0")


def _expanded(intervals: DataFrame, months: list[str]) -> DataFrame:
    """A row for each month from ``at`` up to ``until``, with ``reference_month``."""
    rows = intervals.where("until > at").withColumn("__m", F.explode(F.sequence(F.col("at"), F.col("until") - 1)))
    return rows.withColumn("reference_month", F.element_at(F.array(*[F.lit(m) for m in months]), F.col("__m") + 1)).drop("__m")


def establishment_intervals(state: DataFrame, events: DataFrame, closed: DataFrame, months: list[str]) -> DataFrame:
    """``at`` and ``until`` of each version of an establishment, its fields, and ``inserted``, whether it came with this version.

    ``state`` is that of month 0, ``closed`` the months in which companies end
    (root, ``at``), after the events of that month.  An insert of a known key
    and an update or delete of an unknown one do nothing: whether a key is
    known is told by the last insert or delete before, effective or not.
    """
    fields = F.struct(*ESTABLISHMENT_FIELDS)
    first = state.select(*ESTABLISHMENT_KEY, F.lit(0).alias("at"), F.lit(0).alias("phase"), F.lit("INSERT").alias("kind"), fields.alias("v"))
    own = _placed(events, months).select(*ESTABLISHMENT_KEY, "at", F.lit(1).alias("phase"), F.col("tipo_alteracao").alias("kind"), F.struct(*[F.col(f"novo.{c}").alias(c) for c in ESTABLISHMENT_FIELDS]).alias("v"))
    came = first.unionByName(own.where("kind = 'INSERT'")).select(*ESTABLISHMENT_KEY)
    ends = came.join(closed, ROOT).select(*ESTABLISHMENT_KEY, "at", F.lit(2).alias("phase"), F.lit("DELETE").alias("kind"), F.lit(None).cast(first.schema["v"].dataType).alias("v"))
    moves, w = reduce(DataFrame.unionByName, [first, own, ends]), Window.partitionBy(*ESTABLISHMENT_KEY).orderBy("at", "phase")
    told = F.when(F.col("kind") != "UPDATE", F.col("kind") == "INSERT")
    known = F.coalesce(F.last(told, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))
    moves = moves.withColumn("known", known).where((F.col("kind") == "INSERT") != F.col("known"))
    moves = moves.withColumn("until", F.coalesce(F.lead("at").over(w), F.lit(len(months))))
    return moves.where("kind <> 'DELETE' AND until > at").select(*ESTABLISHMENT_KEY, "at", "until", (F.col("kind") == "INSERT").alias("inserted"), "v.*")


def root_spells(intervals: DataFrame, from_leaving: bool = False) -> DataFrame:
    """``at`` and ``until`` of the times without a break in which a root has establishments.

    An establishment that comes in the month in which all others went opens a
    new spell, or with ``from_leaving`` goes on with theirs.  Only the last end by month and kind is looked at, so that a
    root with very many establishments is a few rows.
    """
    # updates first: what they go on with was there before the month's inserts
    ends = intervals.groupBy(ROOT, "at", "inserted").agg(F.max("until").alias("until"))
    w = Window.partitionBy(ROOT).orderBy("at", "inserted")
    before = F.max("until").over(w.rowsBetween(Window.unboundedPreceding, -1))
    last = F.coalesce(before, F.lit(-1))
    opens = F.col("inserted") & (last < F.col("at") if from_leaving else last <= F.col("at"))
    spell = F.sum(opens.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return ends.withColumn("spell", spell).groupBy(ROOT, "spell").agg(F.min("at").alias("at"), F.max("until").alias("until"))


def root_intervals(spells: DataFrame, events: dict[str, DataFrame], attributes: DataFrame, months: list[str]) -> DataFrame:
    """``at`` and ``until`` of each version of a root's company, fiscal and partner columns.

    A spell begins with the baseline's values.  Events of months in which the
    root has no establishments are missed, as there is nothing that they could
    change.
    """
    rows = []
    for t, _ in _TABLES:
        news = {name: F.struct(F.col("tipo_alteracao").alias("kind"), F.col("novo")) if name == t else F.lit(None).cast(f"struct<kind:string,novo:{events[name].schema['novo'].dataType.simpleString()}>") for name, _ in _TABLES}
        rows.append(_placed(events[t], months).select(ROOT, F.col("at").alias("point"), *[c.alias(name) for name, c in news.items()]))
    points = reduce(DataFrame.unionByName, rows)
    within = spells.join(points, ROOT).where("point >= at AND point < until").select(ROOT, F.col("at").alias("start"), F.col("until").alias("end"), "point", *[t for t, _ in _TABLES])
    starts = spells.select(ROOT, F.col("at").alias("start"), F.col("until").alias("end"), F.col("at").alias("point"), *[F.lit(None).cast(points.schema[t].dataType).alias(t) for t, _ in _TABLES])
    w = Window.partitionBy(ROOT, "start").orderBy("point")
    rows = starts.unionByName(within)
    # at most one event a table and month, so that any of them is the one
    rows = rows.groupBy(ROOT, "start", "end", "point").agg(*[F.first(t, ignorenulls=True).alias(t) for t, _ in _TABLES])
    rows = rows.select(ROOT, F.col("point").alias("at"), F.coalesce(F.lead("point").over(w), F.col("end")).alias("until"), *[F.last(t, ignorenulls=True).over(w).alias(t) for t, _ in _TABLES])
    rows = rows.join(attributes, ROOT, "left")

    def value(c: str, t: str) -> Column:
        kind, gone = F.col(f"{t}.kind"), F.lit(0) if c in PARTNER_ZERO else F.lit(None)
        first = F.coalesce(F.col(c), F.lit(0)) if c in PARTNER_ZERO else F.col(c)
        return F.when(kind.isin("INSERT", "UPDATE"), F.col(f"{t}.novo.{c}")).when(kind == "DELETE", gone).otherwise(first).alias(c)

    return rows.select(ROOT, "at", "until", *[value(c, t) for t, cs in _TABLES for c in cs])


def panel_by_intervals(spark: SparkSession, tables: dict[str, DataFrame], ledger: dict[str, DataFrame], start: str, end: str, states: str | None = None, logged: DataFrame | None = None, from_leaving: bool = False) -> tuple[DataFrame, DataFrame]:
    """(panel, quarantine) with the arguments and the results of :func:`panelforge.plans.replay.reconstruct_panel`, for any number of months at once.

    One case differs: of a partner event that leaves a count null, the count is
    null for all establishments here, while the steps give 0 to those that
    come later.
    """
    months = month_range(start, end)
    found = quarantine(tables["empresa"], start, "retained")
    held = found if logged is None else upsert(logged.where(F.col("reference_month") != start), found, [ROOT])
    held = materialise(held.select(ROOT, "motivo", "reference_month"), "quarantine")
    companies = resolve_companies(tables["empresa"], names=[]).join(held.select(ROOT), ROOT, "left_anti")
    attributes = company_attributes(companies, tables["simples"], tables["socios"])
    state = latest_status(tables["estabelecimento"].select(*ESTABLISHMENT_KEY, *ESTABLISHMENT_FIELDS))
    closed = _placed(ledger["empresa"], months).where("tipo_alteracao = 'DELETE'").select(ROOT, "at").distinct()
    versions = materialise(establishment_intervals(state, ledger["estabelecimento"], closed, months), "establishment-intervals")
    roots = materialise(root_intervals(root_spells(versions, from_leaving), ledger, attributes, months), "root-intervals")
    # two written tables, so that Spark splits the rows of a root that very many establishments have
    roots = roots.withColumnsRenamed({"at": "r_at", "until": "r_until"})
    both = versions.join(roots, ROOT).where("r_at < until AND at < r_until")
    both = both.withColumns({"at": F.greatest("at", "r_at"), "until": F.least("until", "r_until")})
    return finish(_expanded(both, months), tables["munic"], held, states), held


def reverse_intervals(latest: DataFrame, ledger: DataFrame, keys: list[str], months: list[str]) -> DataFrame:
    """``at`` and ``until`` of each version of a row, from the state of the last month and what its events say was before.

    The value before an event holds back to the event before it; before an
    insert there is nothing.  Of several events of a key in a month the first
    (by ``id``, if there is one) counts.
    """
    values = [c for c in latest.columns if c not in keys]
    order = F.col("id") if "id" in ledger.columns else F.lit(0)
    events = _placed(ledger, months).groupBy(*keys, "at").agg(F.min_by(F.struct("tipo_alteracao", F.struct(*[F.col(f"anterior.{c}").alias(c) for c in values]).alias("v")), order).alias("e"))
    back = events.select(*keys, F.col("at").alias("until"), F.col("e.v").alias("v"), (F.col("e.tipo_alteracao") != "INSERT").alias("there"))
    own = latest.select(*keys, F.lit(len(months)).alias("until"), F.struct(*values).alias("v"), F.lit(True).alias("there"))
    w = Window.partitionBy(*keys).orderBy("until")
    rows = back.unionByName(own).withColumn("at", F.coalesce(F.lag("until").over(w), F.lit(0)))
    return rows.where("there AND until > at").select(*keys, "at", "until", "v.*")


def panel_by_reverse_intervals(latest: DataFrame, ledger: DataFrame, keys: list[str], months: list[str], opened: str = "data_inicio_atividade") -> DataFrame:
    """All months, with the results of :func:`panelforge.plans.reverse.panel_from_reverse`: one shuffle by key and one expansion."""
    rows = _expanded(reverse_intervals(latest, ledger, keys, months), months).drop("at", "until")
    return rows.where(F.col(opened).isNull() | (F.col(opened) <= month_end_int(F.col("reference_month"))))
