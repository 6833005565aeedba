"""Forward replay: a baseline and a ledger of monthly events become a panel of establishment by month.

The state is one wide frame.  A month costs two joins: one full outer join on
the establishment key applies deletes, updates and inserts; one left join on
the company root applies company, fiscal and partner events, gathered to one
row per root first.  Each month's state is written, so lineage is one month
long, and the next month starts from files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.expr import in_list, month_range
from panelforge.operators.dedup import latest_status, quarantine, resolve_companies
from panelforge.operators.keyed import upsert
from panelforge.operators.summary import partner_summary
from panelforge.schemas import COMPANY_FIELDS, ESTABLISHMENT_FIELDS, ESTABLISHMENT_KEY, FISCAL_FIELDS, PANEL_COLUMNS, PARTNER_FIELDS, PARTNER_ZERO
from panelforge.storage import materialise

ROOT = "cnpj_basico"
_ATTRIBUTES = [*COMPANY_FIELDS, *FISCAL_FIELDS, *PARTNER_FIELDS]


def company_attributes(companies: DataFrame, fiscal: DataFrame, partners: DataFrame) -> DataFrame:
    """Company, fiscal and partner columns of every root that any of the three has."""
    parts = [companies.select(ROOT, *COMPANY_FIELDS), fiscal.select(ROOT, *FISCAL_FIELDS), partner_summary(partners).select(ROOT, *PARTNER_FIELDS)]
    return reduce(lambda a, b: a.join(b, ROOT, "full_outer"), parts)


def _zeroed(source: str = "") -> list[Column]:
    return [(F.coalesce(F.col(source + c), F.lit(0)) if c in PARTNER_ZERO else F.col(source + c)).alias(c) for c in _ATTRIBUTES]


def baseline_state(establishments: DataFrame, attributes: DataFrame) -> DataFrame:
    """One row per establishment, the one with the highest status, with the attributes of its root; partner counts are 0 without partners."""
    rows = latest_status(establishments.select(*ESTABLISHMENT_KEY, *ESTABLISHMENT_FIELDS))
    return rows.join(attributes, ROOT, "left").select(*ESTABLISHMENT_KEY, *ESTABLISHMENT_FIELDS, *_zeroed())


def _establishment_events(state: DataFrame, events: DataFrame, attributes: DataFrame, from_leaving: bool) -> DataFrame:
    """State after the month's establishment events.

    Deletes and updates of unknown keys and inserts of known ones do nothing.
    A new establishment takes the attributes of a sibling that was in the
    state before the month's inserts (the one with the least key), or, if its
    root has none, the root's attributes in the baseline.  With
    ``from_leaving`` siblings that the month deletes count too.
    """
    news = events.select(*ESTABLISHMENT_KEY, F.col("tipo_alteracao").alias("__kind"), F.col("novo").alias("__new"))
    own = state.select(*ESTABLISHMENT_KEY, F.struct(*ESTABLISHMENT_FIELDS, *_ATTRIBUTES).alias("__own"))
    both = own.join(news, ESTABLISHMENT_KEY, "full_outer")
    kind, known = F.col("__kind"), F.col("__own").isNotNull()
    updated = known & F.coalesce(kind == "UPDATE", F.lit(False))
    kept = both.where(known & F.coalesce(kind != "DELETE", F.lit(True))).select(
        *ESTABLISHMENT_KEY, *[F.when(updated, F.col(f"__new.{c}")).otherwise(F.col(f"__own.{c}")).alias(c) for c in ESTABLISHMENT_FIELDS], *[F.col(f"__own.{c}").alias(c) for c in _ATTRIBUTES]
    )
    added = both.where(~known & (kind == "INSERT")).select(*ESTABLISHMENT_KEY, *[F.col(f"__new.{c}").alias(c) for c in ESTABLISHMENT_FIELDS])
    siblings = (state if from_leaving else kept).join(added.select(ROOT).distinct(), ROOT, "left_semi").groupBy(ROOT).agg(F.min_by(F.struct(*_ATTRIBUTES), F.struct("cnpj_ordem", "cnpj_dv")).alias("__sibling"))
    first = attributes.select(ROOT, F.struct(*_ATTRIBUTES).alias("__first"))
    rows = added.join(siblings, ROOT, "left").join(first, ROOT, "left").withColumn("__from", F.when(F.col("__sibling").isNotNull(), F.col("__sibling")).otherwise(F.col("__first")))
    return kept.unionByName(rows.select(*ESTABLISHMENT_KEY, *ESTABLISHMENT_FIELDS, *_zeroed("__from.")))


def _root_events(events: dict[str, DataFrame]) -> DataFrame:
    """One row per root: kind and new values of its company, fiscal and partner event, null without one."""
    parts = [events[t].select(ROOT, F.col("tipo_alteracao").alias(f"__{t}"), F.col("novo").alias(f"__{t}_new")) for t in ("empresa", "simples", "socios")]
    return reduce(lambda a, b: a.join(b, ROOT, "full_outer"), parts)


def _apply_root_events(state: DataFrame, roots: DataFrame) -> DataFrame:
    """A company's deletion removes all its establishments; a fiscal one empties its columns, a partner one zeroes the counts."""
    rows = state.join(roots, ROOT, "left")
    rows = rows.where(F.coalesce(F.col("__empresa") != "DELETE", F.lit(True)))

    def value(c: str, t: str) -> Column:
        kind, gone = F.col(f"__{t}"), F.lit(0) if c in PARTNER_ZERO else F.lit(None)
        return F.when(kind.isin("INSERT", "UPDATE"), F.col(f"__{t}_new.{c}")).when(kind == "DELETE", gone).otherwise(F.col(c)).alias(c)

    tables = [("empresa", COMPANY_FIELDS), ("simples", FISCAL_FIELDS), ("socios", PARTNER_FIELDS)]
    return rows.select(*ESTABLISHMENT_KEY, *ESTABLISHMENT_FIELDS, *[value(c, t) for t, cs in tables for c in cs])


def next_month(state: DataFrame, events: dict[str, DataFrame], attributes: DataFrame, from_leaving: bool = False) -> DataFrame:
    """State after one month's events, which are keyed by table name and unique by key in each table."""
    return _apply_root_events(_establishment_events(state, events["estabelecimento"], attributes, from_leaving), _root_events(events))


def finish(rows: DataFrame, cities: DataFrame, held: DataFrame, states: str | None) -> DataFrame:
    """The output of all months at once: the states asked for, with city codes, and without the company and fiscal values of roots in quarantine."""
    rows = rows.where(in_list(F.col("uf"), states)).join(cities.groupBy(F.col("codigo").alias("municipio")).agg(F.min("cd_mun").alias("cd_mun")), "municipio", "left")
    rows = rows.join(held.select(ROOT).distinct().withColumn("__held", F.lit(True)), ROOT, "left")
    hidden = {*COMPANY_FIELDS, *FISCAL_FIELDS}
    return rows.select("reference_month", *[F.when(F.col("__held").isNull(), F.col(c)).alias(c) if c in hidden else F.col(c) for c in PANEL_COLUMNS])


def reconstruct_panel(spark: SparkSession, tables: dict[str, DataFrame], ledger: dict[str, DataFrame], start: str, end: str, states: str | None = None, logged: DataFrame | None = None, from_leaving: bool = False) -> tuple[DataFrame, DataFrame]:
    """(panel, quarantine) from ``start``, the month of the baseline ``tables``, to ``end``.

    ``ledger`` has the events of each table with ``mes_referencia``; the
    filter on states is on the output alone, as an establishment may move in
    and out.  ``logged`` is the quarantine so far; its rows of ``start`` are
    found anew.  Companies in quarantine have no attributes in the baseline.

    A root whose establishments all go in a month in which another one comes
    begins again with its baseline values, as deletes are applied first; with
    ``from_leaving`` it goes on with the values it had.
    """
    months = month_range(start, end)
    found = quarantine(tables["empresa"], start, "retained")
    held = found if logged is None else upsert(logged.where(F.col("reference_month") != start), found, [ROOT])
    held = materialise(held.select(ROOT, "motivo", "reference_month"), "quarantine")
    companies = resolve_companies(tables["empresa"], names=[]).join(held.select(ROOT), ROOT, "left_anti")
    attributes = materialise(company_attributes(companies, tables["simples"], tables["socios"]), "attributes")
    state = materialise(baseline_state(tables["estabelecimento"], attributes), "state")
    out = [state.withColumn("reference_month", F.lit(months[0]))]
    for month in months[1:]:
        state = materialise(next_month(state, {t: e.where(F.col("mes_referencia") == month) for t, e in ledger.items()}, attributes, from_leaving), "state")
        out.append(state.withColumn("reference_month", F.lit(month)))
    # the months' states are files by now; cities and quarantine meet them once, not month by month
    return finish(reduce(DataFrame.unionByName, out), tables["munic"], held, states), held
