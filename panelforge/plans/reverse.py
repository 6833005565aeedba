"""Reverse replay: from a later state back to earlier months, by undoing each month's events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.expr import month_end_int, safe_parse_date
from panelforge.operators.keyed import keep_keys
from panelforge.operators.summary import partner_age_summary
from panelforge.storage import materialise


def undo_month(state: DataFrame, events: DataFrame, keys: list[str]) -> DataFrame:
    """The state before a month: what it inserted is removed, what it updated or deleted gets its values from before.

    Of several events of a key in the month the first (by ``id``, if there is
    one) counts.  One full outer join.
    """
    values = [c for c in state.columns if c not in keys]
    order = F.col("id") if "id" in events.columns else F.lit(0)
    first = events.groupBy(*keys).agg(F.min_by(F.struct("tipo_alteracao", "anterior"), order).alias("__e"))
    both = state.select(*keys, F.struct(*values).alias("__own")).join(first, keys, "full_outer")
    back = F.col("__e.tipo_alteracao").isin("UPDATE", "DELETE")
    rows = both.where(F.coalesce(F.col("__e.tipo_alteracao") != "INSERT", F.lit(True)))
    return rows.select(*keys, *[F.when(F.coalesce(back, F.lit(False)), F.col(f"__e.anterior.{c}")).otherwise(F.col(f"__own.{c}")).alias(c) for c in values])


def reverse_states(latest: DataFrame, ledger: DataFrame, keys: list[str], months: list[str]) -> dict[str, DataFrame]:
    """State at the end of each of the months, of which the last is ``latest``'s own; each is written once."""
    out, state = {months[-1]: latest}, latest
    for month, before in zip(months[:0:-1], months[-2::-1], strict=True):
        state = materialise(undo_month(state, ledger.where(F.col("mes_referencia") == month), keys), "reverse")
        out[before] = state
    return out


def save_month(state: DataFrame, month: str, opened: str = "data_inicio_atividade", uf: str | None = None) -> DataFrame:
    """A month's rows: those opened by its last day (or at an unknown date), of one federal unit if asked; dates as dates."""
    rows = state.where(F.col(opened).isNull() | (F.col(opened) <= month_end_int(F.lit(month))))
    if uf:
        rows = rows.where(F.col("uf") == uf)
    return rows.withColumns({"reference_month": F.lit(month), "opening_date": safe_parse_date(F.col(opened))})


def save_registry(establishments: DataFrame, companies: DataFrame, fiscal: DataFrame, partners: DataFrame, events: DataFrame, month: str, uf: str, root: str = "cnpj_basico") -> dict[str, DataFrame]:
    """The five relations of a month, of one federal unit: establishments, the companies, fiscal rows and partners of their roots, and the partners' summaries.

    A partner who entered after the month's end does not count.  ``events``
    are the month's partner events per company; companies without have zeros.
    """
    saved = save_month(establishments, month, uf=uf)
    # keys are looked up in a table of the roots, as no task should sort the many partners of its share of roots
    roots = saved.select(root).distinct().hint("shuffle_hash")
    own = {name: keep_keys(rows, roots, [root]).withColumn("reference_month", F.lit(month)) for name, rows in (("companies", companies), ("fiscal", fiscal), ("partners", partners))}
    entered = F.col("data_entrada_sociedade")
    own["partners"] = own["partners"].where(entered.isNull() | (entered <= month_end_int(F.lit(month))))
    return {"establishments": saved, **own, "summaries": partner_age_summary(own["partners"], events)}


def expand_static(rows: DataFrame, changed: DataFrame, keys: list[str], months: list[str], opened: str = "data_inicio_atividade") -> DataFrame:
    """Rows of keys that never changed, once for each month by whose end they were opened.

    The months are a literal array that is exploded in place: no join.
    """
    still = rows.join(changed.select(*keys), keys, "left_anti")
    out = still.withColumn("reference_month", F.explode(F.array(*[F.lit(m) for m in months])))
    return out.where(F.col(opened).isNull() | (F.col(opened) <= month_end_int(F.col("reference_month"))))


def panel_from_reverse(latest: DataFrame, ledger: DataFrame, keys: list[str], months: list[str], opened: str = "data_inicio_atividade") -> DataFrame:
    """All months: changed keys by undoing events, the others by expansion."""
    changed = materialise(ledger.where(F.col("mes_referencia").between(months[0], months[-1])).select(*keys).distinct(), "changed")
    states = reverse_states(latest.join(changed, keys, "left_semi"), ledger, keys, months)
    moved = [s.where(F.col(opened).isNull() | (F.col(opened) <= month_end_int(F.lit(m)))).withColumn("reference_month", F.lit(m)) for m, s in states.items()]
    return reduce(DataFrame.unionByName, moved).unionByName(expand_static(latest, changed, keys, months, opened))
