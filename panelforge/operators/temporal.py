"""Validity intervals, transition logs and month-to-month classification of a panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.expr import any_differs

# The columns that make up an establishment's state in a panel.
PANEL_STATE = ["identificador_matriz_filial", "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral", "pais", "data_inicio_atividade", "cnae_fiscal_principal", "municipio", "uf", "cnae_fiscal_secundaria"]


def intervals(panel: DataFrame, keys: list[str], watched: list[str], carried: list[str], month: str = "reference_month", strict: bool = False) -> DataFrame:
    """Runs of months in which the watched columns of a key stay the same, with the first and last month of each.

    A change in a carried column splits a run but opens no new one, so a
    value that comes back within a run belongs to one interval with its
    former self.  Months in which the key is missing do not end a run, unless
    ``strict``.  Both window steps use one partitioning by key.
    """
    w = Window.partitionBy(*keys).orderBy(month)
    change = any_differs((F.lag(c).over(w), F.col(c)) for c in watched)
    if strict:
        step = F.months_between(F.to_date(F.concat(F.col(month), F.lit("-01"))), F.to_date(F.concat(F.lag(month).over(w), F.lit("-01"))))
        change = change | F.coalesce(step > 1, F.lit(False))
    rows = panel.withColumn("__change", change.cast("int"))
    rows = rows.withColumn("__run", F.sum("__change").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    columns = [*watched, *[c for c in carried if c not in watched]]
    return rows.groupBy(*keys, "__run", *columns).agg(F.min(month).alias("valid_from_month"), F.max(month).alias("valid_to_month")).drop("__run")


def transitions(panel: DataFrame, keys: list[str], variables: list[str], months: list[str], month: str = "reference_month") -> DataFrame:
    """Long log of what changed from each month to the next: a row per key, month and variable.

    Keys in both months give an UPDATE row for each variable that differs;
    keys that come or go give an INSERT or DELETE row for every variable.
    One full outer join of the panel with itself, a month shifted, covers all
    months.
    """
    after = F.create_map(*[F.lit(x) for pair in zip(months, months[1:], strict=False) for x in pair]) if len(months) > 1 else F.lit(None).cast("map<string,string>")
    image = F.struct(*[F.col(v).cast("string").alias(v) for v in variables])
    now = panel.where(F.col(month).isin(months[1:])).select(*keys, F.col(month).alias("reference_month"), image.alias("now"))
    was = panel.where(F.col(month).isin(months[:-1])).select(*keys, F.try_element_at(after, F.col(month)).alias("reference_month"), image.alias("was"))
    both = now.join(was, [*keys, "reference_month"], "full_outer")
    kind = F.when(F.col("was").isNull(), "INSERT").when(F.col("now").isNull(), "DELETE").otherwise("UPDATE")
    cells = F.array(*[F.struct(F.lit(v).alias("variable_name"), F.col(f"was.{v}").alias("previous_value"), F.col(f"now.{v}").alias("current_value")) for v in variables])
    rows = both.select(*keys, "reference_month", kind.alias("change_type"), F.explode(cells).alias("x")).select(*keys, "reference_month", "x.*", "change_type")
    return rows.where((F.col("change_type") != "UPDATE") | ~F.col("previous_value").eqNullSafe(F.col("current_value")))


def classify(before: DataFrame, after: DataFrame, keys: list[str], state: list[str] = PANEL_STATE) -> DataFrame:
    """``event`` INSERT, DELETE, UPDATE or NO CHANGE for every key of two months."""
    image = F.struct(*state)
    both = before.select(*keys, image.alias("was")).join(after.select(*keys, image.alias("now")), keys, "full_outer")
    same = ~any_differs((F.col(f"was.{c}"), F.col(f"now.{c}")) for c in state)
    event = F.when(F.col("was").isNull(), "INSERT").when(F.col("now").isNull(), "DELETE").when(same, "NO CHANGE").otherwise("UPDATE")
    return both.select(*keys, event.alias("event"))


def reconcile(events: DataFrame) -> DataFrame:
    """One row: sizes of both months from the classification, and whether the two identities between them hold."""
    n = {k: F.count_if(F.col("event") == v) for k, v in (("inserted", "INSERT"), ("deleted", "DELETE"), ("updated", "UPDATE"), ("unchanged", "NO CHANGE"))}
    out = events.agg(*[x.alias(k) for k, x in n.items()], F.count_if(F.col("event") != "INSERT").alias("previous"), F.count_if(F.col("event") != "DELETE").alias("next"))
    return out.withColumns({
        "next_holds": F.col("next") == F.col("previous") + F.col("inserted") - F.col("deleted"),
        "previous_holds": F.col("previous") == F.col("deleted") + F.col("updated") + F.col("unchanged"),
    })


def tag_static(rows: DataFrame, changed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with ``is_static``: whether their key never changed."""
    seen = changed.select(*keys).distinct().withColumn("__seen", F.lit(True))
    return rows.join(seen, keys, "left").withColumn("is_static", F.col("__seen").isNull()).drop("__seen")


def changed_keys(ledger: DataFrame, keys: list[str], first: str, last: str, table: str | None = None, state: str | None = None) -> DataFrame:
    """Distinct keys with an event from ``first`` to ``last``, of one table and one federal unit (in either image) if asked."""
    rows = ledger.where(F.col("mes_referencia").between(first, last))
    if table:
        rows = rows.where(F.col("tabela") == table)
    if state:
        rows = rows.where(F.coalesce(F.col("anterior.uf") == state, F.lit(False)) | F.coalesce(F.col("novo.uf") == state, F.lit(False)))
    return rows.select(*keys).distinct()
