"""Duplicate rows: best row per key, merged rows, conflicts and their quarantine.

Where several rows are equally good, all remaining columns break the tie, so
the choice does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.expr import given, score
from panelforge.schemas import COMPANY_FIELDS, ESTABLISHMENT_KEY


def first_by(rows: DataFrame, keys: list[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``, then by all other columns."""
    ties = [F.col(c).asc_nulls_last() for c in rows.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *ties)
    return rows.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def dedup_establishments(rows: DataFrame) -> DataFrame:
    """Per key the row with most of five fields filled, then the highest status, then the latest start."""
    filled = score(F.col("situacao_cadastral").isNotNull(), given(F.col("data_situacao_cadastral")), F.col("cnae_fiscal_principal").isNotNull(), F.col("uf").isNotNull(), F.col("municipio").isNotNull())
    return first_by(rows, ESTABLISHMENT_KEY, [filled.desc(), F.col("situacao_cadastral").desc_nulls_last(), F.col("data_inicio_atividade").desc_nulls_last()])


def dedup_fiscal(rows: DataFrame) -> DataFrame:
    """Per company the row with most of four fields filled, then the highest options."""
    filled = score(F.col("opcao_pelo_simples").isNotNull(), given(F.col("data_opcao_simples")), F.col("opcao_mei").isNotNull(), given(F.col("data_opcao_mei")))
    return first_by(rows, ["cnpj_basico"], [filled.desc(), F.col("opcao_pelo_simples").desc_nulls_last(), F.col("opcao_mei").desc_nulls_last()])


def latest_status(rows: DataFrame, keys: list[str] = ESTABLISHMENT_KEY, status: str = "situacao_cadastral") -> DataFrame:
    """Per key the row with the highest status, nulls last."""
    return first_by(rows, keys, [F.col(status).desc_nulls_last()])


def quarantine(rows: DataFrame, month: str, source: str = "staging", keys: list[str] | None = None, fields: list[str] = COMPANY_FIELDS) -> DataFrame:
    """Keys whose rows have more than one value in a field, with the reason and the month.

    Null against a value is no conflict.  ``source`` is ``staging`` or ``retained``.
    """
    keys = keys or ["cnpj_basico"]
    # least and greatest value tell which keys are in conflict, in one partial aggregation; only the rows of those few are counted
    held = rows.groupBy(*keys).agg(*[_spread(f) for f in fields]).where(_in_conflict(fields)).select(*keys)
    counts = rows.join(held, keys, "left_semi").groupBy(*keys).agg(*[F.count_distinct(f).alias(f"n_{f}") for f in fields])
    parts = [F.when(F.col(f"n_{f}") > 1, F.concat(F.lit(f"{f} ("), F.col(f"n_{f}").cast("string"), F.lit(") "))).otherwise("") for f in fields]
    return counts.select(*keys, F.concat(F.lit(f"Conflict in {source} company fields: "), *parts).alias("motivo"), F.lit(month).alias("reference_month"))


def _spread(f: str) -> Column:
    return F.struct(F.min(f).alias("least"), F.max(f).alias("most")).alias(f"__{f}")


def _in_conflict(fields: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.coalesce(F.col(f"__{f}.least") != F.col(f"__{f}.most"), F.lit(False)) for f in fields], F.lit(False))


def merge_duplicates(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per key with each column's greatest value (text by its bytes)."""
    return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in columns])


def resolve_companies(rows: DataFrame, keys: list[str] | None = None, fields: list[str] = COMPANY_FIELDS, names: list[str] | None = None) -> DataFrame:
    """One row per company: merged, and with null fields where its rows are in conflict; its name is merged in any case."""
    keys, names = keys or ["cnpj_basico"], ["razao_social"] if names is None else names
    # conflict and merge come from the same grouping: one shuffle, and no row is expanded
    merged = rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names], *[_spread(f) for f in fields])
    return merged.select(*keys, *names, *[F.when(~_in_conflict(fields), F.col(f"__{f}.most")).alias(f) for f in fields])
