"""Partner summaries per company."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.expr import age_of_band, differs, rounded_mean
from panelforge.schemas import ADMINISTRATORS


def partner_summary(
    partners: DataFrame, key: str = "cnpj_basico", kind: str = "identificador_socio", age: str = "faixa_etaria", entry: str = "data_entrada_sociedade",
    role: str = "qualificacao_socio", kinds: tuple = (2, 1, 3), admin_roles: list = ADMINISTRATORS,
) -> DataFrame:
    """Per company: partners, those of three kinds, least and greatest age band and entry date (0 is missing), administrators."""
    n, c = lambda x: F.count_if(x).cast("int"), F.col
    aged, entered = F.nullif(c(age), F.lit(0)), F.nullif(c(entry), F.lit(0))
    return partners.groupBy(key).agg(
        F.count("*").cast("int").alias("qtde_socios"), n(c(kind) == kinds[0]).alias("qtde_socios_pf"), n(c(kind) == kinds[1]).alias("qtde_socios_pj"), n(c(kind) == kinds[2]).alias("qtde_socios_estrangeiro"),
        F.min(aged).cast("int").alias("min_faixa_etaria"), F.max(aged).cast("int").alias("max_faixa_etaria"), F.min(entered).cast("int").alias("data_entrada_antiga"), F.max(entered).cast("int").alias("data_entrada_recente"),
        n(c(role).isin(admin_roles)).alias("qtde_administradores"),
    )


def partner_monthly_events(ledger: DataFrame, role: str = "qualificacao_socio") -> DataFrame:
    """Per month and company: partners added, removed, and with another qualification, from row-level partner events.

    ``ledger`` has ``mes_referencia``, ``cnpj_basico``, ``tipo_alteracao`` and
    the images ``anterior`` and ``novo`` as structs.
    """
    kind = F.col("tipo_alteracao")
    changed = (kind == "UPDATE") & differs(F.col(f"anterior.{role}"), F.col(f"novo.{role}"))
    counts = {"partner_additions": kind == "INSERT", "partner_removals": kind == "DELETE", "qualification_changes": changed}
    return ledger.groupBy("mes_referencia", "cnpj_basico").agg(*[F.count_if(c).alias(n) for n, c in counts.items()])


def partner_age_summary(partners: DataFrame, events: DataFrame) -> DataFrame:
    """Per month and company: partners, ages from band midpoints, partners by kind, and the month's events (0 if none)."""
    rows = partners.withColumn("age", age_of_band(F.col("faixa_etaria"))).groupBy("reference_month", "cnpj_basico").agg(
        F.count("*").alias("partner_count"), rounded_mean(F.col("age")).alias("average_age"), F.min("age").alias("minimum_age"), F.max("age").alias("maximum_age"),
        F.count_if(F.col("identificador_socio") == 1).alias("corporate_partner_count"), F.count_if(F.col("identificador_socio") == 2).alias("individual_partner_count"),
    )
    names = ["partner_additions", "partner_removals", "qualification_changes"]
    out = rows.join(events.withColumnRenamed("mes_referencia", "reference_month"), ["reference_month", "cnpj_basico"], "left")
    return out.select(*rows.columns, *[F.coalesce(n, F.lit(0)).alias(n) for n in names])
