"""The named end-user reports.

Lookups (cities, activities) are joined as they are; Spark broadcasts them by
their size on disk, and joins them by key once they are too large for that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.expr import sector_label

# The columns of the list, in its order.
BUSINESS_COLUMNS = [
    "e.cnpj_basico", "e.cnpj_ordem", "e.cnpj_dv", "s.opcao_pelo_simples", "s.data_opcao_simples", "s.opcao_mei", "s.data_opcao_mei", "s.data_exclusao_mei",
    "e.identificador_matriz_filial", "e.nome_fantasia", "e.situacao_cadastral", "e.data_situacao_cadastral", "e.motivo_situacao_cadastral", "e.data_inicio_atividade", "e.cnae_fiscal_principal",
    "c.secao_cnae as secao", "c.desc_secao_en", "em.porte_empresa", "em.razao_social", "em.natureza_juridica", "em.qualificacao_responsavel", "em.capital_social",
    "m.cd_mun", "m.descricao as city", "e.tipo_logradouro", "e.logradouro", "e.numero", "e.bairro", "e.cep",
]


def with_sectors(activities: DataFrame, code: str = "codigo") -> DataFrame:
    """Activities with their division and its labels in two languages."""
    division = F.substring(F.col(code), 1, 2)
    return activities.withColumns({"secao_cnae": division, "desc_secao": sector_label(division, False), "desc_secao_en": sector_label(division)})


def with_city_codes(cities: DataFrame, codes: DataFrame) -> DataFrame:
    """Cities with the statistics office's code; a city code listed twice counts once."""
    one = codes.groupBy("codigo").agg(F.min("cd_mun").alias("cd_mun"))
    return cities.join(one, "codigo", "left")


def _activity(activities: DataFrame) -> DataFrame:
    return activities.withColumn("__code", F.col("codigo").cast("int"))


def business_list(establishments: DataFrame, companies: DataFrame, fiscal: DataFrame, cities: DataFrame, activities: DataFrame, uf: str = "SP") -> DataFrame:
    """All establishments of a federal unit, with company, fiscal, city and activity columns."""
    e = establishments.where(F.col("uf") == uf).alias("e")
    rows = e.join(companies.alias("em"), F.col("e.cnpj_basico") == F.col("em.cnpj_basico"), "left").join(fiscal.alias("s"), F.col("e.cnpj_basico") == F.col("s.cnpj_basico"), "left")
    rows = rows.join(cities.alias("m"), F.col("e.municipio") == F.col("m.codigo"), "left").join(_activity(activities).alias("c"), F.col("e.cnae_fiscal_principal") == F.col("c.__code"), "left")
    return rows.selectExpr(*BUSINESS_COLUMNS)


def geocoded_business_list(establishments: DataFrame, companies: DataFrame, fiscal: DataFrame, cities: DataFrame, activities: DataFrame, places: DataFrame, uf: str = "SP") -> DataFrame:
    """Those that have coordinates for their root and postcode; several places give several rows."""
    g = places.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select("cnpj_basico", "cep", "latitude", "longitude")
    return business_list(establishments, companies, fiscal, cities, activities, uf).join(g, ["cnpj_basico", "cep"])


def _status_counts(status: Column, unit: Column, names: tuple[str, ...], active: object, closed: object, head: object, branch: object) -> list[Column]:
    cells = [(status == active, None), (status == closed, None), (status == active, head), (status == closed, head), (status == active, branch), (status == closed, branch)]
    return [F.count_if(c if u is None else c & (unit == u)).alias(n) for n, (c, u) in zip(names, cells, strict=True)]


# The columns of the two summaries.
CITY_COUNTS = ("active", "failed", "active_head_offices", "failed_head_offices", "active_branches", "failed_branches")
SECTOR_COUNTS = ("active", "failed", "active_ho", "failed_ho", "active_br", "failed_br")


def city_summary(establishments: DataFrame, cities: DataFrame, uf: str = "SP") -> DataFrame:
    """Active and closed establishments per city, in all and by head office and branch; unknown cities are a group of their own."""
    rows = establishments.where(F.col("uf") == uf).join(cities, F.col("municipio") == F.col("codigo"), "left")
    counts = _status_counts(F.col("situacao_cadastral"), F.col("identificador_matriz_filial"), CITY_COUNTS, 2, 8, 1, 2)
    return rows.groupBy(F.col("cd_mun").alias("city_code"), F.col("descricao").alias("city")).agg(*counts)


def city_sector_summary(establishments: DataFrame, cities: DataFrame, activities: DataFrame, uf: str = "SP") -> DataFrame:
    """The same by city and sector.  Groups are by the raw sector, so an unknown activity and the sector 'Others' are two rows with one label."""
    c = _activity(activities).select("__code", "desc_secao_en")
    rows = establishments.where(F.col("uf") == uf).join(cities, F.col("municipio") == F.col("codigo"), "left").join(c, F.col("cnae_fiscal_principal") == F.col("__code"), "left")
    counts = _status_counts(F.col("situacao_cadastral"), F.col("identificador_matriz_filial"), SECTOR_COUNTS, 2, 8, 1, 2)
    out = rows.groupBy(F.col("cd_mun").alias("city_code"), F.col("descricao").alias("city"), "desc_secao_en").agg(*counts)
    return out.select("city_code", "city", F.coalesce("desc_secao_en", F.lit("Others")).alias("sector_desc"), *SECTOR_COUNTS)


def secondary_activities(rows: DataFrame, names: DataFrame, keys: list[str], listed: str, most: int = 10) -> DataFrame:
    """Comma-separated codes as numbered columns ``cnae_secundario_k`` with their names; items after ``most`` are left out.

    ``names`` has ``codigo`` and ``descricao``.  A null list gives nulls.
    """
    items = rows.select(*keys, F.posexplode_outer(F.split(listed, ",")).alias("at", "codigo")).join(names.select("codigo", "descricao"), "codigo", "left")
    cells = []
    for k in range(most):
        cells += [F.max(F.when(F.col("at") == k, F.col(c))).alias(f"{n}_{k + 1}") for c, n in (("codigo", "cnae_secundario"), ("descricao", "descricao_atividade_secundaria"))]
    return items.groupBy(*keys).agg(*cells)


def monthly_statistics(sources: dict[str, DataFrame], months: DataFrame, month: str = "reference_month") -> DataFrame:
    """Rows of each source per month, one column a source, 0 where it has none."""
    out = months.select(month).distinct()
    for name, rows in sources.items():
        out = out.join(rows.groupBy(month).agg(F.count("*").alias(name)), month, "left")
    return out.select(month, *[F.coalesce(n, F.lit(0)).alias(n) for n in sources])


def place_checks(places: DataFrame) -> DataFrame:
    """One row: rows, distinct roots, and how many roots and postcodes have a wrong length."""
    return places.agg(F.count("*").alias("n"), F.count_distinct("cnpj_basico").alias("n_roots"), F.count_if(F.length("cnpj_basico") != 8).alias("bad_roots"), F.count_if(F.length("cep") != 8).alias("bad_postcodes"))
