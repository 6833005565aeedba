"""Table layouts: the ten dump families, the ledger, the overlay and the panel."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

def layout(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()

# Column names, order and types of the published dump layout, which has no headers.
EMPRESA = layout(
    cnpj_basico=_S, razao_social=_S, natureza_juridica=_I, qualificacao_responsavel=_I, capital_social=_D, porte_empresa=_I, ente_federativo_responsavel=_S,
)
ESTABELECIMENTO = layout(
    cnpj_basico=_S, cnpj_ordem=_S, cnpj_dv=_S, identificador_matriz_filial=_I, nome_fantasia=_S, situacao_cadastral=_I, data_situacao_cadastral=_I,
    motivo_situacao_cadastral=_I, nome_cidade_exterior=_S, pais=_S, data_inicio_atividade=_I, cnae_fiscal_principal=_I, cnae_fiscal_secundaria=_S,
    tipo_logradouro=_S, logradouro=_S, numero=_S, complemento=_S, bairro=_S, cep=_S, uf=_S, municipio=_I, ddd_1=_S, telefone_1=_S, ddd_2=_S, telefone_2=_S,
    ddd_fax=_S, fax=_S, correio_eletronico=_S, situacao_especial=_S, data_situacao_especial=_I,
)
SOCIOS = layout(
    cnpj_basico=_S, identificador_socio=_I, nome_socio_razao_social=_S, cpf_cnpj_socio=_S, qualificacao_socio=_I, data_entrada_sociedade=_I, pais=_I,
    representante_legal=_S, nome_do_representante=_S, qualificacao_representante_legal=_I, faixa_etaria=_I,
)
SIMPLES = layout(cnpj_basico=_S, opcao_pelo_simples=_S, data_opcao_simples=_I, data_exclusao_simples=_I, opcao_mei=_S, data_opcao_mei=_I, data_exclusao_mei=_I)
CNAE = layout(codigo=_S, descricao=_S)
CODED = layout(codigo=_I, descricao=_S)
GEOLOC = layout(cnpj_basico=_S, tipo_logradouro=_S, logradouro=_S, numero=_S, uf=_S, cidade=_S, bairro=_S, cep=_S, latitude=_D, longitude=_D)
MUNIC = layout(codigo=_I, descricao=_S, cd_mun=_I)

#: Substring of a dump file's name -> family, first match wins.
ROUTES = {"EMPRE": "empresa", "ESTABELE": "estabelecimento", "SOCIO": "socios", "SIMPLES": "simples", "CNAE": "cnae", "MOTI": "moti", "MUNIC": "munic", "NATJU": "natju", "PAIS": "pais", "QUALS": "quals"}
FAMILIES = {"empresa": EMPRESA, "estabelecimento": ESTABELECIMENTO, "socios": SOCIOS, "simples": SIMPLES, "cnae": CNAE, "moti": CODED, "munic": CODED, "natju": CODED, "pais": CODED, "quals": CODED}

# The columns of the key, of the tracked fields and of the panel, in the panel's order.
ESTABLISHMENT_KEY = ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]
ESTABLISHMENT_FIELDS = [
    "identificador_matriz_filial", "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral", "pais", "data_inicio_atividade",
    "cnae_fiscal_principal", "cnae_fiscal_secundaria", "uf", "municipio", "situacao_especial", "data_situacao_especial",
]
COMPANY_FIELDS = ["capital_social", "natureza_juridica", "porte_empresa", "qualificacao_responsavel", "ente_federativo_responsavel"]
FISCAL_FIELDS = ["opcao_pelo_simples", "data_opcao_simples", "data_exclusao_simples", "opcao_mei", "data_opcao_mei", "data_exclusao_mei"]
PARTNER_COUNTS = ["qtde_socios", "qtde_socios_pf", "qtde_socios_pj", "qtde_socios_estrangeiro"]
PARTNER_FIELDS = [*PARTNER_COUNTS, "min_faixa_etaria", "max_faixa_etaria", "data_entrada_antiga", "data_entrada_recente", "qtde_administradores"]
#: The partner fields that are 0, not null, for a company without partners.
PARTNER_ZERO = [*PARTNER_COUNTS, "qtde_administradores"]
PANEL_COLUMNS = [*ESTABLISHMENT_KEY, *ESTABLISHMENT_FIELDS, *COMPANY_FIELDS, *FISCAL_FIELDS, *PARTNER_FIELDS, "cd_mun"]
#: Qualification codes of administrators.
ADMINISTRATORS = [5, 10, 16, 49]

#: Columns that change detection ignores; they only go to the side outputs of each month.
SIDE_OUTPUTS = {
    "empresa": ["cnpj_basico", "razao_social"],
    "estabelecimento": [*ESTABLISHMENT_KEY, "nome_fantasia", "ddd_1", "ddd_2", "ddd_fax", "telefone_1", "telefone_2", "fax", "correio_eletronico"],
    "estabelecimento_enderecos": [*ESTABLISHMENT_KEY, "tipo_logradouro", "logradouro", "numero", "complemento", "bairro", "cep", "nome_cidade_exterior"],
}


@dataclass(frozen=True)
class TableSpec:
    """What change detection needs to know of a table: its key, its tracked columns, and values that a tombstone takes for a row never seen."""

    name: str
    keys: list[str]
    tracked: list[str]
    defaults: dict[str, object] = field(default_factory=dict)


SPECS = {
    "empresa": TableSpec("empresa", ["cnpj_basico"], COMPANY_FIELDS),
    "estabelecimento": TableSpec("estabelecimento", ESTABLISHMENT_KEY, ESTABLISHMENT_FIELDS),
    "socios": TableSpec("socios", ["cnpj_basico"], PARTNER_FIELDS, dict.fromkeys(PARTNER_ZERO, 0)),
    "simples": TableSpec("simples", ["cnpj_basico"], FISCAL_FIELDS),
}
