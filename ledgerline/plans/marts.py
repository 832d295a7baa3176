"""The registry's marts: pure functions from its tables to their output tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lookups as L
from ..operators.quality import Reference
from . import specs as S

Tables = dict[str, DataFrame]
SUPPLEMENT = "codigo string, descricao string, confidence string, notes string"


def enriched_domains(spark: SparkSession, t: Tables) -> Tables:
    """motivos, paises and qualificacoes_socios with the codes that monthly files lack."""
    make = lambda rows: L.static_dictionary(spark, rows, SUPPLEMENT)
    return {
        "motivos_enriched": L.enrich_domain(t["motivos"], make(S.REASONS), "serpro_dominio", f"{S.SUPPLEMENT_URL}motivo_situacao_cadastral.csv"),
        "paises_enriched": L.enrich_domain(t["paises"], make(S.COUNTRIES), "serpro_dominio", f"{S.SUPPLEMENT_URL}pais.csv"),
        "qualificacoes_socios_enriched": L.enrich_domain(t["qualificacoes_socios"], make(S.QUALIFICATIONS), "receita_ods", S.QUALIFICATIONS_URL),
    }


def label_domains(spark: SparkSession) -> Tables:
    """The five static dictionaries; a code has the type of the column that it labels."""

    def make(rows: list[tuple], url: str | None, kind: str = "string") -> DataFrame:
        sourced = [(c, d, "receita_layout" if url is None or c == "00" else "serpro_dominio", S.LAYOUT_URL if url is None or c == "00" else f"{S.SUPPLEMENT_URL}{url}") for c, d in rows]
        return L.static_dictionary(spark, sourced, f"codigo {kind}, descricao string, source_kind string, source_url string")

    return {
        "portes_empresa": make(S.COMPANY_SIZES, "porte_empresa.csv"),
        "situacoes_cadastrais": make(S.STATUSES, "situacao_cadastral.csv"),
        "indicadores_matriz_filial": make(S.HEADQUARTERS, "indicador_matriz.csv", "int"),
        "identificadores_socio": make(S.PARTNER_KINDS, None),
        "faixas_etarias": make(S.AGE_BANDS, None),
    }


def cnaes_hierarquia(spark: SparkSession, t: Tables) -> DataFrame:
    sections = L.static_dictionary(spark, S.section_rows(), "divisao_code string, secao_name string")
    return L.prefix_hierarchy(t["cnaes"], "codigo", sections).select("codigo", "descricao", "secao", "divisao", "grupo", "classe")


def _cnpj() -> Column:
    return F.concat("cnpj_basico", "cnpj_ordem", "cnpj_dv").alias("cnpj")


def empresa_detalhe(t: Tables) -> DataFrame:
    """One row for each establishment of a company, with nine labels and the tax regime."""
    labels = (
        ("cnaes", "cnae_fiscal_principal", "cnae_fiscal_principal_descricao"), ("municipios", "municipio", "municipio_nome"),
        ("motivos_enriched", "motivo_situacao_cadastral", "motivo_situacao_cadastral_descricao"), ("paises_enriched", "pais", "pais_descricao"),
        ("qualificacoes_socios_enriched", "qualificacao_responsavel", "qualificacao_responsavel_descricao"), ("naturezas_juridicas", "natureza_juridica", "natureza_juridica_descricao"),
        ("portes_empresa", "porte", "porte_descricao"), ("situacoes_cadastrais", "situacao_cadastral", "situacao_cadastral_descricao"),
        ("indicadores_matriz_filial", "identificador_matriz_filial", "identificador_matriz_filial_descricao"),
    )
    t = L.looked_at(t, [dim for dim, _, _ in labels])
    out = t["empresas"].join(t["estabelecimentos"], "cnpj_basico")
    for dim, code, label in labels:
        out = L.with_lookup(out, t[dim], code, label)
    out = out.join(t["dados_simples"], "cnpj_basico", "left")
    company = ["natureza_juridica", "natureza_juridica_descricao", "qualificacao_responsavel", "qualificacao_responsavel_descricao", "capital_social", "porte", "porte_descricao", "ente_federativo_responsavel"]
    labelled = {"identificador_matriz_filial", "situacao_cadastral", "motivo_situacao_cadastral", "pais", "cnae_fiscal_principal"}
    place = []
    for c in ("nome_fantasia", "identificador_matriz_filial", *[x for x in S.FAMILIES["ESTABELE"].columns if x not in ("cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia")]):
        place += [c, f"{c}_descricao"] if c in labelled else [c, "municipio_nome"] if c == "municipio" else [c]
    return out.select("cnpj_basico", "cnpj_ordem", "cnpj_dv", _cnpj(), "razao_social", *company, *place, *S.FAMILIES["SIMPLESCSV"].columns[1:])


def socios_detalhe(t: Tables) -> DataFrame:
    """Partners with five labels; one lookup serves two roles."""
    out = t["socios"]
    pairs = [
        ("identificadores_socio", "identificador_de_socio"), ("qualificacoes_socios_enriched", "qualificacao_do_socio"), ("paises_enriched", "pais"),
        ("qualificacoes_socios_enriched", "qualificacao_do_representante_legal"), ("faixas_etarias", "faixa_etaria"),
    ]
    t = L.looked_at(t, [dim for dim, _ in pairs])
    for dim, code in pairs:
        out = L.with_lookup(out, t[dim], code, f"{code}_descricao")
    labelled = {code for _, code in pairs}
    order = [x for c in ("socio_id", *S.FAMILIES["SOCIOCSV"].columns) for x in ([c, f"{c}_descricao"] if c in labelled else [c])]
    return out.select(*order)


def data_quality_flags(t: Tables) -> DataFrame:
    """Flags of each establishment that has a company; those without one are left out."""
    out = t["estabelecimentos"].join(t["empresas"].select("cnpj_basico", "capital_social"), "cnpj_basico")
    for dim, code, flag in (
        ("paises", "pais", "pais_lookup_missing"), ("motivos", "motivo_situacao_cadastral", "motivo_lookup_missing"), ("paises_enriched", "pais", "pais_enriched_lookup_missing"),
        ("motivos_enriched", "motivo_situacao_cadastral", "motivo_enriched_lookup_missing"),
    ):
        out = L.lookup_missing_flag(out, t[dim], code, flag)
    cep = F.col("cep")
    status = L.shape_status(cep, [(cep == "00000000", "zero_sentinel"), (cep.rlike(r"^[0-9]{8}\z"), "valid_shape")], "malformed")
    return out.select(
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", _cnpj(), status.alias("cep_status"), (F.col("uf") == "EX").alias("is_exterior"), "pais_lookup_missing", "motivo_lookup_missing",
        "pais_enriched_lookup_missing", "motivo_enriched_lookup_missing", L.sentinel_flag(F.col("capital_social"), S.CAPITAL_SENTINEL).alias("capital_social_is_suspicious_sentinel"),
    )


def dropped_by_flags(t: Tables) -> DataFrame:
    """How many establishments have no company, and so no flags."""
    return t["estabelecimentos"].join(t["empresas"].select("cnpj_basico"), "cnpj_basico", "left_anti").agg(F.count("*").alias("dropped"))


def estabelecimentos_clean(t: Tables, flags: DataFrame) -> DataFrame:
    key = ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]
    out = flags.join(t["estabelecimentos"].select(*key, "cep"), key).join(t["empresas"].select("cnpj_basico", "capital_social"), "cnpj_basico")
    return out.select(
        *key, "cnpj", *L.raw_clean_pair(F.col("cep"), "cep", F.col("cep_status") != "valid_shape"),
        *L.raw_clean_pair(F.col("capital_social"), "capital_social", F.col("capital_social_is_suspicious_sentinel")),
        "cep_status", "capital_social_is_suspicious_sentinel", "pais_lookup_missing", "motivo_lookup_missing", "is_exterior",
    )


def socios_quality_flags(t: Tables) -> DataFrame:
    t = L.looked_at(t, ["paises", "qualificacoes_socios", "paises_enriched", "qualificacoes_socios_enriched"])
    out = t["socios"]
    for suffix, table in (("", ""), ("_enriched", "_enriched")):
        for dim, code, name, ignore in (
            ("paises", "pais", "pais", ()), ("qualificacoes_socios", "qualificacao_do_socio", "qualificacao_socio", ()),
            ("qualificacoes_socios", "qualificacao_do_representante_legal", "qualificacao_representante", ("00",)),
        ):
            out = L.lookup_missing_flag(out, t[dim + table], code, f"{name}{suffix}_lookup_missing", ignore=ignore)
    masked = (F.col("representante_legal") == S.MASKED_REPRESENTATIVE) & (F.col("qualificacao_do_representante_legal") == "00")
    names = ("pais", "qualificacao_socio", "qualificacao_representante")
    return out.select(
        "socio_id", "cnpj_basico", "identificador_de_socio", "cnpj_cpf_do_socio", masked.alias("representante_is_placeholder"), *[f"{n}_lookup_missing" for n in names],
        *[f"{n}_enriched_lookup_missing" for n in names], (F.col("faixa_etaria") == "0").alias("faixa_etaria_nao_se_aplica"),
    )


def socios_clean(t: Tables, flags: DataFrame) -> DataFrame:
    """Raw and clean pairs; the representative's three columns are cleared together."""
    trio = ("representante_legal", "nome_do_representante", "qualificacao_do_representante_legal")
    out = flags.join(t["socios"].select("socio_id", *trio, "faixa_etaria"), "socio_id")
    pairs = [p for c in trio for p in L.raw_clean_pair(F.col(c), c, F.col("representante_is_placeholder"))]
    return out.select(
        "socio_id", "cnpj_basico", "identificador_de_socio", "cnpj_cpf_do_socio", *pairs, *L.raw_clean_pair(F.col("faixa_etaria"), "faixa_etaria", F.col("faixa_etaria_nao_se_aplica")),
        "representante_is_placeholder", "pais_lookup_missing", "qualificacao_socio_lookup_missing", "qualificacao_representante_lookup_missing", "faixa_etaria_nao_se_aplica",
    )


def cnae_secundaria_exploded(t: Tables) -> DataFrame:
    rows = t["estabelecimentos"].withColumn("cnpj", _cnpj())
    return L.explode_delimited(rows, ["cnpj_basico", "cnpj_ordem", "cnpj_dv", "cnpj"], "cnae_fiscal_secundaria", "cnae_codigo")


def empresas_busca_nome(t: Tables) -> DataFrame:
    """Active headquarters with names and places; filtered before the join."""
    active = t["estabelecimentos"].where("situacao_cadastral = '02' and identificador_matriz_filial = 1")
    out = t["empresas"].select("cnpj_basico", "razao_social").join(active, "cnpj_basico")
    out = L.with_lookup(L.with_lookup(out, t["cnaes"], "cnae_fiscal_principal", "cnae_descricao"), t["municipios"], "municipio", "municipio_nome")
    return out.select(
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", _cnpj(), "razao_social", "nome_fantasia", "uf", F.col("municipio").alias("municipio_codigo"), "municipio_nome", "situacao_cadastral",
        "identificador_matriz_filial", "cnae_fiscal_principal", "cnae_descricao", "data_inicio_atividade",
    )


def empresas_busca_nome_counts(search: DataFrame) -> DataFrame:
    kinds = {"uf": ["uf"], "uf_municipio": ["uf", "municipio_nome"], "uf_cnae": ["uf", "cnae_fiscal_principal"]}
    out = L.count_rollups(search, kinds, {"uf_municipio": {"municipio_codigo": "municipio_codigo"}})
    return out.select("kind", "uf", "municipio_codigo", "municipio_nome", "cnae_fiscal_principal", "total")


#: Columns of facts and the code tables they refer to.
REFERENCES = [
    Reference("estabelecimentos.cnae_fiscal_principal", "estabelecimentos", "cnae_fiscal_principal", "cnaes"),
    Reference("estabelecimentos.municipio", "estabelecimentos", "municipio", "municipios"),
    Reference("estabelecimentos.motivo_situacao_cadastral", "estabelecimentos", "motivo_situacao_cadastral", "motivos", "motivos_enriched"),
    Reference("estabelecimentos.pais", "estabelecimentos", "pais", "paises", "paises_enriched"),
    Reference("empresas.natureza_juridica", "empresas", "natureza_juridica", "naturezas_juridicas"),
    Reference("empresas.qualificacao_responsavel", "empresas", "qualificacao_responsavel", "qualificacoes_socios", "qualificacoes_socios_enriched"),
    Reference("socios.pais", "socios", "pais", "paises", "paises_enriched"),
    Reference("socios.qualificacao_do_socio", "socios", "qualificacao_do_socio", "qualificacoes_socios", "qualificacoes_socios_enriched"),
    Reference("socios.qualificacao_do_representante_legal", "socios", "qualificacao_do_representante_legal", "qualificacoes_socios", "qualificacoes_socios_enriched", ("00",)),
]
