"""Every mart of the registry over all of its columns, from registry tables that stand on the given ones.

Each code table is its own, and each has codes that facts lack and lacks codes that
facts have; monthly and enriched tables differ by the codes that the supplement brings.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import landing as S
from ..sources.tables import table
from . import marts, specs
from .registry import query

AS_OF = "2026-01-01"


def _values(rows: list[tuple], width: int = 2) -> str:
    quote = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return "VALUES " + ", ".join("(" + ", ".join(quote(v) for v in r[:width]) + ")" for r in rows)


def _enriched(name: str, monthly: str, rows: list[tuple]) -> str:
    return f"{name} AS (SELECT * FROM {monthly} UNION ALL SELECT * FROM ({_values(rows)}) v(codigo, descricao) WHERE codigo NOT IN (SELECT codigo FROM {monthly}))"


TABLES_SQL = f"""
    WITH cnaes AS (SELECT lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS codigo, p_name || ' ' || p_partkey AS descricao FROM part WHERE p_partkey % 3 <> 0),
    municipios AS (SELECT lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS codigo, s_name AS descricao FROM supplier),
    motivos AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS codigo, 'M ' || n_name AS descricao FROM nation),
    paises AS (SELECT lpad(CAST(n_nationkey * 5 AS VARCHAR), 3, '0') AS codigo, n_name AS descricao FROM nation),
    qualificacoes AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS codigo, 'Q ' || n_name AS descricao FROM nation WHERE n_nationkey < 20),
    naturezas AS (SELECT '20' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS codigo, n_name || ' SA' AS descricao FROM nation),
    {_enriched('motivos_e', 'motivos', specs.REASONS)}, {_enriched('paises_e', 'paises', specs.COUNTRIES)}, {_enriched('qualificacoes_e', 'qualificacoes', specs.QUALIFICATIONS)},
    portes(codigo, descricao) AS ({_values(specs.COMPANY_SIZES)}), situacoes(codigo, descricao) AS ({_values(specs.STATUSES)}), matriz(codigo, descricao) AS ({_values(specs.HEADQUARTERS)}),
    tipos(codigo, descricao) AS ({_values(specs.PARTNER_KINDS)}), faixas(codigo, descricao) AS ({_values(specs.AGE_BANDS)}),
    empresas AS (
      SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, c_name AS razao_social, CAST(2000 + c_custkey % 30 AS VARCHAR) AS natureza_juridica, lpad(CAST(c_custkey % 45 AS VARCHAR), 2, '0') AS qualificacao_responsavel,
        CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 20 = 0 THEN 999999999999.0::DOUBLE ELSE c_acctbal END AS capital_social,
        CASE c_custkey % 5 WHEN 0 THEN '00' WHEN 1 THEN '01' WHEN 2 THEN '03' WHEN 3 THEN '05' ELSE '07' END AS porte, CASE WHEN c_custkey % 6 = 0 THEN 'UNIÃO' END AS ente_federativo_responsavel
      FROM customer WHERE c_custkey % 10 <> 9),
    estabelecimentos AS (
      SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cnpj_basico, CAST(o_orderkey AS VARCHAR) AS cnpj_ordem, lpad(CAST(o_orderkey % 97 AS VARCHAR), 2, '0') AS cnpj_dv, CAST(1 + o_orderkey % 3 AS INTEGER) AS identificador_matriz_filial,
        CASE WHEN o_orderkey % 4 <> 0 THEN 'LOJA ' || o_orderkey END AS nome_fantasia, CASE o_orderstatus WHEN 'F' THEN '02' WHEN 'O' THEN '05' ELSE '07' END AS situacao_cadastral, CAST(o_orderdate AS DATE) AS data_situacao_cadastral,
        lpad(CAST(o_orderkey % 40 AS VARCHAR), 2, '0') AS motivo_situacao_cadastral, CASE WHEN o_orderpriority LIKE '1%' THEN 'CITY ' || (o_custkey % 9) END AS nome_cidade_exterior,
        CASE WHEN o_orderkey % 7 > 0 THEN lpad(CAST(o_custkey * 3 % 160 AS VARCHAR), 3, '0') END AS pais, CAST(o_orderdate AS DATE) - CAST(o_orderkey % 1000 AS INTEGER) AS data_inicio_atividade,
        lpad(CAST(o_orderkey % 3000 AS VARCHAR), 7, '0') AS cnae_fiscal_principal, CASE WHEN o_orderkey % 3 > 0 THEN lpad(CAST(o_orderkey % 50 AS VARCHAR), 7, '0') || ', ' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 7, '0') || ',,' END AS cnae_fiscal_secundaria,
        CASE o_orderkey % 3 WHEN 0 THEN 'RUA' WHEN 1 THEN 'AVENIDA' END AS tipo_logradouro, 'R ' || (o_orderkey % 500) AS logradouro, CAST(o_orderkey % 999 AS VARCHAR) AS numero, CASE WHEN o_orderkey % 5 = 0 THEN 'AP ' || (o_orderkey % 9) END AS complemento,
        'B ' || (o_custkey % 77) AS bairro,
        CASE WHEN o_orderkey % 11 = 0 THEN '00000000' WHEN o_orderkey % 13 = 0 THEN '12A' WHEN o_orderkey % 17 <> 0 THEN lpad(CAST(o_orderkey * 7919 % 100000000 AS VARCHAR), 8, '0') END AS cep,
        CASE WHEN o_orderpriority LIKE '1%' THEN 'EX' WHEN o_orderkey % 19 > 0 THEN 'SP' END AS uf, lpad(CAST(o_custkey % 120 AS VARCHAR), 4, '0') AS municipio, lpad(CAST(o_orderkey % 90 AS VARCHAR), 2, '0') AS ddd_1,
        CAST(10000000 + o_orderkey AS VARCHAR) AS telefone_1, CASE WHEN o_orderkey % 2 = 0 THEN '11' END AS ddd_2, CASE WHEN o_orderkey % 2 = 0 THEN CAST(20000000 + o_orderkey AS VARCHAR) END AS telefone_2,
        CASE WHEN o_orderkey % 8 = 0 THEN '12' END AS ddd_fax, CASE WHEN o_orderkey % 8 = 0 THEN CAST(30000000 + o_orderkey AS VARCHAR) END AS fax, 'a' || o_orderkey || '@example.org' AS correio_eletronico,
        CASE WHEN o_orderkey % 50 = 0 THEN 'ESPÓLIO' END AS situacao_especial, CASE WHEN o_orderkey % 50 = 0 THEN CAST(o_orderdate AS DATE) + 1 END AS data_situacao_especial
      FROM orders),
    simples AS (
      SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cnpj_basico, CASE WHEN c_nationkey < 12 THEN 'S' ELSE 'N' END AS opcao_pelo_simples, DATE '2010-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS data_opcao_pelo_simples,
        CASE WHEN c_nationkey >= 12 THEN DATE '2020-01-01' + CAST(c_custkey % 300 AS INTEGER) END AS data_exclusao_do_simples, CASE WHEN c_custkey % 3 = 0 THEN 'S' ELSE 'N' END AS opcao_pelo_mei,
        CASE WHEN c_custkey % 3 = 0 THEN DATE '2011-01-01' + CAST(c_custkey % 900 AS INTEGER) END AS data_opcao_pelo_mei, CASE WHEN c_custkey % 6 = 0 THEN DATE '2021-05-05' END AS data_exclusao_do_mei
      FROM customer WHERE c_mktsegment <> 'BUILDING'),
    partner_rows AS (
      SELECT lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cnpj_basico, CAST(1 + o_orderkey % 4 AS VARCHAR) AS identificador_de_socio, CASE WHEN o_orderkey % 11 > 0 THEN 'PARTNER  É ' || o_orderkey END AS nome_socio,
        CASE WHEN o_orderkey % 9 = 0 THEN '00000000000000' ELSE '***' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') || '**' END AS cnpj_cpf_do_socio, lpad(CAST(o_orderkey % 45 AS VARCHAR), 2, '0') AS qualificacao_do_socio,
        CAST(o_orderdate AS DATE) AS data_entrada_sociedade, CASE WHEN o_orderkey % 4 = 0 THEN lpad(CAST(o_custkey * 3 % 160 AS VARCHAR), 3, '0') END AS pais,
        CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '***111111**' ELSE '***000000**' END AS representante_legal, CASE WHEN o_orderkey % 5 < 3 THEN 'REP ' || o_orderkey END AS nome_do_representante,
        CASE o_orderkey % 6 WHEN 2 THEN lpad(CAST(o_orderkey % 45 AS VARCHAR), 2, '0') WHEN 3 THEN NULL ELSE '00' END AS qualificacao_do_representante_legal,
        CASE WHEN o_orderkey % 12 < 10 THEN CAST(o_orderkey % 12 AS VARCHAR) WHEN o_orderkey % 12 = 11 THEN 'A' END AS faixa_etaria, o_orderkey
      FROM orders WHERE o_orderkey % 99 > 0),
    socios AS (
      SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21) AS socio_id, * EXCLUDE (h, o_orderkey)
      FROM (SELECT *, md5(cnpj_basico || chr(31) || identificador_de_socio || chr(31) || cnpj_cpf_do_socio || chr(31) || CASE WHEN nome_socio IS NULL THEN '' ELSE 'partner é ' || o_orderkey END || chr(31) || strftime(data_entrada_sociedade, '%Y%m%d')) AS h
            FROM partner_rows))"""


def registry_tables(spark, sf_dir) -> marts.Tables:
    """Facts through the library's own normalisation, ids and types; code tables enriched by its own supplement."""
    t = lambda name: table(spark, sf_dir, name)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    joined = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    day = lambda c: F.replace(c.cast("date").cast("string"), F.lit("-"), F.lit(""))
    n, k, c = F.col("n_nationkey"), F.col("o_orderkey"), F.col("c_custkey")
    codes = lambda df, code, label: df.select(code.alias("codigo"), label.alias("descricao"))
    monthly = {
        "cnaes": codes(t("part").where("p_partkey % 3 <> 0"), pad(F.col("p_partkey"), 7), joined(F.col("p_name"), " ", F.col("p_partkey"))), "municipios": codes(t("supplier"), pad(F.col("s_suppkey"), 4), F.col("s_name")),
        "motivos": codes(t("nation"), pad(n, 2), joined("M ", F.col("n_name"))), "paises": codes(t("nation"), pad(n * 5, 3), F.col("n_name")),
        "qualificacoes_socios": codes(t("nation").where("n_nationkey < 20"), pad(n, 2), joined("Q ", F.col("n_name"))), "naturezas_juridicas": codes(t("nation"), joined("20", pad(n, 2)), joined(F.col("n_name"), " SA")),
    }
    capital = F.when(c % 9 == 0, None).when(c % 20 == 0, F.lit(specs.CAPITAL_SENTINEL)).otherwise(F.col("c_acctbal"))
    companies = t("customer").where("c_custkey % 10 <> 9").select(
        pad(c, 8).alias("cnpj_basico"), F.col("c_name").alias("razao_social"), (c % 30 + 2000).cast("string").alias("natureza_juridica"), pad(c % 45, 2).alias("qualificacao_responsavel"), capital.alias("capital_social"),
        F.element_at(F.array(*[F.lit(v) for v in ("00", "01", "03", "05", "07")]), (c % 5 + 1).cast("int")).alias("porte"), F.when(c % 6 == 0, "UNIÃO").alias("ente_federativo_responsavel"),
    )
    owner, when, abroad = F.col("o_custkey"), F.col("o_orderdate"), F.col("o_orderpriority").like("1%")
    place = {
        "cnpj_basico": pad(owner, 8), "cnpj_ordem": k.cast("string"), "cnpj_dv": pad(k % 97, 2), "identificador_matriz_filial": (k % 3 + 1).cast("string"), "nome_fantasia": F.when(k % 4 != 0, joined("LOJA ", k)),
        "situacao_cadastral": F.when(F.col("o_orderstatus") == "F", "02").when(F.col("o_orderstatus") == "O", "05").otherwise("07"), "data_situacao_cadastral": day(when), "motivo_situacao_cadastral": pad(k % 40, 2),
        "nome_cidade_exterior": F.when(abroad, joined("CITY ", owner % 9)), "pais": F.when(k % 7 > 0, (owner * 3 % 160).cast("string")), "data_inicio_atividade": day(F.date_sub(when, (k % 1000).cast("int"))),
        "cnae_fiscal_principal": pad(k % 3000, 7), "cnae_fiscal_secundaria": F.when(k % 3 > 0, joined(pad(k % 50, 7), ", ", pad(k % 60, 7), ",,")), "tipo_logradouro": F.when(k % 3 == 0, "RUA").when(k % 3 == 1, "AVENIDA"),
        "logradouro": joined("R ", k % 500), "numero": (k % 999).cast("string"), "complemento": F.when(k % 5 == 0, joined("AP ", k % 9)), "bairro": joined("B ", owner % 77),
        "cep": F.when(k % 11 == 0, "00000000").when(k % 13 == 0, "12A").when(k % 17 != 0, pad(k * 7919 % 100000000, 8)), "uf": F.when(abroad, "EX").when(k % 19 > 0, "SP"), "municipio": pad(owner % 120, 4), "ddd_1": pad(k % 90, 2),
        "telefone_1": (k + 10000000).cast("string"), "ddd_2": F.when(k % 2 == 0, "11"), "telefone_2": F.when(k % 2 == 0, (k + 20000000).cast("string")), "ddd_fax": F.when(k % 8 == 0, "12"),
        "fax": F.when(k % 8 == 0, (k + 30000000).cast("string")), "correio_eletronico": joined("a", k, "@example.org"), "situacao_especial": F.when(k % 50 == 0, "ESPÓLIO"), "data_situacao_especial": F.when(k % 50 == 0, day(F.date_add(when, 1))),
    }
    partner = {
        "cnpj_basico": pad(owner, 8), "identificador_de_socio": (k % 4 + 1).cast("string"), "nome_socio": F.when(k % 11 > 0, joined("PARTNER  É ", k)), "cnpj_cpf_do_socio": F.when(k % 9 != 0, joined("***", pad(k % 1000000, 6), "**")),
        "qualificacao_do_socio": pad(k % 45, 2), "data_entrada_sociedade": day(when), "pais": F.when(k % 4 == 0, pad(owner * 3 % 160, 3)), "representante_legal": F.when(k % 5 == 0, None).when(k % 5 == 1, "***111111**").otherwise("***000000**"),
        "nome_do_representante": F.when(k % 5 < 3, joined("REP ", k)), "qualificacao_do_representante_legal": F.when(k % 6 == 2, pad(k % 45, 2)).when(k % 6 != 3, "00"),
        "faixa_etaria": F.when(k % 12 < 10, (k % 12).cast("string")).when(k % 12 == 11, "A"),
    }
    tax = {
        "cnpj_basico": pad(c, 8), "opcao_pelo_simples": F.when(F.col("c_nationkey") < 12, "S").otherwise("N"), "data_opcao_pelo_simples": day(F.date_add(F.lit("2010-01-01").cast("date"), (c % 3000).cast("int"))),
        "data_exclusao_do_simples": F.when(F.col("c_nationkey") >= 12, day(F.date_add(F.lit("2020-01-01").cast("date"), (c % 300).cast("int")))), "opcao_pelo_mei": F.when(c % 3 == 0, "S").otherwise("N"),
        "data_opcao_pelo_mei": F.when(c % 3 == 0, day(F.date_add(F.lit("2011-01-01").cast("date"), (c % 900).cast("int")))), "data_exclusao_do_mei": F.when(c % 6 == 0, "20210505"),
    }

    def loaded(rows, columns, family):
        rows = rows.select(*[v.alias(name) for name, v in columns.items()])
        return S.typed(S.clean_dates(S.identified(S.normalise(rows, family), family), family, AS_OF), family)

    facts = {
        "empresas": companies, "estabelecimentos": loaded(t("orders"), place, "ESTABELE"), "socios": loaded(t("orders").where("o_orderkey % 99 > 0"), partner, "SOCIOCSV"),
        "dados_simples": loaded(t("customer").where("c_mktsegment <> 'BUILDING'"), tax, "SIMPLESCSV"),
    }
    return monthly | marts.enriched_domains(spark, monthly) | marts.label_domains(spark) | facts


CNPJ = "e.cnpj_basico, e.cnpj_ordem, e.cnpj_dv, e.cnpj_basico || e.cnpj_ordem || e.cnpj_dv AS cnpj"


@query(TABLES_SQL + f"""
    SELECT {CNPJ}, razao_social, natureza_juridica, nj.descricao AS natureza_juridica_descricao, qualificacao_responsavel, q.descricao AS qualificacao_responsavel_descricao, capital_social, porte, po.descricao AS porte_descricao,
      ente_federativo_responsavel, nome_fantasia, identificador_matriz_filial, mf.descricao AS identificador_matriz_filial_descricao, situacao_cadastral, si.descricao AS situacao_cadastral_descricao, data_situacao_cadastral,
      motivo_situacao_cadastral, mo.descricao AS motivo_situacao_cadastral_descricao, nome_cidade_exterior, pais, pa.descricao AS pais_descricao, data_inicio_atividade, cnae_fiscal_principal, cn.descricao AS cnae_fiscal_principal_descricao,
      cnae_fiscal_secundaria, tipo_logradouro, logradouro, numero, complemento, bairro, cep, uf, municipio, mu.descricao AS municipio_nome, ddd_1, telefone_1, ddd_2, telefone_2, ddd_fax, fax, correio_eletronico, situacao_especial,
      data_situacao_especial, opcao_pelo_simples, data_opcao_pelo_simples, data_exclusao_do_simples, opcao_pelo_mei, data_opcao_pelo_mei, data_exclusao_do_mei
    FROM empresas m JOIN estabelecimentos e ON e.cnpj_basico = m.cnpj_basico LEFT JOIN naturezas nj ON nj.codigo = natureza_juridica LEFT JOIN qualificacoes_e q ON q.codigo = qualificacao_responsavel LEFT JOIN portes po ON po.codigo = porte
    LEFT JOIN matriz mf ON mf.codigo = identificador_matriz_filial LEFT JOIN situacoes si ON si.codigo = situacao_cadastral LEFT JOIN motivos_e mo ON mo.codigo = motivo_situacao_cadastral LEFT JOIN paises_e pa ON pa.codigo = pais
    LEFT JOIN cnaes cn ON cn.codigo = cnae_fiscal_principal LEFT JOIN municipios mu ON mu.codigo = municipio LEFT JOIN simples s ON s.cnpj_basico = m.cnpj_basico""")
def empresa_detalhe(spark, sf_dir):
    return marts.empresa_detalhe(registry_tables(spark, sf_dir))


@query(TABLES_SQL + """
    SELECT socio_id, cnpj_basico, identificador_de_socio, ti.descricao AS identificador_de_socio_descricao, nome_socio, cnpj_cpf_do_socio, qualificacao_do_socio, qs.descricao AS qualificacao_do_socio_descricao, data_entrada_sociedade,
      pais, pa.descricao AS pais_descricao, representante_legal, nome_do_representante, qualificacao_do_representante_legal, qr.descricao AS qualificacao_do_representante_legal_descricao, faixa_etaria, fa.descricao AS faixa_etaria_descricao
    FROM socios LEFT JOIN tipos ti ON ti.codigo = identificador_de_socio LEFT JOIN qualificacoes_e qs ON qs.codigo = qualificacao_do_socio LEFT JOIN paises_e pa ON pa.codigo = pais
    LEFT JOIN qualificacoes_e qr ON qr.codigo = qualificacao_do_representante_legal LEFT JOIN faixas fa ON fa.codigo = faixa_etaria""")
def socios_detalhe(spark, sf_dir):
    return marts.socios_detalhe(registry_tables(spark, sf_dir))


ALL_FLAGS_SQL = TABLES_SQL + f""",
    flags AS (
      SELECT {CNPJ}, CASE WHEN cep IS NULL THEN 'missing' WHEN cep = '00000000' THEN 'zero_sentinel' WHEN regexp_full_match(cep, '[0-9]{{8}}') THEN 'valid_shape' ELSE 'malformed' END AS cep_status, uf = 'EX' AS is_exterior,
        pais IS NOT NULL AND pais NOT IN (SELECT codigo FROM paises) AS pais_lookup_missing, motivo_situacao_cadastral NOT IN (SELECT codigo FROM motivos) AS motivo_lookup_missing,
        pais IS NOT NULL AND pais NOT IN (SELECT codigo FROM paises_e) AS pais_enriched_lookup_missing, motivo_situacao_cadastral NOT IN (SELECT codigo FROM motivos_e) AS motivo_enriched_lookup_missing,
        capital_social = 999999999999.0 AS capital_social_is_suspicious_sentinel, cep, capital_social
      FROM estabelecimentos e JOIN empresas m ON m.cnpj_basico = e.cnpj_basico)"""


@query(ALL_FLAGS_SQL + " SELECT * EXCLUDE (cep, capital_social) FROM flags")
def data_quality_flags(spark, sf_dir):
    return marts.data_quality_flags(registry_tables(spark, sf_dir))


@query(ALL_FLAGS_SQL + """
    SELECT cnpj_basico, cnpj_ordem, cnpj_dv, cnpj, cep AS cep_raw, CASE WHEN cep_status = 'valid_shape' THEN cep END AS cep_clean, capital_social AS capital_social_raw,
      CASE WHEN NOT coalesce(capital_social_is_suspicious_sentinel, false) THEN capital_social END AS capital_social_clean, cep_status, capital_social_is_suspicious_sentinel, pais_lookup_missing, motivo_lookup_missing, is_exterior
    FROM flags""")
def estabelecimentos_clean(spark, sf_dir):
    t = registry_tables(spark, sf_dir)
    return marts.estabelecimentos_clean(t, marts.data_quality_flags(t))


PARTNER_FLAGS_SQL = TABLES_SQL + """,
    flags AS (
      SELECT socio_id, cnpj_basico, identificador_de_socio, cnpj_cpf_do_socio, representante_legal = '***000000**' AND qualificacao_do_representante_legal = '00' AS representante_is_placeholder,
        pais IS NOT NULL AND pais NOT IN (SELECT codigo FROM paises) AS pais_lookup_missing, qualificacao_do_socio NOT IN (SELECT codigo FROM qualificacoes) AS qualificacao_socio_lookup_missing,
        coalesce(qualificacao_do_representante_legal <> '00' AND qualificacao_do_representante_legal NOT IN (SELECT codigo FROM qualificacoes), false) AS qualificacao_representante_lookup_missing,
        pais IS NOT NULL AND pais NOT IN (SELECT codigo FROM paises_e) AS pais_enriched_lookup_missing, qualificacao_do_socio NOT IN (SELECT codigo FROM qualificacoes_e) AS qualificacao_socio_enriched_lookup_missing,
        coalesce(qualificacao_do_representante_legal <> '00' AND qualificacao_do_representante_legal NOT IN (SELECT codigo FROM qualificacoes_e), false) AS qualificacao_representante_enriched_lookup_missing,
        faixa_etaria = '0' AS faixa_etaria_nao_se_aplica
      FROM socios)"""


@query(PARTNER_FLAGS_SQL + " SELECT * FROM flags")
def socios_quality_flags(spark, sf_dir):
    return marts.socios_quality_flags(registry_tables(spark, sf_dir))


_PAIR = "{0} AS {0}_raw, CASE WHEN {1} IS NULL OR NOT {1} THEN {0} END AS {0}_clean"


@query(PARTNER_FLAGS_SQL + f"""
    SELECT f.socio_id, f.cnpj_basico, f.identificador_de_socio, f.cnpj_cpf_do_socio, {", ".join(_PAIR.format(c, "representante_is_placeholder") for c in ("representante_legal", "nome_do_representante", "qualificacao_do_representante_legal"))},
      {_PAIR.format("faixa_etaria", "faixa_etaria_nao_se_aplica")}, representante_is_placeholder, pais_lookup_missing, qualificacao_socio_lookup_missing, qualificacao_representante_lookup_missing, faixa_etaria_nao_se_aplica
    FROM flags f JOIN socios s ON s.socio_id = f.socio_id""")
def socios_clean(spark, sf_dir):
    """Flags meet the partners by their surrogate id."""
    t = registry_tables(spark, sf_dir)
    return marts.socios_clean(t, marts.socios_quality_flags(t))


SEARCHED_SQL = TABLES_SQL + f""",
    search AS (
      SELECT {CNPJ}, razao_social, nome_fantasia, uf, municipio AS municipio_codigo, mu.descricao AS municipio_nome, situacao_cadastral, identificador_matriz_filial, cnae_fiscal_principal, cn.descricao AS cnae_descricao, data_inicio_atividade
      FROM empresas m JOIN estabelecimentos e ON e.cnpj_basico = m.cnpj_basico LEFT JOIN cnaes cn ON cn.codigo = cnae_fiscal_principal LEFT JOIN municipios mu ON mu.codigo = municipio
      WHERE situacao_cadastral = '02' AND identificador_matriz_filial = 1)"""


@query(SEARCHED_SQL + " SELECT * FROM search")
def empresas_busca_nome(spark, sf_dir):
    return marts.empresas_busca_nome(registry_tables(spark, sf_dir))


@query(SEARCHED_SQL + """
    SELECT 'uf' AS kind, uf, NULL AS municipio_codigo, NULL AS municipio_nome, NULL AS cnae_fiscal_principal, count(*) AS total FROM search GROUP BY uf
    UNION ALL SELECT 'uf_municipio', uf, min(municipio_codigo), municipio_nome, NULL, count(*) FROM search GROUP BY uf, municipio_nome
    UNION ALL SELECT 'uf_cnae', uf, NULL, NULL, cnae_fiscal_principal, count(*) FROM search GROUP BY uf, cnae_fiscal_principal""")
def empresas_busca_nome_counts(spark, sf_dir):
    return marts.empresas_busca_nome_counts(marts.empresas_busca_nome(registry_tables(spark, sf_dir)))


@query(TABLES_SQL + f"""
    SELECT {CNPJ}, trim(part) AS cnae_codigo FROM (SELECT *, unnest(string_split(cnae_fiscal_secundaria, ',')) AS part FROM estabelecimentos) e WHERE trim(part) <> ''""")
def cnae_secundaria_exploded(spark, sf_dir):
    return marts.cnae_secundaria_exploded(registry_tables(spark, sf_dir))


@query(TABLES_SQL + f"""
    SELECT codigo, descricao, s.section AS secao, substr(codigo, 1, 2) AS divisao, substr(codigo, 1, 3) AS grupo, substr(codigo, 1, 4) || '-' || substr(codigo, 5, 1) AS classe
    FROM cnaes LEFT JOIN ({_values(specs.section_rows())}) s(division, section) ON division = substr(codigo, 1, 2)""")
def cnaes_hierarquia(spark, sf_dir):
    return marts.cnaes_hierarquia(spark, registry_tables(spark, sf_dir))


@query(TABLES_SQL + """
    SELECT (SELECT count(*) FROM estabelecimentos) AS establishments, count(*) AS dropped FROM estabelecimentos WHERE cnpj_basico NOT IN (SELECT cnpj_basico FROM empresas)""")
def dropped_by_flags(spark, sf_dir):
    t = registry_tables(spark, sf_dir)
    whole = t["estabelecimentos"].agg(F.count("*").alias("establishments")).withColumn("_one", F.lit(1))
    return whole.join(marts.dropped_by_flags(t).withColumn("_one", F.lit(1)), "_one").drop("_one")


_ORPHANS = [
    ("estabelecimentos", "cnae_fiscal_principal", "cnaes", None, ""), ("estabelecimentos", "municipio", "municipios", None, ""), ("estabelecimentos", "motivo_situacao_cadastral", "motivos", "motivos_e", ""),
    ("estabelecimentos", "pais", "paises", "paises_e", ""), ("empresas", "natureza_juridica", "naturezas", None, ""), ("empresas", "qualificacao_responsavel", "qualificacoes", "qualificacoes_e", ""), ("socios", "pais", "paises", "paises_e", ""),
    ("socios", "qualificacao_do_socio", "qualificacoes", "qualificacoes_e", ""), ("socios", "qualificacao_do_representante_legal", "qualificacoes", "qualificacoes_e", " AND qualificacao_do_representante_legal <> '00'"),
]
_count = lambda t, c, dim, extra: f"(SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT codigo FROM {dim}){extra})"


@query(TABLES_SQL + " UNION ALL ".join(f" SELECT '{t}.{c}' AS label, {_count(t, c, dim, x)} AS orphans" for t, c, dim, _, x in _ORPHANS))
def registry_orphans(spark, sf_dir):
    """All nine references of the report."""
    from ..operators.quality import orphan_report

    return orphan_report(registry_tables(spark, sf_dir), marts.REFERENCES)


@query(TABLES_SQL + " UNION ALL ".join(f" SELECT '{t}.{c}' AS label, {_count(t, c, dim, x)} AS monthly_orphans, {_count(t, c, rich, x)} AS enriched_orphans, true AS available" for t, c, dim, rich, x in _ORPHANS if rich))
def registry_coverage(spark, sf_dir):
    from ..operators.quality import enriched_coverage

    return enriched_coverage(registry_tables(spark, sf_dir), [r for r in marts.REFERENCES if r.enriched])
