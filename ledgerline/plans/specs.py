"""What the registry's files and tables look like, as plain data."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Family:
    """One family of landing files: its table, columns in file order, keys, types and rules."""

    table: str
    columns: tuple[str, ...]
    key: tuple[str, ...] = ("codigo",)
    dates: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    rules: dict[str, str] = field(default_factory=dict)
    lengths: dict[str, int] = field(default_factory=dict)
    required: tuple[str, ...] = ()


# Column orders, key columns, formats and lengths of the delivered files.
CODE = ("codigo", "descricao")
BASICO = r"^[0-9A-Z]{8}\z"
FAMILIES: dict[str, Family] = {
    "CNAECSV": Family("cnaes", CODE),
    "MOTICSV": Family("motivos", CODE),
    "MUNICCSV": Family("municipios", CODE),
    "NATJUCSV": Family("naturezas_juridicas", CODE),
    "PAISCSV": Family("paises", CODE),
    "QUALSCSV": Family("qualificacoes_socios", CODE),
    "EMPRECSV": Family(
        "empresas",
        ("cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel", "capital_social", "porte", "ente_federativo_responsavel"),
        key=("cnpj_basico",), doubles=("capital_social",),
        rules={"cnpj_basico": BASICO, "natureza_juridica": r"^[0-9]{4}\z", "qualificacao_responsavel": r"^[0-9]{2}\z", "porte": r"^(00|01|03|05)\z"},
        lengths={"cnpj_basico": 8, "natureza_juridica": 4, "qualificacao_responsavel": 2, "porte": 2}, required=("cnpj_basico",),
    ),
    "ESTABELE": Family(
        "estabelecimentos",
        (
            "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia", "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral",
            "nome_cidade_exterior", "pais", "data_inicio_atividade", "cnae_fiscal_principal", "cnae_fiscal_secundaria", "tipo_logradouro", "logradouro", "numero", "complemento",
            "bairro", "cep", "uf", "municipio", "ddd_1", "telefone_1", "ddd_2", "telefone_2", "ddd_fax", "fax", "correio_eletronico", "situacao_especial", "data_situacao_especial",
        ),
        key=("cnpj_basico", "cnpj_ordem", "cnpj_dv"), dates=("data_situacao_cadastral", "data_inicio_atividade", "data_situacao_especial"), integers=("identificador_matriz_filial",),
        rules={
            "cnpj_basico": BASICO, "cnpj_ordem": r"^[0-9A-Z]{4}\z", "cnpj_dv": r"^[0-9]{2}\z", "situacao_cadastral": r"^(01|02|03|04|08)\z", "cep": r"^[0-9]{8}\z",
            "cnae_fiscal_principal": r"^[0-9]{7}\z",
        },
        lengths={"cnpj_basico": 8, "cnpj_ordem": 4, "cnpj_dv": 2, "situacao_cadastral": 2, "motivo_situacao_cadastral": 2, "pais": 3, "cnae_fiscal_principal": 7, "cep": 8, "uf": 2, "municipio": 7},
        required=("cnpj_basico", "cnpj_ordem", "cnpj_dv"),
    ),
    "SOCIOCSV": Family(
        "socios",
        (
            "cnpj_basico", "identificador_de_socio", "nome_socio", "cnpj_cpf_do_socio", "qualificacao_do_socio", "data_entrada_sociedade", "pais", "representante_legal",
            "nome_do_representante", "qualificacao_do_representante_legal", "faixa_etaria",
        ),
        key=("socio_id",), dates=("data_entrada_sociedade",),
        rules={"cnpj_basico": BASICO, "identificador_de_socio": r"^[123]\z", "faixa_etaria": r"^[0-9]\z"},
        lengths={"cnpj_basico": 8, "identificador_de_socio": 1, "cnpj_cpf_do_socio": 14, "qualificacao_do_socio": 2, "pais": 3, "representante_legal": 11, "qualificacao_do_representante_legal": 2, "faixa_etaria": 1},
        required=("cnpj_basico", "cnpj_cpf_do_socio"),
    ),
    "SIMPLESCSV": Family(
        "dados_simples",
        ("cnpj_basico", "opcao_pelo_simples", "data_opcao_pelo_simples", "data_exclusao_do_simples", "opcao_pelo_mei", "data_opcao_pelo_mei", "data_exclusao_do_mei"),
        key=("cnpj_basico",), dates=("data_opcao_pelo_simples", "data_exclusao_do_simples", "data_opcao_pelo_mei", "data_exclusao_do_mei"),
        rules={"cnpj_basico": BASICO, "opcao_pelo_simples": r"^[SN]\z", "opcao_pelo_mei": r"^[SN]\z"},
        lengths={"cnpj_basico": 8, "opcao_pelo_simples": 1, "opcao_pelo_mei": 1}, required=("cnpj_basico",),
    ),
}

# The states and EX for abroad.
UFS = ("AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "EX", "GO", "MA", "MG", "MS", "MT", "PA", "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO")

#: The partner's identity, in hashing order.
PARTNER_IDENTITY = ("cnpj_basico", "identificador_de_socio", "cnpj_cpf_do_socio", "nome_socio", "data_entrada_sociedade")

# Sentinels and placeholders.
CAPITAL_SENTINEL = 999999999999.0
MASKED_REPRESENTATIVE = "***000000**"
NO_DOCUMENT = "00000000000000"

# Codes that monthly lookups lack, with label, confidence and note.
SUPPLEMENT_URL = "https://bcadastros.serpro.gov.br/documentacao/dominios/pj/"
REASONS = [
    ("32", "Inexistente De Fato – Ade/Cosar", "high", 'Ausente do Motivos.csv mensal; presente na tabela de domínio SERPRO. Código 15 = "Inexistente De Fato"; 32 é a variante ADE/COSAR.'),
]
COUNTRIES = [
    ("015", "ALAND, ILHAS", "high", None),
    ("042", "ANTÁRTICA", "high", None),
    ("150", "JERSEY, ILHA DO CANAL", "medium", 'SERPRO rotula "Jersey"; a tabela Siscomex/ME rotula "Guernsey" o mesmo código. Validade do código alta; rótulo divergente entre fontes.'),
    ("151", "CANÁRIAS, ILHAS", "high", None),
    ("200", "CURACAO", "high", None),
    ("321", "GUERNSEY", "high", None),
    ("359", "MAN, ILHA DE", "high", None),
    ("367", "INGLATERRA", "high", None),
    ("393", "JERSEY", "high", None),
    ("449", "MACEDÔNIA, ANT.REP.IUGOSLAVA", "high", None),
    ("498", "MONTENEGRO", "high", None),
    ("578", "PALESTINA", "high", None),
    ("678", "SAINT KITTS E NEVIS", "high", None),
    ("693", "SAO BARTOLOMEU", "high", None),
    ("699", "SÃO MARTINHO, ILHA DE (PARTE HOLANDESA)", "high", None),
    ("737", "SERVIA", "high", None),
    ("755", "SVALBARD E JAN MAYEN", "high", None),
    ("994", "A DESIGNAR", "high", 'Placeholder administrativo ("a designar"), não um país real.'),
]
QUALIFICATIONS = [
    ("36", "Gerente-Delegado", "high", 'Código legado (COLETADO ATUALMENTE="Não" na tabela ODS oficial da Receita); ausente das CSVs de coleta atuais do SERPRO. Corroborado pela norma idArquivoBinario=18132.'),
]
QUALIFICATIONS_URL = "https://www.gov.br/receitafederal/pt-br/assuntos/orientacao-tributaria/cadastros/cnpj/tabela-de-qualificacao-do-socio-representante.ods"

# Small dictionaries, (code, label).
COMPANY_SIZES = [("00", "NÃO INFORMADO"), ("01", "Microempresa"), ("03", "Empresa de Pequeno Porte"), ("05", "Demais")]
STATUSES = [("01", "Nula"), ("02", "Ativa"), ("03", "Suspensa"), ("04", "Inapta"), ("05", "Ativa Não Regular"), ("08", "Baixada")]
HEADQUARTERS = [(1, "Matriz"), (2, "Filial")]
PARTNER_KINDS = [("1", "Pessoa Jurídica"), ("2", "Pessoa Física"), ("3", "Estrangeiro")]
AGE_BANDS = [
    ("0", "Não se aplica"), ("1", "0 a 12 anos"), ("2", "13 a 20 anos"), ("3", "21 a 30 anos"), ("4", "31 a 40 anos"), ("5", "41 a 50 anos"), ("6", "51 a 60 anos"), ("7", "61 a 70 anos"),
    ("8", "71 a 80 anos"), ("9", "Maiores de 80 anos"),
]
LAYOUT_URL = "https://www.gov.br/receitafederal/dados/cnpj-metadados.pdf"

# Activity sections as ranges of two-digit divisions.
SECTIONS = [
    ("A", 1, 3), ("B", 5, 9), ("C", 10, 33), ("D", 35, 35), ("E", 36, 39), ("F", 41, 43), ("G", 45, 47), ("H", 49, 53), ("I", 55, 56), ("J", 58, 63), ("K", 64, 66), ("L", 68, 68),
    ("M", 69, 75), ("N", 77, 82), ("O", 84, 84), ("P", 85, 85), ("Q", 86, 88), ("R", 90, 93), ("S", 94, 96), ("T", 97, 97), ("U", 99, 99),
]


def section_rows() -> list[tuple[str, str]]:
    """(division, section) of each division that has one."""
    return [(f"{d:02d}", name) for name, low, high in SECTIONS for d in range(low, high + 1)]
