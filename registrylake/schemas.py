"""Data contract: datasets, declared types, lookup columns and domain codes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column names, order and declared types of the public registry
# files. Archive columns are matched by position, so the order matters.
_COLUMNS = {
    "cnaes": "cnaes_code text, description text",
    "empresas": """
        cnpj_base text, razao_social text, natureza_code u64, qualificacao_code u64,
        capital_social f64, porte_empresa u16, ente_federativo_responsavel text
    """,
    "estabelecimentos": """
        cnpj_base text, cnpj_ordem text, cnpj_dv text, identificador_matriz_filial u64,
        nome_fantasia text, situacao_cadastral u16, data_situacao_cadastral u32,
        motivo_situacao_cadastral u16, nome_cidade_exterior text, pais_code u64,
        data_inicio_atividade u32, cnae_principal_code text, cnae_secundario_code text,
        tipo_logradouro text, logradouro text, numero text, complemento text, bairro text,
        cep text, uf text, municipio_code u64, ddd_1 text, telefone_1 text, ddd_2 text,
        telefone_2 text, ddd_fax text, fax text, correio_eletronico text,
        situacao_especial text, situacao_especial_data u32
    """,
    "paises": "pais_code u64, pais_name text",
    "socios": """
        cnpj_base text, identificador_de_socio u16, nome_socio text, cpf_cnpj_socio text,
        codigo_qualificacao_socio u64, data_entrada_sociedade u32, pais_code u64,
        representante_legal_cpf text, representante_legal_nome text,
        representante_legal_qualificacao u64, faixa_etaria i64
    """,
    "naturezas": "natureza_code u64, natureza_juridica_descricao text",
    "simples": """
        cnpj_base text, opcao_pelo_simples text, data_opcao_pelo_simples u32,
        data_exclusao_do_simples u32, opcao_pelo_mei text, data_opcao_pelo_mei u32,
        data_exclusao_do_mei u32
    """,
    "municipios": "municipio_code u64, municipio_nome text",
    "qualificacoes": "qualificacao_code u64, qualificacao_descricao text",
    "motivos": "motivo_code u16, motivo_descricao text",
    "cnae_alimenticio": "cnaes_code text, descricao text, categoria text",
}

# Columns each silver table is looked up by.
_SILVER_LOOKUPS = {
    "cnaes": ["cnaes_code"],
    "empresas": ["cnpj_base"],
    "estabelecimentos": ["cnpj_base", "cnpj_ordem", "cnpj_dv", "uf", "municipio_code"],
    "paises": ["pais_code"],
    "socios": ["cnpj_base"],
    "naturezas": ["natureza_code"],
    "simples": ["cnpj_base"],
    "municipios": ["municipio_code"],
    "qualificacoes": ["qualificacao_code"],
    "motivos": ["motivo_code"],
    "cnae_alimenticio": ["cnaes_code"],
}

# Single and composite lookups of the gold tables.
GOLD_LOOKUPS = {
    "empresas": [
        "cnpj_base",
        ["municipio_code", "cnpj_base"],
        ["uf", "municipio_code"],
        ["cnpj_base", "identificador_matriz_filial", "cnpj_ordem"],
        ["municipio_code", "cnae_principal_code"],
        ["municipio_code", "cnae_secundario_code"],
        ["municipio_code", "nome_fantasia"],
    ],
    "socios": ["cnpj_base"],
    "cnaes": ["cnaes_code"],
    "simples": ["cnpj_base"],
    "municipios": ["municipio_code", ["uf", "municipio_code"]],
    "naturezas": ["natureza_code"],
    "qualificacoes": ["qualificacao_code"],
    "cnae_alimenticio": ["cnaes_code"],
}

# Registry codes. Both lists are parameters of the gold build.
ACTIVE_STATUS_CODES = [2]
DOMESTIC_COUNTRY_CODES = [105, 106, 997, 998, 999]

# Single-file datasets in load order, then the columns the
# establishment file carries but nobody needs (dropped only on request).
SINGLE_FILE_DATASETS = [
    "Motivos", "Municipios", "Naturezas", "Paises", "Qualificacoes", "Cnaes", "Simples",
]
UNUSED_COLUMNS = {"estabelecimentos": ["ddd_fax", "fax"]}

# Physical order of the one gold table whose lookups do not all start with its key.
GOLD_CLUSTERING = {"empresas": ["uf", "municipio_code", "cnpj_base"]}

# Physical order of the one silver table that is looked up by columns of few values.
SILVER_INTERLEAVING = {"estabelecimentos": ["uf", "municipio_code", "cnpj_base"]}

_SPARK_TYPES = {
    "text": T.StringType(),
    "i64": T.LongType(),
    "i32": T.IntegerType(),
    "i16": T.ShortType(),
    "u64": T.LongType(),
    "u32": T.LongType(),
    "u16": T.IntegerType(),
    "f64": T.DoubleType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
}

# Spark has no unsigned types, so their ranges are rules of their own: no sign, and
# at most this much. Stored integers are signed 64-bit, which is the limit of u64.
UNSIGNED_LIMITS = {"u16": 2**16 - 1, "u32": 2**32 - 1, "u64": None}


def spark_type(declared: str) -> T.DataType:
    """Spark type of a declared type; list<x> is an array of x, unknown names are text."""
    if declared.startswith("list<") and declared.endswith(">"):
        return T.ArrayType(spark_type(declared[5:-1]))
    return _SPARK_TYPES.get(declared, T.StringType())


@dataclass(frozen=True)
class Dataset:
    """Ordered columns with declared types, and how the table is looked up."""

    name: str
    columns: dict[str, str]
    lookups: list = field(default_factory=list)

    @classmethod
    def of(cls, name: str, columns: str, lookups: list | None = None) -> Dataset:
        pairs = (column.split() for column in columns.split(","))
        return cls(name, {column: declared for column, declared in pairs}, lookups or [])

    @property
    def names(self) -> list[str]:
        return list(self.columns)

    @property
    def struct(self) -> T.StructType:
        return T.StructType(
            [T.StructField(name, spark_type(kind)) for name, kind in self.columns.items()]
        )


DATASETS = {
    name: Dataset.of(name, columns, _SILVER_LOOKUPS[name]) for name, columns in _COLUMNS.items()
}
