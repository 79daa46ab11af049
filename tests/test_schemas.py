import pytest
from pyspark.sql import types as T

from registrylake.schemas import (
    ACTIVE_STATUS_CODES,
    DATASETS,
    DOMESTIC_COUNTRY_CODES,
    GOLD_LOOKUPS,
    UNUSED_COLUMNS,
    Dataset,
    spark_type,
)
from registrylake.sources.delimited import scan_delimited
from registrylake.tables.layer import leading_columns


def test_column_counts():
    counts = {name: len(d.columns) for name, d in DATASETS.items()}
    assert counts == {
        "cnaes": 2, "empresas": 7, "estabelecimentos": 30, "paises": 2, "socios": 11,
        "naturezas": 2, "simples": 7, "municipios": 2, "qualificacoes": 2, "motivos": 2,
        "cnae_alimenticio": 3,
    }


def test_every_dataset_has_columns_and_lookups():
    for dataset in DATASETS.values():
        assert dataset.columns and dataset.lookups
        for entry in dataset.lookups:
            assert entry in dataset.columns
    assert set(UNUSED_COLUMNS["estabelecimentos"]) <= set(DATASETS["estabelecimentos"].columns)


def test_gold_lookups_name_known_columns():
    assert len(GOLD_LOOKUPS) == 8 and len(GOLD_LOOKUPS["empresas"]) == 7
    known = {name: set(d.columns) for name, d in DATASETS.items()}
    known["empresas"] |= known["estabelecimentos"]
    known["municipios"] |= {"uf"}
    for table, lookups in GOLD_LOOKUPS.items():
        for entry in lookups:
            assert set([entry] if isinstance(entry, str) else entry) <= known[table]


def test_codes():
    assert ACTIVE_STATUS_CODES == [2]
    assert DOMESTIC_COUNTRY_CODES == [105, 106, 997, 998, 999]


@pytest.mark.parametrize(
    "declared, expected",
    [
        ("text", T.StringType()), ("i64", T.LongType()), ("i32", T.IntegerType()),
        ("i16", T.ShortType()), ("u64", T.LongType()), ("u32", T.LongType()),
        ("u16", T.IntegerType()), ("f64", T.DoubleType()), ("bool", T.BooleanType()),
        ("date", T.DateType()), ("datetime", T.TimestampType()),
        ("list<u16>", T.ArrayType(T.IntegerType())), ("interval", T.StringType()),
    ],
)
def test_spark_type(declared, expected):
    assert spark_type(declared) == expected


def test_leading_columns():
    assert leading_columns("t", []) == []
    assert leading_columns("t", ["a", ["b", "c"], ["a", "c"]]) == ["a", "b"]
    with pytest.raises(ValueError, match="Empty lookup path"):
        leading_columns("t", ["a", []])


def test_a_list_cannot_be_read_from_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a;b\n1;2\n")
    with pytest.raises(ValueError, match="list<i64> cannot be read"):
        scan_delimited(spark, str(tmp_path / "t.csv"), Dataset.of("t", "a text, b list<i64>"))
