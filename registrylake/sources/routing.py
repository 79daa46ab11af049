"""Which dataset a bronze file belongs to, and how each dataset is loaded."""

from __future__ import annotations

import fnmatch
import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from registrylake.functions.text import name_number, name_prefix
from registrylake.operators.rows import exclude_codes
from registrylake.schemas import DATASETS, Dataset
from registrylake.sources.delimited import scan_archives, scan_delimited, strict
from registrylake.sources.files import Files


log = logging.getLogger(__name__)

# Datasets that come in many archives, and the names of those.
_MANY = {
    "estabelecimentos": "Estabelecimentos*.zip",
    "empresas": "Empresas*.zip",
    "socios": "Socios*.zip",
}


def archives_of(dataset: str, names: list[str]) -> str:
    """Glob of the archives that a dataset is read from, given the names in the folder.

    A dataset of one file is read from the archive without a number; numbered parts count only
    when that is missing.
    """
    if dataset in _MANY:
        return _MANY[dataset]
    single, parts = f"{dataset.capitalize()}.zip", f"{dataset.capitalize()}[0-9]*.zip"
    if single not in names:
        return parts
    if fnmatch.filter(names, parts):
        log.warning("%s is read, its numbered parts are not", single)
    return single


def kept_rows(dataset: str, rows: DataFrame, excluded: DataFrame) -> DataFrame:
    """Rows of a dataset that are loaded: companies lose the excluded legal forms."""
    return exclude_codes(rows, excluded, "natureza_code") if dataset == "empresas" else rows


def route(spark: SparkSession, directory: str, pattern: str = "*.zip") -> DataFrame:
    """The files of a directory with their dataset and number, both from the file name."""
    files = [(name,) for name in Files(spark).names(directory, pattern)]
    stem = F.regexp_replace("file", r"\.[^.]*$", "")
    return spark.createDataFrame(files, "file string").select(
        "file", name_prefix(stem).alias("dataset"), name_number(stem).alias("number")
    )


def excluded_legal_forms(spark: SparkSession, directory: str) -> DataFrame:
    """Codes of the legal forms that are not companies. The file is required."""
    path = f"{directory}/naturezas_nao_empresas.csv"
    if not Files(spark).exists(path):
        raise FileNotFoundError(path)
    # Only the code column matters; the file may carry others.
    names = spark.read.options(sep=";", header=True).csv(path).columns
    columns = {name: "u64" if name == "natureza_code" else "text" for name in names}
    codes = strict(scan_delimited(spark, path, Dataset("naturezas_nao_empresas", columns)))
    return codes.select("natureza_code")


def load(spark: SparkSession, directory: str, stem: str, **options) -> DataFrame:
    """Rows of one archive by its name without extension, such as ``Empresas0``.

    The dataset follows from the name; companies lose the excluded legal forms. A missing
    archive is an empty frame, a malformed record fails the job that reads the frame.
    """
    name = stem.lower().rstrip("0123456789")
    rows = strict(scan_archives(spark, directory, f"{stem}.zip", DATASETS[name], **options))
    if name != "empresas":
        return rows
    return kept_rows(name, rows, excluded_legal_forms(spark, directory))
