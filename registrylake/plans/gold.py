"""Gold: cleaned, joined and filtered tables built from silver."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from functools import partial

from pyspark.sql import DataFrame

from registrylake.operators.joins import enrich_with_max, full_outer_using, keep_known_keys
from registrylake.operators.keys import distinct_values, first_per_key
from registrylake.operators.rows import blank_to_null, in_or_null
from registrylake.schemas import (
    ACTIVE_STATUS_CODES,
    DATASETS,
    DOMESTIC_COUNTRY_CODES,
    GOLD_CLUSTERING,
    GOLD_LOOKUPS,
)
from registrylake.plans.parallel import run_all
from registrylake.tables.layer import Layer
from registrylake.tables.work import staged, work_folder

log = logging.getLogger(__name__)

_COPIED = ["cnaes", "naturezas", "qualificacoes", "cnae_alimenticio"]
_KEY = "cnpj_base"


def gold_empresas(
    companies: DataFrame,
    establishments: DataFrame,
    country_codes: Iterable[int] = DOMESTIC_COUNTRY_CODES,
    status_codes: Iterable[int] = ACTIVE_STATUS_CODES,
) -> DataFrame:
    """One row per company and establishment, domestic and active (or unknown).

    The filter stands after the full join: a company whose establishments are all filtered
    out disappears, one that has none stays. Blanks are still values to the join.
    """
    joined = full_outer_using(first_per_key(companies, _KEY), establishments, _KEY)
    kept = joined.where(
        in_or_null("pais_code", country_codes) & in_or_null("situacao_cadastral", status_codes)
    )
    return blank_to_null(kept)


def gold_of_known_companies(silver_table: DataFrame, known: DataFrame) -> DataFrame:
    """Partners or tax-regime rows of the companies that reached gold."""
    return blank_to_null(keep_known_keys(silver_table, known, _KEY))


def gold_municipios(cities: DataFrame, companies: DataFrame) -> DataFrame:
    """Cities with the alphabetically last state seen in company addresses."""
    return blank_to_null(enrich_with_max(cities, companies, "municipio_code", "uf"))


def build_gold(
    silver: Layer,
    gold: Layer,
    country_codes: Iterable[int] = DOMESTIC_COUNTRY_CODES,
    status_codes: Iterable[int] = ACTIVE_STATUS_CODES,
) -> None:
    """Replace all gold tables, in one step once all are written.

    Safe to run again. After a failure no further table is started, and the layer is as it
    was before the build.
    """
    with gold.build() as new:

        def write(table: str, df: DataFrame) -> None:
            new.replace(table, df, GOLD_LOOKUPS[table], GOLD_CLUSTERING.get(table, ()))
            log.info("gold table %s written", table)

        companies = gold_empresas(
            silver.read("empresas"), silver.read("estabelecimentos"), country_codes, status_codes
        )
        write("empresas", companies)

        # From here on the written table is read, not computed again.
        companies = new.read("empresas")
        folder = work_folder(silver.spark)
        try:
            known = staged(distinct_values(companies, _KEY), folder)
            plans = {
                "socios": gold_of_known_companies(silver.read("socios"), known),
                "municipios": gold_municipios(silver.read("municipios"), companies),
                "simples": gold_of_known_companies(silver.read("simples"), known),
            }
            for table in _COPIED:
                plans[table] = blank_to_null(_silver_or_empty(silver, table))
            # The remaining tables do not depend on each other.
            run_all(partial(write, table, df) for table, df in plans.items())
        finally:
            gold.files.delete(folder)


def _silver_or_empty(silver: Layer, table: str) -> DataFrame:
    """A silver table; the optional food activities may be missing, which gives no rows."""
    if table == "cnae_alimenticio" and not silver.exists(table):
        log.warning("no silver table %s, the gold table will be empty", table)
        return silver.spark.createDataFrame([], DATASETS[table].struct)
    return silver.read(table)
