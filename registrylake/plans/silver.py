"""Silver: bronze archives to typed tables."""

from __future__ import annotations

import fnmatch
import logging
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from registrylake.operators.joins import keep_known_keys
from registrylake.operators.keys import distinct_keys
from registrylake.plans.parallel import run_all
from registrylake.schemas import (
    DATASETS,
    SILVER_INTERLEAVING,
    SINGLE_FILE_DATASETS,
    UNUSED_COLUMNS,
)
from registrylake.sources.archives import manifest, matching
from registrylake.sources.delimited import (
    accepted,
    empty_scan,
    rejected,
    scan_archives,
    scan_delimited,
    scan_schema,
    strict,
)
from registrylake.sources.files import Files
from registrylake.sources.routing import archives_of, excluded_legal_forms, kept_rows
from registrylake.tables.layer import Layer
from registrylake.tables.ledger import Ledger, digest, source_name
from registrylake.tables.work import staged, work_folder

log = logging.getLogger(__name__)

_KEY = "cnpj_base"
_FACTS = ("empresas", "estabelecimentos", "socios")


def ingest_silver(
    spark: SparkSession,
    source: str,
    silver: Layer,
    *,
    header: bool = True,
    members: str = "first",
    quarantine: bool = False,
    drop_unused: bool = False,
    allow_missing: bool = False,
    incremental: bool = False,
    interleave: bool = False,
    profile: bool = False,
    **scan_options,
) -> None:
    """Replace all silver tables from a bronze folder, in one step once all are written.

    Partners come last: they are kept only when their key is among the establishments or
    companies written before them. All other tables are independent of each other.
    Without an archive a code table stays as it is, or is empty if it is not there yet; for
    companies, establishments and partners that is an error unless ``allow_missing``.
    A malformed record fails the job, or with ``quarantine`` goes to ``<table>_rejected``.

    With ``incremental`` the parsed rows of every archive are kept beside the layer, by name
    and checksum: only archives that changed are inflated, and only tables are written that
    something they depend on changed for. The result is that of a full ingest.

    With ``interleave`` establishments are laid out for lookups by state, by city and by key
    alike, at the price of a shuffle. With ``profile`` every table is measured as it is written.
    """
    files = Files(spark)
    source = files.qualified(source)
    if not files.exists(source):
        raise FileNotFoundError(source)
    excluded = excluded_legal_forms(spark, source)  # fails here when the file is missing
    folder = work_folder(spark)
    try:
        listed = staged(manifest(spark, source), f"{folder}/manifest")
        scan_options |= {"header": header, "members": members}
        ledger = Ledger(spark, f"{silver.location}/_parsed") if incremental else None
        with silver.build() as new:
            _ingest(
                spark, source, new, excluded, quarantine, drop_unused, allow_missing, interleave,
                profile, ledger, folder, listed, scan_options,
            )
    finally:
        files.delete(folder)


def _ingest(
    spark, source, new, excluded, quarantine, drop_unused, allow_missing, interleave, profile,
    ledger, folder, listed, scan_options,
) -> None:
    files = new.files

    names = files.names(source, "*.zip")

    def scan(table: str) -> tuple[DataFrame, str | None] | None:
        """Rows of the archives, and what they come from if a ledger knows."""
        dataset, pattern = DATASETS[table], archives_of(table, names)
        if not fnmatch.filter(names, pattern):
            if table in _FACTS and not allow_missing:
                raise FileNotFoundError(f"{source}/{pattern}")
            if new.exists(table):
                log.warning("no archive %s, table %s stays as it is", pattern, table)
                return None
            log.warning("no archive %s, table %s will be empty", pattern, table)
        read = partial(scan_archives, spark, source, dataset=dataset, spool=folder, **scan_options)
        if ledger is None:
            return read(pattern=pattern, listed=listed), None
        chosen = matching(listed, pattern, scan_options["members"])

        def changed(names: list[str]) -> DataFrame:
            name = F.substring_index("archive", "/", -1)
            names = spark.createDataFrame([(n,) for n in names], "name string")
            some = listed.join(names, name == F.col("name"), "left_semi")
            return read(pattern="*", listed=some, source=source_name("archive", "member"))

        return ledger.rows(table, chosen, scan_options, scan_schema(dataset), changed)

    def write(
        table: str,
        found: tuple[DataFrame, str | None] | None,
        keep: Callable = lambda rows: rows,
        *depends: str | None,
    ) -> None:
        if found is None:
            return
        scanned, origin = found
        if origin:
            origin = digest(origin, quarantine, drop_unused, interleave, profile, *depends)
            if new.exists(table) and new.origin(table) == origin:
                log.info("table %s is current", table)
                return
        dataset = DATASETS[table]
        unused = UNUSED_COLUMNS.get(table, []) if drop_unused else []
        lookups = [entry for entry in dataset.lookups if entry not in unused]
        interleaving = SILVER_INTERLEAVING.get(table, ()) if interleave else ()
        written = {"origin": origin, "interleaving": interleaving, "profile": profile}
        if not quarantine:
            new.replace(table, keep(strict(scanned)).drop(*unused), lookups, **written)
            new.drop(f"{table}_rejected")
            return
        if origin is None:
            # Archives are dear to read: what they hold is written once, then split.
            scanned = staged(scanned, f"{folder}/{table}")
        new.replace(table, keep(accepted(scanned)).drop(*unused), lookups, **written)
        bad = rejected(scanned)
        if bad.isEmpty():
            new.drop(f"{table}_rejected")
        else:
            log.warning("%s: malformed records are in %s_rejected", table, table)
            new.replace(f"{table}_rejected", bad)

    def write_companies() -> None:
        codes = None
        if ledger:
            hashes = F.sum(F.xxhash64("natureza_code").cast("decimal(38,0)"))
            codes = str(tuple(excluded.agg(hashes, F.count("natureza_code")).first()))
        write("empresas", scan("empresas"), lambda rows: kept_rows("empresas", rows, excluded), codes)

    def write_single(name: str) -> None:
        write(name.lower(), scan(name.lower()))

    # Independent of each other; the longest first.
    run_all(
        [
            lambda: write("estabelecimentos", scan("estabelecimentos")),
            write_companies,
            *[partial(write_single, name) for name in SINGLE_FILE_DATASETS],
            lambda: write("cnae_alimenticio", (_food_activities(spark, source), None)),
        ]
    )

    known = distinct_keys([new.read("estabelecimentos"), new.read("empresas")], _KEY)
    write(
        "socios",
        scan("socios"),
        lambda rows: keep_known_keys(rows, known, _KEY),
        new.origin("estabelecimentos"),
        new.origin("empresas"),
    )


def _food_activities(spark: SparkSession, source: str) -> DataFrame:
    path = f"{source}/cnae_alimenticio.csv"
    dataset = DATASETS["cnae_alimenticio"]
    if Files(spark).exists(path):
        return scan_delimited(spark, path, dataset, by_name=True, multiline=True)
    log.warning("no file %s, table %s will be empty", path, dataset.name)
    return empty_scan(spark, dataset)
