"""The two jobs as commands, for spark-submit or ``python -m registrylake``."""

from __future__ import annotations

import argparse
import hashlib
import logging

from pyspark.sql import SparkSession

from registrylake.plans.gold import build_gold
from registrylake.plans.silver import ingest_silver
from registrylake.schemas import ACTIVE_STATUS_CODES, DOMESTIC_COUNTRY_CODES
from registrylake.sources.files import Files
from registrylake.tables.layer import Layer


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="registrylake")
    jobs = parser.add_subparsers(dest="job", required=True)
    ingest = jobs.add_parser("ingest-silver", help="bronze archives to silver tables")
    ingest.add_argument("--bronze", required=True, help="folder of the archives")
    ingest.add_argument("--silver", required=True, help="folder of the silver tables")
    ingest.add_argument("--no-header", action="store_true", help="archives have no header line")
    ingest.add_argument("--all-members", action="store_true", help="read every archive member")
    ingest.add_argument("--quarantine", action="store_true", help="set malformed records aside")
    ingest.add_argument("--drop-unused", action="store_true", help="leave out unused columns")
    ingest.add_argument("--allow-missing", action="store_true", help="go without some archives")
    build = jobs.add_parser("build-gold", help="silver tables to gold tables")
    build.add_argument("--silver", required=True, help="folder of the silver tables")
    build.add_argument("--gold", required=True, help="folder of the gold tables")
    build.add_argument("--countries", type=int, nargs="+", default=DOMESTIC_COUNTRY_CODES)
    build.add_argument("--statuses", type=int, nargs="+", default=ACTIVE_STATUS_CODES)
    return parser.parse_args(arguments)


def layer_at(spark: SparkSession, kind: str, location: str) -> Layer:
    """A layer whose name goes with its location, so that two folders never share one."""
    location = Files(spark).qualified(location)
    return Layer(spark, f"{kind}_{hashlib.md5(location.encode()).hexdigest()[:12]}", location)


def run(spark: SparkSession, chosen: argparse.Namespace) -> None:
    silver = layer_at(spark, "silver", chosen.silver)
    if chosen.job == "ingest-silver":
        ingest_silver(
            spark,
            chosen.bronze,
            silver,
            header=not chosen.no_header,
            members="all" if chosen.all_members else "first",
            quarantine=chosen.quarantine,
            drop_unused=chosen.drop_unused,
            allow_missing=chosen.allow_missing,
        )
    else:
        build_gold(silver, layer_at(spark, "gold", chosen.gold), chosen.countries, chosen.statuses)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    command = parse()
    run(SparkSession.builder.appName(f"registrylake {command.job}").getOrCreate(), command)
