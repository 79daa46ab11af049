"""Parsed rows of archives, kept by name and checksum, so that only changed ones are read again."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from registrylake.sources.files import Files
from registrylake.tables.markers import Markers, folder_name, older

#: Column by which a scan tells the member a row is from, and the folder of its rows.
SOURCE, _PART = "_source", "_part"


def digest(*values) -> str:
    return hashlib.sha256(json.dumps(values, sort_keys=True).encode()).hexdigest()[:32]


def source_name(archive: str, member: str) -> Column:
    """Name of an archive without its folder, and of the member."""
    return F.concat(F.substring_index(archive, "/", -1), F.lit("|"), F.col(member))


class Ledger:
    """Rows of archive members in a folder, by dataset.

    Each member's rows are a folder of their own, named in a numbered marker with the name,
    size and checksum of the member and the options it was read with. A changed member gets a
    new folder; the rows of members that are gone or changed stay until the next change, for
    queries that still read them.
    """

    def __init__(self, spark: SparkSession, location: str):
        self.spark, self.files = spark, Files(spark)
        self.location = self.files.qualified(location)
        self._markers = Markers(self.files, f"{self.location}/_log")

    def rows(
        self,
        table: str,
        members: DataFrame,
        options: dict,
        schema: T.StructType,
        scan: Callable[[list[str]], DataFrame],
    ) -> tuple[DataFrame, str]:
        """The rows of all members of a manifest, and a digest of what they come from.

        ``scan`` reads the archives with the given names, all their members, into ``schema``
        with a column ``_source``. It is called only for archives with a member that is new,
        has another size or checksum, or was read with other options.
        """
        listed = members.select(source_name("archive", "member").alias("name"), "archive", "size", "crc")
        found = {row["name"]: row for row in listed.collect()}  # one row per member
        state = digest(options, schema.jsonValue())
        number, tables = self._markers.last()
        before = tables.get(table) or {"state": state, "parts": {}}
        known = before["parts"] if before["state"] == state else {}
        same = lambda name, row: known.get(name, [None])[:2] == [row["size"], row["crc"]]
        parts = {name: known[name] for name, row in found.items() if same(name, row)}
        changed = {row["archive"] for name, row in found.items() if name not in parts}
        if changed:
            fresh = {name for name, row in found.items() if row["archive"] in changed}
            folder = f"{self.location}/{table}/{folder_name(number, uuid.uuid4().hex)}"
            rows = scan(sorted(archive.rsplit("/", 1)[-1] for archive in changed))
            part = F.md5(SOURCE).alias(_PART)
            rows.select(*schema.names, part).write.partitionBy(_PART).parquet(folder)
            written = set(self.files.directories(folder))
            for name in fresh:
                own = f"{_PART}={hashlib.md5(name.encode()).hexdigest()}"
                row = found[name]
                parts[name] = [row["size"], row["crc"], f"{folder}/{own}" if own in written else None]
        if changed or known.keys() != parts.keys() or before["state"] != state or table not in tables:
            self._publish(table, {"state": state, "parts": parts}, before)
        folders = sorted(folder for _, _, folder in parts.values() if folder)
        reader = self.spark.read.schema(schema)
        rows = reader.parquet(*folders) if folders else self.spark.createDataFrame([], schema)
        return rows, digest(state, {name: part[:2] for name, part in parts.items()})

    def _publish(self, table: str, entry: dict, before: dict) -> None:
        while True:
            number, tables = self._markers.last()
            if self._markers.publish(number + 1, {**tables, table: entry}):
                break
        self._markers.clean(number + 1)
        used = {part[2].rsplit("/", 2)[1] for e in (entry, before) for part in e["parts"].values() if part[2]}
        for folder in self.files.directories(f"{self.location}/{table}"):
            if folder not in used and used and older(folder, min(used)):
                self.files.delete(f"{self.location}/{table}/{folder}")
        kept = {part[2] for e in (entry, before) for part in e["parts"].values() if part[2]}
        for folder in used:
            path = f"{self.location}/{table}/{folder}"
            for part in self.files.directories(path):
                if f"{path}/{part}" not in kept:
                    self.files.delete(f"{path}/{part}")
