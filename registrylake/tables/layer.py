"""A layer: one catalog database of Parquet tables under one folder."""

from __future__ import annotations

import hashlib
import re
import threading
import uuid
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from registrylake.operators.keys import distinct_values, row_count
from registrylake.schemas import Dataset
from registrylake.sources.files import Files
from registrylake.tables.layout import (
    hashed_paths,
    interleaved,
    key_hash,
    leading_columns,
    paths_of,
    with_hashes,
)
from registrylake.tables.markers import Markers, folder_name, older
from registrylake.tables.work import staged, work_folder

#: Names that appends use while they write start so.
_ASIDE = "_batch"
_database = threading.Lock()


class ConcurrentWrite(RuntimeError):
    """Another writer changed the same table since this one started."""


class Layer:
    """Tables of one layer, by name.

    Every write of a whole table goes to a new version folder. What the layer holds is named
    by numbered markers: each lists all tables with their version and schema, the highest
    valid one counts. A marker is created only if its number is not taken, and appears whole,
    so a commit is one step, of one table or of all tables of a ``build``. A write that fails
    or stops leaves the layer as it was, and a new session finds exactly what was committed.
    Of two writers that start from the same version of a table, the second to commit fails
    with ``ConcurrentWrite``; writers of different tables do not disturb each other. The
    previous version of a table stays until the next one, for queries that still read it.

    Rows are appended as a batch: a folder written aside, then renamed into the version it
    belongs to. The name follows from the identity of the batch, so a retry adds nothing.

    Lookups by a column are served without indexes: each column that starts a declared
    path gets a Bloom filter per row group where Parquet writes one (not for columns of few
    values), and so does a stored hash of each composite path that needs one, which only
    ``lookup`` sees. A table written with ``clustering`` is laid out by ranges of those columns,
    so a lookup along them reads few files; with ``interleaving`` by ranges of all of them at
    once, so a lookup by any one of them does.
    """

    def __init__(self, spark: SparkSession, name: str, location: str):
        if not name.isidentifier():
            raise ValueError(f"Not a name for a layer: {name}")
        self.files = Files(spark)
        self.spark, self.name = spark, name
        self.location = self.files.qualified(location)
        self._markers = Markers(self.files, f"{self.location}/_log")
        self._committing = threading.Lock()
        quoted = self.location.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{quoted}'")
        there = self.files.qualified(unquote(spark.catalog.getDatabase(name).locationUri))
        if there != self.location:
            raise ValueError(f"Layer {name} is at {there}, not at {self.location}")
        _, committed = self._markers.last()
        for table in {*self.tables(), *committed}:
            self._follow(table, committed.get(table))

    def _qualified(self, table: str) -> str:
        if not table.isidentifier():
            raise ValueError(f"Not a name for a table: {table}")
        return f"`{self.name}`.`{table}`"

    def _path(self, table: str, version: str = "") -> str:
        return f"{self.location}/{table}/{version}".rstrip("/")

    # Versions

    def _commit(self, changes: dict[str, dict | None], seen: dict[str, dict]) -> None:
        """Publish written versions, and None for dropped tables, in one step.

        ``seen`` are the tables when the writer started.
        """
        with self._committing:
            while True:
                number, tables = self._markers.last()
                moved = sorted(
                    table for table in changes
                    if (tables.get(table) or {}).get("version") != (seen.get(table) or {}).get("version")
                )
                if moved:
                    raise ConcurrentWrite(f"{self.name}: {moved} changed since this write started")
                after = {t: entry for t, entry in {**tables, **changes}.items() if entry}
                if self._markers.publish(number + 1, after):
                    break
            for table, entry in changes.items():
                self._follow(table, entry)
            self._clean(number + 1, {table: (tables.get(table), changes[table]) for table in changes})

    def _clean(self, number: int, versions: dict[str, tuple[dict | None, dict | None]]) -> None:
        """Remove what neither the last nor the previous version of a table needs.

        A writer that is still at work started no earlier than the previous version, and
        version folders start with the number of the marker they started from.
        """
        for table, (before, after) in versions.items():
            if after is None:
                self.files.delete(self._path(table))
            elif before:
                kept = {before["version"], after["version"]}
                for version in self.files.directories(self._path(table)):
                    if version not in kept and older(version, before["version"]):
                        self.files.delete(self._path(table, version))
        self._markers.clean(number)

    def _follow(self, table: str, entry: dict | None) -> None:
        """Let the catalog know the committed version of a table."""
        name = self._qualified(table)
        if self.exists(table):
            details = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
            there = self.files.qualified(unquote(details.first()["data_type"]))
            if entry and there == self._path(table, entry["version"]):
                return
            self.spark.sql(f"DROP TABLE {name}")
        if entry:
            path = self._path(table, entry["version"])
            self._create(name, path, T.StructType.fromJson(entry["schema"]), table, entry)

    def _create(self, name: str, path: str, schema: T.StructType, table: str, entry: dict) -> None:
        options = self._writing(table, entry["lookups"], entry["hashes"])
        options |= {"recursiveFileLookup": "true"}
        self.spark.catalog.createTable(name, path=path, source="parquet", schema=schema, **options)

    @staticmethod
    def _writing(table: str, lookups: list, hashes: Iterable[str] = ()) -> dict[str, str]:
        """Options with which files of the table are written."""
        options = {"compression": "zstd"}
        for column in [*leading_columns(table, lookups), *hashes]:
            options["parquet.bloom.filter.adaptive.enabled"] = "true"
            options[f"parquet.bloom.filter.enabled#{column}"] = "true"
        return options

    # Catalog

    def exists(self, table: str) -> bool:
        return table.isidentifier() and self.spark.catalog.tableExists(self._qualified(table))

    def tables(self) -> list[str]:
        listed = self.spark.catalog.listTables(self.name)
        return sorted(t.name for t in listed if not t.isTemporary and not t.name.startswith(_ASIDE))

    def columns(self, table: str) -> dict[str, str]:
        """Column names and stored types, from the catalog alone."""
        return {f.name: f.dataType.simpleString() for f in self.read(table).schema.fields}

    # Reads

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self._qualified(table))

    @staticmethod
    def _stored(entry: dict) -> T.StructType:
        """The columns in the files: those of the table and the hashes of composite paths."""
        declared = T.StructType.fromJson(entry["schema"])
        return T.StructType([*declared, *[T.StructField(name, T.LongType()) for name in entry["hashes"]]])

    def lookup(self, table: str, **values) -> DataFrame:
        """Rows with these values; NULL stands for NULL.

        Values are those of the stored types. Row groups are passed over by the Bloom filters
        of single columns, and of every composite path whose columns all have a value.
        """
        self._qualified(table)
        entry = self._markers.last()[1].get(table)
        if entry is None:
            raise ValueError(f"No table {table!r} in layer {self.name}")
        schema = T.StructType.fromJson(entry["schema"])
        unknown = sorted(set(values) - set(schema.names))
        if unknown:
            raise ValueError(f"Columns {unknown} are not in table {table!r}")
        given = {name: F.lit(value).cast(schema[name].dataType) for name, value in values.items()}
        rows = self.spark.read.schema(self._stored(entry)).option("recursiveFileLookup", True)
        rows = rows.parquet(self._path(table, entry["version"]))
        for name, value in given.items():
            rows = rows.where(F.col(name).isNull() if values[name] is None else F.col(name) == value)
        for name, path in entry["hashes"].items():
            if all(values.get(column) is not None for column in path):
                rows = rows.where(F.col(name) == key_hash(given[column] for column in path))
        return rows.select(schema.names)

    def profile(self, table: str) -> DataFrame:
        """What was measured while the table was written, if it was written with a profile.

        One row per column: ``column_name, n, nulls, blanks, least, most``; the ends as text.
        Rows appended later do not count.
        """
        self._qualified(table)
        entry = self._markers.last()[1].get(table) or {}
        rows = [tuple(row) for row in entry.get("profile") or []]
        schema = "column_name string, n long, nulls long, blanks long, least string, most string"
        return self.spark.createDataFrame(rows, schema)

    def _functions(self, sql: str) -> None:
        """Functions that return tables, for the tables that a query calls them for."""
        for table, kind in set(re.findall(r"\b(\w+)_(blank_to_null|first_per)`?\s*\(", sql)):
            if not self.exists(table):
                continue
            name, fields = self._qualified(table), self.read(table).schema.fields
            columns = ", ".join(f"`{f.name}`" for f in fields)
            if kind == "blank_to_null":
                values = [
                    f"nullif(`{f.name}`, '') AS `{f.name}`" if f.dataType == T.StringType() else f"`{f.name}`"
                    for f in fields
                ]
                parameter, body = "", f"SELECT {', '.join(values)} FROM {name}"
            else:
                keys = " ".join(f"WHEN '{f.name}' THEN CAST(`{f.name}` AS STRING)" for f in fields)
                unknown = "raise_error(concat('not a column of the table: ', key))"
                order = ", ".join(f"`{f.name}` ASC NULLS LAST" for f in fields)
                parameter = "key STRING"
                body = (
                    f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY CASE key {keys} "
                    f"ELSE {unknown} END ORDER BY {order}) AS _rank FROM {name}) WHERE _rank = 1"
                )
            returned = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(
                f"CREATE OR REPLACE FUNCTION `{self.name}`.`{table}_{kind}`({parameter}) "
                f"RETURNS TABLE({returned}) RETURN {body}"
            )

    def query(self, sql: str) -> DataFrame:
        """A query over the tables of this layer. Only queries parse as a subquery, so
        statements that change data are refused.

        For every table there are two functions that return a table:
        ``<table>_blank_to_null()``, with NULL for empty text, and ``<table>_first_per('column')``,
        one row per value of a column, the smallest by all columns in order, NULLs last.
        """
        self._functions(sql)
        with _database:  # one at a time: the current database belongs to the session
            before = self.spark.catalog.currentDatabase()
            self.spark.catalog.setCurrentDatabase(self.name)
            try:
                return self.spark.sql(f"SELECT * FROM (\n{sql.strip().rstrip(';')}\n)")
            finally:
                self.spark.catalog.setCurrentDatabase(before)

    def row_count(self, table: str) -> DataFrame:
        return row_count(self.read(table))

    def distinct(self, table: str, column: str) -> DataFrame:
        if not (table.isidentifier() and column.isidentifier()):
            raise ValueError(f"Not names of a table and a column: {table}, {column}")
        return distinct_values(self.read(table), column)

    # Writes

    def build(self) -> Build:
        """Several tables that are published together: ``with layer.build() as new``."""
        return Build(self)

    def create(self, table: str, columns: Dataset | T.StructType) -> None:
        """An empty typed table, unless the table is there already."""
        self._qualified(table)
        if not self.exists(table):
            declared = isinstance(columns, Dataset)
            struct = columns.struct if declared else columns
            self.replace(
                table, self.spark.createDataFrame([], struct), columns.lookups if declared else ()
            )

    def replace(
        self,
        table: str,
        df: DataFrame,
        lookups: Iterable[str | list[str]] = (),
        clustering: Iterable[str] = (),
        **options,
    ) -> None:
        """Write the table, replacing what was there once all is written; see ``Build.replace``."""
        with self.build() as new:
            new.replace(table, df, lookups, clustering, **options)

    def append(self, table: str, df: DataFrame, batch: str | None = None) -> bool:
        """Add rows by column name; absent columns are NULL, unknown ones an error.

        The stored types hold: Spark refuses a value that does not fit. A batch that was
        added under the same identity since the table was last replaced is not added again;
        the answer tells. Without one every call is a batch of its own.
        """
        name = self._qualified(table)
        entry = self._markers.last()[1].get(table)
        if entry:
            self._follow(table, entry)
        stored = self.spark.table(name).schema
        unknown = sorted(set(df.columns) - set(stored.names))
        if unknown:
            raise ValueError(f"Columns {unknown} are not in table {table!r}")
        rows = df.select(
            [
                F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                for f in stored.fields
            ]
        )
        identity = uuid.uuid4().hex if batch is None else hashlib.sha256(batch.encode()).hexdigest()
        path, own = self._path(table, entry["version"]), f"{_ASIDE}_{uuid.uuid4().hex}"
        target, aside = f"{path}/batch-{identity}", f"{path}/{own}"
        if self.files.exists(target):
            return False
        # Names that start with an underscore are not read.
        self._create(f"`{self.name}`.`{own}`", aside, self._stored(entry), table, entry)
        try:
            with_hashes(rows, entry["hashes"]).write.insertInto(f"`{self.name}`.`{own}`")
            added = self.files.rename_new(aside, target)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS `{self.name}`.`{own}`")
            self.files.delete(aside)
        now = self._markers.last()[1].get(table) or {}
        if now.get("version") != entry["version"]:
            raise ConcurrentWrite(f"{self.name}: {table!r} was replaced during this append")
        self.spark.catalog.refreshTable(name)
        return added

    def append_records(self, table: str, records: list[dict], batch: str | None = None) -> int:
        """Add a few records given as dictionaries; returns how many were added."""
        name = self._qualified(table)
        if not records:
            return 0
        stored = {f.name: f for f in self.spark.table(name).schema.fields}
        unknown = sorted({key for record in records for key in record} - set(stored))
        if unknown:
            raise ValueError(f"Columns {unknown} are not in table {table!r}")
        struct = T.StructType(list(stored.values()))
        rows = [tuple(record.get(column) for column in stored) for record in records]
        return len(records) * self.append(table, self.spark.createDataFrame(rows, struct), batch)

    def drop(self, table: str) -> None:
        """Remove the table and its files; no error when it is not there."""
        self._qualified(table)
        with self.build() as new:
            new.drop(table)


class Build:
    """New versions of tables of a layer, published in one step when the block ends.

    Until then only ``read`` of the build sees them. If the block fails nothing is published
    and what was written is removed. Tables may be written by several threads.
    """

    def __init__(self, layer: Layer):
        self.layer, self.spark, self.files = layer, layer.spark, layer.files
        self._number, self._seen = layer._markers.last()
        self._changes: dict[str, dict | None] = {}

    def __enter__(self) -> Build:
        return self

    def __exit__(self, kind, error, trace) -> None:
        try:
            if kind is None and self._changes:
                self.layer._commit(self._changes, self._seen)
        except ConcurrentWrite:
            self._remove()
            raise
        if kind is not None:
            self._remove()

    def _remove(self) -> None:
        for table, entry in self._changes.items():
            if entry:
                self.files.delete(self.layer._path(table, entry["version"]))

    def exists(self, table: str) -> bool:
        if table in self._changes:
            return self._changes[table] is not None
        return self.layer.exists(table)

    def origin(self, table: str) -> str | None:
        """What the rows of a table come from, if it was said when they were written."""
        entry = self._changes[table] if table in self._changes else self._seen.get(table)
        return (entry or {}).get("origin")

    def read(self, table: str) -> DataFrame:
        """A table as the build leaves it."""
        entry = self._changes.get(table)
        if entry is None:
            return self.layer.read(table)
        reader = self.spark.read.schema(T.StructType.fromJson(entry["schema"]))
        return reader.parquet(self.layer._path(table, entry["version"]))

    def replace(
        self,
        table: str,
        df: DataFrame,
        lookups: Iterable[str | list[str]] = (),
        clustering: Iterable[str] = (),
        *,
        interleaving: Iterable[str] = (),
        origin: str | None = None,
        profile: bool = False,
    ) -> None:
        """Write a new version of the table.

        With ``clustering`` files are ranges of these columns, in order; with ``interleaving``
        they are ranges of all of them at once. Either way the rows are written aside first, as
        ranges are found by reading them twice. ``origin`` may name what the rows come from, to
        tell later whether they are current. With ``profile`` the columns are measured in the
        pass that writes them.
        """
        self.layer._qualified(table)
        lookups, clustering, interleaving = list(lookups), list(clustering), list(interleaving)
        paths_of(table, lookups)
        hashes = hashed_paths(table, lookups, clustering)
        options = self.layer._writing(table, lookups, hashes)
        fields = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        version = folder_name(self._number, uuid.uuid4().hex)
        path, aside = self.layer._path(table, version), None
        observed = Observation()
        try:
            if clustering or interleaving:
                aside = work_folder(self.spark)
                df = staged(df, aside)
            if profile:
                df = df.observe(observed, *_measures(fields))
            df = with_hashes(df, hashes)
            if clustering:
                # Ranges are cut by a sample, so a frequent value spreads over several files
                # by the columns after it.
                df = df.repartitionByRange(*clustering).sortWithinPartitions(*clustering)
            elif interleaving:
                place = "_place"
                df = df.withColumn(place, interleaved(df, interleaving))
                df = df.repartitionByRange(place, *interleaving).sortWithinPartitions(place, *interleaving)
                df = df.drop(place)
            df.write.options(**options).parquet(path)
        except BaseException:
            self.files.delete(path)
            raise
        finally:
            if aside:
                self.files.delete(aside)
        entry = {"version": version, "schema": fields.jsonValue(), "lookups": lookups}
        entry |= {"hashes": hashes, "origin": origin}
        if profile:
            entry["profile"] = _profiled(fields, observed.get)
        self._changes[table] = entry

    def drop(self, table: str) -> None:
        """Leave the table out of what is published."""
        if self.exists(table):
            self._changes[table] = None


def _measures(fields: T.StructType) -> list[Column]:
    """Measures of all columns; each is named by its column's number."""
    measures = [F.count(F.lit(1)).alias("n")]
    for i, field in enumerate(fields):
        column = F.col(field.name)
        blank = column == "" if isinstance(field.dataType, T.StringType) else F.lit(False)
        measures += [F.count(column).alias(f"filled{i}"), F.count_if(blank).alias(f"blanks{i}")]
        if not isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            measures += [
                end(column).cast("string").alias(f"{name}{i}")
                for name, end in (("least", F.min), ("most", F.max))
            ]
    return measures


def _profiled(fields: T.StructType, measured: dict) -> list[list]:
    """Rows of a profile."""
    n = measured["n"]
    return [
        [field.name, n, n - measured[f"filled{i}"], measured[f"blanks{i}"],
         measured.get(f"least{i}"), measured.get(f"most{i}")]
        for i, field in enumerate(fields)
    ]
