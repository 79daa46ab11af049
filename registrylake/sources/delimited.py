"""Delimited text to typed columns, with malformed records kept apart.

Every scan returns the declared columns plus ``_record`` and ``_reason``: the raw text and
the complaint for a malformed record, NULL for a good one. ``strict`` fails on the first
malformed record inside the same pass; ``accepted`` and ``rejected`` split the rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from registrylake.functions.text import parse_text
from registrylake.schemas import Dataset
from registrylake.sources.archives import scan_records

RECORD, REASON, SOURCE = "_record", "_reason", "_source"

# A quoted blank stays '' and a bare one becomes NULL: the reader puts ``nullValue`` in
# place of a bare blank, so it must be text that no Latin-1 file can hold.
_ABSENT = "\ue000"


def _options(sep: str) -> dict[str, str]:
    return {
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "nullValue": _ABSENT,
        "emptyValue": "",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RECORD,
    }


def _text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in [*names, RECORD]])


def _is_broken(record: Column, fields: int, sep: str) -> Column:
    """Judge a record whose field count is off: a short one is fine, its tail is NULL."""
    unquoted = F.regexp_replace(record, r'"[^"]*"', "")
    found = F.size(F.split(unquoted, rf"\Q{sep}\E"))
    # WHEN rather than AND: the repeated part of an AND would be computed for every row.
    is_off = F.col(RECORD).isNotNull()
    return F.when(is_off, (found > fields) | unquoted.contains('"')).otherwise(False)


def _has_loose_break(record: Column, sep: str) -> Column:
    """True when a line break is not inside a properly quoted field.

    Quotes in the middle of unquoted fields can pair up across lines; the parser would
    read the first line and lose the rest.
    """
    one_field = rf'(?:"(?:[^"]++|"")*+"|[^"\n\Q{sep}\E]*+)'
    proper = rf"^{one_field}(?:\Q{sep}\E{one_field})*+$"
    return record.contains("\n") & ~record.rlike(proper)


def _typed(text: DataFrame, dataset: Dataset, broken: Column, carried: tuple = ()) -> DataFrame:
    """Parse the text columns; ``record`` holds the raw text of each row.

    Columns named in ``carried`` pass through.

    The number of malformed records is an observed metric of the scan. Filters are not
    moved below an observation, which also keeps a filter on a parsed column from
    repeating the whole parse inside its condition.
    """
    numbers = {name: kind for name, kind in dataset.columns.items() if kind != "text"}
    parsed = text.withColumns(
        {f"__{name}": parse_text(F.col(name), kind) for name, kind in numbers.items()}
    )
    complaints = [F.when(broken, F.lit("malformed record"))]
    for name in numbers:
        unread = F.col(f"__{name}").isNull() & (F.col(name) != "")
        complaints.append(F.when(unread, F.lit(f"bad value: {name}")))
    reason = F.coalesce(*complaints)
    values = [F.col(f"__{name}" if name in numbers else name).alias(name) for name in dataset.names]
    judged = parsed.select(*values, "record", reason.alias(REASON), *carried)
    return judged.select(
        *dataset.names,
        F.when(F.col(REASON).isNotNull(), F.col("record")).alias(RECORD),
        REASON,
        *carried,
    ).observe(f"{dataset.name} {uuid.uuid4().hex}", F.count(REASON).alias("malformed"))


def scan_archives(
    spark: SparkSession,
    directory: str,
    pattern: str,
    dataset: Dataset,
    *,
    header: bool = True,
    members: str = "first",
    sep: str = ";",
    source: Column | None = None,
    **options,
) -> DataFrame:
    """All archives matching a glob as one typed table, columns matched by position.

    ``source``, of the columns ``archive`` and ``member``, tells where rows are from.

    An archive that does not exist contributes nothing: no match at all gives an empty
    frame of the declared columns. Blank lines are skipped, as in plain files.
    """
    numeric = [i for i, kind in enumerate(dataset.columns.values()) if kind != "text"]
    records = scan_records(
        spark, directory, pattern, header=header, members=members, sep=sep,
        fields=len(dataset.names), numeric=numeric, **options,
    ).where("value <> ''")
    schema = ", ".join(f"{name} string" for name in [*dataset.names, RECORD])
    parsed = F.from_csv("value", schema, _options(sep))
    carried = () if source is None else (source.alias(SOURCE),)
    text = records.select(F.col("value").alias("record"), parsed.alias("parsed"), *carried).select(
        "record", "parsed.*", *[SOURCE for _ in carried]
    )
    broken = _is_broken(F.col("record"), len(dataset.names), sep) | _has_loose_break(
        F.col("record"), sep
    )
    return _typed(text, dataset, broken, tuple(SOURCE for _ in carried))


def scan_delimited(
    spark: SparkSession,
    path: str,
    dataset: Dataset,
    *,
    header: bool = True,
    by_name: bool = False,
    multiline: bool = False,
    encoding: str = "UTF-8",
    sep: str = ";",
) -> DataFrame:
    """Plain delimited files as a typed table.

    Columns are matched by position, or with ``by_name`` by the header: a declared column
    the file lacks is NULL, an undeclared one is an error. ``multiline`` accepts line breaks
    inside quotes, at the price of one task per file.
    """
    options = _options(sep) | {"header": header, "encoding": encoding, "multiLine": multiline}
    names = dataset.names
    if by_name:
        names = spark.read.options(sep=sep, header=True, encoding=encoding).csv(path).columns
        unknown = sorted(set(names) - set(dataset.names))
        if unknown:
            raise ValueError(f"{path}: columns {unknown} are not declared for {dataset.name}")
    text = spark.read.schema(_text_schema(names)).options(**options).csv(path)
    for name in dataset.names:
        if name not in names:
            text = text.withColumn(name, F.lit(None).cast("string"))
    broken = _is_broken(F.col(RECORD), len(names), sep)
    whole = F.concat_ws(sep, *[F.coalesce(F.col(name), F.lit("")) for name in names])
    text = text.withColumn("record", F.coalesce(F.col(RECORD), whole))
    return _typed(text, dataset, broken)


def scan_schema(dataset: Dataset) -> T.StructType:
    """Columns of a scan: the declared ones, the record and the reason."""
    extra = [T.StructField(RECORD, T.StringType()), T.StructField(REASON, T.StringType())]
    return T.StructType([*dataset.struct.fields, *extra])


def empty_scan(spark: SparkSession, dataset: Dataset) -> DataFrame:
    """What a scan of no files gives."""
    return spark.createDataFrame([], scan_schema(dataset))


def scan_inferred(
    spark: SparkSession, path: str, *, sep: str = ";", encoding: str = "UTF-8"
) -> DataFrame:
    """A delimited file with a header and no declared types.

    Whole numbers are 64-bit, and dates stay text: only numbers and booleans are inferred.
    """
    reader = spark.read.options(sep=sep, header=True, encoding=encoding, escape='"')
    inferred = reader.option("inferSchema", True).csv(path).schema
    narrowed = {
        T.IntegerType: T.LongType(),
        T.DateType: T.StringType(),
        T.TimestampType: T.StringType(),
        T.TimestampNTZType: T.StringType(),
    }
    fields = [
        T.StructField(f.name, narrowed.get(type(f.dataType), f.dataType)) for f in inferred.fields
    ]
    return reader.schema(T.StructType(fields)).csv(path)


def strict(scanned: DataFrame) -> DataFrame:
    """Good rows; the job fails with the text of the first malformed record it meets."""
    complaint = F.concat(F.col(REASON), F.lit(": "), F.col(RECORD))
    good = F.when(F.col(REASON).isNull(), F.lit(True)).otherwise(
        F.raise_error(complaint).cast("boolean")
    )
    return scanned.where(good).drop(RECORD, REASON)


def accepted(scanned: DataFrame) -> DataFrame:
    """Good rows only."""
    return scanned.where(F.col(REASON).isNull()).drop(RECORD, REASON)


def rejected(scanned: DataFrame) -> DataFrame:
    """Malformed records with the reason, and whatever columns could be parsed."""
    return scanned.where(F.col(REASON).isNotNull())
