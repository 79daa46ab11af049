"""Bronze files made from tables, for the registered queries, the tests and the benchmark."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from registrylake.sources.files import resolve


def _field(column: T.StructField, quoted: bool) -> Column:
    value = F.col(column.name)
    if isinstance(column.dataType, T.StringType) and not quoted:
        text = value
    elif isinstance(column.dataType, T.StringType):
        text = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    elif isinstance(column.dataType, T.DoubleType):
        text = F.replace(value.cast("string"), F.lit("."), F.lit(","))
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit(""))


def record_text(df: DataFrame, sep: str = ";", quoted: bool = True) -> DataFrame:
    """One column ``value``: quoted text, decimal commas, nothing for NULL."""
    fields = [_field(f, quoted) for f in df.schema.fields]
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def write_archives(
    df: DataFrame, directory: str, stem: str, sep: str = ";", quoted: bool = True
) -> None:
    """Zip archives ``<stem><n>.zip`` of Latin-1 text with a header, one per task.

    Every task streams its rows into its own archive under a temporary name and renames
    it at the end, so a repeated task leaves one complete archive.
    """
    header = sep.join(df.columns) + "\n"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{stem}{task.partitionId()}"
        system, folder = resolve(directory)
        system.create_dir(folder, recursive=True)
        partial = f"{folder}/.{name}.{task.taskAttemptId()}"
        rows = 0
        with system.open_output_stream(partial) as file:
            with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as packed:
                with packed.open(f"{name}.csv", "w", force_zip64=True) as member:
                    member.write(header.encode("latin-1"))
                    for batch in batches:
                        lines = batch.column(0).to_pylist()
                        rows += len(lines)
                        member.write(("\n".join(lines) + "\n").encode("latin-1") if lines else b"")
        system.move(partial, f"{folder}/{name}.zip")
        yield pa.RecordBatch.from_pydict({"archive": [name], "rows": [rows]})

    written = record_text(df, sep, quoted).mapInArrow(pack, "archive string, rows long")
    written.write.format("noop").mode("overwrite").save()


def write_text(df: DataFrame, path: str, sep: str = ";") -> None:
    """A folder of delimited Latin-1 text files with headers."""
    text = record_text(df, sep).withColumnRenamed("value", sep.join(df.columns))
    # Records are formatted already: the writer must add no quotes of its own.
    text.write.options(
        header=True, encoding="ISO-8859-1", quote="", sep="\x01", escapeQuotes=False
    ).csv(path)


def conform(df: DataFrame, struct: T.StructType) -> DataFrame:
    """All columns of ``struct``: those of ``df`` cast, the others NULL."""
    return df.select(
        [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in struct.fields
        ]
    )
