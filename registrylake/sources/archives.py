"""Zip archives of delimited Latin-1 text as logical records.

The directories of the archives are read by tasks into a manifest of their members; the driver
opens no archive. Members are dealt to tasks by their bytes, each is inflated once. A member
can only be read from its start, so one that is larger than a task should be is spooled first:
one task streams it into blocks of whole records on the shared folder, with the ends of the
records, and all tasks turn blocks into rows. A lost task repeats its own members or blocks.

A quote opens a field only at its start. The next single quote ends the quoted part: before a
separator or the end of the record it closes the field, elsewhere the rest of the field is
plain text. So a stray inch mark never joins records.
"""

from __future__ import annotations

import fnmatch
import logging
import re
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from registrylake.sources.files import Files, resolve
from registrylake.tables.work import staged, work_folder

log = logging.getLogger(__name__)

MANIFEST_SCHEMA = (
    "archive string, member string, number int, members int, size bigint, packed bigint, crc bigint"
)
RECORD_SCHEMA = "archive string, member string, record_offset bigint, value string"
_BLOCK_SCHEMA = "archive string, member string, start bigint, ends binary, block binary"
#: Bytes inflated at a time: what a worker holds besides is several arrays of such a size.
_CHUNK = 1 << 20
_MAX_RECORD = 64 << 20
#: Inflated bytes a task should read; larger members are spooled. Blocks in a spool file.
TASK_BYTES = 64 << 20
_BLOCKS = 16
_LF, _CR, _QUOTE = 10, 13, 34


def _inside_quotes(buffer: np.ndarray, breaks: np.ndarray, sep: bytes, at_end: bool) -> np.ndarray:
    """Which of the breaks are inside a quoted field; the buffer starts with a record.

    Each run of quotes either opens a field, closes one, does what the state before it
    says, or nothing. The state at a break follows from the last run that sets it and the
    number of runs since that turn it over.
    """
    quotes = np.flatnonzero(buffer == _QUOTE)
    if not len(quotes):
        return np.zeros(len(breaks), bool)
    new = np.concatenate(([True], np.diff(quotes) > 1))
    first = quotes[new]
    size = np.diff(np.append(np.flatnonzero(new), len(quotes)))
    after = first + size
    known = after < len(buffer)
    if not (known[-1] or at_end):  # what follows the last run is in the next chunk
        first, size, after, known = first[:-1], size[:-1], after[:-1], known[:-1]
    edge = np.zeros(256, bool)
    edge[[_LF, _CR]] = True
    starts = np.where(first > 0, edge[buffer[first - 1]] | (buffer[first - 1] == sep[-1]), True)
    following = buffer[np.minimum(after, len(buffer) - 1)]
    ends = ~known | edge[following] | (following == sep[0])
    odd = size % 2 == 1  # pairs are escaped quotes, or an empty field
    opens, closes, turns = starts & ~ends & odd, ~starts & odd, starts & ends & odd
    turned = np.cumsum(turns)
    number = np.arange(1, len(first) + 1)
    last = np.maximum.accumulate(np.where(opens | closes, number, 0))
    base = np.where(last > 0, opens[last - 1], False)
    since = turned - np.where(last > 0, turned[last - 1], 0)
    state = np.concatenate(([False], base ^ (since % 2 == 1)))
    return state[np.searchsorted(first, breaks)]


def _record_ends(pending: bytes, sep: bytes, at_end: bool, give_up: bool) -> np.ndarray:
    """Ends of the records that ``pending``, which starts with one, holds whole.

    If there is none and the wait is given up, every line ends a record.
    """
    buffer = np.frombuffer(pending, np.uint8)
    breaks = np.flatnonzero(buffer == _LF)
    if b"\r" in pending:
        returns = np.flatnonzero(buffer == _CR)
        if not at_end:
            returns = returns[returns < len(buffer) - 1]  # its LF may be in the next chunk
        followed = buffer[np.minimum(returns + 1, len(buffer) - 1)] == _LF
        breaks = np.union1d(breaks, returns[~followed])
    ends = breaks[~_inside_quotes(buffer, breaks, sep, at_end)] + 1
    rest = int(ends[-1]) if len(ends) else 0
    if at_end or give_up and not len(ends):
        ends = np.union1d(ends, breaks[breaks >= rest] + 1)
    if at_end and len(pending) and (not len(ends) or ends[-1] < len(pending)):
        ends = np.append(ends, len(pending))
    return ends


def record_blocks(
    stream, chunk: int = _CHUNK, max_record: int = _MAX_RECORD, sep: bytes = b";"
) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """A stream as runs of whole records: first byte, the bytes, and where records end in them.

    A line break ends a record unless it is inside a quoted field; CR LF and a lone CR count
    as LF. A field that is still open after ``max_record`` bytes, or at the end, is given up:
    the lines from its record on are records of their own, for the parser to judge.
    """
    base, pending = 0, b""  # pending starts at byte ``base``, with a record
    while True:
        # A long wait reads as much again as it holds, so that it is not scanned over and over.
        data = stream.read(max(chunk, min(len(pending), max_record - len(pending))))
        pending += data
        ends = _record_ends(pending, sep, not data, len(pending) > max_record)
        if len(ends):
            last = int(ends[-1])
            yield base, pending[:last], ends
            base, pending = base + last, pending[last:]
        if not data:
            return


def record_batches(blocks: Iterator[tuple[int, bytes, np.ndarray]]) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Offsets and UTF-8 text of the records of blocks."""
    for base, raw, ends in blocks:
        yield np.append(0, ends[:-1]) + base, _texts(raw, ends)


def _texts(raw: bytes, ends: np.ndarray) -> pa.Array:
    """Latin-1 records laid end to end as an array of UTF-8 strings without line breaks."""
    # Each byte above 127 becomes two bytes in UTF-8.
    wide = np.flatnonzero(np.frombuffer(raw, np.uint8) > 127)
    offsets = np.append(0, ends + np.searchsorted(wide, ends)).astype(np.int32)
    texts = pa.StringArray.from_buffers(
        len(ends), pa.py_buffer(offsets), pa.py_buffer(raw.decode("latin-1").encode())
    )
    if b"\r" in raw:
        texts = pc.replace_substring_regex(texts, "\r\n?", "\n")
    return pc.utf8_rtrim(texts, "\n")


# Manifest


def manifest(spark: SparkSession, directory: str, pattern: str = "*.zip") -> DataFrame:
    """One row per member of the archives that match a glob, folders left out.

    ``number`` counts the members of an archive from 0; ``size`` and ``packed`` are bytes,
    ``crc`` is the checksum of the inflated bytes, all from the directory of the archive.
    """
    files = Files(spark)
    directory = files.qualified(directory)
    archives = [(f"{directory}/{name}",) for name in files.names(directory, pattern)]
    tasks = max(1, min(len(archives), 4 * spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame(archives, "archive string").repartition(tasks)
    return listed.mapInArrow(_list_members, MANIFEST_SCHEMA)


def _list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for archive in batch.column(0).to_pylist():
            system, path = resolve(archive)
            with system.open_input_file(path) as file, zipfile.ZipFile(file) as packed:
                members = [info for info in packed.infolist() if not info.is_dir()]
            for number, info in enumerate(members):
                sizes = info.file_size, info.compress_size
                rows.append((archive, info.filename, number, len(members), *sizes, info.CRC))
        columns = [list(column) for column in zip(*rows)] or [[] for _ in range(7)]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * 3]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
        names = [part.split()[0] for part in MANIFEST_SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays(arrays, names)


def matching(members: DataFrame, pattern: str, which: str = "all") -> DataFrame:
    """The members of a manifest whose archive's name matches a glob; all, or the first of each."""
    name = F.substring_index("archive", "/", -1)
    found = members.where(name.rlike("^" + fnmatch.translate(pattern)))
    return found if which == "all" else found.where("number = 0")


# Records


class _Records:
    """Turns members and blocks into rows of records; for tasks."""

    def __init__(self, header: bool, sep: str, fields: int, numeric: list[int], max_record: int):
        self.header, self.sep, self.fields, self.numeric = header, sep, fields, numeric
        self.max_record = max_record

    @contextmanager
    def _opened(self, archive: str, member: str):
        system, path = resolve(archive)
        with (
            system.open_input_file(path) as file,
            zipfile.ZipFile(file) as packed,
            packed.open(member) as stream,
        ):
            yield record_blocks(stream, _CHUNK, self.max_record, self.sep.encode("latin-1"))

    def of_members(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, member in zip(*(batch.column(c).to_pylist() for c in ("archive", "member"))):
                with self._opened(archive, member) as blocks:
                    yield from self._rows(archive, member, blocks)

    def spool(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, member in zip(*(batch.column(c).to_pylist() for c in ("archive", "member"))):
                with self._opened(archive, member) as blocks:
                    for base, raw, ends in blocks:
                        ends = ends.astype(np.int32).tobytes()
                        columns = [[archive], [member], [base], [ends], [raw]]
                        names = ["archive", "member", "start", "ends", "block"]
                        kinds = [pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
                        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
                        yield pa.RecordBatch.from_arrays(arrays, names)

    def of_blocks(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                archive, member, base, ends, raw = (column[i].as_py() for column in batch.columns)
                block = base, raw, np.frombuffer(ends, np.int32).astype(np.int64)
                yield from self._rows(archive, member, iter([block]))

    def _rows(self, archive: str, member: str, blocks) -> Iterator[pa.RecordBatch]:
        for offsets, texts in record_batches(blocks):
            if self.header and offsets[0] == 0:
                self._check_header(texts[0].as_py(), archive)
                offsets, texts = offsets[1:], texts[1:]
            count = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(archive, count), pa.repeat(member, count), pa.array(offsets, pa.int64()), texts],
                ["archive", "member", "record_offset", "value"],
            )

    def _check_header(self, header: str, archive: str) -> None:
        """A header has the declared number of fields, and no numbers where numbers are due."""
        fields = re.sub('"[^"]*"', lambda q: q[0].replace(self.sep, " "), header).split(self.sep)
        if self.fields and len(fields) != self.fields:
            raise ValueError(f"{archive}: header has {len(fields)} fields, {self.fields} are declared")
        numbers = [fields[i].strip('"') for i in self.numeric if i < len(fields)]
        filled = [text for text in numbers if text]
        if filled and all(re.fullmatch("[+-]?[0-9]+([.,][0-9]+)?", text) for text in filled):
            raise ValueError(f"{archive}: the header looks like a record; header=False?")


def _dealt(members: DataFrame, tasks: int, share: int) -> DataFrame:
    """The members in ``tasks`` partitions of about ``share`` inflated bytes each."""
    # One row per member: the running sum is over the manifest, not over what it lists.
    running = F.sum("size").over(Window.orderBy("archive", "number"))
    task = F.floor((running - F.col("size") / 2) / F.lit(max(1, share)))
    placed = members.withColumn("task", F.least(task, F.lit(tasks - 1)).cast("int"))
    return placed.repartitionById(tasks, "task")


def scan_records(
    spark: SparkSession,
    directory: str,
    pattern: str,
    *,
    listed: DataFrame | None = None,
    header: bool = True,
    members: str = "first",
    sep: str = ";",
    fields: int = 0,
    numeric: list[int] = (),
    task_bytes: int = TASK_BYTES,
    max_record: int = _MAX_RECORD,
    spool: str | None = None,
) -> DataFrame:
    """Logical records of all archives matching a glob; no match is an empty frame.

    ``listed`` is a manifest that covers the directory, if there is one already. Members of
    more than ``task_bytes`` are spooled at once, to a new folder within ``spool``, which the
    caller removes when the records have been used. A field of more than ``max_record`` bytes
    counts as never closed.
    """
    if listed is None:
        listed = staged(manifest(spark, directory, pattern))
    chosen = matching(listed, pattern, members)
    large = F.col("size") > task_bytes
    seen = chosen.agg(
        F.count_if(~large).alias("small"),
        F.coalesce(F.sum(F.when(~large, F.col("size"))), F.lit(0)).alias("bytes"),
        F.count_if(large).alias("large"),
        F.count_if(F.col("members") > 1).alias("several"),
    ).first()
    if seen.several and members != "all":
        log.warning("%s: of %d archives only the first member is read", pattern, seen.several)
    records = spark.createDataFrame([], RECORD_SCHEMA)
    reader = _Records(header, sep, fields, list(numeric), max_record)
    if seen.small:
        wanted = max(2 * spark.sparkContext.defaultParallelism, -(-seen.bytes // task_bytes))
        tasks = min(seen.small, wanted)
        small = _dealt(chosen.where(~large), tasks, -(-seen.bytes // tasks))
        records = small.mapInArrow(reader.of_members, RECORD_SCHEMA)
    if seen.large:
        # A task per member: what takes longest is one member, inflated once.
        place = F.row_number().over(Window.orderBy(F.desc("size"), "archive", "number")) - 1
        each = chosen.where(large).withColumn("task", place).repartitionById(seen.large, "task")
        folder = f"{spool}/{work_folder(spark).rsplit('/', 1)[-1]}" if spool else work_folder(spark)
        blocks = each.mapInArrow(reader.spool, _BLOCK_SCHEMA)
        blocks.write.options(maxRecordsPerFile=_BLOCKS, compression="zstd").parquet(folder)
        blocks = spark.read.schema(_BLOCK_SCHEMA).parquet(folder)
        spooled = blocks.mapInArrow(reader.of_blocks, RECORD_SCHEMA)
        records = records.union(spooled) if seen.small else spooled
    return records
