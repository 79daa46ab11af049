"""Merkle fixity audit of web archives.

A page becomes a WARC record, a record has a place in an archive file: a file number and an
offset. Records are hashed where they are read; from there on only digests move. The digests
of the records that start in a range of offsets, in order, make the hash of the range; 16
neighbouring ranges make one on the next level, up to a file, and 16 files up to the root.
Ranges are of fixed width, so a lost record changes its own branch and no other.

An audit compares the roots of two replicas and descends only where hashes differ, down to
the records that are damaged, lost or not in the first replica. Each level is a join of the
children of differing nodes, written to the shared folder before the next.

Defined results
- NULL pages: a NULL url or html is empty; a NULL page_id is named ``-``. Repeated rows are
  records of their own, each with its own offset. Very long pages are hashed whole.
- Two empty replicas agree; against an empty one every record is lost.
- Other columns play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from registrylake.operators.joins import join_on_key
from registrylake.tables.work import staged

FANOUT = 16
RANGE_BYTES = 1 << 16
FILE_RECORDS = 2048

DAMAGED, LOST, EXTRA = "damaged", "lost", "extra"


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC resource record as text: header lines, an empty line, the page, two line ends."""
    page_id, url, html = F.coalesce(page_id.cast("string"), F.lit("-")), *(
        F.coalesce(c, F.lit("")) for c in (url, html)
    )
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        page_id,
        F.lit(">\r\nWARC-Target-URI: "),
        url,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(html).cast("string"),
        F.lit("\r\n\r\n"),
        html,
        F.lit("\r\n\r\n"),
    )


def hashed(pages: DataFrame, *carried: str) -> DataFrame:
    """``page_id, url, length, digest`` of the record of each page, and the columns ``carried``."""
    record = warc_record(F.col("page_id"), F.col("url"), F.col("html"))
    return pages.select("page_id", "url", *carried, record.alias("record")).select(
        "page_id",
        "url",
        F.octet_length("record").cast("long").alias("length"),
        F.sha2("record", 256).alias("digest"),
        *carried,
    )


def hex_digits(records: int) -> int:
    """Hexadecimal digits that number the files: 16 times as many files per digit."""
    digits = 1
    while 16**digits * FILE_RECORDS < records:
        digits += 1
    return digits


def laid_out(records: DataFrame) -> DataFrame:
    """Adds ``file`` and ``offset``: records are dealt to files by a hash of id, url and digest
    and lie there in that order.

    More than ``FILE_RECORDS`` equal records are dealt on to further files, each by itself; as
    they are equal it does not matter which goes where.
    """
    name = F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("-")), "url", "digest")
    named = records.withColumn("_name", F.md5(name))
    counts = named.groupBy("_name").agg(F.count(F.lit(1)).alias("n"))
    spread = counts.where(F.col("n") > FILE_RECORDS).select(
        "_name", F.ceil(F.col("n") / FILE_RECORDS).alias("_spread")
    )
    digits = hex_digits(records.count())
    file = F.conv(F.substring("_name", 1, digits), 16, 10).cast("long")
    dealt = (
        join_on_key(named.withColumn("_row", F.monotonically_increasing_id()), spread, "_name", "left")
        .withColumn("file", (file + F.coalesce(F.pmod("_row", "_spread"), F.lit(0))) % 16**digits)
        .drop("_name", "_row", "_spread")
    )
    order = Window.partitionBy("file").orderBy("page_id", "url", "digest")
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return dealt.withColumn("offset", F.coalesce(before, F.lit(0).cast("long")))


def _folded(children: DataFrame, *parent: Column) -> DataFrame:
    """Parents of ``file, node, hash``: the hash of the ordered children."""
    ordered = F.sort_array(F.collect_list(F.struct("order", "hash")))
    lines = F.transform(ordered, lambda c: F.concat_ws(" ", c["order"].cast("string"), c["hash"]))
    return children.groupBy(*parent).agg(F.sha2(F.array_join(lines, "\n"), 256).alias("hash"))


@dataclass(frozen=True)
class Shape:
    """Levels of ranges within a file, and of files."""

    ranges: int
    files: int


def shape_of(*replicas: DataFrame) -> Shape:
    """The shape that holds all replicas."""
    offset, file = 0, 0
    for records in replicas:
        row = records.agg(F.max("offset").alias("offset"), F.max("file").alias("file")).first()
        offset, file = max(offset, row["offset"] or 0), max(file, row["file"] or 0)
    ranges, files = 0, 0
    while offset // (RANGE_BYTES * FANOUT**ranges) > 0:
        ranges += 1
    while file // FANOUT**files > 0:
        files += 1
    return Shape(ranges, files)


def merkle_levels(records: DataFrame, shape: Shape) -> list[DataFrame]:
    """``file, node, hash`` of every level, the ranges of records first, the root last.

    A range holds at most ``RANGE_BYTES`` over the size of the smallest record, an inner
    node 16 children, so no group grows with the archive.
    """
    start = F.floor(F.col("offset") / RANGE_BYTES)
    leaf = records.select(
        "file",
        start.alias("node"),
        F.col("offset").alias("order"),
        F.concat_ws(" ", F.col("length").cast("string"), "digest").alias("hash"),
    )
    levels = [staged(_folded(leaf, F.col("file"), F.col("node")))]
    for _ in range(shape.ranges):
        below = levels[-1].withColumn("order", F.col("node"))
        up = F.floor(F.col("node") / FANOUT).alias("node")
        levels.append(staged(_folded(below, F.col("file"), up)))
    for _ in range(shape.files):
        below = levels[-1].withColumn("order", F.col("file"))
        up = F.floor(F.col("file") / FANOUT).alias("file")
        levels.append(staged(_folded(below, up, F.col("node"))))
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes of a level whose hashes differ, or that one side lacks."""
    other = b.withColumnRenamed("hash", "other")
    return (
        a.join(other, ["file", "node"], "full")
        .where(~F.col("hash").eqNullSafe(F.col("other")))
        .select("file", "node")
    )


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """``file, offset, status`` of the records that differ between two laid-out replicas."""
    shape = shape_of(a, b)
    trees = [merkle_levels(records, shape) for records in (a, b)]
    wrong = staged(_differing(trees[0][-1], trees[1][-1]))
    depth = shape.ranges + shape.files
    for level in range(depth - 1, -1, -1):
        over_files = level >= shape.ranges
        parent = [
            (F.floor(F.col("file") / FANOUT) if over_files else F.col("file")).alias("p_file"),
            (F.col("node") if over_files else F.floor(F.col("node") / FANOUT)).alias("p_node"),
        ]
        suspects = wrong.select(F.col("file").alias("p_file"), F.col("node").alias("p_node"))
        sides = [
            tree[level].select("*", *parent).join(suspects, ["p_file", "p_node"], "left_semi")
            for tree in trees
        ]
        wrong = staged(_differing(*(side.select("file", "node", "hash") for side in sides)))
    node = F.floor(F.col("offset") / RANGE_BYTES).alias("node")
    suspect = [
        records.select("file", "offset", "length", "digest", node)
        .join(wrong, ["file", "node"], "left_semi")
        .select("file", "offset", F.struct("length", "digest").alias(name))
        for records, name in ((a, "left"), (b, "right"))
    ]
    both = suspect[0].join(suspect[1], ["file", "offset"], "full")
    status = (
        F.when(F.col("right").isNull(), LOST)
        .when(F.col("left").isNull(), EXTRA)
        .when(F.col("left") != F.col("right"), DAMAGED)
    )
    return both.withColumn("status", status).where("status IS NOT NULL").select(
        "file", "offset", "status"
    )
