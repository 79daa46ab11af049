"""How filters act on each other, for every order in which they may be applied.

Each document becomes a mask: one bit per filter that it fails. All that the audit needs is
how many documents, good and toxic ones among them, a part has of each mask: at most 32 cells
a part, whatever the number of documents. A recursive CTE extends prefixes of filters by the
letters they do not hold yet; it joins the masks and carries the bits applied so far, so each
level of the recursion gives the fate of every mask at that step. The recursion sees masks
only, 10,400 rows at most; counts per part are joined to it afterwards, so neither documents
nor parts enter it. Prefixes are shared by the orders that start with them.

Filters (what makes a document fail): A under 100 words, B fewer than 80 distinct words in
100, C more than 10 capitals A-Z in 100 code points, D any of ``#$%&*|``, E a text that a
smaller doc_id has too, in any part. Words are what spaces and ASCII control breaks separate.

A document fails E unless its id is the smallest of its text. The smallest id per text is
found by a digest of the text, with partial minima before the shuffle; documents are then
joined to it by digest and id, which no frequent text makes skewed.

Defined results
- A NULL text counts as empty, and equals other empty ones. NULL lang is the part ''.
- Repeated rows count each; rows with equal ids do not make each other fail E. A row without
  doc_id never fails E, is nobody's original, and has no labels.
- A document is good or toxic if any label row of its id says 1.
- An empty table has no parts and gives an empty result. Other columns play no part.
- Very long texts are split a piece at a time; only their distinct words are held at once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from registrylake.llm.shingles import byte_texts, small_batches
from registrylake.operators.joins import join_on_key
from registrylake.tables.work import staged

LETTERS = "ABCDE"
LEAST_WORDS = 100
#: Percent: distinct words at least, capitals at most.
LEAST_DISTINCT, MOST_CAPITALS = 80, 10

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_MARKS = b"#$%&*|"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Texts of more bytes are not split into one list.
_LONG = 1 << 22


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that a text of UTF-8 bytes fails."""
    if len(text) > _LONG:
        n, seen = 0, set()
        for match in _WORD.finditer(text):
            n += 1
            seen.add(match[0])
        distinct = len(seen)
    else:
        words = text.split()  # of bytes: at space, tab, line feed, VT, FF and CR
        n, distinct = len(words), len(set(words))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    points = len(text) if text.isascii() else len(text.decode())
    return (
        (n < LEAST_WORDS)
        + 2 * (100 * distinct < LEAST_DISTINCT * n)
        + 4 * (100 * capitals > MOST_CAPITALS * points)
        + 8 * (len(text.translate(None, _MARKS)) < len(text))
    )


def described(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest, mask`` of every document, the mask without E."""
    slim = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            texts = byte_texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    pa.array([hashlib.sha256(text).digest() for text in texts], pa.binary()),
                    pa.array([text_mask(text) for text in texts], pa.int32()),
                ],
                ["doc_id", "part", "digest", "mask"],
            )

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(describe, f"doc_id {kind}, part string, digest binary, mask int")


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of each part by the filters they fail."""
    rows = staged(described(docs))
    identified = rows.where("doc_id IS NOT NULL")
    firsts = identified.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    # By digest and id: the partition of a frequent text holds one row per id.
    firsts = firsts.select("digest", "doc_id", F.lit(True).alias("first"))
    marked = identified.join(firsts, ["digest", "doc_id"], "left").select(
        "doc_id", "part", (F.col("mask") + F.when(F.col("first"), 0).otherwise(16)).alias("mask")
    )
    flag = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)).cast("int")).alias(name)
    known = (
        labels.select("doc_id", "quality", "toxic")
        .where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
        .groupBy("doc_id")
        .agg(flag("quality"), flag("toxic"))
    )
    judged = join_on_key(marked, known, "doc_id", "left")
    unnamed = rows.where("doc_id IS NULL").select(
        "doc_id", "part", "mask", F.lit(0).alias("quality"), F.lit(0).alias("toxic")
    )
    total = lambda name: F.sum(F.coalesce(F.col(name), F.lit(0)).cast("long"))
    return (
        judged.unionByName(unnamed)
        .groupBy("part", "mask")
        .agg(F.count(F.lit(1)).alias("n"), total("quality").alias("good"), total("toxic").alias("toxic"))
    )


#: One row per prefix of filters and mask: the letter of the step, its bit, the bits before it.
#: The recursion starts with the empty prefix.
PREFIXES = """
    WITH RECURSIVE steps (prefix, step, letter, bit, applied, mask) AS (
      SELECT '', 0, '', 0, 0, mask FROM {masks}
      UNION ALL
      SELECT concat(s.prefix, u.letter), s.step + 1, u.letter, u.bit, u.applied, s.mask
      FROM steps s JOIN {unused} u ON u.applied = s.applied | s.bit)
    SELECT * FROM steps WHERE step > 0"""


def prefixes(masks: DataFrame) -> DataFrame:
    """Every prefix of an order with every mask of ``masks``, by recursion over the letters."""
    spark = masks.sparkSession
    unused = [
        (applied, letter, 1 << i)
        for applied in range(1 << len(LETTERS))
        for i, letter in enumerate(LETTERS)
        if not applied >> i & 1
    ]
    unused = spark.createDataFrame(unused, "applied int, letter string, bit int")
    return spark.sql(PREFIXES, unused=unused, masks=masks)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of all filters and step, with what the step does.

    ``docs`` has ``doc_id``, ``text`` and ``lang``; ``labels`` has ``doc_id``, ``quality`` and
    ``toxic``. Columns: ``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``.
    """
    cells = staged(mask_cells(docs, labels))
    spark = docs.sparkSession
    masks = spark.range(1 << len(LETTERS)).select(F.col("id").cast("int").alias("mask"))
    steps = staged(prefixes(masks))
    fails, before = F.expr("mask & bit != 0"), F.expr("mask & applied != 0")
    counted = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0))
    by_prefix = (
        steps.join(cells, "mask")
        .groupBy("part", "prefix", "step", "letter")
        .agg(
            counted(~before & ~fails).alias("kept"),
            counted(~before & fails).alias("removed"),
            counted(before & fails).alias("redundant"),
            counted(F.expr("mask = bit")).alias("unique_fails"),
            counted(~before & fails, "good").alias("good_lost"),
            counted(~before & fails, "toxic").alias("toxic_lost"),
        )
    )
    # A prefix stands for all orders that start with it: 24, 6, 2, 1 and 1 of them.
    orders = F.element_at(F.array(*[F.lit(n) for n in (24, 6, 2, 1, 1)]), F.col("step"))
    by_prefix = staged(by_prefix)
    shapley = by_prefix.groupBy("part", "letter").agg(
        F.sum(F.col("removed") * orders).alias("shapley")
    )
    whole = steps.where(f"step = {len(LETTERS)}").select(F.col("prefix").alias("filter_order")).distinct()
    stepped = whole.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS))))).select(
        "filter_order", "step", F.expr("substr(filter_order, 1, step)").alias("prefix")
    )
    return (
        by_prefix.join(stepped, ["prefix", "step"])
        .join(shapley, ["part", "letter"])
        .select(
            "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
            "good_lost", "toxic_lost", "shapley",
        )
    )
