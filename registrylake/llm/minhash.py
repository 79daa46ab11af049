"""Near-duplicate documents by b-bit MinHash.

1. One pass over the texts keeps, per document, the size and a 128-bit hash of its set of
   5-word shingles, 36 band keys of 7 minima each (5 for a threshold of 80 percent), and the
   low 2 bits of 256 minima packed into 8 longs. Texts are not shuffled for it.
2. Documents with equal sets are one class, which has a number; the text of its smallest id
   stands for it.
3. Classes that share a band key are candidates. Every bucket has a hub, the member with
   most company over all its buckets. Signatures tell how similar members are to the hub, by
   the number of equal bits corrected for chance. Only members that are not close to their
   hub are compared with the rest of the bucket, in blocks of bounded size.
4. Close candidates make clusters. The full sets of a cluster meet in one task, or for a
   large one in blocks that each get the hub: first all are compared with the hub, then what
   is not linked with it with all that is close. Of large clusters the members outside the
   largest component then meet all blocks.

So a group of near copies costs its size, plus its odd members against the rest. Every step
passes on a spanning star of what it finds, at most a row per member; no stage makes all
pairs of a group, and no candidate is dropped by a cap. The chance to miss a link is that of
no equal band, ``(1 - 0.85**7)**36`` or ``(1 - 0.8**5)**36``, under one in a million at the
threshold, and that of a signature 4.5 deviations off.

Defined results
- No words (NULL, empty or blank text): no shingles, linked with nothing, kept.
- Fewer than five words: one shingle, the whole sequence.
- Rows that share a doc_id are one document: each of its texts links it, and all stay or go
  together. A row without doc_id is linked with nothing and kept. Other columns, whatever
  their names, play no part.
- An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from registrylake.llm.components import components
from registrylake.llm.shingles import (
    WordHashes,
    byte_texts,
    mixed,
    shingle_set,
    small_batches,
)
from registrylake.operators.joins import join_on_key
from registrylake.tables.work import staged

MIN_PERCENT = 85
#: Bands, the most minima in one, and the chance to miss a pair right at the threshold that
#: sets how many minima a band has.
BANDS, ROWS = 36, 7
MISSED = 1e-6
MINIMA, BITS = 256, 2
_LANES = 64 // BITS
_LONGS = MINIMA // _LANES
_CHANCE = 1 / (1 << BITS)
#: Members of a bucket or cluster that one task compares with each other at a time, and bytes
#: of their full sets.
BLOCK = 2048
BLOCK_BYTES = 32 << 20

_random = np.random.default_rng(20240607)
_FACTORS = (_random.integers(0, 1 << 32, (MINIMA, 1), np.uint32) | np.uint32(1)).astype(np.uint32)
_OFFSETS = _random.integers(0, 1 << 32, (MINIMA, 1), np.uint32)
_BAND_SEEDS = _random.integers(0, 1 << 63, BANDS, np.uint64)
_SHIFTS = (np.arange(_LANES, dtype=np.uint64) * np.uint64(BITS)).reshape(1, _LANES)

_FEATURES = (
    "doc_id long, n_shingles long, set_high long, set_low long, bands array<long>, sig array<long>, "
    "mark long"
)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of the hash functions over a set of 64-bit hashes."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full((MINIMA, 1), np.uint32(0xFFFFFFFF))
    for start in range(0, len(values), 1024):
        block = values[None, start : start + 1024] * _FACTORS
        block += _OFFSETS
        np.minimum(least, block.min(axis=1, keepdims=True), out=least)
    return mixed(least[:, 0].astype(np.uint64) * _FACTORS[:, 0] + np.uint64(1))


def band_rows(percent: int) -> int:
    """The most minima a band may have for the links of ``percent`` to be found."""
    found = (r for r in range(ROWS, 1, -1) if (1 - (percent / 100) ** r) ** BANDS < MISSED)
    return next(found, 1)


def band_keys(smallest: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, different bands never meant to meet."""
    keys = _BAND_SEEDS.copy()
    for row in smallest[: BANDS * rows].reshape(BANDS, rows).T:
        keys = mixed(keys + row)
    return keys.view(np.int64)


def packed_bits(smallest: np.ndarray) -> np.ndarray:
    """The low bits of the minima, in longs."""
    low = (smallest & np.uint64((1 << BITS) - 1)).reshape(_LONGS, _LANES)
    return np.bitwise_or.reduce(low << _SHIFTS, axis=1).view(np.int64)


def most_unequal(percent: int) -> int:
    """Unequal lanes up to which two signatures may belong to a link of ``percent``."""
    similarity = percent / 100
    equal = similarity + (1 - similarity) * _CHANCE
    deviation = (equal * (1 - equal) / MINIMA) ** 0.5
    return int(MINIMA * (1 - equal + 4.5 * deviation))


def estimate(unequal: float) -> float:
    """Similarity that so many unequal lanes speak for, corrected for chance."""
    return (1 - unequal / MINIMA - _CHANCE) / (1 - _CHANCE)


def _features(band: int):
    """Sizes, hashes, band keys of ``band`` minima and signatures of the sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in small_batches(batches, "text"):
            rows = []
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), strict=True
            ):
                shingles = shingle_set(text, hashes)
                if not len(shingles):
                    rows.append((doc_id, 0, None, None, None, None))
                    continue
                whole = xxhash.xxh3_128_intdigest(shingles.tobytes())
                high, low = np.array([whole >> 64, whole & (1 << 64) - 1], np.uint64).view(np.int64)
                smallest = minima(shingles)
                rows.append(
                    (
                        doc_id, len(shingles), high, low,
                        band_keys(smallest, band), packed_bits(smallest),
                    )
                )
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2
            names = ["doc_id", "n_shingles", "set_high", "set_low", "bands", "sig"]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("mark")], [*names, "mark"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in small_batches(batches, "text"):
        packed = [shingle_set(text, hashes).tobytes() for text in byte_texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(packed, pa.binary())], ["doc_id", "shingles"]
        )


def _unequal(x, y):
    """Unequal lanes of two signature columns."""
    odd = F.lit(0)
    ones = F.lit(sum(1 << BITS * lane for lane in range(_LANES)))
    for k in range(_LONGS):
        differ = F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))
        odd = odd + F.bit_count(differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(ones))
    return odd


_LANE_ONES = np.uint64(sum(1 << BITS * lane for lane in range(_LANES)))


def _close_pairs(minor: np.ndarray, sigs: np.ndarray, most: int) -> Iterator[tuple]:
    """Index pairs (minor, any) whose signatures have at most ``most`` unequal lanes."""
    for start in range(0, len(minor), 64):
        some = minor[start : start + 64]
        differ = sigs[some][:, None, :] ^ sigs[None, :, :]
        differ = (differ | (differ >> np.uint64(1))) & _LANE_ONES
        row, column = np.nonzero(np.bitwise_count(differ).sum(axis=2, dtype=np.int32) <= most)
        yield some[row], column


def _stars(doc: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Links from the smallest document of each component of the index pairs to the others."""
    n = len(doc)
    if not pairs:
        return np.empty((0, 2), np.int64)
    i = np.concatenate([a for a, _ in pairs])
    j = np.concatenate([b for _, b in pairs])
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, label, doc)
    head = least[label]
    return np.stack((head, doc), axis=1)[head != doc]


def _links_batch(links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])


def _cells(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The rows of each cell, from rows sorted by the columns that name it."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        new = np.zeros(max(0, table.num_rows - 1), bool)
        for name in names:
            mark = table.column(name).to_numpy()
            new |= mark[1:] != mark[:-1]
        start = 0
        for end in (np.flatnonzero(new) + 1).tolist():
            yield table.slice(start, end - start)
            start = end
        rest = table.slice(start)
    if rest is not None and rest.num_rows:
        yield rest


def _signatures(cell: pa.Table) -> np.ndarray:
    packed = cell.column("sig").combine_chunks().flatten().to_numpy()
    return packed.view(np.uint64).reshape(-1, _LONGS)


def _close(most: int):
    """Stars of the close members of each cell that has members far from its hub."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches, ["key", "block", "part"]):
            doc = cell.column("doc").to_numpy()
            minor = np.flatnonzero(cell.column("minor").to_numpy())
            pairs = list(_close_pairs(minor, _signatures(cell), most))
            yield _links_batch(_stars(doc, pairs))

    return run


class _Sets:
    """The sets of a cell, one after another."""

    def __init__(self, cell: pa.Table):
        column = cell.column("shingles").to_pylist()
        self.size = np.array([len(x) // 8 for x in column], np.int64)
        self.end = np.cumsum(self.size)
        self.all = np.frombuffer(b"".join(column), np.uint64)

    def of(self, i: int) -> np.ndarray:
        return self.all[self.end[i] - self.size[i] : self.end[i]]

    def linked(self, i: int, others: np.ndarray, percent: int) -> np.ndarray:
        """Those of the others that are similar enough to the set i."""
        x, n = self.of(i), self.size[others]
        fit = 100 * np.minimum(n, len(x)) >= percent * np.maximum(n, len(x))
        others, n = others[fit], n[fit]
        if not len(others):
            return others
        them = np.concatenate([self.of(j) for j in others.tolist()])
        at = np.minimum(np.searchsorted(x, them), len(x) - 1)
        shared = np.add.reduceat((x[at] == them).astype(np.int64), np.cumsum(n) - n)
        return others[100 * shared >= percent * (len(x) + n - shared)]


def _verified(most: int, percent: int):
    """Stars of the links of each cell, by the full sets.

    Rows with ``part`` -1 are a cluster or a block of one, its hub marked as minor: all is
    compared with the hub, and what is not linked with it with all that is close. In other
    cells the minor rows are compared with what is close and in another component.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches, ["key", "block", "part"]):
            doc, sets, sigs = cell.column("doc").to_numpy(), _Sets(cell), _signatures(cell)
            component = cell.column("component").to_numpy()
            minor = np.flatnonzero(cell.column("minor").to_numpy())
            pairs, every = [], np.arange(len(doc))
            if cell.column("part")[0].as_py() < 0:
                hub = int(minor[0])
                found = sets.linked(hub, every, percent)
                pairs.append((np.full(len(found), hub), found))
                minor = np.setdiff1d(every, found)
            for i, j in _close_pairs(minor, sigs, most):
                other = doc[i] != doc[j]
                other &= (component[i] != component[j]) | (component[i] < 0)
                i, j = i[other], j[other]
                for k in np.unique(i).tolist():
                    found = sets.linked(k, j[i == k], percent)
                    pairs.append((np.full(len(found), k), found))
            yield _links_batch(_stars(doc, pairs))

    return run


def _in_cells(rows: DataFrame) -> DataFrame:
    cell = ["key", "block", "part"]
    return rows.repartition(*cell).sortWithinPartitions(*cell)


def _blocks(n: Column) -> Column:
    return F.ceil(n / BLOCK).cast("long")


def _crossed(odd: DataFrame, rest: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of cells in which every odd row meets every row of its ``key``.

    Both have ``blocks`` and ``parts`` of the key and ``h``, a hash of the document. All
    rows are dealt into blocks, odd ones into parts; a cell is a block and a part.
    """
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    minors = odd.withColumns({"minor": F.lit(1), "part": F.pmod("h", "parts")}).withColumn(
        "block", upto("blocks")
    )
    others = rest.withColumns({"minor": F.lit(0), "block": F.pmod("h", "blocks")}).withColumn(
        "part", upto("parts")
    )
    columns = ["key", "block", "part", "minor", *columns]
    return _in_cells(minors.select(columns).union(others.select(columns)))


def _clusters(heads: DataFrame, most: int) -> DataFrame:
    """``doc, cluster, company``: classes that close signatures within buckets connect."""
    banded = heads.select(F.col("doc_id").alias("doc"), F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = staged(join_on_key(banded, shared, "key", "inner"))
    company = members.groupBy("doc").agg(F.sum("n").alias("company"))
    signed = staged(
        heads.select(F.col("doc_id").alias("doc"), "sig", "n_shingles").join(company, "doc")
    )
    members = members.join(signed, "doc")
    hubs = members.groupBy("key").agg(
        F.max(F.struct("company", -F.col("doc"), "sig")).alias("hub")
    )
    marked = staged(
        join_on_key(members, hubs, "key", "inner").select(
            "key", "doc", "sig", "n", (-F.col("hub.col2")).alias("hub"),
            (_unequal(F.col("sig"), F.col("hub.sig")) <= most).alias("close"),
        )
    )
    stars = marked.where("close AND doc != hub").select(F.col("hub").alias("a"), F.col("doc").alias("b"))
    far = marked.where("NOT close").groupBy("key").agg(F.count(F.lit(1)).alias("far"))
    opened = join_on_key(marked, far, "key", "inner").withColumns(
        {"h": F.xxhash64("doc"), "blocks": _blocks(F.col("n")), "parts": _blocks(F.col("far"))}
    )
    cells = _crossed(opened.where("NOT close"), opened, ["doc", "sig"])
    more = cells.mapInArrow(_close(most), "a long, b long")
    found = components(stars.union(more))
    return found.select(F.col("node").alias("doc"), F.col("component").alias("cluster")).join(
        signed, "doc"
    )


def _links(clusters: DataFrame, sets: DataFrame, most: int, percent: int) -> DataFrame:
    """Links ``a, b`` that connect what the full sets connect within clusters."""
    sizes = clusters.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES).cast("long").alias("by_size"),
        F.max(F.struct("company", -F.col("doc"))).alias("hub"),
    )
    rows = clusters.join(sizes, "cluster").select(
        F.col("cluster").alias("key"), "doc", "sig", "n", F.xxhash64("doc").alias("h"),
        F.greatest(_blocks(F.col("n")), "by_size").alias("blocks"), (-F.col("hub.col2") == F.col("doc")).alias("is_hub"),
    )
    full = staged(rows.join(sets.withColumnRenamed("doc_id", "doc"), "doc"))
    own = F.array(F.pmod("h", "blocks"))
    each = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    cells = full.select(
        "key",
        F.explode(F.when(F.col("is_hub"), each).otherwise(own)).alias("block"),
        F.lit(-1).cast("long").alias("part"),
        F.col("is_hub").cast("int").alias("minor"),
        "doc", F.lit(-1).cast("long").alias("component"), "sig", "shingles",
    )
    check = _verified(most, percent)
    links = staged(_in_cells(cells).mapInArrow(check, "a long, b long"))
    large = full.where("blocks > 1")
    if large.isEmpty():
        return links
    labelled = (
        large.join(components(links).withColumnRenamed("node", "doc"), "doc", "left")
        .withColumn("component", F.coalesce("component", "doc"))
    )
    parts = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    main = (
        parts.groupBy("key")
        .agg(F.max(F.struct("size", "component")).alias("main"), F.sum("size").alias("all"))
        .where("all > main.size")
        .select("key", F.col("main.component").alias("main"),
                (1 - F.col("main.size") / F.col("all")).alias("odd"))
    )
    # Parts of the odd members are as large as the blocks of all.
    parts = F.ceil(F.col("odd") * F.col("blocks")).cast("long")
    opened = labelled.join(main, "key").withColumn("parts", parts)
    cells = _crossed(
        opened.where("component != main"), opened, ["doc", "component", "sig", "shingles"]
    )
    return links.union(cells.mapInArrow(check, "a long, b long"))


def near_duplicates(docs: DataFrame, percent: int = MIN_PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    Two documents are linked when 100 times the common shingles is at least ``percent``
    times all shingles of both. The component is named by its smallest doc_id, which is
    the document to keep.
    """
    most = most_unequal(percent)
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark")
    )
    features = staged(docs.mapInArrow(_features(band_rows(percent)), _FEATURES))

    linkable = features.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["set_high", "set_low"]
    # An id may stand for several classes, so classes have numbers, which hold once written.
    first = linkable.groupBy(*same).agg(F.min("doc_id").alias("doc_id"))
    first = linkable.join(first, [*same, "doc_id"]).groupBy(*same, "doc_id").agg(F.min("mark").alias("mark"))
    classes = staged(first.withColumn("class", F.monotonically_increasing_id()))
    heads = (
        linkable.join(classes, [*same, "doc_id", "mark"])
        .dropDuplicates(["class"])
        .select(F.col("class").alias("doc_id"), "n_shingles", "bands", "sig")
    )

    clusters = staged(_clusters(heads, most))
    # Named a merge, so that texts are sent to the few wanted ids alike at every size.
    wanted = (
        clusters.select(F.col("doc").alias("class"))
        .join(classes.select("class", "doc_id", "mark"), "class")
        .hint("merge")
    )
    texts = docs.join(wanted, ["doc_id", "mark"]).select(F.col("class").alias("doc_id"), "text")
    sets = texts.mapInArrow(_sets, "doc_id long, shingles binary")
    links = _links(clusters, sets, most, percent).union(_same_id(linkable, classes, same))
    found = components(links).select(F.col("node").alias("class"), "component")

    # A component is named by the smallest id of its classes.
    part = F.coalesce("component", "class").alias("component")
    tagged = classes.join(found, "class", "left").select(*same, "doc_id", part)
    least = tagged.join(found.select("component").distinct(), "component", "left_semi")
    least = least.groupBy("component").agg(F.min("doc_id").alias("least"))
    named = join_on_key(tagged, least, "component", "left").select(
        *same, F.coalesce("least", "doc_id").alias("component")
    )
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id"))
    return (
        features.select("doc_id", "n_shingles", *same)
        .join(named, same, "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _same_id(linkable: DataFrame, classes: DataFrame, same: list[str]) -> DataFrame:
    """Links ``a, b`` between the classes of every id that has several."""
    ends = [f(name).alias(f"{f.__name__}_{name}") for name in same for f in (F.min, F.max)]
    several = linkable.groupBy("doc_id").agg(*ends).where(
        " OR ".join(f"min_{name} != max_{name}" for name in same)
    )
    rows = linkable.select("doc_id", *same).join(several.select("doc_id"), "doc_id", "left_semi").distinct()
    rows = staged(rows.join(classes.select(*same, "class"), same).select("doc_id", "class"))
    stars = rows.groupBy("doc_id").agg(F.min("class").alias("a"))
    return join_on_key(rows, stars, "doc_id", "inner").select("a", F.col("class").alias("b"))


def keep_first(docs: DataFrame, percent: int = MIN_PERCENT) -> DataFrame:
    """The documents but for those that have a near duplicate with a smaller doc_id."""
    dropped = near_duplicates(docs, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
