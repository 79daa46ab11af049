"""Exact top-k search by inner product: tiled matrix products, partial selection, tree merging.

Components become whole numbers, floor(1024 * x), so every score is exact and the result
depends on nothing but the rows. All rows are packed once into tiles of one length and one
integer width, cut by bytes and written to the shared folder. Query rows are packed the same
way and taken in blocks, whose bytes are bound by ``BLOCK_BYTES``. For each block, a task
multiplies its tiles of candidates with the tiles of the block, selects the best of each
product and merges them into one list per query of the block. The lists of all tasks are
written and merged as a tree of ``FAN`` lists at a time, so no task ever holds all lists of a
query, however many tasks there were.

A block is one broadcast of bounded size and one pass over the packed tiles. A pass of n
candidates over a block of m queries costs n * m products, against which reading the tiles
again is small.

Defined results
- A vector that is NULL, or holds a NULL or non-finite component, takes no part; nor does a
  row without ``vec_id``. Vectors are only compared with vectors of the same length; two
  empty ones have the score 0.
- Repeated rows are rows of their own: each is a query and a candidate, a query excludes only
  itself. Ties go to the smaller vec_id; rows equal in both are the same result.
- A component beyond the range of a long counts as its end, and so does a score; such rows
  are multiplied in exact integers, slowly.
- A query with fewer than k partners has as many rows as partners. Empty tables give empty
  results. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from registrylake.tables.work import staged, work_folder

SCALE = 1024
#: Bytes of packed vectors in a tile, and in the queries of a block.
TILE_BYTES = 1 << 18
BLOCK_BYTES = 4 << 20
#: Entries of one matrix of scores, and lists merged at a time.
SCORES = 1 << 21
FAN = 16

_TILE = "tile long, dim int, width int, n int, rows binary, ids binary, vectors binary"
_LISTS = "query long, query_id long, node int, best array<struct<minus:long,vec_id:long>>"
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def quantised(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``row, vec_id, v``: the rows that take part, numbered, with whole components."""
    # The row number holds as soon as the tiles are written; nothing reads it before.
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("v", lambda x: F.floor(x * SCALE))
    return rows.where(F.col("vec_id").isNotNull() & finite).select("row", "vec_id", whole.alias("v"))


def _width(values: np.ndarray) -> int:
    """Bytes per component that hold all values."""
    if not values.size:
        return 2
    low, high = int(values.min()), int(values.max())
    return next(w for w in (2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)


def _packed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], tile: int, dim: int):
    """One tile of vectors in the order of their ids."""
    rows, ids, values = (np.concatenate(arrays) for arrays in zip(*parts, strict=True))
    order = np.argsort(ids, kind="stable")
    width = _width(values)
    packed = values[order].astype(f"<i{width}").tobytes()
    columns = [[tile], [dim], [width], [len(ids)], [rows[order].tobytes()], [ids[order].tobytes()], [packed]]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
        ["tile", "dim", "width", "n", "rows", "ids", "vectors"],
    )


class _Packer:
    """Collects vectors by length and gives tiles of at most ``most`` bytes, or of one vector."""

    def __init__(self, most: int):
        self._most, self._parts, self._size = most, defaultdict(list), defaultdict(int)
        self._next = TaskContext.get().partitionId() << 32

    def _tile(self, dim: int) -> pa.RecordBatch:
        self._next += 1
        self._size[dim] = 0
        return _packed(self._parts.pop(dim), self._next - 1, dim)

    def add(self, rows: np.ndarray, ids: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        dim = values.shape[1]
        room = max(1, self._most // max(16, 8 * dim))
        start = 0
        while start < len(ids):
            piece = slice(start, start + room - self._size[dim])
            self._parts[dim].append((rows[piece], ids[piece], values[piece]))
            self._size[dim] += len(ids[piece])
            start += len(ids[piece])
            if self._size[dim] >= room:
                yield self._tile(dim)

    def rest(self) -> Iterator[pa.RecordBatch]:
        for dim in list(self._parts):
            yield self._tile(dim)


def tiles_of(rows: DataFrame, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """Tiles of quantised rows, without a shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(tile_bytes)
        for batch in batches:
            numbers, ids = (batch.column(c).to_numpy() for c in ("row", "vec_id"))
            vectors = batch.column("v")
            lengths = np.diff(vectors.offsets.to_numpy())
            values, offsets = vectors.flatten().to_numpy(), np.append(0, np.cumsum(lengths))
            for dim in np.unique(lengths):
                chosen = np.flatnonzero(lengths == dim)
                at = offsets[chosen][:, None] + np.arange(dim)
                yield from packer.add(numbers[chosen], ids[chosen], values[at].reshape(len(chosen), dim))
        yield from packer.rest()

    return rows.mapInArrow(pack, _TILE)


class Tile:
    """Vectors of a packed tile."""

    def __init__(self, dim: int, width: int, n: int, rows: bytes, ids: bytes, vectors: bytes):
        self.dim, self.n = dim, n
        self.rows, self.ids = np.frombuffer(rows, np.int64), np.frombuffer(ids, np.int64)
        self.values = np.frombuffer(vectors, f"<i{width}").reshape(n, dim)
        least, most = (int(f(self.values)) if self.values.size else 0 for f in (np.min, np.max))
        self.size = max(-least, most)
        self._floats = None

    @property
    def floats(self) -> np.ndarray:
        if self._floats is None:
            self._floats = self.values.astype(np.float64)
        return self._floats


def _batch_tiles(batch: pa.RecordBatch) -> Iterator[Tile]:
    names = ("dim", "width", "n", "rows", "ids", "vectors")
    for values in zip(*(batch.column(name).to_pylist() for name in names), strict=True):
        yield Tile(*values)


def query_tiles(tiles: DataFrame, every: int, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """Tiles of the rows whose vec_id is divisible by ``every``."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(tile_bytes)
        for batch in batches:
            for tile in _batch_tiles(batch):
                chosen = tile.ids % every == 0
                values = tile.values[chosen].astype(np.int64)
                yield from packer.add(tile.rows[chosen], tile.ids[chosen], values)
        yield from packer.rest()

    return tiles.mapInArrow(choose, _TILE)


def products(queries: Tile, shard: Tile) -> np.ndarray:
    """Exact inner products, queries by candidates; of objects only where a double is not exact."""
    bound = queries.dim * queries.size * shard.size
    if bound < 1 << 53:  # every partial sum is a whole number that a double holds
        return queries.floats @ shard.floats.T
    if bound < 1 << 62:
        return queries.values.astype(np.int64) @ shard.values.astype(np.int64).T
    exact = queries.values.astype(object) @ shard.values.astype(object).T
    return np.clip(exact, -_MOST, _MOST).astype(np.int64)


def best_of_tile(queries: Tile, shard: Tile, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best scores of a tile per query, and their columns; missing ones have column -1.

    The ids of a tile ascend, so of equal scores the first columns are taken.
    """
    scores = products(queries, shard)
    width = min(k, shard.n)
    own = np.searchsorted(np.sort(shard.rows), queries.rows)
    place = np.argsort(shard.rows, kind="stable")
    own = np.minimum(own, shard.n - 1)
    mine = shard.rows[place[own]] == queries.rows
    bound = max(1, queries.dim * queries.size * shard.size) * 2 * shard.n
    if scores.dtype == np.float64 and bound < 1 << 53:
        # Score and column in one number: a partial selection then breaks ties by itself.
        keys = scores * shard.n - np.arange(shard.n)
        keys[np.flatnonzero(mine), place[own[mine]]] = -np.inf
        if width < shard.n:
            top = np.argpartition(keys, shard.n - width, axis=1)[:, shard.n - width :]
        else:
            top = np.broadcast_to(np.arange(shard.n), scores.shape)
    else:
        columns = np.broadcast_to(np.arange(shard.n), scores.shape)
        other = np.ones(scores.shape, bool)
        other[np.flatnonzero(mine), place[own[mine]]] = False
        # Largest score first, without the sign flip that the least long cannot take.
        top = np.lexsort((columns, ~scores.astype(np.int64), ~other), axis=1)[:, :width]
    best = np.take_along_axis(scores, top, 1).astype(np.int64)
    top = np.where(mine[:, None] & (top == place[own][:, None]), -1, top)
    return best, top


class _Lists:
    """The k best of each query of a tile so far: scores and ids, and which are there."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores, self.ids = np.zeros((n, 0), np.int64), np.zeros((n, 0), np.int64)
        self.there = np.zeros((n, 0), bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, there: np.ndarray) -> None:
        scores, ids = np.hstack([self.scores, scores]), np.hstack([self.ids, ids])
        there = np.hstack([self.there, there])
        order = np.lexsort((ids, ~scores, ~there), axis=1)[:, : self.k]
        self.scores, self.ids, self.there = (
            np.take_along_axis(a, order, 1) for a in (scores, ids, there)
        )


def _search_block(tiles: DataFrame, packed: list[tuple], k: int) -> DataFrame:
    """The k best of each task for every query of a block."""
    block = tiles.sparkSession.sparkContext.broadcast(packed)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [Tile(*values) for values in block.value]
        found = [_Lists(tile.n, k) for tile in queries]
        for batch in batches:
            for shard in _batch_tiles(batch):
                step = max(1, SCORES // max(1, shard.n))
                for tile, lists in zip(queries, found, strict=True):
                    if tile.dim != shard.dim:
                        continue
                    parts = [best_of_tile(part, shard, k) for part in _rows_of(tile, step)]
                    scores, top = (np.vstack(arrays) for arrays in zip(*parts, strict=True))
                    lists.add(scores, shard.ids[np.maximum(top, 0)], top >= 0)
        node = TaskContext.get().partitionId()
        for tile, lists in zip(queries, found, strict=True):
            if not lists.there.any():
                continue
            sizes = lists.there.sum(axis=1)
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
            best = pa.StructArray.from_arrays(
                [pa.array(-lists.scores[lists.there]), pa.array(lists.ids[lists.there])],
                ["minus", "vec_id"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tile.rows),
                    pa.array(tile.ids),
                    pa.array(np.full(tile.n, node, np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets), best),
                ],
                ["query", "query_id", "node", "best"],
            )

    return tiles.mapInArrow(search, _LISTS)


def _rows_of(tile: Tile, step: int) -> Iterator[Tile]:
    """The tile in parts of at most ``step`` rows."""
    if tile.n <= step:
        yield tile
        return
    width = tile.values.dtype.itemsize
    for start in range(0, tile.n, step):
        part = slice(start, start + step)
        values = tile.values[part]
        yield Tile(
            tile.dim, width, len(values), tile.rows[part].tobytes(), tile.ids[part].tobytes(), values.tobytes()
        )


def merged(lists: DataFrame, k: int, fan: int = FAN) -> DataFrame:
    """One list per query: lists merged by ``fan`` neighbours at a time until one is left."""
    last = lists.agg(F.max("node")).first()[0] or 0
    levels = max(1, math.ceil(math.log(last + 1, fan) - 1e-9))
    for _ in range(levels):
        node = F.floor(F.col("node") / F.lit(fan)).cast("int")
        together = F.flatten(F.collect_list("best"))
        # At most ``fan`` lists of k meet in a group.
        lists = lists.groupBy("query", "query_id", node.alias("node")).agg(
            F.slice(F.sort_array(together), 1, k).alias("best")
        )
    return lists


def _blocks(sizes: list[tuple[int, int]], most: int) -> Iterator[list[int]]:
    """Tiles in blocks of at most ``most`` bytes, one tile at least."""
    block, total = [], 0
    for tile, size in sizes:
        if block and total + size > most:
            yield block
            block, total = [], 0
        block.append(tile)
        total += size
    if block:
        yield block


def top_k(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    vector: str = "embedding",
    tile_bytes: int = TILE_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows for each query row.

    ``vectors`` has ``vec_id`` and an array column. Queries are the rows whose vec_id is
    divisible by ``every``; each is compared with every other row.
    """
    spark: SparkSession = vectors.sparkSession
    tiles = staged(tiles_of(quantised(vectors, vector), tile_bytes))
    queries = staged(query_tiles(tiles, every, tile_bytes))
    # The driver sees the sizes of the query tiles, then one block of them at a time.
    size = F.length("vectors") + F.length("rows") + F.length("ids")
    sizes = [tuple(row) for row in queries.select("tile", size).orderBy("tile").collect()]
    folder = work_folder(spark)
    parts = []
    for number, block in enumerate(_blocks(sizes, block_bytes)):
        # The tiles of a block are neighbours in the order of their numbers.
        chosen = queries.where(F.col("tile").between(block[0], block[-1])).drop("tile").collect()
        path = f"{folder}/{number}"
        merged(staged(_search_block(tiles, [tuple(row) for row in chosen], k)), k).write.parquet(path)
        parts.append(path)
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = spark.read.parquet(*parts).select("query_id", F.posexplode("best").alias("rank", "hit"))
    return best.select(
        "query_id",
        (F.col("rank") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.minus")).alias("score"),
    )
