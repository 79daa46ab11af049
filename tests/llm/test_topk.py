import math
import random

import pytest
from pyspark.sql import functions as F

from registrylake.llm.topk import _blocks, top_k

MOST = (1 << 63) - 1


def brute(rows, k=10, every=100):
    """(query_id, rank, vec_id, score) of all query rows, sorted."""
    clamp = lambda x: max(-MOST, min(MOST, x))
    usable = []
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, [max(-MOST - 1, min(MOST, math.floor(x * 1024))) for x in vector]))
    found = []
    for i, (query, a) in enumerate(usable):
        if query % every:
            continue
        scored = [
            (-clamp(sum(x * y for x, y in zip(a, b))), vec_id)
            for j, (vec_id, b) in enumerate(usable)
            if i != j and len(a) == len(b)
        ]
        for rank, (score, vec_id) in enumerate(sorted(scored)[:k], 1):
            found.append((query, rank, vec_id, -score))
    return sorted(found)


def search(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(map(tuple, top_k(df, **options).collect()))


def vectors(n, dim, seed=1):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, 0.3) for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("tile_bytes, block_bytes", [(1 << 18, 4 << 20), (1000, 900), (100, 100)])
def test_equals_brute_force_whatever_the_tiles(spark, tile_bytes, block_bytes):
    rows = vectors(430, 7)
    got = search(spark, rows, every=20, tile_bytes=tile_bytes, block_bytes=block_bytes)
    assert got == brute(rows, every=20)


def test_ties_and_repeated_rows(spark):
    draw = random.Random(2)
    rows = [(i % 90, [draw.choice([0.0, 0.5, -0.5]) for _ in range(2)]) for i in range(300)]
    rows += [(0, [0.5, 0.5])] * 40
    assert search(spark, rows, every=30) == brute(rows, every=30)


def test_nulls_other_lengths_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (100, [1.0, 0.0]), (1, [0.5, 0.25]), (200, None), (2, [None, 1.0]),
        (3, [nan, 1.0]), (300, [inf, 1.0]), (None, [1.0, 1.0]), (400, [1.0]), (500, []), (5, []),
        (-100, [-1.0, 0.0001]),
    ]
    got = search(spark, rows)
    assert got == brute(rows)
    assert {row[0] for row in got} == {0, 100, -100, 500}
    assert search(spark, []) == [] and search(spark, [(7, [1.0])]) == []


def test_large_components_are_exact(spark):
    draw = random.Random(3)
    sizes = [1e4, 1e7, 3e12, 1e30]
    rows = [(i, [draw.uniform(-1, 1) * draw.choice(sizes) for _ in range(5)]) for i in range(120)]
    for size in sizes:
        some = [(i, [x / max(map(abs, v)) * size for x in v]) for i, v in rows]
        assert search(spark, some, every=10) == brute(some, every=10)
    assert search(spark, rows, every=10) == brute(rows, every=10)


def test_clashing_and_float_columns(spark):
    rows = vectors(50, 3)
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    for name in ("row", "v", "tile", "node", "query", "rank", "score"):
        df = df.withColumn(name, F.lit("x"))
    exact = [(r["vec_id"], list(r["embedding"])) for r in df.collect()]
    assert sorted(map(tuple, top_k(df, every=10).collect())) == brute(exact, every=10)


def test_many_lists_are_merged_as_a_tree(spark):
    rows = vectors(800, 3, seed=4)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(40)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # one task per file
    try:
        got = sorted(map(tuple, top_k(df, every=50, tile_bytes=200).collect()))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert got == brute(rows, every=50)


def test_blocks_are_bound_by_bytes():
    sizes = [(i, 10 + i % 7) for i in range(50)]
    blocks = list(_blocks(sizes, 40))
    assert [tile for block in blocks for tile in block] == list(range(50))
    assert all(sum(dict(sizes)[t] for t in block) <= 40 for block in blocks)
    assert list(_blocks([(1, 100), (2, 5)], 40)) == [[1], [2]]
