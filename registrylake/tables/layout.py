"""How rows are laid out in the files of a table, so that lookups read few of them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

#: Rows drawn to find where the values of a column are cut, and ranks per column in bits.
SAMPLE, BITS = 20_000, 5


def paths_of(table: str, lookups: Iterable[str | list[str]]) -> list[list[str]]:
    """The lookup paths as lists of columns. An empty path is an error."""
    paths = [[entry] if isinstance(entry, str) else list(entry) for entry in lookups]
    if not all(paths):
        raise ValueError(f"Empty lookup path for table {table!r}")
    return paths


def leading_columns(table: str, lookups: Iterable[str | list[str]]) -> list[str]:
    """Columns that start a lookup path, each once."""
    return list(dict.fromkeys(path[0] for path in paths_of(table, lookups)))


def hashed_paths(
    table: str, lookups: Iterable[str | list[str]], clustering: list[str]
) -> dict[str, list[str]]:
    """Stored name of the hash, and columns, of each composite path that needs one.

    None is needed where a column of the path is a path of its own, whose filter serves, or
    where the table is sorted by the path.
    """
    paths = paths_of(table, lookups)
    alone = {path[0] for path in paths if len(path) == 1}
    needed = [
        path for path in paths
        if len(path) > 1 and not alone & set(path) and path != clustering[: len(path)]
    ]
    return {f"_key_{'_'.join(path)}": path for path in needed}


def key_hash(columns: Iterable[Column]) -> Column:
    """Hash of a composite key; NULL where a part is."""
    columns = list(columns)
    known = columns[0].isNotNull()
    for column in columns[1:]:
        known &= column.isNotNull()
    return F.when(known, F.xxhash64(*columns))


def with_hashes(df: DataFrame, hashes: dict[str, list[str]]) -> DataFrame:
    return df.withColumns({name: key_hash(map(F.col, path)) for name, path in hashes.items()})


def bounds(df: DataFrame, columns: list[str], ranks: int) -> dict[str, list]:
    """Values that cut each column into up to ``ranks`` parts, from a bounded sample."""
    total = df.count()
    sample = df.select(*columns)
    if total > SAMPLE:
        sample = sample.sample(SAMPLE / total, seed=7).limit(2 * SAMPLE)
    rows = sample.collect()
    found = {}
    for i, name in enumerate(columns):
        values = sorted(row[i] for row in rows if row[i] is not None)
        cuts = [values[len(values) * k // ranks] for k in range(1, ranks)] if values else []
        found[name] = sorted(set(cuts))
    return found


def interleaved(df: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """Position of a row when all columns matter alike: the bits of their ranks, in turn.

    Rows near each other in this order are near each other in every column: a lookup by any
    one of c columns meets about n ** (1 - 1 / c) of n ranges, and twice as many at most on
    average, as a range may lie across the border of two cells.
    """
    rank = {}
    for name, cuts in bounds(df, columns, 1 << bits).items():
        passed = [F.when(F.col(name) >= F.lit(cut), 1).otherwise(0) for cut in cuts]
        rank[name] = sum(passed, F.lit(0))
    position = F.lit(0).cast("long")
    for bit in range(bits):
        for place, name in enumerate(columns):
            one = F.shiftright(rank[name], bit).bitwiseAND(F.lit(1)).cast("long")
            position = position.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - place))
    return position
