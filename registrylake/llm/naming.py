"""Working columns beside columns of any name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def set_aside(df: DataFrame, taken: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """The table with its columns that have a taken name renamed, and how to name them again."""
    taken, back = set(taken), {}
    used = taken | set(df.columns)
    for name in df.columns:
        if name in taken:
            other = name
            while other in used:
                other += "_"
            used.add(other)
            back[other] = name
    return df.withColumnsRenamed({name: other for other, name in back.items()}), back
