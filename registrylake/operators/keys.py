"""Distinct keys, one row per key, and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F


def first_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest by the other columns in order, NULLs last.

    Rows with a NULL key are one group. ``row_number() = 1`` is planned with a group
    limit before the shuffle, so each task sends one row per key, however hot.
    """
    order = [F.col(name).asc_nulls_last() for name in df.columns if name != key]
    window = Window.partitionBy(key).orderBy(*(order or [F.col(key)]))
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values of a column."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def distinct_keys(frames: list[DataFrame], key: str) -> DataFrame:
    """Distinct values of ``key`` over all frames, NULL included once (SQL ``UNION``)."""
    return reduce(DataFrame.union, [frame.select(key) for frame in frames]).distinct()


def row_count(df: DataFrame) -> DataFrame:
    """One row holding the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("n"))
