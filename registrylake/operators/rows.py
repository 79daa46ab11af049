"""Row-level projections and filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from registrylake.functions.text import blank_to_null as blank_to_null_column
from registrylake.operators.joins import join_on_key


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become NULL in every text column; names and order stay."""
    return df.select(
        [
            blank_to_null_column(f"`{f.name}`").alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def in_or_null(column: str, codes: Iterable) -> Column:
    """Condition: the code is listed, or there is no code."""
    return F.col(column).isin(list(codes)) | F.col(column).isNull()


def exclude_codes(df: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """Rows whose code is known and not listed (SQL ``NOT IN``; a NULL code is dropped).

    An anti join alone would keep NULL codes. It is used instead of ``NOT IN`` because
    that form is always broadcast, whatever the size of the list.
    """
    listed = codes.select(F.col(codes.columns[0]).alias(column)).where(F.col(column).isNotNull())
    known = df.where(F.col(column).isNotNull())
    return join_on_key(known, listed.distinct(), column, "left_anti")


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """All columns but the named ones; names that are absent are ignored."""
    return df.drop(*names)
