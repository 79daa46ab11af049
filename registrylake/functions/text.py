"""Column expressions over registry text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from registrylake.schemas import UNSIGNED_LIMITS, spark_type

# Accepted spellings of numbers. A plain cast would also trim blanks and accept
# a type suffix such as "5d", which the files never mean as a number.
_SIGNED = r"^[+-]?[0-9]+$"
_UNSIGNED = r"^[+]?[0-9]+$"
_DECIMAL = r"^[+-]?(([0-9]+[.,]?[0-9]*|[.,][0-9]+)([eE][+-]?[0-9]+)?|inf|[nN]a[nN])$"


def blank_to_null(column: str) -> Column:
    """NULL for an empty string, the value itself (untrimmed) otherwise."""
    return F.nullif(F.col(column), F.lit("")).alias(column)


def name_prefix(name: Column) -> Column:
    """Lower-cased name without its trailing digits."""
    return F.regexp_replace(F.lower(name), r"[0-9]+$", "")


def name_number(name: Column) -> Column:
    """Trailing digits of a name as text, NULL when there are none."""
    return F.nullif(F.regexp_extract(name, r"([0-9]+)$", 1), F.lit(""))


def parse_text(text: Column, declared: str) -> Column:
    """Typed value of a text field; NULL for blank, unparsable and out-of-range text.

    Delimited text has no lists: a declared list is an error here, not when rows are read.
    """
    if declared.startswith("list<"):
        raise ValueError(f"{declared} cannot be read from delimited text")
    target = spark_type(declared)
    if declared == "f64":
        number = F.replace(text, F.lit(","), F.lit(".")).try_cast(target)
        return F.when(text.rlike(_DECIMAL), number)
    if declared in UNSIGNED_LIMITS:
        number = F.when(text.rlike(_UNSIGNED), text.try_cast(target))
        limit = UNSIGNED_LIMITS[declared]
        return number if limit is None else F.when(number <= limit, number)
    if declared in ("i64", "i32", "i16"):
        return F.when(text.rlike(_SIGNED), text.try_cast(target))
    return text if declared == "text" else text.try_cast(target)

