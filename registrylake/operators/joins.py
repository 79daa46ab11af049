"""Joins on a registry key that may be NULL and may be very frequent on one side."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_SHUFFLE_KEY = "__shuffle_key"


def join_on_key(df: DataFrame, unique: DataFrame, key: str, how: str, grows: bool = False) -> DataFrame:
    """Join ``df``, which may hold a hot key, to a side with at most one row per key.

    Adaptive execution splits a hot partition only when both inputs of the join are
    shuffled for that join. A side that was just deduplicated by the key is not: the
    planner reuses the shuffle of the deduplication. Adding a hash of the key to the
    join columns makes it shuffle both sides, so the hot key of ``df`` can be split.

    A ``unique`` side that ``grows`` with the data is never broadcast. The planner goes by the
    size of its files or its shuffle, and the hash table that the driver makes of the rows can
    be twenty times that.
    """
    hashed = F.xxhash64(key)
    other = unique.withColumn(_SHUFFLE_KEY, hashed)
    joined = df.withColumn(_SHUFFLE_KEY, hashed).join(
        other.hint("merge") if grows else other, [key, _SHUFFLE_KEY], how
    )
    added = [] if how in ("left_semi", "left_anti") else unique.columns
    return joined.select(*df.columns, *[name for name in added if name != key])


def full_outer_using(unique: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """``unique FULL OUTER JOIN facts USING (key)``; NULL keys match nothing and stay.

    A full outer join is never split by adaptive execution, so it is written as the
    facts with their match, plus the unique rows no fact refers to. A filter placed on
    top reaches the scan of the facts in the first part, while the second part still
    compares with all facts, filtered or not. The result is that of the plain join for
    any input; ``unique`` should have one row per key for the split to help.
    """
    left_only = [name for name in unique.columns if name != key]
    right_only = [name for name in facts.columns if name != key]
    # Both parts read the keyed rows alike, so a shuffle below ``unique`` runs once.
    keyed = unique.where(F.col(key).isNotNull())
    # Facts without a key match nothing, so they stay out of the shuffle.
    no_match = [F.lit(None).cast(unique.schema[name].dataType).alias(name) for name in left_only]
    joined = join_on_key(facts.where(F.col(key).isNotNull()), keyed, key, "left", grows=True)
    alone = facts.where(F.col(key).isNull()).select(key, *no_match, *right_only)
    matched = joined.select(key, *left_only, *right_only).union(alone)
    referred = facts.select(key).distinct().hint("merge")
    unmatched = keyed.join(referred, key, "left_anti").select(key, *left_only)
    without_key = unique.where(F.col(key).isNull()).select(key, *left_only)
    no_fact = [F.lit(None).cast(facts.schema[name].dataType).alias(name) for name in right_only]
    return matched.union(unmatched.union(without_key).select("*", *no_fact))


def keep_known_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Semi join: rows whose key is among ``keys`` (distinct, non-NULL keys)."""
    return join_on_key(df, keys.select(key), key, "left_semi", grows=True)


def enrich_with_max(dim: DataFrame, facts: DataFrame, key: str, value: str) -> DataFrame:
    """``dim`` with the largest non-NULL ``value`` of its key; no match gives NULL.

    A maximum of strings is planned as a sort of all facts. The pairs are counted first,
    by hashing within each task, which leaves few rows when a key has few values. A hot
    key with many values is spread by the value, and each task sends its maximum only.
    The filter on the count keeps the optimizer from dropping that step as redundant.
    Whether the result is small enough to broadcast is measured at run time.
    """
    pairs = (
        facts.where(F.col(value).isNotNull())
        .groupBy(key, value)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where("__rows > 0")
    )
    largest = pairs.groupBy(key).agg(F.max(value).alias(value))
    return dim.join(largest, key, "left").select(*dim.columns, value)
