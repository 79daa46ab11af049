"""Mixing sources to target weights by a temperature, realised as block permutations.

Weights are source token shares raised to an exponent and normalised: 1 keeps the shares, 0
makes all sources equal. The exponent is found by bisection, 64 ways at a time, so that the
mixture reaches a target entropy, unless a source would then be repeated too often. Sums of
fractions are sums of decimals, so the order in which rows are added changes nothing.

Each source is dealt into 4,096 blocks by a hash of the document. Its quota of the budget is a
whole number of tokens: some whole passes over the source and a part of one, which takes blocks
in permuted order while they fit, and of the block that does not fit the documents in hash
order while they fit. That block is dealt into 4,096 smaller ones in the same way before its
documents are looked at, so a window holds one document in 16 million of a source. Only sums
per source and block are shuffled, with partial sums first, so a source that holds most of the
corpus costs no more than another; what a document gets follows from its hash and one row per
source. Nothing but column expressions touches documents.

Defined results
- A NULL source is a source of its own. A NULL or blank text has no tokens; a document
  without tokens costs nothing and is taken once. Very long texts are counted whole.
- Rows with the same doc_id are taken alike; rows without doc_id are dealt by their text.
- An empty table gives an empty result. A column that has the name of an added one is
  replaced; others pass through, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from registrylake.tables.work import staged

_SPACE = r"[\x20\x09-\x0D]+"
_WAYS, _ROUNDS = 64, 6


@dataclass(frozen=True)
class Mixture:
    """What to aim at.

    ``entropy`` is a share of the largest possible entropy, that of equal weights;
    ``repeats`` how often a source may be passed through; ``budget`` the tokens to take, as
    a share of the tokens there are.
    """

    entropy: float = 0.95
    repeats: float = 4.0
    budget: float = 1.0
    seed: str = "mix-1"


def word_count(text: Column) -> Column:
    """Words of a text as a long; NULL has none."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACE, -1), "")
    return F.size(words).cast("long")


def _with_keys(docs: DataFrame, columns: list[str], seed: str) -> DataFrame:
    """The columns as one struct ``doc``, with source, tokens, and hash and block of each row."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    return docs.select(
        F.struct(*columns).alias("doc"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("source"),
        word_count(F.col("text")).alias("tokens"),
        F.md5(F.concat_ws("|", F.lit(seed), name)).alias("hash"),
    ).withColumn("block", F.substring("hash", 1, 3))


def _exact(fraction: Column) -> Column:
    """A fraction as a decimal; sums of such are the same in any order."""
    return fraction.cast("decimal(38,26)")


def _measures(sources: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float]]:
    """Entropy, and largest weight per share, of the mixture with each exponent."""
    tried = sources.select("share", F.explode(F.array(*map(F.lit, exponents))).alias("x"))
    raised = F.pow("share", "x")
    rows = (
        tried.groupBy("x")
        .agg(
            F.sum(_exact(raised)).cast("double").alias("all"),
            F.sum(_exact(raised * F.col("x") * F.log("share"))).cast("double").alias("logs"),
            F.max(raised / F.col("share")).alias("most"),
        )
        .collect()
    )
    return {r["x"]: (math.log(r["all"]) - r["logs"] / r["all"], r["most"] / r["all"]) for r in rows}


def _bisect(sources: DataFrame, conditions: list[Callable[[float, float], bool]]) -> list[float]:
    """For each condition on entropy and repetition, the least exponent from which on it holds.

    From 0 to 1; a round of all searches is one aggregation.
    """
    found = _measures(sources, [0.0])
    bounds = [(0.0, 0.0) if holds(*found[0.0]) else (0.0, 1.0) for holds in conditions]
    for _ in range(_ROUNDS):
        tried = [[low + (high - low) / _WAYS * k for k in range(1, _WAYS)] for low, high in bounds]
        if all(low == high for low, high in bounds):
            break
        found = _measures(sources, sorted({x for some in tried for x in some}))
        for i, (low, high) in enumerate(bounds):
            step = (high - low) / _WAYS
            high = min((x for x in tried[i] if conditions[i](*found[x])), default=high)
            bounds[i] = high - step, high
    return [high for _, high in bounds]


def exponent(sources: DataFrame, mixture: Mixture) -> float:
    """The exponent for a table of sources with their ``share``, rounded to nine digits.

    Entropy falls and the repetition of rare sources falls as the exponent grows. The
    largest exponent that still reaches the entropy is taken, or a larger one if otherwise
    a source is repeated too often; at 1 all sources are repeated alike.
    """
    n = sources.count()
    if n < 2:
        return 1.0
    target = mixture.entropy * math.log(n)
    found = _bisect(
        sources,
        [
            lambda entropy, _: entropy < target,
            lambda _, most: mixture.budget * most <= mixture.repeats,
        ],
    )
    return round(max(found), 9)


def quotas_of(sources: DataFrame, total: int, mixture: Mixture) -> DataFrame:
    """``source, weight, quota, tokens, passes, rest``: whole tokens, of any order of rows."""
    x = exponent(sources, mixture)
    raised = F.pow("share", F.lit(x))
    norm = sources.agg(F.sum(_exact(raised)).cast("double")).first()[0] or 1.0
    quota = F.round(F.col("weight") * F.lit(mixture.budget * total)).cast("long")
    return (
        sources.withColumn("weight", raised / F.lit(norm))
        .withColumn("quota", quota)
        .select(
            "source", "weight", "quota", "tokens",
            F.expr("quota div tokens").alias("passes"),
            F.expr("quota % tokens").alias("rest"),
        )
    )


def _first_over(sums: DataFrame, order: list[str]) -> DataFrame:
    """Per source the first row, in an order, up to which ``tokens`` exceed ``rest``.

    As ``source, at, left``: the order's columns of that row, and the tokens left before it.
    """
    ordered = Window.partitionBy("source").orderBy(*order)
    running = F.sum("tokens").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    over = sums.withColumn("sum", running).where("sum > rest")
    left = F.col("rest") - F.col("sum") + F.col("tokens")
    key = F.struct(*order)
    return over.groupBy("source").agg(F.min(key).alias("at"), F.min_by(left, key).alias("left"))


def plan_sources(slim: DataFrame, mixture: Mixture) -> DataFrame:
    """One row per source: its weight, whole passes, and where the last pass ends.

    ``slim`` has the keys and tokens of the documents. Sources without tokens are left out.
    """
    blocks = staged(slim.groupBy("source", "block").agg(F.sum("tokens").alias("tokens")))
    sources = blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    total = sources.agg(F.sum("tokens")).first()[0] or 1
    sources = staged(sources.withColumn("share", F.col("tokens") / F.lit(total)))
    quotas = staged(quotas_of(sources, total, mixture))
    permuted = blocks.join(quotas.drop("tokens"), "source").withColumn(
        "rank", block_rank(mixture.seed, F.col("passes") + 1)
    )
    # The first block that does not fit. The rest is less than the source, so there is one.
    cut = staged(_first_over(permuted, ["rank", "block"]))
    opened = slim.join(
        cut.select("source", F.col("at.block").alias("block"), F.col("left").alias("rest")),
        ["source", "block"],
    ).withColumn("part", F.substring("hash", 4, 3))
    parts = opened.groupBy("source", "part", "rest").agg(F.sum("tokens").alias("tokens"))
    part_cut = staged(_first_over(parts, ["part"]))
    last_part = opened.drop("rest").join(
        part_cut.select("source", F.col("at.part").alias("part"), "left"), ["source", "part"]
    )
    # Rows of one hash are taken alike.
    within = Window.partitionBy("source").orderBy("hash")
    running = F.sum("tokens").over(within.rangeBetween(Window.unboundedPreceding, 0))
    taken = last_part.withColumn("sum", running).where("sum <= left")
    last = taken.groupBy("source").agg(F.max("hash").alias("last_hash"))
    return (
        quotas.join(cut.select("source", F.col("at").alias("cut")), "source", "left")
        .join(part_cut.select("source", F.col("at.part").alias("cut_part")), "source", "left")
        .join(last, "source", "left")
        .select(
            "source", "weight", "passes", (F.col("quota") / F.col("tokens")).alias("epochs"),
            "cut", "cut_part", "last_hash",
        )
    )


def block_rank(seed: str, epoch: Column) -> Column:
    """Key by which the blocks of a source are ordered in a pass."""
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), "source", "block"))


def _taken(docs: DataFrame, columns: list[str], mixture: Mixture) -> DataFrame:
    """The documents as a struct ``doc``, with their tokens, block, weight, copies and epochs."""
    keyed = _with_keys(docs, columns, mixture.seed)
    slim = staged(keyed.select("source", "block", "hash", "tokens"))
    plan = staged(plan_sources(slim, mixture))
    rank = block_rank(mixture.seed, F.col("passes") + 1)
    before = F.struct(rank.alias("rank"), F.col("block")) < F.col("cut")
    part = F.substring("hash", 4, 3)
    # In the block that is cut: smaller parts, and of the part that is cut the first documents.
    inside = (F.col("block") == F.col("cut.block")) & (
        (part < F.col("cut_part")) | ((part == F.col("cut_part")) & (F.col("hash") <= F.col("last_hash")))
    )
    extra = F.coalesce(before | F.coalesce(inside, F.lit(False)), F.lit(False)).cast("long")
    copies = F.when(F.col("tokens") == 0, 1).otherwise(F.col("passes") + extra)
    return keyed.join(plan, "source", "left").select(
        "doc",
        "source",
        "block",
        "tokens",
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
        copies.cast("long").alias("copies"),
        F.coalesce("epochs", F.lit(1.0)).alias("epochs"),
    )


def mix(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """All documents with ``n_tokens``, the ``weight`` of their source, and their ``copies``.

    ``docs`` has ``doc_id``, ``source`` and ``text``. The tokens of the copies of a source
    stay within its quota, and miss it by less than one document.
    """
    columns = [name for name in docs.columns if name not in ("n_tokens", "weight", "copies")]
    return _taken(docs, columns, mixture).select(
        "doc.*", F.col("tokens").alias("n_tokens"), "weight", "copies"
    )


def mixed_rows(docs: DataFrame, mixture: Mixture = Mixture()) -> DataFrame:
    """One row per copy, with its ``epoch`` and its ``position`` from 0 to 1.

    In the order of positions every source runs through its passes evenly, each pass in its
    own permutation of blocks, so any stretch of the whole has about the target weights.
    """
    added = ("n_tokens", "weight", "epoch", "position")
    columns = [name for name in docs.columns if name not in added]
    taken = _taken(docs, columns, mixture).where("copies > 0")
    copies = taken.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    rank = block_rank(mixture.seed, F.col("epoch"))
    fraction = F.conv(F.substring(rank, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    runs = F.greatest(F.col("epochs"), F.col("epoch").cast("double"))
    return copies.select(
        "doc.*",
        F.col("tokens").alias("n_tokens"),
        "weight",
        "epoch",
        ((F.col("epoch") - 1 + fraction) / runs).alias("position"),
    )
