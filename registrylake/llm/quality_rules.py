"""Quality rules as weak supervision: rules vote or abstain, EM weighs them.

Everything that touches documents is a column expression. The texts are read once into
counts; the counts become votes; the model is fitted on the number of documents per vote
pattern, a table of at most ``3 ** len(RULES)`` rows whatever the corpus.

Defined results
- NULL text counts as empty: no words, all counts 0, ``base_failed``.
- Rows are judged one by one: repeated rows, repeated or NULL ids change nothing else than
  the pattern counts. Columns of the input stay as they are; a column that has the name of
  an added one is replaced by it.
- An empty table gives an empty result. Texts are read whole, of whatever length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from registrylake.llm.naming import set_aside
from registrylake.tables.work import staged

_SPACE = r"[\x20\x09-\x0D]+"
_WORD_CHAR = r"[^\x20\x09-\x0D]"
_NOT_SYMBOL = r"[^#*$%&|<>]+"
_NOT_CAPITAL = r"[^A-Z]+"

#: Two parts of a packed long: 33 bits of a window's hash above 31 bits of its position.
_POSITION = 0x7FFFFFFF
_POSITION_BITS = 31

BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PERCENT = 50

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


#: Columns that the counts are made of.
_WORKING = ("__text", "__words", "__lines", "__hashes", "__packed", "__exact", "__starts")


def _neighbours(array: Column, n: Column, function) -> Column:
    """``function`` of each element and the next one; ``n`` is the size of the array."""
    inner = F.greatest(n - 1, F.lit(0))
    return F.zip_with(F.slice(array, 1, inner), F.slice(array, 2, inner), function)


def _present(array: Column) -> Column:
    return F.filter(array, lambda x: x.isNotNull())


def with_text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the counts of ``STATS`` and a few more, as longs.

    ``n_repeat_words`` counts the words inside 3-word windows that occur at least twice in
    the text. Windows are hashed, and packed with their position into longs, which sort
    fast; equal neighbours are candidates, and only those are compared by their words. So
    the cost is that of one sort of longs per text, also for very long texts.

    Each step is a projection of its own that later ones refer to more than once, so that
    Catalyst keeps it apart and evaluates it once per row.
    """
    docs, own = set_aside(docs, _WORKING)
    whole = F.coalesce(F.col(text), F.lit(""))
    words, n = F.col("__words"), F.size("__words")
    df = docs.withColumn("__text", whole).withColumn(
        "__words", F.array_remove(F.split("__text", _SPACE, -1), "")
    )
    lines = F.filter(F.split("__text", "\n", -1), lambda x: x.rlike(_WORD_CHAR))
    df = df.withColumns({"__lines": lines, "__hashes": F.transform(words, lambda w: F.xxhash64(w))})

    m = F.greatest(n - 2, F.lit(0))
    hashes = F.col("__hashes")
    pairs = F.zip_with(F.slice(hashes, 1, m), F.slice(hashes, 2, m), lambda a, b: F.xxhash64(a, b))
    windows = F.zip_with(pairs, F.slice(hashes, 3, m), lambda a, b: F.xxhash64(a, b))
    packed = F.transform(
        windows, lambda x, i: F.shiftleft(x, _POSITION_BITS).bitwiseOR(i.cast("long"))
    )
    df = df.withColumn("__packed", F.sort_array(packed))

    def alike(a, b):
        same = F.shiftright(a, _POSITION_BITS) == F.shiftright(b, _POSITION_BITS)
        return F.when(same, F.array(a.bitwiseAND(_POSITION), b.bitwiseAND(_POSITION)))

    candidates = F.array_distinct(
        F.flatten(_present(_neighbours(F.col("__packed"), m, alike)))
    )
    at = lambda p, k: F.get(words, (p + k).cast("int"))
    exact = F.transform(
        candidates,
        lambda p: F.struct(at(p, 0).alias("a"), at(p, 1).alias("b"), at(p, 2).alias("c"), p.alias("p")),
    )
    df = df.withColumn("__exact", F.sort_array(exact))

    def equal(x, y):
        same = (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
        return F.when(same, F.array(x["p"], y["p"]))

    found = _neighbours(F.col("__exact"), F.size("__exact"), equal)
    df = df.withColumn("__starts", F.sort_array(F.array_distinct(F.flatten(_present(found)))))
    starts = F.col("__starts")
    steps = _neighbours(starts, F.size(starts), lambda a, b: F.least(F.lit(3).cast("long"), b - a))
    covered = F.when(
        F.size(starts) > 0,
        F.aggregate(steps, F.lit(3).cast("long"), lambda total, step: total + step),
    ).otherwise(0)

    df = df.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
            "n_symbols": F.octet_length(F.regexp_replace("__text", _NOT_SYMBOL, "")).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
            "n_repeat_words": covered.cast("long"),
            "n_lines": F.size("__lines").cast("long"),
            "n_capitals": F.octet_length(F.regexp_replace("__text", _NOT_CAPITAL, "")).cast("long"),
        }
    )
    return df.drop(*_WORKING).withColumnsRenamed(own)


def _vote(bad: str, good: str) -> Column:
    return F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)


#: Each rule: when it votes against a document, when for it (else it abstains), and the
#: largest share of good documents that it is believed to accuse. Strict rules come first;
#: the last one often accuses good documents, so others can outvote it.
RULES = {
    "word_length": (
        "word_chars < 2 * n_words or word_chars > 14 * n_words",
        "word_chars >= 3 * n_words and word_chars <= 10 * n_words",
        0.001,
    ),
    "symbols": ("10 * n_symbols > n_words", "100 * n_symbols <= n_words", 0.001),
    "duplicate_lines": ("2 * n_dup_lines > n_lines", "n_dup_lines = 0", 0.001),
    "repetition": (
        "10 * n_repeat_words > 3 * n_words", "20 * n_repeat_words <= n_words", 0.001
    ),
    "capitals": ("10 * n_capitals > 3 * word_chars", "20 * n_capitals <= word_chars", 0.001),
    "some_repetition": (
        "10 * n_repeat_words > n_words", "50 * n_repeat_words <= n_words", 0.1
    ),
}

#: What is believed of bad documents: a rule accuses between these shares of them. Faults
#: are of many kinds, so most rules have nothing against a given bad document. Without the
#: bounds the likeliest model has one kind of fault, and calls good what shows another.
ACCUSED_BAD = (0.1, 0.3)
#: Bounds of the share of good documents. Votes for a document never lower its odds, so the
#: lower bound is also the least posterior of a document that no rule accuses: what becomes
#: of it does not depend on how many other documents are faulty.
SHARE_GOOD = (0.6, 0.97)


def with_votes(stats: DataFrame) -> DataFrame:
    """Adds ``votes``, one of -1, 0, 1 per rule, in the order of ``RULES``."""
    return stats.withColumn(
        "votes", F.array(*[_vote(bad, good).cast("int") for bad, good, _ in RULES.values()])
    )


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents, and per rule the probability of each vote, if it votes, in
    each class. Abstaining is no evidence."""

    prior: float
    good: list[dict[int, float]]
    bad: list[dict[int, float]]

    def accuracy(self, rule: int) -> float:
        """Probability that a vote of the rule names the true class."""
        return self.prior * self.good[rule][1] + (1 - self.prior) * self.bad[rule][-1]

    def weight(self, rule: int, vote: int) -> float:
        """What a vote adds to the logarithm of the odds that a document is good."""
        return math.log(self.good[rule][vote] / self.bad[rule][vote]) if vote else 0.0

    def odds(self, votes: tuple[int, ...]) -> float:
        prior = math.log(self.prior / (1 - self.prior))
        return prior + sum(self.weight(rule, vote) for rule, vote in enumerate(votes))

    def posterior(self, votes: Column) -> Column:
        """Probability that a document with these votes is good."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule in range(len(RULES)):
            vote = F.get(votes, F.lit(rule))
            odds = odds + F.when(vote == -1, self.weight(rule, -1)).when(
                vote == 1, self.weight(rule, 1)
            ).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def _accusing(
    counts: list[tuple[tuple[int, ...], int]], share: list[float], rule: int
) -> tuple[float, float]:
    """Documents of a class that a rule accuses, and that it votes on; one of each added."""
    voted = [(votes[rule], n * s) for (votes, n), s in zip(counts, share, strict=True)]
    return (
        1 + sum(n for vote, n in voted if vote < 0),
        2 + sum(n for vote, n in voted if vote),
    )


def _within(x: float, bounds: tuple[float, float]) -> float:
    return min(bounds[1], max(bounds[0], x))


def fit_counts(counts: list[tuple[tuple[int, ...], int]], rounds: int = 200) -> LabelModel:
    """EM over the number of documents per vote pattern, within what is believed.

    Starts from "bad if a strict rule says so" and ends when the shares of documents that
    rules accuse stand still. The share of good documents is held at what no strict rule
    accuses: votes say too little for documents to find it again as the mean posterior,
    which would sink from round to round. An empty list gives the beliefs alone.
    """
    total = sum(n for _, n in counts)
    strict = [rule for rule, (_, _, most) in enumerate(RULES.values()) if most < 0.01]
    share = [0.0 if any(votes[r] < 0 for r in strict) else 1.0 for votes, _ in counts]
    kept = sum(n * s for (_, n), s in zip(counts, share, strict=True))
    prior = _within((kept + 1) / (total + 2), SHARE_GOOD)
    model = LabelModel(prior, [], [])
    for _ in range(rounds):
        good, bad = [], []
        for rule, (_, _, most) in enumerate(RULES.values()):
            accused, voted = _accusing(counts, share, rule)
            wrong = _within(accused / voted, (most / 2, most))
            accused, voted = _accusing(counts, [1 - s for s in share], rule)
            right = _within(accused / voted, ACCUSED_BAD)
            good.append({-1: wrong, 1: 1 - wrong})
            bad.append({-1: right, 1: 1 - right})
        before, model = model, LabelModel(prior, good, bad)
        moved = [
            abs(now[-1] - then[-1])
            for now, then in zip(good + bad, before.good + before.bad)
        ]
        if moved and max(moved) < 1e-9:
            break
        share = [1 / (1 + math.exp(-model.odds(votes))) for votes, _ in counts]
    return model


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of the words inside repeated windows."""
    return (F.col("n_words") < BASE_MIN_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_MAX_REPEAT_PERCENT * F.col("n_words")
    )


def fit(voted: DataFrame) -> LabelModel:
    """The model of all documents that the base rule leaves to it.

    Only the pattern counts reach the driver.
    """
    left = voted.where(~base_failed())
    patterns = left.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
    return fit_counts(sorted((tuple(row["votes"]), row["n"]) for row in patterns))


def judge(voted: DataFrame, model: LabelModel, threshold: float = 0.5) -> DataFrame:
    """Adds ``base_failed``, ``quality`` (the posterior) and ``kept``."""
    return voted.withColumns(
        {"base_failed": base_failed(), "quality": model.posterior(F.col("votes"))}
    ).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that the rules keep, with their columns.

    The counted documents are written once to the shared folder, so that texts are not
    counted again after the model is fitted.
    """
    columns = docs.columns
    numbered = docs.select(F.struct("*").alias("doc"), F.col("text").alias("text"))
    voted = staged(with_votes(with_text_stats(numbered).drop("text")))
    kept = judge(voted, fit(voted), threshold).where("kept")
    return kept.select([F.col(f"doc.`{name}`").alias(name) for name in columns])
