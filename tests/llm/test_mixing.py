import math
import random
from collections import defaultdict

import pytest

from pyspark.sql import functions as F

from registrylake.llm.mixing import Mixture, exponent, mix, mixed_rows, quotas_of


def corpus(seed=1):
    rng = random.Random(seed)
    sizes = {"big": 400, "middle": 90, "small": 12, None: 30, "": 5}
    docs, doc_id = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            docs.append((doc_id, "w " * rng.randrange(1, 60), source))
            doc_id += 1
    return docs


def weights(docs, x):
    tokens = defaultdict(int)
    for _, text, source in docs:
        tokens[source] += len((text or "").split())
    raised = {s: (t / sum(tokens.values())) ** x for s, t in tokens.items()}
    return tokens, {s: r / sum(raised.values()) for s, r in raised.items()}


def entropy(w):
    return -sum(p * math.log(p) for p in w.values()) / math.log(len(w))


@pytest.mark.parametrize("mixture", [Mixture(), Mixture(0.8, 100.0, 0.5), Mixture(0.99, 1.5, 2.0)])
def test_weights_quotas_and_limits(documents, mixture):
    docs = corpus()
    rows = mix(documents(docs), mixture).collect()
    assert len(rows) == len(docs)
    used, weight, longest = defaultdict(int), {}, defaultdict(int)
    for row in rows:
        used[row["source"]] += row["copies"] * row["n_tokens"]
        longest[row["source"]] = max(longest[row["source"]], row["n_tokens"])
        weight[row["source"]] = row["weight"]
    tokens, natural = weights(docs, 1.0)
    assert sum(weight.values()) == pytest.approx(1)
    # All weights come from one exponent.
    x = math.log(weight["big"] / weight["small"]) / math.log(tokens["big"] / tokens["small"])
    assert weight == pytest.approx(weights(docs, x)[1], abs=1e-6)
    budget = mixture.budget * sum(tokens.values())
    repeats = max(weight[s] * budget / tokens[s] for s in tokens)
    assert repeats <= mixture.repeats * (1 + 1e-6) or x == pytest.approx(1)
    if repeats < mixture.repeats * 0.999:
        assert entropy(weight) == pytest.approx(mixture.entropy, abs=1e-6) or x == pytest.approx(1)
    for source, quota in ((s, weight[s] * budget) for s in tokens):
        assert round(quota) - longest[source] < used[source] <= round(quota)


def test_rows_follow_copies_and_positions(documents):
    docs = documents(corpus())
    copies = {r["doc_id"]: r["copies"] for r in mix(docs).collect()}
    rows = mixed_rows(docs).collect()
    taken = defaultdict(list)
    for row in rows:
        taken[row["doc_id"]].append(row["epoch"])
        assert 0 <= row["position"] <= 1
    assert {i: sorted(e) for i, e in taken.items()} == {
        i: list(range(1, c + 1)) for i, c in copies.items() if c
    }
    first = [r for r in rows if r["position"] < 0.5]
    share = sum(r["n_tokens"] for r in first if r["source"] == "small") / sum(r["n_tokens"] for r in first)
    assert share == pytest.approx(rows and [r["weight"] for r in rows if r["source"] == "small"][0], abs=0.04)


def test_odd_rows(spark):
    rows = [(1, "a b", "x", 0), (1, "a b", "x", 0), (None, "c d e", "x", 0), (None, None, None, 0), (4, " ", "y", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight int")
    got = mix(docs).collect()
    assert sorted((r["doc_id"] or 0, r["copies"]) for r in got) == [(0, 1), (0, 1), (1, 1), (1, 1), (4, 1)]
    assert mix(docs.limit(0)).collect() == [] and mixed_rows(docs.limit(0)).collect() == []


def test_exponent_extremes(spark):
    shares = spark.createDataFrame([("a", 0.7), ("b", 0.2), ("c", 0.1)], "source string, share double")
    assert exponent(shares, Mixture(entropy=0.0, repeats=9)) == 1.0
    assert exponent(shares, Mixture(entropy=1.1, repeats=9)) == 0.0
    assert exponent(shares.limit(1), Mixture()) == 1.0


@pytest.mark.parametrize("mixture", [Mixture(), Mixture(0.99, 3.0, 2.0, "other")])
def test_any_partitioning_gives_one_result(spark, documents, mixture):
    docs = documents(corpus(3))
    results = set()
    try:
        for parts in (1, 2, 3, 5, 8, 16):
            for adaptive in ("true", "false"):
                spark.conf.set("spark.sql.adaptive.enabled", adaptive)
                spark.conf.set("spark.sql.shuffle.partitions", str(1 + parts % 7))
                rows = mix(docs.repartition(parts, F.rand(parts)), mixture).collect()
                results.add(tuple(sorted(map(tuple, rows), key=repr)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(results) == 1


@pytest.mark.parametrize("seed", ["a", "b", "c"])
def test_shares_kept_take_every_document_once(documents, seed):
    # The natural mixture has the entropy asked for, so the exponent is 1.
    docs = corpus(4)
    assert {r["copies"] for r in mix(documents(docs), Mixture(0.1, 100.0, 1.0, seed)).collect()} == {1}
    assert {r["copies"] for r in mix(documents(docs), Mixture(0.1, 100.0, 3.0, seed)).collect()} == {3}


def test_a_source_exactly_on_the_limit(spark):
    # Exponent 0: two equal weights; the small source is passed through exactly four times.
    sources = spark.createDataFrame([("a", 700, 0.875), ("b", 100, 0.125)], "source string, tokens long, share double")
    rows = {r["source"]: r for r in quotas_of(sources, 800, Mixture(1.1, 4.0, 1.0)).collect()}
    assert (rows["b"]["passes"], rows["b"]["rest"], rows["a"]["quota"]) == (4, 0, 400)


def test_quotas_of_many_small_sources_add_up(spark):
    tokens = [(i * 7919) % 1000 + 1 for i in range(3000)]
    total = sum(tokens)
    rows = [(str(i), t, t / total) for i, t in enumerate(tokens)]
    sources = spark.createDataFrame(rows, "source string, tokens long, share double")
    one = {(r["source"], r["quota"]) for r in quotas_of(sources, total, Mixture(0.1, 9.0)).collect()}
    assert one == {(str(i), t) for i, t in enumerate(tokens)}


def test_clashing_names_pass_through(documents):
    names = [
        "passes", "cut", "last_hash", "block", "epochs", "doc", "hash", "tokens", "rest", "quota",
        "__source", "__hash", "copies", "weight", "part", "rank", "at", "left",
    ]
    docs = documents(corpus(5))
    for name in names:
        docs = docs.withColumn(name, F.lit("own"))
    plain = {r["doc_id"]: r["copies"] for r in mix(documents(corpus(5))).collect()}
    got = mix(docs).collect()
    assert {r["doc_id"]: r["copies"] for r in got} == plain
    kept = [n for n in names if n not in ("copies", "weight")]
    assert {tuple(r[n] for n in kept) for r in got} == {("own",) * len(kept)}
    rows = mixed_rows(docs).collect()
    assert len(rows) == sum(plain.values())
    assert {tuple(r[n] for n in [*kept, "copies"]) for r in rows} == {("own",) * (len(kept) + 1)}


def test_cut_within_a_block(documents):
    # One document per block part and many: the first documents by hash are taken while they fit.
    docs = [(i, "w " * (i % 7 + 1), "s") for i in range(300)]
    half = {r["doc_id"]: r["copies"] for r in mix(documents(docs), Mixture(1.0, 4.0, 0.5)).collect()}
    taken = sum((i % 7 + 1) * n for i, n in half.items())
    total = sum(i % 7 + 1 for i in range(300))
    assert (total + 1) // 2 - 7 < taken <= (total + 1) // 2 and set(half.values()) == {0, 1}


def test_very_long_texts(documents):
    docs = documents([(1, "w " * 2_000_000, "a"), (2, "w w", "a"), (3, "w" * 3_000_000, "b")])
    got = {r["doc_id"]: (r["n_tokens"], r["copies"]) for r in mix(docs, Mixture(0.0, 9.0)).collect()}
    assert got == {1: (2_000_000, 1), 2: (2, 1), 3: (1, 1)}
