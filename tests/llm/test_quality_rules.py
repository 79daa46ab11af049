import random

import pytest
from brute import base_stats

from registrylake.llm import quality_rules as Q

PROSE = "The quiet river runs along old stone walls and green fields under a pale morning sky. "


def text(seed, n=90):
    rng = random.Random(seed)
    words = [w + rng.choice("aeiou") + rng.choice("bcdfg") for w in PROSE.split() for _ in range(6)]
    return " ".join(rng.choice(words) for _ in range(n))


def tricky():
    rng = random.Random(5)
    texts = [None, "", " \n\t ", "a", "a a a", "a a a a", "x y z x y z", "l\nl\n\n l\nl", "#*$%&|<>", " é \x0b\x1c"]
    texts += [" ".join(rng.choice("ab c d".split(" ")) for _ in range(rng.randrange(40))) for _ in range(60)]
    return texts + ["For " * 3000, text(1, 400) + " " + text(1, 400)]


def test_stats_equal_brute_force(documents):
    texts = tricky()
    got = Q.with_text_stats(documents(list(enumerate(texts)))).collect()
    for row in got:
        assert tuple(row[c] for c in Q.STATS) == base_stats(texts[row["doc_id"]]), row["text"]


def test_good_stay_and_faults_go(documents):
    good = [(i, text(i)) for i in range(60)]
    bad = [(100 + i, " ".join(w + "%%%" for w in text(i).split())) for i in range(6)]
    bad += [(200 + i, text(i).upper()) for i in range(5)]
    bad += [(300, "spam spam " * 60), (301, "too short"), (302, None)]
    docs = documents(good + bad)
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, _ in good]


def test_rows_do_not_influence_each_other_and_names_clash(spark):
    rows = [(None, text(1), 5, "v"), (None, text(1), 5, "v"), (1, None, 5, "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, votes string")
    kept = Q.keep_good(docs)
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(rows[:2], key=repr)
    assert Q.keep_good(docs.limit(0)).collect() == []


def test_em_keeps_strict_faults_bad_and_lets_the_weak_one_be_outvoted():
    vote = lambda **v: tuple(v.get(name, 1) for name in Q.RULES)
    counts = [
        (vote(), 900), (vote(symbols=-1), 60), (vote(repetition=-1, capitals=-1), 40),
        (vote(some_repetition=-1), 9), (vote(some_repetition=-1, repetition=0), 9),
    ]
    for factor in (1, 1000):
        model = Q.fit_counts([(votes, n * factor) for votes, n in counts])
        good = [model.odds(votes) > 0 for votes, _ in counts]
        assert good == [True, False, False, True, True]
        assert model.weight(1, -1) < model.weight(5, -1) < 0
    assert Q.fit_counts([]).odds(vote()) > 0


def test_native_posterior_is_the_models(documents):
    voted = Q.with_votes(Q.with_text_stats(documents([(i, text(i, 20 + 9 * i)) for i in range(20)])))
    model = Q.fit(voted)
    for row in voted.withColumn("p", model.posterior(voted["votes"])).collect():
        assert abs(row["p"] - 1 / (1 + 2.718281828459045 ** -model.odds(tuple(row["votes"])))) < 1e-9


@pytest.mark.parametrize("faulty", [0, 30, 35, 40, 50, 60, 90])
@pytest.mark.parametrize("kinds", [1, 5])
@pytest.mark.parametrize("abstain", [0, 50])
def test_documents_that_nothing_accuses_stay_in_faulty_corpora(faulty, kinds, abstain):
    vote = lambda **v: tuple(v.get(name, 1) for name in Q.RULES)
    strict = list(Q.RULES)[:5]
    silent, one_vote = (0,) * len(Q.RULES), vote(**dict.fromkeys(strict, 0))
    bad = [(vote(**{name: -1}), 10 * faulty // kinds) for name in strict[:kinds]]
    rest = 1000 - 10 * faulty
    quiet = rest * abstain // 100
    good = [(vote(), rest - quiet), (silent, quiet // 2), (one_vote, quiet - quiet // 2)]
    model = Q.fit_counts([(votes, n) for votes, n in good + bad if n])
    assert all(model.odds(votes) > 0 for votes, _ in good)
    assert all(model.odds(votes) < 0 for votes, _ in bad)


def test_faulty_half_of_a_table_does_not_take_the_rest(documents):
    good = [(i, text(i)) for i in range(40)]
    bad = [(100 + i, " ".join(w + "%%%" for w in text(i).split())) for i in range(30)]
    bad += [(200 + i, text(i).upper()) for i in range(30)]
    kept = {r["doc_id"] for r in Q.keep_good(documents(good + bad)).collect()}
    assert kept == {i for i, _ in good}


def test_columns_with_working_names_stay(documents):
    from pyspark.sql import functions as F

    docs = documents([(1, text(1))]).withColumns({n: F.lit("own") for n in ("__text", "__words", "__mine")})
    row = Q.with_text_stats(docs).first()
    assert (row["__text"], row["__words"], row["__mine"], row["n_words"]) == ("own", "own", "own", 90)
