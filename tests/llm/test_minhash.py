import random

import numpy as np
import pytest
from brute import near_components, shingle_sets

from registrylake.llm import minhash
from registrylake.llm.components import components


def family(seed, copies, base_words=120):
    """A base text and copies with up to four changed words."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10_000)}" for _ in range(base_words)]
    texts = [" ".join(base)]
    for _ in range(copies):
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
        texts.append(" ".join(words))
    return texts


def check(docs, frame, percent=85):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(frame, percent).collect()}
    expected, sets = near_components(docs, percent), shingle_sets(docs)
    for doc_id, component in expected.items():
        row = got[doc_id]
        assert row["component_id"] == component, doc_id
        assert row["kept"] == (component == doc_id)
        assert row["n_shingles"] == len(sets[doc_id])


def test_families_equal_brute_force(documents):
    texts = [t for seed in range(4) for t in family(seed, 30)]
    random.Random(9).shuffle(texts)
    docs = list(enumerate(texts, start=10))
    docs += [(500, docs[0][1]), (501, docs[0][1].upper()), (502, "only three words"), (503, "Only  three\twords")]
    check(docs, documents(docs))


@pytest.mark.parametrize(("block", "block_bytes"), [(8, 32 << 20), (2048, 8 * 116 * 9)])
def test_blocks_of_large_buckets_and_clusters(documents, monkeypatch, block, block_bytes):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_BYTES", block_bytes)
    docs = list(enumerate(family(5, 40) + family(6, 25)))
    check(docs, documents(docs))


def test_null_empty_repeated_and_extra(spark):
    rows = [
        (1, None, 7), (2, "", 7), (3, " \t\n", 7), (4, "a b c d e f", 7), (4, "a b c d e f", 7),
        (None, "a b c d e f", 7), (9, "a b c d e f", 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted(
        map(tuple, minhash.near_duplicates(docs).collect()), key=lambda r: (r[0] is None, r)
    )
    assert got == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 2, 4, True), (4, 2, 4, True),
        (9, 2, 4, False), (None, 2, None, True),
    ]
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == 6
    assert minhash.near_duplicates(docs.limit(0)).collect() == []


def test_very_long_text(documents):
    words = " ".join(str(i * 7919 % 100_003) for i in range(60_000))
    got = minhash.near_duplicates(documents([(1, words), (2, words + " end")])).collect()
    assert {r["component_id"] for r in got} == {1}
    assert sorted(r["n_shingles"] for r in got) == [59_996, 59_997]


def test_estimate_follows_similarity():
    rng = np.random.default_rng(1)
    both = rng.integers(0, 1 << 63, 3000, np.uint64)
    for shared in (0.95, 0.85, 0.5):
        n = int(2000 * 2 * shared / (1 + shared))
        a, b = both[:2000], np.concatenate((both[:n], both[2000 : 4000 - n]))
        x, y = (minhash.packed_bits(minhash.minima(s)).view(np.uint64) for s in (a, b))
        differ = x ^ y
        odd = np.bitwise_count((differ | differ >> np.uint64(1)) & minhash._LANE_ONES).sum()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert minhash.estimate(odd) == pytest.approx(true, abs=0.12)
        if true >= 0.85:
            assert odd <= minhash.most_unequal(85)


def test_components_of_chain_star_and_loop(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 130)]
    links = spark.createDataFrame(chain + star + [(200, 200), (201, None)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert components(links.limit(0)).count() == 0


def test_one_class_per_star(spark):
    pairs = [(np.array([0, 1, 4]), np.array([1, 2, 5]))]
    links = minhash._stars(np.array([30, 20, 10, 40, 60, 50]), pairs)
    assert sorted(map(tuple, links.tolist())) == [(10, 20), (10, 30), (50, 60)]


def test_bands_find_pairs_at_the_threshold():
    assert (minhash.band_rows(85), minhash.band_rows(80)) == (7, 5)
    for percent in (40, 60, 80, 85, 95):
        rows = minhash.band_rows(percent)
        assert (1 - (percent / 100) ** rows) ** minhash.BANDS < 1e-6


def test_lone_pairs_between_80_and_85(documents):
    docs, rng = [], random.Random(21)
    for k in range(60):
        words = [f"p{k}w{rng.randrange(10_000)}" for _ in range(104)]
        other = list(words)
        for at in (20, 60)[: 1 + k % 2]:
            other[at] = "changed"
        if k % 2 == 0:
            other[101] = "changed"
            other = other[:-1]
        docs += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    sets = shingle_sets(docs)
    near = [len(sets[2 * k] & sets[2 * k + 1]) / len(sets[2 * k] | sets[2 * k + 1]) for k in range(60)]
    assert all(0.8 <= x < 0.85 for x in near[1::2])
    check(docs, documents(docs), 80)


def test_all_texts_of_a_repeated_id_link(documents):
    from registrylake.llm.minhash import near_duplicates

    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    one, two, three = ([word() for _ in range(80)] for _ in range(3))
    near = lambda words: " ".join([*words, "more"])
    docs = [
        (1, " ".join(one)), (1, " ".join(two)), (2, near(one)), (3, near(two)), (3, near(two)),
        (5, " ".join(three)), (5, ""), (5, None), (6, near(three)), (7, "alone here it stands now"),
    ]
    for order in (docs, docs[::-1]):
        got = sorted((r["doc_id"], r["n_shingles"] > 0, r["component_id"]) for r in near_duplicates(documents(order)).collect())
        assert got == sorted([
            (1, True, 1), (1, True, 1), (2, True, 1), (3, True, 1), (3, True, 1), (5, True, 5),
            (5, False, 5), (5, False, 5), (6, True, 5), (7, True, 7),
        ])
