import random

import numpy as np
import pytest
from brute import cut_passages
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from registrylake.llm import passages
from registrylake.llm.phrases import WINDOW, Places, phrases


def corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(20) for _ in range(5)]
    docs = []
    for doc_id in range(60):
        parts = [prose(rng.randrange(0, 40))]
        for _ in range(rng.randrange(3)):
            text = rng.choice(shared)
            cut = rng.randrange(len(text) // 2)
            parts += [text[cut:], prose(rng.randrange(8))]
        docs.append((doc_id, "".join(parts)))
    docs += [(60, docs[3][1]), (61, "ab" * 400), (62, "ab" * 300), (63, "x" * 49), (64, "x" * 50)]
    docs += [(65, "x" * 200), (-5, shared[0]), (66, shared[0] * 3)]
    return docs


def rows_of(frame):
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted(map(tuple, frame.select(columns).collect()), key=repr)


@pytest.mark.parametrize(("part_bytes", "hot"), [(32 << 20, 256), (3000, 256), (3000, 2)])
def test_equals_brute_force(documents, part_bytes, hot):
    docs = corpus()
    random.Random(1).shuffle(docs)
    got = rows_of(passages.remove_passages(documents(docs), part_bytes, hot))
    assert got == cut_passages(docs)


def test_null_empty_repeated_and_extra(spark):
    text = "a passage that is certainly longer than fifty bytes in all, é"
    rows = [(1, text), (1, text), (2, text), (None, text), (None, None), (3, None), (4, "")]
    rows += [(2, "another text of the same id, " + text)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, part int")
    assert rows_of(passages.remove_passages(docs)) == cut_passages(rows)
    assert passages.remove_passages(docs.limit(0)).collect() == []


def test_long_text_across_chunks(documents):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh ") for _ in range(150_000))
    docs = [(1, text), (2, "start " + text[59_000:61_500] + " end"), (3, text[119_980:120_100])]
    assert rows_of(passages.remove_passages(documents(docs))) == cut_passages(docs)


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=0, max_size=400), st.binary(min_size=50, max_size=90))
def test_every_window_is_in_one_phrase_wherever_it_stands(text, window):
    data = np.frombuffer(text + window + text, np.uint8)
    start, count, group, _ = phrases(data)
    covered = np.concatenate([np.arange(s, s + c) for s, c in zip(start, count)])
    assert covered.tolist() == list(range(len(data) - WINDOW + 1))
    alone = phrases(np.frombuffer(window, np.uint8))[2][0]
    at = np.searchsorted(start, len(text), side="right") - 1
    assert group[at] == alone


def test_packed_places_come_back():
    n = 5
    places = Places(
        np.array([3, 3, 9, 9, 1]), np.array([1, 1, 2, 3, 1], np.uint16),
        np.arange(n, dtype=np.uint32), np.ones(n, np.uint8), np.zeros(n, np.uint8),
        np.arange(n, dtype=np.uint64), np.arange(n, dtype=np.uint64),
    )
    again = Places.unpacked(places.packed(("group", "same")), ("group", "same"))
    assert all((getattr(places, f) == getattr(again, f)).all() for f, _ in Places.FIELDS)
    parts = dict(places.by(np.array([0, 1, 0, 1, 1]), ()))
    assert [len(Places.unpacked(p, ())) for p in parts.values()] == [2, 3]


def test_merged_ranges():
    ranges = np.array([[40, 90], [0, 50], [90, 140], [200, 250]])
    assert passages.merged_ranges(ranges) == [(0, 140), (200, 250)]
    assert passages.merged_ranges(ranges) == [(0, 140), (200, 250)]
    assert passages.merged_ranges(np.array([[0, 50], [10, 60], [61, 111]])) == [(0, 60), (61, 111)]


def test_ids_with_a_common_factor_spread(spark):
    ids = np.array([64 * i for i in range(400)] + [-1, 0, 1, 2**62, -(2**63)], np.int64)
    ours = passages.id_hashes(ids).view(np.int64).tolist()
    df = spark.createDataFrame([(int(i),) for i in ids], "i long").select("i", F.xxhash64("i").alias("h"))
    assert dict(zip(ids.tolist(), ours)) == {r.i: r.h for r in df.collect()}
    assert len({h % 20 for h in ours}) == 20


def test_parts_by_hash_give_the_same_result(documents):
    docs = [(64 * i, f"{i} " + "the same long passage in every document of this small table, again " * 2) for i in range(60)]
    got = passages.remove_passages(documents(docs), part_bytes=500)
    assert sorted(map(tuple, got.drop("removed").collect()), key=repr) == cut_passages(docs)
