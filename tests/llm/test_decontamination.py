import hashlib
import random

import pytest
from brute import contamination

from registrylake.llm import decontamination as D


def tables():
    rng = random.Random(8)
    prose = lambda n: " ".join(rng.choice("the of sun moon tree river stone bird".split()) + str(rng.randrange(4)) for _ in range(n))  # noqa: E731,E501
    items = [(i, prose(rng.randrange(12, 25))) for i in range(12)]
    items += [(20, "short item here"), (21, ""), (22, None), (3, prose(15)), (23, "the the the the the the the the the the the")]
    docs = []
    for doc_id in range(30):
        words = prose(40).split()
        if doc_id % 3 == 0:
            words[5:5] = items[doc_id % 12][1].split()[:11]
        if doc_id % 5 == 0:
            words += ["Short,", "ITEM-here"]
        docs.append((doc_id, " ".join(words)))
    docs += [(40, None), (41, ""), (42, "the " * 30), (7, "short item here"), (None, items[0][1])]
    return docs, items


def expected(docs, items):
    rows = []
    for doc_id, text in docs:
        words, hit, found = contamination(text, items)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        rows.append((doc_id, words, hit, len(found), digest, hit > 0))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("most", [4 << 20, 200])
def test_equals_brute_force(spark, documents, most):
    docs, items = tables()
    frame = spark.createDataFrame(items, "item_id long, text string")
    marked = D.mark_contaminated(documents(docs).select("doc_id", "text"), frame, most=most)
    got = sorted(map(tuple, marked.drop("text").collect()), key=repr)
    assert got == expected(docs, items)


def test_drop_keeps_columns_and_clean_rows(spark):
    docs, items = tables()
    frame = spark.createDataFrame(items, "item_id long, text string")
    extra = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, n_hit string")
    clean = D.drop_contaminated(extra, frame)
    assert clean.columns == extra.columns
    want = [r[0] for r in expected(docs, items) if not r[-1]]
    assert sorted((r[0] for r in clean.collect()), key=repr) == sorted(want, key=repr)


def test_empty_tables_and_unnamed_items(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    got = D.mark_contaminated(documents([(1, "a b")]).select("doc_id", "text"), none).collect()
    assert [(r["n_words"], r["contaminated"]) for r in got] == [(2, False)]
    unnamed = spark.createDataFrame([(None, "a b"), (None, "c d")], "item_id long, text string")
    docs = documents([(1, "a b c d")]).select("doc_id", "text")
    row = D.mark_contaminated(docs, unnamed).first()
    assert (row["n_hit"], row["n_items"]) == (4, 1)
    assert D.mark_contaminated(docs.limit(0), unnamed).collect() == []


def test_prefix_is_the_rarest_word():
    index = D.build_index([("1", b"a b c")], {b"a": 9, b"b": 1, b"c": 5}, 10)
    assert list(index) == [b"b"]
    assert list(D.occurrences([b"b", b"a", b"b", b"c", b"b"], index)) == [(1, 4, {"1"})]


def test_working_names_pass_through(documents, spark):
    from pyspark.sql import functions as F

    from registrylake.llm.decontamination import mark_contaminated

    passage = " ".join(f"word{i}" for i in range(12))
    docs = documents([(1, passage), (2, "x y")]).withColumns({n: F.lit("own") for n in ("__spans", "__names", "__spans_")})
    items = spark.createDataFrame([(7, passage)], "item_id long, text string")
    marked = mark_contaminated(docs, items)
    rows = {r["doc_id"]: (r["contaminated"], r["__spans"], r["__names"], r["__spans_"]) for r in marked.collect()}
    assert rows == {1: (True, "own", "own", "own"), 2: (False, "own", "own", "own")}
