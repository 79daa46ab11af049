import itertools
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from registrylake.llm import filter_audit
from registrylake.llm.filter_audit import audit, text_mask

COLUMNS = [
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
    "toxic_lost", "shapley",
]


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
    )


def brute(docs, labels):
    """All rows, by going through every order document by document."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    parts = defaultdict(list)
    for doc_id, text, lang in docs:
        twin = doc_id is not None and any(
            other is not None and other < doc_id and (t or "") == (text or "") for other, t, _ in docs
        )
        failed = {c for c, bad in zip("ABCDE", (*fails(text or ""), twin)) if bad}
        known = doc_id is not None
        parts[lang or ""].append((failed, known and doc_id in good, known and doc_id in toxic))
    rows, shapley = [], defaultdict(int)
    for part, members in parts.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            there = members
            for step, letter in enumerate(order, 1):
                gone = [m for m in there if letter in m[0]]
                there = [m for m in there if letter not in m[0]]
                failing = [m for m in members if letter in m[0]]
                shapley[part, letter] += len(gone)
                rows.append(
                    (part, order, step, len(there), len(gone), len(failing) - len(gone),
                     sum(m[0] == {letter} for m in members), sum(m[1] for m in gone), sum(m[2] for m in gone))
                )
    return sorted((*row, shapley[row[0], row[1][row[2] - 1]]) for row in rows)


def run(spark, docs, labels, extra=()):
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    k = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for name in extra:
        d, k = d.withColumn(name, F.lit("x")), k.withColumn(name, F.lit("y"))
    found = audit(d, k)
    assert found.columns == COLUMNS
    kinds = [t for _, t in found.dtypes]
    assert kinds == ["string", "string", "int"] + ["bigint"] * 7
    return sorted(map(tuple, found.collect()))


def some_documents(n, seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(n):
        few = draw.choice([words, words[:60]])
        text = draw.choice([" ", "\n", "\t "]).join(draw.choices(few, k=draw.choice([20, 99, 100, 130])))
        text = text.upper() if draw.random() < 0.2 else text
        text += draw.choice(["", "", " #tag", " 5%"])
        if docs and draw.random() < 0.3:
            text = draw.choice(docs)[1]
        docs.append((i, text, draw.choice(["en", "de", None])))
    draw.shuffle(docs)
    labels = [(i, draw.choice([0, 1, None]), draw.choice([0, 1, None])) for i in range(0, n, 2)]
    return docs, labels


def test_equals_brute_force(spark):
    docs, labels = some_documents(150, 1)
    assert run(spark, docs, labels) == brute(docs, labels)


def test_nulls_repeats_ties_and_clashing_columns(spark):
    docs = [
        (5, None, "en"), (3, "", "en"), (None, "", "en"), (None, None, None), (7, "same", "de"),
        (7, "same", "de"), (8, "same", "fr"), (6, "x" * 50, ""), (2, " \n\t", None),
    ]
    labels = [(3, 1, 0), (3, 0, 1), (None, 1, 1), (8, None, 1), (99, 1, 1)]
    extra = ["part", "mask", "digest", "first", "n", "good", "step", "prefix", "__shuffle_key"]
    assert run(spark, docs, labels, extra) == brute(docs, labels)


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    docs, _ = some_documents(10, 2)
    assert run(spark, docs, []) == brute(docs, [])


def test_masks_of_long_texts_and_borders(monkeypatch):
    draw = random.Random(3)
    texts = ["", " ", "A", "aA" * 5, "é" * 9 + "A", "é" * 10 + "A", "a\xa0b " * 100, "w " * 99, "|"]
    texts += [t for _, t, _ in some_documents(60, 4)[0]]
    texts += ["".join(draw.choices("aB c\n#\x0b\x0c\x1c", k=300)) for _ in range(60)]
    for long in (1 << 22, 0):
        monkeypatch.setattr(filter_audit, "_LONG", long)
        for text in texts:
            assert text_mask(text.encode()) == sum(b << i for i, b in enumerate(fails(text)))


def test_recursion_covers_all_prefixes_once(spark):
    masks = spark.createDataFrame([(0,), (31,)], "mask int")
    rows = filter_audit.prefixes(masks).collect()
    want = [p for n in range(1, 6) for p in map("".join, itertools.permutations("ABCDE", n))]
    assert sorted((r["prefix"], r["mask"]) for r in rows) == sorted((p, m) for p in want for m in (0, 31))
    for row in rows:
        assert row["applied"] == sum(1 << "ABCDE".index(c) for c in row["prefix"][:-1])
        assert row["prefix"][-1] == row["letter"] and row["step"] == len(row["prefix"])
