import random

from brute import base_spans, contamination, near_components

import corpus_pipeline
from registrylake.llm import pii
from registrylake.llm.mixing import mix

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def corpus():
    """Documents by what should become of them."""
    rng = random.Random(11)
    prose = lambda: " ".join(
        rng.choice("river stone bird tree light road house garden winter summer".split())
        + rng.choice("abcdefgh") + rng.choice("klmnop") for _ in range(rng.randrange(60, 120))
    )
    clean = [(i, prose() + ".", f"s{i % 3}") for i in range(30)]
    copies = [(100 + i, clean[i][1] + (" end" if i % 2 else ""), "s0") for i in range(6)]
    junk = [(200 + i, " ".join(w + "$$$" for w in prose().split()), "s1") for i in range(4)]
    junk += [(210, "too short", "s1"), (211, None, "s1"), (212, "again " * 80, None)]
    leaked = [(300 + i, f"{prose()} {ITEM} {prose()}", "s2") for i in range(3)]
    private = [(400, f"{prose()} write ann@mail.example.com or +1 (017) 555-7713 {prose()}", None)]
    return clean, copies, junk, leaked, private


def test_stages_and_run(spark, tmp_path):
    clean, copies, junk, leaked, private = corpus()
    rows = [(*r[:2], "en", r[2], len(r[1] or "")) for r in sum(corpus(), [])]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(1, ITEM), (2, "not in there at all")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")

    left = {r[0] for r in rows}
    texts = {r[0]: r[1] for r in rows}
    current = docs
    for (name, stage), gone in zip(corpus_pipeline.STAGES[:4], (junk, copies, leaked, [])):
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns, name
        left -= {r[0] for r in gone}
        got = current.collect()
        assert {r["doc_id"] for r in got} == left, name
        current = spark.createDataFrame(got, schema)
    # The brute-force versions agree with what was planted.
    kept = [(i, texts[i]) for i in left | {r[0] for r in copies + leaked}]
    first = near_components(kept)
    assert {i for i, c in first.items() if i != c} == {r[0] for r in copies}
    assert {i for i, t in kept if contamination(t, [(1, ITEM)])[1]} == {r[0] for r in leaked}
    for row in current.collect():
        assert not base_spans(row["text"]) and row["n_chars"] == len(row["text"])
        assert row["text"] == pii.redacted(texts[row["doc_id"]], pii.all_spans(texts[row["doc_id"]])[1])
    assert "[EMAIL]" in current.where("doc_id = 400").first()["text"]

    copies_of = {r["doc_id"]: r["copies"] for r in mix(current).collect()}
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(mixed) == sum(copies_of.values())
    assert {r["doc_id"] for r in mixed} == {i for i, n in copies_of.items() if n} <= left


def test_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept int"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_near_duplicates_from_80_percent_go(spark):
    rng = random.Random(3)
    rows, left = [], set()
    for k in range(20):
        words = [f"p{k}w{rng.randrange(10_000)}" for _ in range(104)]
        # One word changes 5 of 100 shingles: two leave 90 of 110, three 85 of 115.
        for n, places in enumerate(((), (20, 60) if k % 2 else (20, 50, 80))):
            text = " ".join("changed" if i in places else w for i, w in enumerate(words))
            rows.append((2 * k + n, text, "en", "s", len(text)))
        left |= {2 * k} if k % 2 else {2 * k, 2 * k + 1}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    first = near_components([r[:2] for r in rows], 80)
    assert kept == left == {i for i, c in first.items() if i == c}
