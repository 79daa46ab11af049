"""The registered queries of the subpackage on the smallest given tables."""

import hashlib
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from brute import base_spans, base_stats, cut_passages, near_components
from oracle import compare, duck

from registrylake.llm import quality_classifier, queries as llm

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.fixture(scope="module")
def given(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


def test_one_query_per_operator():
    names = list(llm.queries())
    assert [name.split("_")[0] for name in names] == [f"op{n}" for n in range(1, 14)] + ["pipeline"]
    assert set(llm.oracle_sql()) <= set(names)


@pytest.mark.parametrize("key", llm.oracle_sql())
def test_query_equals_its_sql(spark, con, key):
    assert compare(spark, con, key, str(DATA)) is None


def test_near_duplicates_and_passages_equal_brute_force(spark, given):
    got = {r["doc_id"]: r["component_id"] for r in llm.op1_minhash(spark, str(DATA)).collect()}
    assert got == near_components(given)
    cut = llm.op2_passages(spark, str(DATA))
    assert sorted(map(tuple, cut.collect()), key=repr) == cut_passages(given)


def test_counts_of_rules_and_personal_data_equal_brute_force(spark, given):
    texts = dict(given)
    for row in llm.op10_quality_rules(spark, str(DATA)).collect():
        stats = base_stats(texts[row["doc_id"]])
        assert tuple(row[1:6]) == stats
        failed = stats[0] < 50 or 100 * stats[4] > 50 * stats[0]
        assert row["base_failed"] == failed and not (failed and row["kept"])
    for row in llm.op5_pii(spark, str(DATA)).collect():
        spans = base_spans(texts[row["doc_id"]])
        joined = [f"{kind}:{start}:{end}" for start, end, kind in spans]
        for name in ("email", "ip", "card", "phone"):
            assert row[f"n_{name}"] == sum(k == name for _, _, k in spans)
        assert row["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(row["spans"].split(",")) | {""}


def test_alignment_equals_brute_force(spark, given):
    from test_token_alignment import A, B, brute

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    models = a, sentencepiece.SentencePieceProcessor(model_file=B)
    got = llm.op11_alignment(spark, str(DATA)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(models, given)


def test_token_counts_equal_the_library(spark, given):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: r for r in llm.op3_token_counts(spark, str(DATA)).collect()}
    assert len(got) == len(given)
    for doc_id, text in given:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        row = got[doc_id]
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len((text or "").encode()), n, n > 512)


def test_classifier_equals_plain_formulas(spark, given):
    out = {i for i, _ in given if zlib.crc32(str(i).encode()) % 5 == 0}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    stats = {i: np.array(quality_classifier.text_statistics(t or "")) for i, t in given}
    rows = {q: np.array([stats[i] for i in stats if i not in out and labels.get(i) == q]) for q in (0, 1)}
    n = sum(map(len, rows.values()))
    spread = {q: np.cov(x.T, bias=True) for q, x in rows.items()}
    pooled = sum(len(x) * spread[q] for q, x in rows.items()) / n

    def density(q, x):
        own = 0.9 * spread[q] + 0.1 * pooled
        own = 0.9 * own + 0.1 * np.diag(np.diag(own)) + 1e-4 * np.eye(len(x))
        d = x - rows[q].mean(axis=0)
        return np.log(len(rows[q]) / n) - 0.5 * (d @ np.linalg.inv(own) @ d + np.linalg.slogdet(own)[1])

    for row in llm.op6_quality_classifier(spark, str(DATA)).collect():
        x = stats[row["doc_id"]]
        score = 1 / (1 + np.exp(np.clip(density(0, x) - density(1, x), -60, 60)))
        assert row["score"] == pytest.approx(score, abs=1e-6)
        assert row["held_out"] == (row["doc_id"] in out) and row["predicted"] == int(row["score"] >= 0.3)
