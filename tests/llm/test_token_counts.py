import public_tokenizers
import pytest

from registrylake.llm import token_counts as K

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", "a", " ", "  x\n\n y", "it's we'll  I'd don't\t\tx", "a<|endoftext|>b <|endoftext|>", "<|endoftext|",
    "😀 ok 😀😀", "՘a֋b", "x\x1c y\x85z\xa0 q\u2003r", "ab" * 3000, " " * 999, "漢字かな 123４５", "\r\n\r\n", "é" * 70,
    "word " * 2000, "\x00\x01", "⁏ ₟ \u0558", "#!/usr/bin 0x1F_a1", "\ud7ff\ue000",
]


@pytest.fixture(scope="module")
def tokenizer():
    return K.read_tokenizer(PATH)


def test_counts_equal_the_library(spark, documents, tokenizer):
    docs = documents(list(enumerate(TEXTS)) + [(900, None), (None, "a b"), (900, None)])
    for row in K.count_tokens(docs, PATH, limit=5).collect():
        text = row["text"] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(text.encode()), n, n > 5)


def test_names_clash_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", "old")], "doc_id long, text string, n_tokens string")
    counted = K.count_tokens(docs, PATH)
    assert counted.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
    assert tuple(counted.first()) == (1, "a b", 3, 2, False)
    assert K.count_tokens(docs.limit(0), PATH).collect() == []


def test_second_tier_is_bounded_and_first_stays(tokenizer):
    lengths = K.PieceLengths(tokenizer, {"a": 1}, room=3)
    for piece in [" qx", " zy", " kj", " vw", "a"]:
        assert lengths[piece] == len(tokenizer.encode(piece).ids)
        assert len(lengths) <= 5 and "a" in lengths
    assert lengths["z" * 100] and "z" * 100 not in lengths


def test_long_texts_are_split_piecewise(tokenizer, monkeypatch):
    counter = K.TokenCounter(tokenizer, K.frequent_lengths(tokenizer))
    text = "some words, and 12 more; " * 50
    whole = counter.count(text)
    monkeypatch.setattr(K, "_LONG", 10)
    assert counter.count(text) == whole


def test_first_tier_holds_true_lengths(tokenizer):
    frequent = K.frequent_lengths(tokenizer)
    assert 30_000 < len(frequent) <= tokenizer.get_vocab_size()
    assert frequent[" the"] == 1 and "<|endoftext|>" not in frequent


def test_a_vocabulary_that_splits_otherwise_is_left_to_the_library(documents):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = K.read_tokenizer(path)
    assert not K.divides(tokenizer)
    texts = ["Hello  World, it's 12,500 ÉTÉ!", "", "naïve\n\nlines"]
    got = {r["doc_id"]: r["n_tokens"] for r in K.count_tokens(documents(list(enumerate(texts))), path).collect()}
    assert got == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
