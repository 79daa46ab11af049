import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from registrylake.llm import token_alignment as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_table():
    keep = list(range(ord("!"), ord("~") + 1)) + list(range(0xA1, 0xAD)) + list(range(0xAE, 0x100))
    table, extra = {}, 0
    for b in range(256):
        if b in keep:
            table[chr(b)] = b
        else:
            table[chr(256 + extra)] = b
            extra += 1
    return table


def plain_groups(models, text):
    """Lists of (A ids, B ids), by whole-text encoding and sets of ends."""
    a, b = models
    if not text:
        return []
    table = byte_table()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    spelled_a = [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a]
    ids_b = b.encode(text)
    spelled_b = []
    for i in ids_b:
        piece = b.id_to_piece(i)
        spelled_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    want = (" " + text).encode()
    if b"".join(spelled_a) != want or b"".join(spelled_b) != want:
        return []
    groups, i, j, x, y = [([], [])], 0, 0, 0, 0
    while i < len(ids_a) or j < len(ids_b):
        if x == y and i:
            groups.append(([], []))
        if x <= y:
            x += len(spelled_a[i])
            groups[-1][0].append(ids_a[i])
            i += 1
            if x == y:
                continue
        while y < x:
            y += len(spelled_b[j])
            groups[-1][1].append(ids_b[j])
            j += 1
    return groups


def brute(models, docs):
    found = [(doc_id, plain_groups(models, text)) for doc_id, text in docs]
    links = [Counter((a, b) for x, y in groups for a in x for b in y) for _, groups in found]
    count = Counter(pair for one in links for pair in one)
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    rows = []
    for (doc_id, groups), one in zip(found, links):
        spelled = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append(
            (
                doc_id,
                sum(len(x) for x, _ in groups),
                sum(len(y) for _, y in groups),
                len(groups),
                sum(one.values()),
                sum(n for p, n in one.items() if count[p] == most[p[0]]),
                sum(n * count[p] for p, n in one.items()),
                hashlib.sha256(spelled.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(rows, key=repr)


def run(spark, docs, **options):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted(map(tuple, ta.align(df, A, B, **options).collect()), key=repr)


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "the cat\nsat  on\tthe mat. ", "<|endoftext|> x", "<s>a</s>",
    "▁x", "a▁ b", "it's 's we'll", "naïve café ﬁ ½", "東京 都 and 大阪", "é ​ x y 　 z", "\x00 \x01\x1c b",
    "🙂 🙂🙂", "﻿start", "x" * 3000, "ab" * 900 + " " + "1234567890" * 50, " \n \n ", "᠎ a", "q r s",
]


def prose(n, seed):
    draw = random.Random(seed)
    words = ["the", "Registry", "of", "kompanien,", "über", "12,500", "été", "x" * 30, "\n\n", "", "it's", "(a)", "東京"]
    return [(i, " ".join(draw.choices(words, k=draw.randint(1, 60)))) for i in range(n)]


def test_equals_brute_force(spark, models):
    docs = [*prose(60, 1), *[(100 + i, t) for i, t in enumerate(ODD)], (None, "the cat"), (3, "the cat"), (3, "the cat")]
    want = brute(models, docs)
    assert run(spark, docs) == want
    # With little or no room most pairs go by the shuffle.
    assert run(spark, docs, room=40) == want
    assert run(spark, docs, room=0) == want


def test_empty_table_and_clashing_columns(spark, models):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "")]) == brute(models, [(1, None), (2, "")])
    docs = prose(12, 2)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for name in ("row", "pairs", "links", "pair", "n", "best", "n_a", "miss"):
        df = df.withColumn(name, F.lit("x"))
    assert sorted(map(tuple, ta.align(df, A, B, room=3).collect()), key=repr) == brute(models, docs)


def test_groups_of_documents(spark, models):
    docs = [*prose(10, 3), *[(100 + i, t) for i, t in enumerate(ODD)]]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = defaultdict(list)
    for row in ta.token_groups(df, A, B).orderBy("doc_id", "group").collect():
        found[row["doc_id"]].append(row)
    for doc_id, text in docs:
        rows = found[doc_id]
        assert [(r["a"], r["b"]) for r in rows] == plain_groups(models, text)
        assert [r["group"] for r in rows] == list(range(len(rows)))
        if rows:
            assert rows[0]["start"] == 0 and rows[-1]["stop"] == len((" " + text).encode())
            assert all(x["stop"] == y["start"] for x, y in zip(rows, rows[1:]))


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64, 1 << 16])
def test_pieces_give_the_shared_ends(piece):
    draw = random.Random(piece)
    for n in (0, 1, 2, 40):
        for _ in range(60):
            a, b = (np.array(sorted(draw.sample(range(60), draw.randint(0, n))), np.int64) for _ in "ab")
            i, j = ta.cuts(a, b, piece)
            assert a[i].tolist() == sorted(set(a.tolist()) & set(b.tolist())) == b[j].tolist()
            at_a, at_b = ta.diagonal_splits(a, b, piece)
            sizes = np.diff(at_a + at_b)
            assert (sizes[:-1] == piece).all() and at_a[-1] == len(a) and at_b[-1] == len(b)


def test_division_and_long_texts(models, monkeypatch):
    encoder = ta.ready(ta.vocabularies(A, B))[0]
    assert encoder.divides
    texts = [t for t in ODD if t] + [t for _, t in prose(40, 5)] + [" ".join(t for _, t in prose(300, 6))]
    whole = ta.ready(ta.vocabularies(A, B))[0]
    whole.divides = False
    for stretch, kept in ((1 << 20, 1 << 18), (50, 3)):
        monkeypatch.setattr(ta, "_STRETCH", stretch)
        monkeypatch.setattr(ta, "_KEPT", kept)
        for text in texts:
            got, want = encoder.encode(text), whole.encode(text)
            assert (got is None) == (want is None)
            assert got is None or all((x == y).all() and len(x) == len(y) for x, y in zip(got, want))


def test_other_vocabularies_are_not_divided(models):
    spec = json.loads(models[0].to_str())
    assert ta.divides(models[0]) and ta.b_divides(models[1])
    spec["normalizer"] = {"type": "Lowercase"}
    assert not ta.divides(Tokenizer.from_str(json.dumps(spec)))
    assert not ta.divides(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")))


def test_links_of_large_groups():
    draw = np.random.default_rng(1)
    size_a, size_b = np.array([1, 90, 2, 5]), np.array([3, 70, 1, 1])
    a, b = draw.integers(0, 9, size_a.sum()).astype(np.int32), draw.integers(0, 7, size_b.sum()).astype(np.int32)
    groups = ta.Groups(a, b, size_a, size_b, np.array([0, 91, 98]), np.array([0, 73, 75]), np.array([0, 2, 4]))
    want = Counter()
    x = y = 0
    for g, (m, n) in enumerate(zip(size_a, size_b)):
        want.update((g // 2, int(i) * 7 + int(j)) for i in a[x : x + m] for j in b[y : y + n])
        x, y = x + m, y + n
    for most in (1, 5, 100, 1 << 20):
        text, pair, links = ta.pair_links(groups, 7, most)
        assert dict(zip(zip(text.tolist(), pair.tolist()), links.tolist())) == want
