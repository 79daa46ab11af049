"""Token counts of whole texts by a two-tier lookup of pre-token lengths.

A byte-level BPE encodes each pre-token by itself, so a text has as many tokens as its
pre-tokens together. The first tier is broadcast: the vocabulary strings that are a
pre-token of their own, the most frequent ones of the tokenizer's own corpus, with their
lengths; its size is bound by the vocabulary. Other pre-tokens are encoded once per worker
and remembered in a second tier that is emptied when full. Nothing is shuffled.

The library that the vocabulary file is made for does all encoding. Splitting is left to it
as well for texts with a character that Unicode 3.2 does not know, because later versions
are not the same everywhere, for texts that hold a special string, and for all texts if the
vocabulary file splits or changes texts in another way.

Defined results
- A NULL text counts as empty: no bytes, no tokens.
- Rows are judged one by one; repeated rows, NULL or repeated ids change nothing.
- Other columns pass through; one that has the name of an added column is replaced.
- Empty tables give empty results.
"""

from __future__ import annotations

import json
import pickle
import unicodedata
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T
from tokenizers import Tokenizer

from registrylake.llm.shingles import small_batches

#: Fixed value: the published pattern that splits text before byte-level merges.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Texts of more characters are split piece by piece, never into one list.
_LONG = 1 << 20
#: Pre-tokens of more characters are encoded each time they occur.
_LONGEST_KEPT = 64

_ADDED = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("over_limit", T.BooleanType()),
]


def divides(tokenizer: Tokenizer) -> bool:
    """Whether pre-tokens split by ``PIECES`` are encoded as in the whole text."""
    spec = json.loads(tokenizer.to_str())
    before = spec["pre_tokenizer"] or {}
    return (
        spec["normalizer"] is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
        and spec["model"].get("type") == "BPE"
        and not spec["model"].get("dropout")
        and all(token["special"] for token in spec["added_tokens"])
    )


class PieceLengths(dict):
    """Tokens per pre-token: the broadcast table, and what this worker met besides."""

    def __init__(self, tokenizer: Tokenizer, frequent: dict[str, int], room: int = 1 << 18):
        super().__init__(frequent)
        self._tokenizer, self._frequent = tokenizer, frequent
        self._most = len(frequent) + room

    def __missing__(self, piece: str) -> int:
        n = len(self._tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= _LONGEST_KEPT:
            if len(self) >= self._most:
                self.clear()
                self.update(self._frequent)
            self[piece] = n
        return n


class TokenCounter:
    """Counts tokens as the library gives them, without added special tokens."""

    def __init__(self, tokenizer: Tokenizer, frequent: dict[str, int], apart: bool = True):
        self._tokenizer, self._apart = tokenizer, apart
        self._lengths = PieceLengths(tokenizer, frequent)
        self._special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self._pieces = regex.compile(PIECES)
        self._known: set[str] = set()

    def _old(self, text: str) -> bool:
        """Whether Unicode 3.2 knows all characters."""
        new = set(text) - self._known
        category = unicodedata.ucd_3_2_0.category
        if any(category(char) == "Cn" for char in new):
            return False
        self._known |= new
        return True

    def count(self, text: str) -> int:
        old = self._apart and (text.isascii() or self._old(text))
        if not old or any(s in text for s in self._special):
            return len(self._tokenizer.encode(text, add_special_tokens=False).ids)
        pieces: Iterable[str]
        if len(text) > _LONG:
            pieces = (match[0] for match in self._pieces.finditer(text))
        else:
            pieces = self._pieces.findall(text)
        return sum(map(self._lengths.__getitem__, pieces))


def frequent_lengths(tokenizer: Tokenizer) -> dict[str, int]:
    """Lengths of the vocabulary strings that are one pre-token; at most the vocabulary."""
    special = {token.content for token in tokenizer.get_added_tokens_decoder().values()}
    texts = [tokenizer.decode([i], skip_special_tokens=False) for i in range(tokenizer.get_vocab_size())]
    whole = regex.compile(PIECES)
    texts = [t for t in texts if t and "�" not in t and t not in special and whole.findall(t) == [t]]
    encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
    return {text: len(one.ids) for text, one in zip(texts, encoded, strict=True)}


def read_tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a vocabulary file, without truncation or padding."""
    tokenizer = Tokenizer.from_str(Path(path).read_text(encoding="utf-8"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """The documents with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    ``path`` names the vocabulary file on the driver; tasks get its content and the lengths
    of frequent pre-tokens as one broadcast, whose size the vocabulary bounds.
    """
    tokenizer = read_tokenizer(path)
    shared = docs.sparkSession.sparkContext.broadcast(
        pickle.dumps((tokenizer.to_str(), frequent_lengths(tokenizer), divides(tokenizer)))
    )
    added = [field.name for field in _ADDED]
    columns = [name for name in docs.columns if name not in added]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, frequent, apart = pickle.loads(shared.value)
        counter = TokenCounter(Tokenizer.from_str(vocabulary), frequent, apart)
        for batch in small_batches(batches, "text"):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            tokens = [counter.count(text) for text in texts]
            sizes = [len(text.encode()) for text in texts]
            more = [
                pa.array(sizes, pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ]
            kept = [batch.column(name) for name in columns]
            yield pa.RecordBatch.from_arrays(kept + more, columns + added)

    kept = [docs.schema[name] for name in columns]
    return docs.select(columns).mapInArrow(count, T.StructType(kept + _ADDED))
