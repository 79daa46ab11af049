"""Benchmark passages in documents, by a prefix-filtered join of word windows.

A benchmark item is the set of its windows of 10 consecutive words; an item of fewer words,
but not none, is one window. Words of the benchmark are ordered by how rare they are in all
documents. A window can only occur where its rarest word, its prefix, occurs, so this word
and its offset in the window are the index. Each document looks its words up, takes the
windows that the offset and the length leave room for, and compares them word by word.

The items are the query set, the documents stay where they are: nothing is shuffled but the
counts of benchmark words. The index is broadcast in blocks of at most ``BLOCK_BYTES`` of
item text; a larger benchmark takes one pass over the documents per block.

Defined results
- NULL or empty texts have no words: nothing occurs in them, they occur nowhere.
- Items with the same id are one item; items without id are one item with an empty name.
- Rows of documents are judged one by one, so repeated rows and NULL ids change nothing.
- An empty benchmark leaves every document clean; empty documents give an empty result.
- Other columns pass through; one that has the name of an added column is replaced.
"""

from __future__ import annotations

import hashlib
import pickle
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from registrylake.llm.shingles import byte_texts, small_batches
from registrylake.llm.naming import set_aside
from registrylake.tables.work import staged

WINDOW_WORDS = 10
BLOCK_BYTES = 4 << 20

#: A-Z to a-z, all other ASCII but digits and letters to space; other bytes stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

_ADDED = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
]
_ADDED_NAMES = [field.name for field in _ADDED]
_CARRIED = [
    T.StructField("__spans", T.ArrayType(T.LongType())),
    T.StructField("__names", T.ArrayType(T.StringType())),
]


def words_of(text: bytes) -> list[bytes]:
    """Runs of digits, letters a-z and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_FOLD).split()


def windows_of(words: list[bytes], size: int = WINDOW_WORDS) -> set[tuple[bytes, ...]]:
    width = min(size, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def build_index(items: list[tuple[str, bytes]], counts: dict[bytes, int], size: int) -> dict:
    """``rarest word -> [(offset, length, {window: item names})]``."""
    index: dict = {}
    for name, text in items:
        for window in windows_of(words_of(text), size):
            word = min(window, key=lambda w: (counts.get(w, 0), w))
            slots = index.setdefault(word, {})
            found = slots.setdefault((window.index(word), len(window)), {})
            found.setdefault(window, set()).add(name)
    return {
        word: [(*slot, found) for slot, found in slots.items()] for word, slots in index.items()
    }


def occurrences(words: list[bytes], index: dict) -> Iterator[tuple[int, int, set[str]]]:
    """``start, end, items`` of every window of the index in a text, by word positions."""
    n = len(words)
    for at, word in enumerate(words):
        if word in index:
            for offset, length, windows in index[word]:
                start = at - offset
                if start >= 0 and start + length <= n:
                    names = windows.get(tuple(words[start : start + length]))
                    if names:
                        yield start, start + length, names


def _counting(vocabulary):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = pickle.loads(vocabulary.value), Counter()
        for batch in small_batches(batches, "text"):
            for text in byte_texts(batch.column("text")):
                counts.update(filter(known.__contains__, words_of(text)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            ["word", "n"],
        )

    return count


def _scanning(shared, size: int, columns: list[str], last: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = build_index(*pickle.loads(shared.value), size)
        for batch in small_batches(batches, "text"):
            spans, names = [], []
            before = zip(batch.column("__spans").to_pylist(), batch.column("__names").to_pylist())
            added = []
            for text, (old_spans, old_names) in zip(byte_texts(batch.column("text")), before):
                words = words_of(text)
                here, found = set(old_spans or ()), set(old_names or ())
                for start, end, items in occurrences(words, index):
                    here.add(start << 32 | end)
                    found |= items
                if not last:
                    spans.append(sorted(here))
                    names.append(sorted(found))
                    continue
                hit = bytearray(len(words))
                for span in here:
                    start, end = span >> 32, span & 0xFFFFFFFF
                    hit[start:end] = b"\x01" * (end - start)
                digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
                added.append((len(words), sum(hit), len(found), digest, bool(here)))
            kept = [batch.column(name) for name in columns]
            if last:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
                more = [pa.array(c, k) for c, k in zip(zip(*added), kinds)]
                yield pa.RecordBatch.from_arrays(kept + more, columns + _ADDED_NAMES)
            else:
                more = [pa.array(spans, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(kept + more, [*columns, "__spans", "__names"])

    return scan


def benchmark_blocks(items: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of about ``most`` bytes of text, one after another."""
    named = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"),
        F.col("text").cast("binary").alias("text"),
    ).where("text IS NOT NULL")
    size = named.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("name")), F.lit(0)))
    blocks = max(1, -(-size.first()[0] // most))
    for block in range(blocks):
        rows = named.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == block).collect()
        yield [(row["name"], bytes(row["text"])) for row in rows]


def mark_contaminated(
    docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS, most: int = BLOCK_BYTES
) -> DataFrame:
    """The documents with ``n_words, n_hit, n_items, items_sha256, contaminated``.

    ``docs`` has ``text``; ``items`` has ``item_id`` and ``text``. A word is hit when an
    occurrence of any window covers it; ``n_items`` counts the items with a window that
    occurs, and ``items_sha256`` is the hash of their ids, sorted as strings and joined by
    commas. A document with a word hit is contaminated.
    """
    context = docs.sparkSession.sparkContext
    docs = docs.select([name for name in docs.columns if name not in _ADDED_NAMES])
    docs, own = set_aside(docs, [field.name for field in _CARRIED])
    columns = docs.columns
    marked = docs.select(
        *columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in _CARRIED]
    )
    kept = [docs.schema[name] for name in columns]
    blocks = list_ahead(benchmark_blocks(items, most))
    for block, last in blocks:
        known = {word for _, text in block for word in words_of(text)}
        vocabulary = context.broadcast(pickle.dumps(known))
        counted = docs.select("text").mapInArrow(_counting(vocabulary), "word binary, n long")
        counts = {
            bytes(row["word"]): row["n"]
            for row in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()
        }
        shared = context.broadcast(pickle.dumps((block, counts)))
        schema = T.StructType(kept + (_ADDED if last else _CARRIED))
        marked = marked.mapInArrow(_scanning(shared, size, columns, last), schema)
        if not last:
            marked = staged(marked)
    return marked.withColumnsRenamed(own)


def list_ahead(items: Iterator) -> Iterator[tuple]:
    """Each item, and whether it is the last one."""
    items = iter(items)
    item = next(items)
    for following in items:
        yield item, False
        item = following
    yield item, True


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs, with their columns."""
    whole = docs.select(F.struct("*").alias("doc"), "text")
    clean = mark_contaminated(whole, items).where("NOT contaminated")
    return clean.select([F.col(f"doc.`{name}`").alias(name) for name in docs.columns])
