"""Token groups that two tokenizers agree on, and how token pairs are linked corpus-wide.

A text is encoded by a byte-level BPE (A) and by a piece model (B). Tokens of both end at byte
offsets; offsets where both end cut the text into groups. Finding them is a merge of two
sorted lists of ends, and is done as a merge path: binary searches along diagonals divide the
merge into pieces of equal work, whatever texts the ends belong to. Each piece finds the ends
that both lists share within it. A shared end that a diagonal divides is found by comparing the
two sides of the border; the cuts of all pieces in order give the groups, also those that run
over several pieces.

Encoding: a text is divided at single spaces between other characters. No pre-token of A and
no merge of B reaches over such a place (both vocabularies are tested for that, otherwise
whole texts are encoded), so each part is encoded once per worker and remembered.

Links are all A-B pairs of a group. A document's pairs are written once, with how often they
occur. Counts per pair are summed within tasks before their shuffle. Documents then look up the
counts: those of the most frequent pairs, ``ROOM`` at most, are broadcast; only other pairs are
shuffled, and none of them is frequent.

Defined results
- A NULL or empty text has no tokens, nor has one whose tokens do not spell a space and the
  text: all counts are 0 and the hash is ''.
- Every row counts as a document, repeated ones and those without doc_id as well.
- Empty tables give empty results. Other columns play no part, whatever their names.
- A very long text is encoded in parts and merged in pieces; a group too large to list its
  links is counted by its distinct ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window, functions as F, types as T
from tokenizers import Tokenizer

from registrylake.llm.shingles import small_batches
from registrylake.llm.token_counts import divides, read_tokenizer
from registrylake.tables.work import staged

#: Steps of the merge in a piece, links listed at a time, pairs whose counts are broadcast.
PIECE = 1 << 16
LINKS = 1 << 20
ROOM = 1 << 18
#: Bytes of text handled at a time.
_BATCH = 1 << 20
#: Characters of a part that is remembered, parts in a generation, characters divided at a time.
_LONGEST_KEPT, _KEPT, _STRETCH = 64, 1 << 18, 1 << 20

_SPACE = "▁"
_DIVISION = re.compile(r"(?<=\S) (?=\S)")


# Vocabularies


def byte_letters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary.

    Printable bytes stand for themselves, the others follow from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def bytes_of_a(tokenizer: Tokenizer) -> list[bytes]:
    letters = byte_letters()
    spelled = [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        plain = all(c in letters for c in token)
        spelled[i] = bytes(letters[c] for c in token) if plain else token.encode()
    return spelled


def bytes_of_b(model: sentencepiece.SentencePieceProcessor) -> list[bytes]:
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    byte = re.compile("<0x([0-9A-F]{2})>")
    return [
        bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace(_SPACE, " ").encode()
        for p in pieces
    ]


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, message[at : at + size]
        at += size


def b_divides(model: sentencepiece.SentencePieceProcessor) -> bool:
    """Whether B encodes the parts of a text as it encodes the whole.

    It merges pairs, adds a space in front, leaves characters as they are, and no piece holds
    a space after another character.
    """
    outer = dict(_fields(model.serialized_model_proto()))
    # Fixed values, the published numbers of the fields: 2 is the trainer (3 kind of model,
    # 24 spaces as suffix), 3 the normalizer (2 character map, 3 space in front, 4 spaces
    # removed, 5 spaces marked).
    trainer, normalizer = (dict(_fields(outer.get(n, b""))) for n in (2, 3))
    return (
        trainer.get(3, 1) == 2
        and not trainer.get(24, 0)
        and not normalizer.get(2, b"")
        and bool(normalizer.get(3, 1))
        and not normalizer.get(4, 1)
        and bool(normalizer.get(5, 1))
        and not any(
            _SPACE in model.id_to_piece(i).lstrip(_SPACE) for i in range(model.vocab_size())
        )
    )


class Encoder:
    """Ids of both tokenizers for texts.

    Parts of texts are remembered, in two generations: when the newer one is full it replaces
    the older one, so parts that keep occurring stay. A part has its ids by A and B, as bytes
    of 32-bit numbers, and whether both spell a space and the part.
    """

    def __init__(self, a: str, b: bytes):
        self._a = Tokenizer.from_str(a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.bytes_a, self.bytes_b = bytes_of_a(self._a), bytes_of_b(self._b)
        tables = self.bytes_a, self.bytes_b
        self.lengths = tuple(np.array([*map(len, t)], np.int64) for t in tables)
        self.divides = divides(self._a) and b_divides(self._b)
        self._new: dict[str, tuple[bytes, bytes, bool]] = {}
        self._old: dict[str, tuple[bytes, bytes, bool]] = {}

    def _whole(self, text: str) -> tuple[list[int], list[int], bool]:
        a = self._a.encode(" " + text, add_special_tokens=False).ids
        b = self._b.encode(text)
        spelled = (" " + text).encode()
        same = (
            b"".join(map(self.bytes_a.__getitem__, a)) == spelled
            and b"".join(map(self.bytes_b.__getitem__, b)) == spelled
        )
        return a, b, same

    def _encoded(self, text: str) -> tuple[bytes, bytes, bool]:
        a, b, same = self._whole(text)
        return np.array(a, np.int32).tobytes(), np.array(b, np.int32).tobytes(), same

    def _together(self, parts: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """Parts without spaces at their ends, encoded as one text and taken apart again."""
        *ids, same = self._whole(" ".join(parts))
        stops = np.cumsum([len(part.encode()) + 1 for part in parts])
        sides = []
        for numbers, lengths in zip(ids, self.lengths, strict=True):
            numbers = np.array(numbers, np.int32)
            ends = np.cumsum(lengths[numbers])
            at = np.searchsorted(ends, stops)
            if not same or (ends[at] != stops).any():
                return [self._encoded(part) for part in parts]
            raw, bounds = numbers.tobytes(), [0, *(4 * (at + 1)).tolist()]
            sides.append([raw[x:y] for x, y in zip(bounds, bounds[1:])])
        return [(x, y, True) for x, y in zip(*sides, strict=True)]

    def _looked_up(self, parts: list[str]) -> list[tuple[bytes, bytes, bool]]:
        found = list(map(self._new.get, parts))
        if None not in found:
            return found
        if len(self._new) >= _KEPT:
            self._old, self._new = self._new, {}
        missing = dict.fromkeys(part for part, ids in zip(parts, found) if ids is None)
        more = {part: self._old.get(part) for part in missing}
        unknown = [part for part, ids in more.items() if ids is None]
        clean = [part for part in unknown if part == part.strip()]
        if clean:
            more.update(zip(clean, self._together(clean), strict=True))
        more.update((part, self._encoded(part)) for part in unknown if more[part] is None)
        self._new.update(item for item in more.items() if len(item[0]) <= _LONGEST_KEPT)
        return [more[part] if ids is None else ids for part, ids in zip(parts, found)]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids by A and B, or None if there are no tokens by definition."""
        if not text:
            return None
        if self.divides and _SPACE not in text:
            found = [f for stretch in stretches(text) for f in self._looked_up(_DIVISION.split(stretch))]
        else:
            found = [self._encoded(text)]
        a, b = (np.frombuffer(b"".join([f[i] for f in found]), np.int32) for i in (0, 1))
        if not all([f[2] for f in found]):
            # Parts that differ could still spell the whole.
            spelled = (" " + text).encode()
            for ids, table in ((a, self.bytes_a), (b, self.bytes_b)):
                if b"".join(map(table.__getitem__, ids.tolist())) != spelled:
                    return None
        return a, b


def stretches(text: str) -> Iterator[str]:
    """A text in stretches of bounded size, where it can be divided."""
    start = 0
    while len(text) - start > _STRETCH and (cut := _DIVISION.search(text, start + _STRETCH)):
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text


# Merge path


def diagonal_splits(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two sorted arrays stands after every ``piece`` steps, and at its end.

    One binary search per diagonal, all at once; of equal values that of ``a`` comes first.
    """
    steps = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        m, d = middle[open_], steps[open_]
        first = a[m] <= b[d - 1 - m]
        low[open_] = np.where(first, m + 1, low[open_])
        high[open_] = np.where(first, high[open_], m)
    return low, steps - low


def shared_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the values that both arrays of a piece hold."""
    at = np.searchsorted(b, a)
    same = np.flatnonzero(at < len(b))
    same = same[b[at[same]] == a[same]]
    return same, at[same]


def cuts(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the ends that ``a`` and ``b`` share, in order; both ascend strictly."""
    at_a, at_b = diagonal_splits(a, b, piece)
    parts = []
    for k in range(len(at_a) - 1):
        i, j = at_a[k], at_b[k]
        if k and i and j < len(b) and a[i - 1] == b[j]:
            parts.append(([i - 1], [j]))  # the border divides a shared end
        x, y = shared_ends(a[i : at_a[k + 1]], b[j : at_b[k + 1]])
        parts.append((x + i, y + j))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = [np.concatenate(side).astype(np.int64) for side in zip(*parts, strict=True)]
    return both[0], both[1]


@dataclass
class Groups:
    """Tokens of several texts with the groups they form.

    ``size_a`` and ``size_b`` count tokens per group; ``a_of``, ``b_of`` and ``g_of`` say where
    the tokens and groups of each text start.
    """

    a: np.ndarray
    b: np.ndarray
    size_a: np.ndarray
    size_b: np.ndarray
    a_of: np.ndarray
    b_of: np.ndarray
    g_of: np.ndarray


def group_tokens(encoder: Encoder, texts: list[str | None], lengths, piece: int = PIECE) -> Groups:
    """Groups of all texts, found in one merge of their ends laid end to end."""
    empty = np.zeros(0, np.int32)
    encoded = [encoder.encode(text) if text else None for text in texts]
    a, b = (
        np.concatenate([empty, *[e[side] for e in encoded if e is not None]]) for side in (0, 1)
    )
    a_of, b_of = (
        np.append(0, np.cumsum([0 if e is None else len(e[side]) for e in encoded], dtype=np.int64))
        for side in (0, 1)
    )
    # Both lists of ends of a text stop at its last byte, so no group leaves its text.
    ends_a, ends_b = np.cumsum(lengths[0][a]), np.cumsum(lengths[1][b])
    i, j = cuts(ends_a, ends_b, piece)
    size_a, size_b = np.diff(i, prepend=-1), np.diff(j, prepend=-1)
    return Groups(a, b, size_a, size_b, a_of, b_of, np.searchsorted(i, a_of - 1, "right"))


def pair_links(groups: Groups, width: int, most: int = LINKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, pair and number of links, for every pair linked in a text, sorted.

    A pair is ``a * width + b``. Groups are taken in runs of at most ``most`` links; a group
    with more is counted by its distinct ids.
    """
    links = groups.size_a * groups.size_b
    start_a, start_b = (np.cumsum(s) - s for s in (groups.size_a, groups.size_b))
    text = np.repeat(np.arange(len(groups.g_of) - 1), np.diff(groups.g_of))
    found = []
    for g in np.flatnonzero(links > most):
        ids_a = groups.a[start_a[g] : start_a[g] + groups.size_a[g]]
        ids_b = groups.b[start_b[g] : start_b[g] + groups.size_b[g]]
        (ids_a, times_a), (ids_b, times_b) = (np.unique(x, return_counts=True) for x in (ids_a, ids_b))
        for one, times in zip(ids_a.tolist(), times_a.tolist(), strict=True):
            found.append((np.full(len(ids_b), text[g]), one * width + ids_b.astype(np.int64), times * times_b))
    few = np.flatnonzero(links <= most)
    run = np.cumsum(links[few]) // most
    for chosen in np.split(few, np.flatnonzero(np.diff(run)) + 1) if len(few) else []:
        n = links[chosen]
        group = np.repeat(chosen, n)
        k = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
        size = groups.size_b[group]
        pair = groups.a[start_a[group] + k // size].astype(np.int64) * width
        pair += groups.b[start_b[group] + k % size]
        found.append(_summed(text[group], pair))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    if len(found) == 1:
        return found[0]
    return _summed(*(np.concatenate(side) for side in zip(*found, strict=True)))


def _summed(text: np.ndarray, pair: np.ndarray, links: np.ndarray | None = None):
    """Equal pairs of a text once, with the sum of their links, or their number."""
    span = int(pair.max(initial=0)) + 1
    key = text * span + pair  # texts of a batch times pairs of ids: far below 2 ** 63
    if links is None:
        key, links = np.unique(key, return_counts=True)
    else:
        key, at = np.unique(key, return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, at, links)
        links = total
    return key // span, key % span, links


class Speller:
    """Writes the groups of a text as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, size_a: int, size_b: int):
        numbers = [str(i).encode() for i in range(max(size_a, size_b))]
        self._follows, self._half, self._last = (
            np.array([number + mark for number in numbers], object) for mark in (b",", b"|", b";")
        )

    def spell(self, groups: Groups) -> list[bytes]:
        """One string per text; no groups give an empty one."""
        n = len(groups.a) + len(groups.b)
        words = np.empty(n, object)
        end_a, end_b = np.cumsum(groups.size_a), np.cumsum(groups.size_b)
        # A token comes after the tokens of A before it and those of B in earlier groups.
        place_a = np.arange(len(groups.a)) + np.repeat(end_b - groups.size_b, groups.size_a)
        place_b = np.arange(len(groups.b)) + np.repeat(end_a, groups.size_b)
        words[place_a] = self._follows[groups.a]
        words[place_b] = self._follows[groups.b]
        words[place_a[end_a - 1]] = self._half[groups.a[end_a - 1]]
        words[place_b[end_b - 1]] = self._last[groups.b[end_b - 1]]
        of = groups.a_of + groups.b_of
        return [b"".join(words[x:y].tolist())[:-1] for x, y in zip(of, of[1:])]


# Whole tables


def vocabularies(path_a: str, path_b: str) -> dict:
    """What tasks need of both vocabularies; its size does not depend on documents."""
    b = Path(path_b).read_bytes()
    width = sentencepiece.SentencePieceProcessor(model_proto=b).vocab_size()
    return {"a": read_tokenizer(path_a).to_str(), "b": b, "width": width}


def ready(shared: dict) -> tuple[Encoder, tuple[np.ndarray, np.ndarray]]:
    """The encoder and the bytes of each id; made once per worker, which keeps what was
    broadcast to it from task to task."""
    if "encoder" not in shared:
        shared["encoder"] = Encoder(shared["a"], shared["b"])
    return shared["encoder"], shared["encoder"].lengths


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")


def token_groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``doc_id, group, start, stop, a, b``: byte range and ids of every group of each document.

    The range is one of the bytes of a space and the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabularies(path_a, path_b))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lengths = ready(shared.value)
        for batch in small_batches(batches, "text", _BATCH):
            groups = group_tokens(encoder, batch.column("text").to_pylist(), lengths)
            count = np.diff(groups.g_of)
            sizes = np.add.reduceat(lengths[0][groups.a], np.cumsum(groups.size_a) - groups.size_a) \
                if len(groups.a) else np.zeros(0, np.int64)
            text = np.repeat(np.arange(batch.num_rows), count)
            stop = np.cumsum(sizes)
            base = np.append(0, stop)[groups.g_of[:-1]]
            stop = stop - base[text]
            lists = [
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(ids))
                for n, ids in ((groups.size_a, groups.a), (groups.size_b, groups.b))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(text)),
                    pa.array(np.arange(len(text)) - groups.g_of[text]),
                    pa.array(stop - sizes),
                    pa.array(stop),
                    *lists,
                ],
                ["doc_id", "group", "start", "stop", "a", "b"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, group long, start long, stop long, a array<int>, b array<int>"
    return docs.select("doc_id", "text").mapInArrow(find, schema)


def _numbers(counts) -> pa.Array:
    return pa.array(np.asarray(counts, np.int64))


def described(docs: DataFrame, vocabulary: dict) -> DataFrame:
    """Counts and hash of each document, with its pairs and their links as two arrays."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lengths = ready(shared.value)
        speller = Speller(len(lengths[0]), len(lengths[1]))
        for batch in small_batches(batches, "text", _BATCH):
            groups = group_tokens(encoder, batch.column("text").to_pylist(), lengths)
            text, pair, links = pair_links(groups, shared.value["width"])
            offsets = np.searchsorted(text, np.arange(batch.num_rows + 1))
            running = np.append(0, np.cumsum(links))
            hashes = [hashlib.sha256(s).hexdigest() if s else "" for s in speller.spell(groups)]
            starts = pa.array(offsets.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    *map(_numbers, map(np.diff, (groups.a_of, groups.b_of, groups.g_of))),
                    _numbers(np.diff(running[offsets])),
                    pa.array(hashes, pa.string()),
                    pa.ListArray.from_arrays(starts, _numbers(pair)),
                    pa.ListArray.from_arrays(starts, _numbers(links)),
                ],
                ["row", "doc_id", *_COUNTS, "groups_sha256", "pairs", "links"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{name} long" for name in _COUNTS)
    schema = f"row long, doc_id {kind}, {counts}, groups_sha256 string, pairs array<long>, links array<long>"
    return _rows(docs).mapInArrow(describe, schema)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """``pair, n, best``: documents that link the pair, and whether that is the most of its A id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, n = np.unique(batch.column("pairs").flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([_numbers(pair), _numbers(n)], ["pair", "n"])

    counted = rows.select("pairs").mapInArrow(count, "pair long, n long")
    counted = counted.groupBy("pair").agg(F.sum("n").alias("n"))
    # An A id has at most as many pairs as B has ids.
    of_a = Window.partitionBy(F.expr(f"pair div {width}"))
    return counted.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))


def least_frequency(counts: DataFrame, room: int) -> int:
    """The least power of two such that at most ``room`` pairs are as frequent."""
    power = F.floor(F.log2("n") + 1e-12).cast("int")
    sizes = dict(counts.groupBy(power.alias("p")).count().collect())  # 64 rows at most
    total = 0
    for p in sorted(sizes, reverse=True):
        total += sizes[p]
        if total > room:
            return 1 << (p + 1)
    return 1


def align(docs: DataFrame, path_a: str, path_b: str, room: int = ROOM) -> DataFrame:
    """Counts of tokens, groups and links of every document, and what its links count.

    ``docs`` has ``doc_id`` and ``text``; the paths name the vocabulary files of A and B on the
    driver. Columns: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256``. ``count_sum`` adds up, over all links, in how many documents of the table
    the pair is linked; ``n_best`` counts the links whose pair is the most frequent of its A id.
    """
    vocabulary = vocabularies(path_a, path_b)
    rows = staged(described(docs, vocabulary))
    counts = staged(pair_counts(rows, vocabulary["width"]))
    least = least_frequency(counts, room)
    frequent = counts.where(F.col("n") >= least).toArrow()
    looked = looked_up(rows, frequent)
    names = ["n_best", "count_sum"]
    if least > 1:
        looked = staged(looked)
        rare = counts.where(F.col("n") < least)
        missed = looked.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("miss")).select(
            "row", F.col("miss.pairs").alias("pair"), F.col("miss.links").alias("links")
        )
        more = (
            missed.join(rare, "pair")
            .groupBy("row")
            .agg(
                F.sum(F.col("links") * F.col("best").cast("long")).alias("more_best"),
                F.sum(F.col("links") * F.col("n")).alias("more_sum"),
            )
        )
        added = [
            (F.col(name) + F.coalesce(more_name, F.lit(0))).alias(name)
            for name, more_name in zip(names, ("more_best", "more_sum"), strict=True)
        ]
        looked = looked.join(more, "row", "left").select("doc_id", *_COUNTS, *added, "groups_sha256")
    return looked.select("doc_id", *_COUNTS, *names, "groups_sha256")


def looked_up(rows: DataFrame, frequent: pa.Table) -> DataFrame:
    """Sums over the frequent pairs of each document; its other pairs stay as arrays."""
    frequent = frequent.sort_by("pair")
    table = [frequent.column(c).to_numpy() for c in ("pair", "n", "best")]
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            pairs, links = batch.column("pairs"), batch.column("links")
            offsets = np.append(0, np.cumsum(np.diff(pairs.offsets.to_numpy())))
            pair, times = pairs.flatten().to_numpy(), links.flatten().to_numpy()
            at = np.searchsorted(known, pair)
            hit = at < len(known)
            hit[hit] = known[at[hit]] == pair[hit]
            value = np.zeros((2, len(pair) + 1), np.int64)
            value[0, 1:][hit] = times[hit] * best[at[hit]]
            value[1, 1:][hit] = times[hit] * n[at[hit]]
            sums = np.diff(np.cumsum(value, axis=1)[:, offsets], axis=1)
            rest = np.append(0, np.cumsum(~hit))[offsets].astype(np.int32)
            columns = {name: batch.column(name) for name in ("row", "doc_id", *_COUNTS)}
            columns |= {"n_best": _numbers(sums[0]), "count_sum": _numbers(sums[1])}
            columns |= {"groups_sha256": batch.column("groups_sha256")}
            for name, values in (("pairs", pair), ("links", times)):
                columns[name] = pa.ListArray.from_arrays(pa.array(rest), _numbers(values[~hit]))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    long = T.LongType()
    fields = [T.StructField("n_best", long), T.StructField("count_sum", long)]
    names = ["row", "doc_id", *_COUNTS]
    schema = T.StructType(
        [*[rows.schema[c] for c in names], *fields, *[rows.schema[c] for c in ("groups_sha256", "pairs", "links")]]
    )
    return rows.mapInArrow(look_up, schema)
