"""Removal of repeated passages by prefix-free parsing of the corpus.

Every byte is removed that a string of 50 bytes covers which also starts in a document with
a smaller id, as the documents came in.

1. Parsing. Rolling-hash triggers cut each text into overlapping phrases (``phrases.py``).
   The parse of a document is its list of phrases; the dictionary are the distinct ones.
   Within a batch of documents all occurrences of a phrase but those in its first document
   are settled: they are covered. Triggers, phrase hashes and places, packed, are the only
   thing of all documents that is shuffled, by trigger.
2. Dictionary and parse. Sorted by trigger, phrase and document, occurrences of a phrase
   outside its first document are covered whole. A trigger of one document only is unique.
   What is left are first occurrences of different phrases with a common trigger: the ends
   of repeated passages and chance meetings.
3. Windows. Of those phrases the bytes are fetched. Their windows of 50 bytes are grouped by
   two 64-bit hashes, and a window is covered unless its document is the first in its group.
   There is no suffix array and no order of suffixes: only whether windows of 50 bytes are
   equal matters, which hashes tell without comparing bytes.

A trigger that very many different phrases of one batch share is not followed as a whole:
its phrases are cut into single windows, which are grouped by their content, with one
occurrence per batch. So no common string collects the corpus in one task.

Texts are shuffled once, to the places found in them. Windows are only compared within groups
of a trigger, which is where they can be equal.

Defined results
- A NULL text counts as empty. A row without doc_id stays as it is and covers nothing.
- Rows with the same doc_id do not cover each other.
- Removed bytes may be parts of a character, so what is kept is binary.
- Other columns play no part; an empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from registrylake.llm.phrases import WINDOW, Places, doubled, phrases, window_hashes
from registrylake.llm.shingles import byte_texts, mixed
from registrylake.tables.work import staged

#: Text that one part of a shuffle stands for, and that is parsed before phrases are sent.
PART_BYTES = 16 << 20
BATCH_BYTES = 8 << 20
#: Different phrases of a trigger in one batch from which on single windows are followed.
HOT_PHRASES = 256

_COVERED, _OPEN, _HOT, _ASKED = 0, 1, 2, 3
_SHORT, _GROUP, _NONE = ("short", "same"), ("group",), ()
_PACKED = "part int, places binary"


def _rows(pairs, names=("part", "places"), kinds=(pa.int32(), pa.binary())):
    columns = list(zip(*pairs)) or [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], list(names)
    )


def text_mark(text: bytes) -> int:
    """What tells apart texts with the same doc_id, in 16 bits."""
    return xxhash.xxh3_64_intdigest(text) & 0xFFFF


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new run of equal values starts."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def _first_docs(places: Places) -> tuple[Places, np.ndarray, np.ndarray]:
    """Sorted by group, phrase and document; starts of phrase runs; whether each place is in
    the first document of its phrase."""
    places = places.take(np.lexsort((places.start, places.doc, places.same, places.group)))
    new = _runs(places.group, places.same)
    run = np.cumsum(new) - 1
    return places, new, places.doc == places.doc[np.flatnonzero(new)][run]


def _covered(places: Places) -> Places:
    """The places as covered ones, without the hashes that nothing asks for any more."""
    none = np.zeros(len(places), np.uint64)
    kind = np.full(len(places), _COVERED, np.uint8)
    return dataclasses.replace(places, kind=kind, group=none, same=none)


def _settled(places: Places, part_of, keep) -> Iterator[tuple[int, bytes]]:
    """Map-side combine: one document per phrase goes on, the rest is covered."""
    places, new, first = _first_docs(places)
    covered = _covered(places.take(~first))
    yield from covered.by(part_of(mixed(covered.doc.view(np.uint64))), keep)
    yield from places.take(first).by(part_of(places.group[first]), keep)


def _parse(parts: int, batch_bytes: int, hot_phrases: int):
    """Packed phrases of all documents, by trigger."""

    def spread(values: np.ndarray) -> np.ndarray:
        return ((values >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)

    def flush(found: list) -> Iterator[pa.RecordBatch]:
        places = Places.joined(found)
        if len(places):
            order = np.lexsort((places.same, places.group))
            group = places.group[order]
            distinct = _runs(group, places.same[order])
            new = _runs(group)
            many = np.add.reduceat(distinct.astype(np.int64), np.flatnonzero(new))
            hot = group[np.flatnonzero(new)][many >= hot_phrases]
            is_hot = np.isin(places.group, hot)
            hots = places.take(is_hot)
            hots.kind = np.full(len(hots), _HOT, np.uint8)
            told = Places.empty()
            if len(hot):
                n = len(hot)
                told = Places(
                    *(np.zeros(n, kind) for _, kind in Places.FIELDS[:4]),
                    np.full(n, _ASKED, np.uint8), hot, np.zeros(n, np.uint64),
                )
            yield _rows(hots.by(spread(hots.same), _SHORT))
            yield _rows(told.by(spread(told.group), _SHORT))
            yield _rows(_settled(places.take(~is_hot), spread, _SHORT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for doc, text in zip(
                batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), strict=True
            ):
                if len(text) < WINDOW:
                    continue
                start, count, group, same = phrases(np.frombuffer(text, np.uint8))
                n = len(start)
                found.append(
                    Places(
                        np.full(n, doc, np.int64), np.full(n, text_mark(text), np.uint16),
                        start.astype(np.uint32), count.astype(np.uint8),
                        np.full(n, _OPEN, np.uint8), group, same,
                    )
                )
                size += len(text)
                if size >= batch_bytes:
                    yield from flush(found)
                    found, size = [], 0
        yield from flush(found)

    return run


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """The rows of each part, from rows sorted by part."""
    part, rows = None, []
    for batch in batches:
        for number, places in zip(batch.column("part").to_pylist(), batch.column("places").to_pylist()):
            if number != part and rows:
                yield part, rows
                rows = []
            part = number
            rows.append(places)
    if rows:
        yield part, rows


def id_hashes(ids: np.ndarray) -> np.ndarray:
    """The hash that ``xxhash64`` gives of longs, as unsigned numbers."""
    # The published primes of the hash; 42 is the seed.
    p1, p2, p3, p4, p5 = (
        np.uint64(p) for p in (
            0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
            0x27D4EB2F165667C5,
        )
    )
    turned = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    with np.errstate(over="ignore"):
        h = np.uint64(42) + p5 + np.uint64(8)
        h = turned(h ^ (turned(ids.view(np.uint64) * p2, 31) * p1), 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))


def _doc_parts(places: Places, parts: int) -> np.ndarray:
    return (id_hashes(places.doc).view(np.int64) % parts).astype(np.int32)


def _combine(parts: int):
    """What dictionary and parse settle: covered, open and hot places, by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _parts(batches):
            places = Places.joined([Places.unpacked(row, _SHORT) for row in rows])
            places.group = places.group | np.uint64(part << 32)
            asked = places.group[places.kind == _ASKED]
            known = places.take((places.kind == _COVERED) | (places.kind == _HOT))
            rest, new, first = _first_docs(places.take(places.kind == _OPEN))
            trigger = _runs(rest.group)
            starts = np.flatnonzero(trigger)
            of = np.cumsum(trigger) - 1
            if len(rest):
                least = np.minimum.reduceat(rest.doc, starts)
                most = np.maximum.reduceat(rest.doc, starts)
                phrases_of = np.add.reduceat(new.astype(np.int64), starts)
                meet = ((least != most) & (phrases_of > 1))[of]
                hot = np.isin(rest.group, asked)
                rest.kind = np.where(hot, _HOT, _OPEN).astype(np.uint8)
                known = Places.joined([known, _covered(rest.take(~first))])
                rest = rest.take(first & (meet | hot))
            out = Places.joined([known, rest])
            yield _rows(out.by(_doc_parts(out, parts), _GROUP))

    return run


def _texts(table: pa.Table) -> dict[tuple[int, int], bytes]:
    found = {}
    for doc, text in zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()):
        if doc is not None:
            text = text or b""
            found[doc, text_mark(text)] = text
    return found


def _fetch(parts: int):
    """Bytes of the open phrases, by trigger; of hot ones the single windows, by content."""

    def run(texts: pa.Table, lists: pa.Table) -> pa.Table:
        known = _texts(texts)
        places = Places.joined(
            [Places.unpacked(row, _GROUP) for row in lists.column("places").to_pylist()]
        )
        rows = []
        opened = places.take(places.kind == _OPEN)
        if len(opened):
            part = (opened.group % np.uint64(parts)).astype(np.int32)
            for number, packed in opened.by(part, _GROUP):
                rows.append((number, packed, _bytes_of(Places.unpacked(packed, _GROUP), known)))
        hot = _windows(places.take(places.kind == _HOT), known)
        if len(hot):
            hot, new, first = _first_docs(hot)
            part = (hot.group[~first] % np.uint64(parts)).astype(np.int32)
            covered = _covered(hot.take(~first))
            rows += [(number, packed, b"") for number, packed in covered.by(part, _GROUP)]
            hot = hot.take(first)
            part = (hot.group % np.uint64(parts)).astype(np.int32)
            for number, packed in hot.by(part, _GROUP):
                rows.append((number, packed, _bytes_of(Places.unpacked(packed, _GROUP), known)))
        kinds = (pa.int32(), pa.binary(), pa.binary())
        batch = _rows(rows, ("part", "places", "bytes"), kinds)
        return pa.Table.from_batches([batch])

    return run


def _bytes_of(places: Places, texts: dict) -> bytes:
    """The bytes that the windows of each place span, one after another."""
    out = []
    for doc, mark, start, count in zip(
        places.doc.tolist(), places.text.tolist(), places.start.tolist(), places.count.tolist()
    ):
        out.append(texts[doc, mark][start : start + count + WINDOW - 1])
    return b"".join(out)


def _each_window(places: Places, data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Place, number within the place and two hashes of every window."""
    count = places.count.astype(np.int64)
    total = int(count.sum())
    place = np.repeat(np.arange(len(places)), count)
    number = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
    span = count + WINDOW - 1
    at = (np.cumsum(span) - span)[place] + number
    hashes = [window_hashes(doubled(data, seed, 32), at) for seed in (0, 1)]
    return place, number, *hashes


def _windows(places: Places, texts: dict) -> Places:
    """Every window as a place of its own, its group and phrase its content."""
    if not len(places):
        return Places.empty()
    data = np.frombuffer(_bytes_of(places, texts), np.uint8)
    place, number, one, other = _each_window(places, data)
    out = places.take(place)
    out.start = (out.start + number).astype(np.uint32)
    out.count = np.ones(len(out), np.uint8)
    out.kind = np.full(len(out), _OPEN, np.uint8)
    out.group, out.same = one, other
    return out


def _suffixes(parts: int):
    """Covered windows of the fetched phrases, by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _part_rows(batches):
            places = Places.joined([Places.unpacked(p, _GROUP) for p, b in rows if b])
            done = [Places.unpacked(p, _GROUP) for p, b in rows if not b]
            if len(places):
                data = np.frombuffer(b"".join(b for _, b in rows), np.uint8)
                place, number, one, other = _each_window(places, data)
                doc = places.doc[place]
                order = np.lexsort((doc, other, one))
                new = _runs(one[order], other[order])
                least = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
                hit = np.zeros(len(order), bool)
                hit[order] = doc[order] > least
                found = places.take(place[hit])
                found.start = (found.start + number[hit]).astype(np.uint32)
                found.count = np.ones(len(found), np.uint8)
                done.append(found)
            out = Places.joined(done)
            out.kind = np.full(len(out), _COVERED, np.uint8)
            yield _rows(out.by(_doc_parts(out, parts), _NONE))

    return run


def _part_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[bytes, bytes]]]:
    part, rows = None, []
    for batch in batches:
        columns = (batch.column(name).to_pylist() for name in ("part", "places", "bytes"))
        for number, places, data in zip(*columns):
            if number != part and rows:
                yield rows
                rows = []
            part = number
            rows.append((places, data))
    if rows:
        yield rows


def _cut(texts: pa.Table, lists: pa.Table) -> pa.Table:
    """The documents of a part without their covered bytes."""
    spans: dict[tuple[int, int], list] = {}
    for keep, column in ((_GROUP, "places"), (_NONE, "found")):
        for row in lists.column(column).to_pylist():
            if row is None:
                continue
            places = Places.unpacked(row, keep)
            places = places.take(places.kind == _COVERED)
            new = np.append(np.flatnonzero(_runs(places.doc, places.text)), len(places))
            for a, b in zip(new[:-1].tolist(), new[1:].tolist()):
                key = int(places.doc[a]), int(places.text[a])
                start = places.start[a:b].astype(np.int64)
                end = start + places.count[a:b] + WINDOW - 1
                spans.setdefault(key, []).append(np.stack((start, end), axis=1))
    rows = []
    for doc, text in zip(texts.column("doc_id").to_pylist(), texts.column("text").to_pylist()):
        text = text or b""
        ranges = spans.get((doc, text_mark(text)), ()) if doc is not None else ()
        merged = merged_ranges(np.concatenate(ranges)) if len(ranges) else []
        kept, at = [], 0
        for start, end in merged:
            kept.append(text[at:start])
            at = end
        kept = b"".join([*kept, text[at:]])
        rows.append((doc, len(text), merged, kept))
    docs, sizes, merged, kept = zip(*rows) if rows else ((), (), (), ())
    flat = [[x for span in spans for x in span] for spans in merged]
    return pa.table(
        {
            "doc_id": pa.array(docs, pa.int64()),
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array([n - len(k) for n, k in zip(sizes, kept)], pa.int64()),
            "n_spans": pa.array([len(spans) for spans in merged], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            "removed": pa.array(flat, pa.list_(pa.int64())),
        }
    )


def merged_ranges(ranges: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that any of the ranges covers."""
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    new = np.concatenate(([True], ranges[1:, 0] > reach[:-1]))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(ranges) - 1)
    return list(zip(ranges[new, 0].tolist(), reach[last].tolist()))


def remove_passages(
    docs: DataFrame, part_bytes: int = PART_BYTES, hot_phrases: int = HOT_PHRASES
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed`` of every document.

    ``docs`` has an integer ``doc_id`` and ``text``. ``removed`` lists the starts and ends
    of the removed runs in bytes. ``part_bytes`` is the text that a part of a shuffle stands for, and
    ``hot_phrases`` the number of phrases of a trigger from which on windows are followed.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // part_bytes))

    def sorted_parts(frame: DataFrame) -> DataFrame:
        return frame.repartition("part").sortWithinPartitions("part")

    named = docs.where("doc_id IS NOT NULL")
    parsed = sorted_parts(named.mapInArrow(_parse(parts, min(part_bytes, BATCH_BYTES), hot_phrases), _PACKED))
    lists = staged(parsed.mapInArrow(_combine(parts), _PACKED))

    lone = F.pmod(F.xxhash64("text"), F.lit(parts))
    texts = docs.select(
        F.when(F.col("doc_id").isNull(), lone)
        .otherwise(F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
        .cast("int")
        .alias("part"),
        "doc_id",
        F.col("text").cast("binary").alias("text"),
    )
    fetched = texts.groupBy("part").cogroup(lists.groupBy("part")).applyInArrow(
        _fetch(parts), "part int, places binary, bytes binary"
    )
    found = sorted_parts(fetched).mapInArrow(_suffixes(parts), _PACKED)
    none = F.lit(None).cast("binary")
    both = lists.select("part", "places", none.alias("found")).union(
        found.select("part", none.alias("places"), F.col("places").alias("found"))
    )
    return texts.groupBy("part").cogroup(both.groupBy("part")).applyInArrow(
        _cut,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "removed array<long>",
    )
