"""Content-defined phrases of a text, and packed tables of them.

A trigger is the string of 20 bytes with the smallest rolling hash among those in a window
of 50 bytes, the last one on a tie. Every window has one, equal windows have the same one at
the same place, and the windows of one trigger occurrence lie next to each other. Together
they span its phrase. So phrases cover all windows of a text, each window is in one phrase,
and no phrase depends on more than the bytes it spans and its neighbours' triggers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from registrylake.llm.shingles import mixed

WINDOW = 50
TRIGGER = 20
#: Positions that are looked at together; a position must fit into 16 bits.
CHUNK = 60_000

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)
_random = np.random.default_rng(50_20)
_BYTE_HASHES = _random.integers(0, 1 << 63, (2, 256), np.uint64) * _U(2) + _U(1)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring strings from theirs."""
    h = a * _P + b
    h ^= h >> _U(29)
    return h * _U(0xBF58476D1CE4E5B9)


def doubled(data: np.ndarray, seed: int, most: int) -> dict[int, np.ndarray]:
    """Hashes of all strings of 1, 2, 4 ... ``most`` bytes."""
    hashes, size = {1: _BYTE_HASHES[seed][data]}, 1
    while size < most:
        h = hashes[size]
        hashes[2 * size] = _joined(h[:-size], h[size:]) if len(h) > size else h[:0]
        size *= 2
    return hashes


def window_hashes(hashes: dict[int, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Hashes of the windows that start at the given places."""
    return mixed(
        _joined(_joined(hashes[32][at], hashes[16][at + 32]), hashes[2][at + 48])
    )


def phrases(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, trigger hash and phrase hash of each phrase."""
    found = []
    for first in range(0, len(data) - WINDOW + 1, CHUNK):
        piece = data[first : first + CHUNK + WINDOW - 1]
        hashes = doubled(piece, 0, 32)
        grams = _joined(hashes[16][: len(piece) - TRIGGER + 1], hashes[4][16:])
        grams = mixed(grams)
        place = _U(0xFFFF) - np.arange(len(grams), dtype=np.uint64)
        keys = (grams & ~_U(0xFFFF)) | place
        span, done = WINDOW - TRIGGER + 1, 1
        while done < span:
            step = min(done, span - done)
            keys = np.minimum(keys[:-step], keys[step:])
            done += step
        chosen = (_U(0xFFFF) - (keys & _U(0xFFFF))).astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        count = np.diff(np.append(start, len(chosen)))
        ends = window_hashes(hashes, start), window_hashes(hashes, start + count - 1)
        whole = mixed(_joined(*ends) + count.astype(np.uint64))
        found.append((start + first, count, grams[chosen[start]], whole))
    if not found:
        empty = np.empty(0, np.int64)
        return empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    return tuple(np.concatenate(column) for column in zip(*found))


@dataclass
class Places:
    """Runs of windows in documents, and what is known of each.

    ``doc`` and ``text`` (16 bits of a hash of the text) name the document, ``start`` and
    ``count`` the windows, ``group`` and ``same`` the trigger and phrase hashes.
    """

    doc: np.ndarray
    text: np.ndarray
    start: np.ndarray
    count: np.ndarray
    kind: np.ndarray
    group: np.ndarray
    same: np.ndarray

    FIELDS = (
        ("doc", np.int64),
        ("text", np.uint16),
        ("start", np.uint32),
        ("count", np.uint8),
        ("kind", np.uint8),
        ("group", np.uint64),
        ("same", np.uint64),
    )

    def __len__(self) -> int:
        return len(self.doc)

    def take(self, index) -> Places:
        return Places(*(getattr(self, name)[index] for name, _ in self.FIELDS))

    @classmethod
    def joined(cls, parts: list[Places]) -> Places:
        parts = parts or [cls.empty()]
        return cls(*(np.concatenate([getattr(p, n) for p in parts]) for n, _ in cls.FIELDS))

    @classmethod
    def empty(cls) -> Places:
        return cls(*(np.empty(0, kind) for _, kind in cls.FIELDS))

    def packed(self, keep: tuple[str, ...]) -> bytes:
        """The places as bytes, documents as runs; hashes only of the named fields.

        ``short`` stands for the lower half of the group: a part of a shuffle that is dealt
        by the upper half tells the rest.
        """
        ids = np.flatnonzero(
            np.concatenate(
                ([True], (self.doc[1:] != self.doc[:-1]) | (self.text[1:] != self.text[:-1]))
            )
        ) if len(self) else np.empty(0, np.int64)
        runs = np.diff(np.append(ids, len(self))).astype(np.uint32)
        head = np.array([len(ids), len(self)], np.uint32)
        parts = [head, self.doc[ids], runs, self.text[ids], self.start, self.count, self.kind]
        hashes = {"group": self.group, "same": self.same, "short": self.group.astype(np.uint32)}
        parts += [hashes[name] for name in keep]
        return b"".join(np.ascontiguousarray(part).tobytes() for part in parts)

    @classmethod
    def unpacked(cls, data: bytes, keep: tuple[str, ...]) -> Places:
        ids, n = (int(x) for x in np.frombuffer(data, np.uint32, 2))
        at = 8

        def read(kind, many):
            nonlocal at
            values = np.frombuffer(data, kind, many, at)
            at += values.nbytes
            return values

        doc, runs, text = read(np.int64, ids), read(np.uint32, ids), read(np.uint16, ids)
        values = {
            "doc": np.repeat(doc, runs),
            "text": np.repeat(text, runs),
            "start": read(np.uint32, n),
            "count": read(np.uint8, n),
            "kind": read(np.uint8, n),
        }
        hashes = {
            name: read(np.uint32 if name == "short" else np.uint64, n).astype(np.uint64)
            for name in keep
        }
        none = np.zeros(n, np.uint64)
        group = hashes.get("group", hashes.get("short", none))
        return cls(**values, group=group, same=hashes.get("same", none))

    def by(self, part: np.ndarray, keep: tuple[str, ...]):
        """``part, bytes`` of the places of each part."""
        order = np.lexsort((self.start, self.text, self.doc, part))
        part = part[order]
        ends = np.append(np.flatnonzero(part[1:] != part[:-1]) + 1, len(part))
        start = 0
        for end in ends if len(part) else ():
            yield int(part[start]), self.take(order[start:end]).packed(keep)
            start = end
