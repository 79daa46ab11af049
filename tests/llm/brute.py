"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict


def shingle_sets(docs, size=5):
    """doc_id -> set of word runs; the texts of one id together."""
    sets = defaultdict(set)
    for doc_id, text in docs:
        words = (text or "").encode().lower().split()
        n = min(size, len(words))
        sets[doc_id] |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
    return dict(sets)


def near_components(docs, percent=85):
    """doc_id -> smallest doc_id that links lead to."""
    sets = shingle_sets(docs)
    parent = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {doc_id: find(doc_id) for doc_id in ids}


def cut_passages(docs, width=50):
    """(doc_id, bytes, removed, spans, hash of the rest) per row, sorted."""
    first = {}
    texts = [(doc_id, (text or "").encode()) for doc_id, text in docs]
    for doc_id, text in texts:
        for i in range(len(text) - width + 1):
            if doc_id is not None:
                key = text[i : i + width]
                first[key] = min(doc_id, first.get(key, doc_id))
    rows = []
    for doc_id, text in texts:
        mask = [False] * len(text)
        for i in range(len(text) - width + 1):
            if doc_id is not None and first[text[i : i + width]] < doc_id:
                mask[i : i + width] = [True] * width
        spans = sum(m and (i == 0 or not mask[i - 1]) for i, m in enumerate(mask))
        kept = bytes(c for c, m in zip(text, mask) if not m)
        rows.append((doc_id, len(text), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(rows, key=repr)


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def contamination(text, items, size=10):
    """Words, hit words and the ids of items that occur, for one text."""
    words, hit, found = words_of(text), set(), set()
    for item_id, item in items:
        item_words = words_of(item)
        n = min(size, len(item_words))
        for i in range(len(item_words) - n + 1 if item_words else 0):
            window = item_words[i : i + n]
            for at in range(len(words) - n + 1):
                if words[at : at + n] == window:
                    hit |= set(range(at, at + n))
                    found.add(item_id)
    return len(words), len(hit), found


def base_stats(text):
    """Words, their characters, symbols, repeated lines, words in repeated 3-word windows."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = list(zip(words, words[1:], words[2:]))
    inside = {p for i, t in enumerate(triples) if triples.count(t) > 1 for p in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(inside),
    )


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (2 if i % 2 else 1)
        total += value if value < 10 else value - 9
    return total % 10 == 0


def base_spans(text):
    """(start, end, kind) by start, then kind."""
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    found = []
    for order, (kind, pattern) in enumerate(kinds.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in match[0].split(".")),
                "card": 14 <= len(digits) <= 19 and _luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((match.start(), order, match.end(), kind))
    return [(start, end, kind) for start, _, end, kind in sorted(found)]
