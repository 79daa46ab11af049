"""Personal data in texts, also when disguised, with spans in source characters.

Base detection takes e-mail addresses, IPv4 addresses, payment cards and phone numbers as
they stand. Then a transducer rewrites a copy of the text: look-alike letters and digits of
other scripts become ASCII, invisible characters vanish, runs of spelled digits become
digits, and "at" and "dot" in brackets or in a spelled address become signs. Last, in runs
of figures of any length, letters like O and l, single digit words and spelled dots become
digits and dots; whether that makes a number is left to the base patterns. It keeps for every
piece of the copy the piece of the source that it came from. What is detected in the copy and
touches a rewritten piece is mapped back and added.

"at" or a lone @ before a domain with plain dots is mostly prose ("more at example.org"), and
so is "at ten dot thirty". They count if something else speaks for an address: a dot, digit, +
or _ in the name, a domain of a mail service, or a word like "contact" or "mail" before it; a
domain with spelled dots also by a usual last label. The signs are known in four languages.

Detection is linear in the length of a text. All offsets are code points, ends exclusive.

Defined results
- A NULL text counts as empty and has no spans; a redacted NULL stays NULL.
- Rows are judged one by one: repeated rows, NULL or repeated ids change nothing.
- Other columns pass through; one that has the name of an added column is replaced.
- Empty tables give empty results.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from registrylake.llm.shingles import small_batches

KINDS = ("email", "ip", "card", "phone")

Span = tuple[int, int, str]

# The base patterns. The look-behinds and possessive repeats change no match: they keep the
# search from trying every start within one run of digits.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = str.maketrans("", "", " -().+")


def _emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end, "email"
        at = text.find("@", max(at + 1, end))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of all kinds by start, then in the order of ``KINDS``."""
    found = list(_emails(text))
    for match in _IP.finditer(text):
        if all(map(_small, match[0].split("."))):
            found.append((match.start(), match.end(), "ip"))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 14:
            digits = match[0].translate(_NOT_DIGIT)
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append((match.start(), match.end(), "card"))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 10 <= len(match[0].translate(_NOT_DIGIT)) <= 15:
                found.append((match.start(), match.end(), "phone"))
    return _ordered(found)


def _ordered(spans) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# Letters that look like an ASCII letter, and signs that stand for one.
_LOOK_ALIKES = dict(
    zip(
        "АВЕКМНОРСТУХІЈЅаеорсухіјѕһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαονρτυκι",
        "ABEKMHOPCTYXIJSaeopcyxijshdqwABEZHIKMNOPTYXaovptuki",
        strict=True,
    )
)
_SIGNS = {"․": ".", "。": ".", "｡": ".", "﹒": ".", "﹫": "@", "‐": "-", "‑": "-", "﹢": "+"}
_INVISIBLE = "­​‌‍⁠﻿"
# The digits as words.
_SPELLED = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
_DIGIT_LIKE = {"o": "0", "l": "1", "i": "1"}
_DIGIT_OF = {word: str(n) for words in _SPELLED.values() for n, word in enumerate(words.split())}


def _ascii(char: str) -> str | None:
    """What a character stands for: an ASCII character, nothing, or None for itself."""
    if char in _INVISIBLE:
        return ""
    if "！" <= char <= "～":
        return chr(ord(char) - 0xFEE0)
    digit = unicodedata.decimal(char, None)
    if digit is not None and char > "\x7f":
        return str(digit)
    return _LOOK_ALIKES.get(char) or _SIGNS.get(char)


_ALIKE = re.compile(
    "[" + "".join(map(re.escape, [*_LOOK_ALIKES, *_SIGNS, *_INVISIBLE])) + "！-～]|(?![0-9])\\d"
)
_DIGIT_WORD = "(?:" + "|".join(sorted(_DIGIT_OF, key=len, reverse=True)) + ")"
_AT, _DOT = "(?:at|arroba|arobase)", "(?:dot|punkt|point|punto)"
_OPEN, _CLOSE = r"(?:(?<![ \t])[ \t]++)?[\[({<][ \t]*", r"[ \t]*[\])}>][ \t]*"
_WORDS = re.compile(
    rf"(?<!\w)(?P<digits>(?:plus[ -]+)?{_DIGIT_WORD}(?:[ -]+(?:{_DOT}[ -]+)?{_DIGIT_WORD}){{2,}})(?!\w)"
    rf"|(?P<at>{_OPEN}(?:{_AT}|@){_CLOSE})"
    rf"|(?P<dot>{_OPEN}(?:{_DOT}|\.){_CLOSE})"
    rf"|(?<=[a-z0-9])(?P<address>(?:[ ]+{_DOT}[ ]+[a-z0-9_+-]+)*(?:[ ]+{_AT}[ ]+|[ ]*@[ ]*)[a-z0-9-]+(?:(?:[ ]+{_DOT}[ ]+|\.)[a-z0-9-]+)+)(?!\w)",
    re.IGNORECASE,
)
_SIGN = re.compile(rf"[ ]+(?:(?P<dot>{_DOT})|{_AT})[ ]+|[ ]+@[ ]*|@[ ]+", re.IGNORECASE)
_SOME_AT = re.compile(rf"(?:@| {_AT} ) *[a-z0-9-]+(?:\.[a-z0-9]| +{_DOT} )| {_DOT} +[a-z0-9_+-]+(?: *@| +{_AT} )")
_CUE = re.compile(r"(?:mail|contact|write|reach|address)[a-z]*(?:[ ]+[a-z]+)?[^a-z0-9]+$", re.IGNORECASE)
_PRONOUNS = frozenset("me us him her it them you".split())
# Last labels of domains that are usual and no common words.
_LAST_LABELS = frozenset(
    "com org net edu gov mil int info biz name mobi dev app io eu uk de fr es pt nl ch at be lu "
    "dk se no fi pl cz sk hu ro bg gr tr ru ua br mx ar cl co pe ca au nz jp cn kr tw in za".split()
) - frozenset("at be no in".split())
# Runs of figures, digit words and letters that look like digits, with what a phone or a
# spelled dot may have between them.
_TOKEN = rf"(?:{_DIGIT_WORD}|[0-9oli])++(?!\w)"
_NUMBER = re.compile(
    rf"(?:\+|(?<!\w)(?:plus[ -]++)?){_TOKEN}(?:[ ().-]++(?:(?:dot|punkt|point|punto)[ -]++)?{_TOKEN})*+",
    re.IGNORECASE,
)
_PIECE = re.compile(
    rf"plus[ -]+|(?<![ ().-])[ ().-]*+(?P<dot>dot|punkt|point|punto)[ -]+|{_DIGIT_WORD}|[oli]",
    re.IGNORECASE,
)
_WORD = re.compile(r"[^\W_]+")
_EDGES = tuple(
    re.compile(f"(?:{edge})+|dot|punkt|point|punto", re.IGNORECASE)
    for edge in ("[oli]", f"{_DIGIT_WORD}|[oli]")
)
_MIXED = re.compile(r"[0-9][ ().-]*[oli]|[oli][ ().-]*[0-9]|[0-9][ ]+(?:punkt|point|punto)[ ]+[0-9oli]")
_BRACKETS = re.compile(r"[\[({<][ \t]*(?:at|arroba|arobase|@|dot|punkt|point|punto|\.)[ \t]*[\])}>]")


def _may_be_spelled(text: str) -> bool:
    """Whether any rewriting of words can apply; a quick look that never says no wrongly."""
    low = text.lower()
    if " dot " in low or _BRACKETS.search(low) or _MIXED.search(low):
        return True
    if "@ " in low or " @" in low or _SOME_AT.search(low):
        return True
    words = re.split(r"\W+", low) if "-" in low else low.split()
    return not _DIGIT_OF.keys().isdisjoint(words)


class Rewriting:
    """A rewritten text, and where each piece of it came from."""

    def __init__(self, text: str):
        self.pieces: list[str] = []
        self.new: list[int] = []
        self.old: list[int] = []
        self.changed: list[bool] = []
        self.ends: list[int] = []
        self._length = 0
        self._source = text

    def add(self, start: int, end: int, piece: str | None = None) -> None:
        """The source from start to end, as it is or as another text."""
        if start < end:
            self.new.append(self._length)
            self.old.append(start)
            self.ends.append(end)
            self.changed.append(piece is not None)
            self.pieces.append(self._source[start:end] if piece is None else piece)
            self._length += len(self.pieces[-1])

    @property
    def text(self) -> str:
        return "".join(self.pieces)

    def source_span(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source characters of a span of the text, and whether any was rewritten."""
        first = bisect.bisect_right(self.new, start) - 1
        last = bisect.bisect_left(self.new, end) - 1
        a = self.old[first] + (0 if self.changed[first] else start - self.new[first])
        b = self.ends[last] if self.changed[last] else self.old[last] + end - self.new[last]
        return a, b, any(self.changed[first : last + 1])


def _spelled(words: str) -> str:
    """Signs for a run of spelled digits, an address after " at ", or a sign in brackets."""
    signs = []
    for word in re.split(r"[ -]+", words.lower()):
        signs.append({"plus": "+"}.get(word) or _DIGIT_OF.get(word, "."))
    return "".join(signs)


def _rewrite_chars(text: str) -> Rewriting:
    out, at = Rewriting(text), 0
    for match in _ALIKE.finditer(text):
        piece = _ascii(match[0])
        if piece is not None:
            out.add(at, match.start())
            out.add(match.start(), match.end(), piece)
            at = match.end()
    out.add(at, len(text))
    return out


def _back(text: str, at: int, of) -> int:
    """Where the run of characters that ends before ``at`` starts."""
    while at and of(text[at - 1]):
        at -= 1
    return at


def _is_address(text: str, start: int, signs: list[str], domain: str) -> bool:
    """Whether a name, a sign for @ and a domain with dots are an address and not prose.

    The name ends before ``start``; ``signs`` are the rewritten signs in order. What speaks for
    an address is looked for in whole words, however long.
    """
    first = _back(text, start, _LOCAL.__contains__)
    name = text[first:start]
    if not name or name.lower() in _PRONOUNS:
        return False
    if any(c.isalpha() for c in name) and any(c in "._+" or c.isdigit() for c in name):
        return True
    if "mail" in domain or "." in signs and domain.rpartition(" ")[2].rpartition(".")[2] in _LAST_LABELS:
        return True
    gap = _back(text, first, lambda c: not c.isalnum())
    word = _back(text, gap, str.isalpha)
    word = _back(text, _back(text, word, " ".__eq__), str.isalpha)
    return bool(_CUE.search(text[word:first]))


def _rewrite_words(text: str) -> Rewriting:
    out, at = Rewriting(text), 0
    for match in _WORDS.finditer(text):
        out.add(at, match.start())
        at = match.end()
        if match["digits"]:
            out.add(match.start(), at, _spelled(match[0]))
        elif match["address"]:
            start, signs = match.start(), list(_SIGN.finditer(match[0]))
            kinds = ["." if sign["dot"] else "@" for sign in signs]
            # A lone @ within the word needs no more evidence: the domain's dots are spelled.
            lone = "@" in match[0] and "." in kinds
            if signs and not lone and not _is_address(text, start, kinds, match[0].lower()):
                signs = []
            for sign in signs:
                out.add(start, match.start() + sign.start())
                start = match.start() + sign.end()
                piece = "." if sign["dot"] else "@"
                out.add(match.start() + sign.start(), start, piece)
            out.add(start, at)
        else:
            out.add(match.start(), at, "@" if match["at"] else ".")
    out.add(at, len(text))
    return out


def _rewrite_number(run: str) -> tuple[Rewriting, list[int]]:
    """A run of figures in digits, and where letters stood for them."""
    out, at, letters = Rewriting(run), 0, []
    for match in _PIECE.finditer(run):
        piece = match[0].lower()
        sign = "." if match["dot"] else "+" if piece.startswith("plus") else _DIGIT_OF.get(piece)
        if sign is None and piece in _DIGIT_LIKE:
            sign = _DIGIT_LIKE[piece]
            letters.append(match.start())
        if sign:
            out.add(at, match.start())
            at = match.end()
            out.add(match.start(), at, sign)
    out.add(at, len(run))
    return out, letters


def _trimmed(run: str) -> Iterator[tuple[int, int]]:
    """A run without look-alike words like "I" at its ends, without digit words, and whole."""
    words = list(_WORD.finditer(run))
    cuts = []
    for edge in _EDGES:
        first, last = 0, len(words)
        while first < last and edge.fullmatch(words[first][0]):
            first += 1
        while first < last and edge.fullmatch(words[last - 1][0]):
            last -= 1
        if first < last:
            cuts.append((words[first].start() if first else 0, words[last - 1].end()))
    yield from dict.fromkeys([*cuts, (0, len(run))])


def _number_spans(text: str) -> Iterator[tuple[int, int, str]]:
    """Spans in runs of figures that show once letters, digit words and dots are rewritten.

    Half of the digits, or eight, have to be such in the text. Nearby words that could
    belong to a number count only where the run without them has none.
    """
    for match in _NUMBER.finditer(text):
        run = match[0]
        if len(run) < 7 or not _PIECE.search(run):
            continue
        found: list[Span] = []
        for start, end in _trimmed(run):
            out, letters = _rewrite_number(run[start:end])
            for a, b, kind in base_spans(out.text):
                n = sum(char.isdigit() for char in out.text[a:b])
                a, b, changed = out.source_span(a, b)
                alike = bisect.bisect_left(letters, b) - bisect.bisect_left(letters, a)
                if n - alike < min(8, n / 2):
                    continue
                a, b = a + start, b + start
                if all(b <= x or y <= a or (x, y) == (a, b) for x, y, _ in found):
                    found.append((a, b, kind))
                    if changed:
                        yield match.start() + a, match.start() + b, kind


def disguised_spans(text: str) -> list[Span]:
    """Spans that show only after rewriting, in source characters."""
    alike = not text.isascii() and any(c > "\x7f" and _ascii(c) is not None for c in set(text))
    if not alike and not _may_be_spelled(text):
        return []
    chars = _rewrite_chars(text)
    words = _rewrite_words(chars.text)
    found = []
    for start, end, kind in base_spans(words.text):
        a, b, changed = words.source_span(start, end)
        a, b, also = chars.source_span(a, b)
        if changed or also:
            found.append((a, b, kind))
    for start, end, kind in _number_spans(words.text):
        a, b, _ = words.source_span(start, end)
        a, b, _ = chars.source_span(a, b)
        found.append((a, b, kind))
    return found


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added spans together."""
    base = base_spans(text)
    added = disguised_spans(text)
    return base, _ordered({*base, *added}) if added else base


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, at, end = [], 0, -1
    for start, stop, kind in spans:
        if start >= end:
            out += [text[at:start] if end < 0 else text[end:start], f"[{kind.upper()}]"]
            end = stop
        end = max(end, stop)
    return "".join([*out, text[max(end, 0) :]])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


_FOUND = [T.StructField(f"n_{kind}", T.LongType()) for kind in KINDS] + [
    T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()),
]


def find_personal_data(docs: DataFrame) -> DataFrame:
    """The documents with the numbers of base spans by kind, the hash of the base spans, and
    all spans as ``kind:start:end``, joined by commas."""
    added = [field.name for field in _FOUND]
    columns = [name for name in docs.columns if name not in added]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows = []
            for text in batch.column("text").to_pylist():
                base, spans = all_spans(text or "")
                kinds = [kind for _, _, kind in base]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*map(kinds.count, KINDS), digest, _joined(spans)))
            types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
            more = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
            kept = [batch.column(name) for name in columns]
            yield pa.RecordBatch.from_arrays(kept + more, columns + added)

    kept = [docs.schema[name] for name in columns]
    return docs.select(columns).mapInArrow(find, T.StructType(kept + _FOUND))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their personal data replaced by ``[EMAIL]`` and the like.

    ``n_chars``, if there, becomes the length of the new text. All rows stay.
    """

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            texts = batch.column("text").to_pylist()
            new = [text and redacted(text, all_spans(text)[1]) for text in texts]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(new, batch.schema.field(at).type))

    cleaned = docs.mapInArrow(clean, docs.schema)
    if "n_chars" not in docs.columns:
        return cleaned
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.withColumn("n_chars", F.when(F.col("text").isNotNull(), length))
