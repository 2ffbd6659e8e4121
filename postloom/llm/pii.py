"""Personal data in texts, also where it is disguised; every span points into the source text.

A text is looked at as it is (the base spans) and once more after a chain of transducers. Each
transducer is a list of edits (start, end, replacement) and yields the new text with a map
from its places to those of the text it read:

1. look-alikes: characters that Unicode or the eye takes for an ASCII one become that one, full
   width and mathematical letters, other scripts' digits, Cyrillic and Greek letters; invisible
   characters go;
2. spelled digits: three or more digit words in a row become digits, ``plus`` before them a plus
   sign, ``dot`` between them a dot;
3. at and dot disguises: ``(at)``, `` [dot] ``, ``name at host dot com``, ``192 dot 168 dot 1 dot 1``.

Identifiers are detected in the result by the same rules and their spans mapped back through
the chain; one that no base span of its kind already covers is added. A replaced passage counts
as a whole. Base spans always stay.

Kinds and rules: e-mail addresses; IPv4 addresses with parts of at most 255; card numbers of
13 to 19 digits that pass Luhn's check; telephone numbers of 9 to 15 digits that start with a
plus sign. Matches are leftmost and do not overlap; one that fails its check is dropped. All
patterns run in time linear in the text: a run is never entered again from its middle.

Places are code points, ends exclusive.

Cases: a NULL text counts as empty and has no spans; texts of any length are searched whole;
rows that repeat an id or a text each get their result; an empty table gives no rows; only the
two named columns are read. A spelled `` at `` counts only before a host whose dots are spelled, or
after a name with a letter and a digit, dot or underscore.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from postloom.llm.bpe import few_rows

KINDS = ["email", "ip", "card", "phone"]

# ASCII letters and the letters that look like them, in the same order.
LOOK_ALIKES = [
    ("AaBCcEeHIiJjKMOoPpSsTXxYy", "АаВСсЕеНІіЈјКМОоРрЅѕТХхУу"),
    ("ABEZHIKMNOoPTYXv", "ΑΒΕΖΗΙΚΜΝΟοΡΤΥΧν"),
]
# Invisible characters.
INVISIBLE = "\u00ad\u034f\u061c\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff"
# Dashes and dots that no rule of Unicode maps to the ASCII ones.
SIGNS = {
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2014": "-", "\u2015": "-", "\u2212": "-",
    "\u3002": ".", "\uff61": ".", "\u06d4": ".",
}
# The digits 0 to 9 in words.
DIGIT_WORDS = [
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
]
# Words for the at sign, each with the words for the dot that go with it.
AT_WORDS = {"at": ("dot",), "ät": ("dot", "punkt"), "arobase": ("dot", "point"), "arroba": ("dot", "punto")}
DOT_WORDS, DASH_WORDS = "dot|point|punkt|punto", "dash|hyphen"
FULL_WIDTH_END = 0x20000  # no character beyond looks like an ASCII one
LOCAL_REACH = 256  # a disguised dot further before the at sign belongs to no address

LOCAL = r"[A-Za-z0-9._%+-]"
_AFTER_AT = r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
# From the start of a run, or from where the match before ended inside one.
_EMAIL = re.compile(rf"(?<!{LOCAL}){LOCAL}++{_AFTER_AT}")
_EMAIL_REST = re.compile(rf"{LOCAL}++{_AFTER_AT}")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGITS = re.compile(r"[^0-9]+")
_LUHN = [sum(divmod(2 * d, 10)) for d in range(10)]


class Span(NamedTuple):
    kind: int
    start: int
    end: int


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(_LUHN[d] for d in values[1::2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    if "@" not in text:
        return
    found, end = _EMAIL.search(text), 0
    while found:
        yield found.span()
        end = found.end()
        found = _EMAIL_REST.match(text, end) or _EMAIL.search(text, end)


def _part_fits(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def spans(text: str) -> list[Span]:
    """Identifiers of a text as it stands, by kind, then start."""
    out = [Span(0, *span) for span in _emails(text)]
    out += [Span(1, *m.span()) for m in _IP.finditer(text) if all(map(_part_fits, m.groups()))]
    for m in _CARD.finditer(text):
        digits = _NO_DIGITS.sub("", m.group()) if m.end() - m.start() >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(Span(2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGITS.sub("", m.group())) <= 15:
            out.append(Span(3, *m.span()))
    return out


class Mapped:
    """A text after edits, and the place in the text before them of each of its places."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        parts, self.news, self.olds, self.ends = [], [], [], []
        at = size = 0

        def add(piece: str, start: int, end: int | None) -> None:
            nonlocal size
            if piece:
                parts.append(piece)
                self.news.append(size)
                self.olds.append(start)
                self.ends.append(end)
                size += len(piece)

        for start, end, new in edits:
            add(text[at:start], at, None)
            add(new, start, end)
            at = end
        add(text[at:], at, None)
        self.text = "".join(parts)

    def back(self, start: int, end: int) -> tuple[int, int]:
        """Source span of a span that is not empty; a replaced passage is taken whole."""
        first, last = bisect_right(self.news, start) - 1, bisect_right(self.news, end - 1) - 1
        low = self.olds[first] + (start - self.news[first] if self.ends[first] is None else 0)
        high = self.ends[last]
        return low, self.olds[last] + end - self.news[last] if high is None else high


@lru_cache(maxsize=1)
def look_alikes() -> dict[int, str]:
    """Characters outside ASCII that stand for one ASCII character."""
    table: dict[int, str] = {}
    for code in range(0x80, FULL_WIDTH_END):
        char = chr(code)
        plain = unicodedata.normalize("NFKC", char)
        if len(plain) == 1 and plain.isascii() and plain.isprintable():
            table[code] = plain
        elif (digit := unicodedata.decimal(char, None)) is not None:
            table[code] = str(digit)
    for ascii_chars, others in LOOK_ALIKES:
        table.update({ord(o): a for a, o in zip(ascii_chars, others, strict=True)})
    return table | {ord(c): s for c, s in SIGNS.items()}


@lru_cache(maxsize=1)
def _disguised_characters() -> frozenset[str]:
    return frozenset(map(chr, look_alikes())) | frozenset(INVISIBLE)


_GONE = re.compile(f"[{INVISIBLE}]+")


def plain_characters(text: str) -> Mapped | None:
    """First transducer; None if it would change nothing."""
    if text.isascii() or _disguised_characters().isdisjoint(set(text)):
        return None
    same_places = text.translate(look_alikes())
    return Mapped(same_places, [(*m.span(), "") for m in _GONE.finditer(same_places)])


_VALUE = {word: str(i) for row in DIGIT_WORDS for i, word in enumerate(row.split())}


def _by_first_letter(words: list[str]) -> str:
    """Alternatives that are entered by their first letter."""
    ordered = sorted(words, key=lambda w: (w[0], -len(w), w))
    groups = (f"{first}(?:{'|'.join(w[1:] for w in group)})" for first, group in groupby(ordered, key=lambda w: w[0]))
    return f"(?:{'|'.join(groups)})"


_WORD = _by_first_letter(list(_VALUE))
_RUN = re.compile(rf"\b{_WORD}\b(?:[ -]{{1,3}}(?:(?:{DOT_WORDS})[ -]{{1,3}})?{_WORD}\b){{2,}}")
_MIDDLE_OF_RUN = re.compile(rf"[ -]{_WORD}[ -]")
_RUN_WORD = re.compile(r"\w+")
_PLUS = re.compile(r"\bplus[ ]\Z")


def digits_of_words(text: str) -> Mapped | None:
    """Second transducer, over a lower-case text."""
    if not _MIDDLE_OF_RUN.search(text):
        return None
    edits = []
    for m in _RUN.finditer(text):
        new = "".join(_VALUE.get(w, ".") for w in _RUN_WORD.findall(m.group()))
        plus = _PLUS.search(text[max(0, m.start() - 6) : m.start()])
        edits.append((m.start() - (5 if plus else 0), m.end(), ("+" if plus else "") + new))
    return Mapped(text, edits) if edits else None


_OPEN, _CLOSE = r"[ ]?[(\[{<][ ]?", r"[ ]?[)\]}>][ ]?"
_IN_BRACKETS = rf"{_OPEN}(?:{DOT_WORDS}|\.){_CLOSE}"
_DOT = rf"(?:{_IN_BRACKETS}|[ ](?:{DOT_WORDS})[ ])"
_AT_SIGNS = [
    re.compile(rf"[(\[{{<][ ]?(?:{'|'.join(AT_WORDS)}|@)[ ]?[)\]}}>][ ]?"),
    re.compile(rf"[ ](?:{'|'.join(AT_WORDS)}|@)[ ]"),
    re.compile("@"),
]
_ANY_DOT = re.compile(_DOT)
_LABEL = "[a-z0-9-]++"
# A host has literal dots and dots in brackets, or the same spelled word between all its parts.
_HOST = re.compile(rf"{_LABEL}(?:(?:\.|{_IN_BRACKETS}){_LABEL})++")
_SPELLED_HOST = re.compile(rf"{_LABEL}(?:\.{_LABEL})*+[ ]({DOT_WORDS})[ ]{_LABEL}(?:(?:[ ]\1[ ]|\.){_LABEL})*+")
_NAME = re.compile(rf"(?:[a-z0-9_%+-]+(?:\.|{_IN_BRACKETS}|[ ]dot[ ]))*[a-z0-9_%+-]+\Z")
_LETTER_LAST = re.compile(r"[a-z][a-z0-9-]*\Z")
_TELLING_NAME = re.compile(r"(?=[^a-z]*[a-z])[a-z0-9_%+.-]*[0-9._]")
_BETWEEN_DIGITS = re.compile(rf"[0-9](?:({_DOT})|[ ]?(?:{DASH_WORDS})[ ]?)(?=[0-9])")
_PLUS_DIGIT = re.compile(r"plus[ ](?=[0-9(])")


def _at_signs(text: str) -> list[tuple[int, int]]:
    """Disguised and plain at signs; one in brackets takes the space before it too."""
    found = []
    for m in (m for pattern in _AT_SIGNS for m in pattern.finditer(text)):
        start = m.start()
        if m.group()[0] not in " @" and text[start - 1 : start] == " ":
            start -= 1
        found.append((start, m.end()))
    return sorted(found)


def _address(text: str, floor: int, start: int, end: int) -> tuple[int, re.Match] | None:
    """Start of the name before an at sign that is disguised, or whose host or name is, and the host."""
    sign = text[start:end]
    literal, spelled = _HOST.match(text, end), _SPELLED_HOST.match(text, end)
    word = sign.strip() if sign != "@" and sign.strip() in (*AT_WORDS, "@") else ""
    if spelled and spelled[1] not in AT_WORDS.get(word, DOT_WORDS.split("|")):
        spelled = None
    host = literal or spelled
    if host is None or not _LETTER_LAST.search(host.group()):
        return None
    reach = max(floor, start - LOCAL_REACH)
    disguised = host is spelled or _ANY_DOT.search(host.group())
    if sign == "@" and not disguised and not _ANY_DOT.search(text, reach, start):
        return None  # an address as it should be
    name = _NAME.search(text[reach:start])
    if name is None or word and not disguised and not _TELLING_NAME.match(name.group()):
        return None
    return reach + name.start(), host


def at_and_dot(text: str) -> Mapped | None:
    """Third transducer, over a lower-case text."""
    edits, floor = [], 0
    for start, end in _at_signs(text):
        found = _address(text, floor, start, end) if start >= floor else None
        if found is None:
            continue
        name, host = found
        edits += [(*d.span(), ".") for d in _ANY_DOT.finditer(text, name, start)]
        edits.append((start, end, "@"))
        edits += [(*d.span(), ".") for d in _ANY_DOT.finditer(text, *host.span())]
        floor = host.end()
    edits += [(m.start() + 1, m.end(), "." if m.group(1) else "-") for m in _BETWEEN_DIGITS.finditer(text)]
    edits += [(*m.span(), "+") for m in _PLUS_DIGIT.finditer(text) if not text[m.start() - 1 : m.start()].isalnum()]
    return Mapped(text, _without_overlaps(sorted(edits))) if edits else None


def _without_overlaps(edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    for edit in edits:
        if not out or edit[0] >= out[-1][1]:
            out.append(edit)
    return out


def _lower(text: str) -> str:
    """Lower case, character by character, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans that appear only once the text is normalised."""
    chain = []
    first = plain_characters(text)
    if first is not None:
        chain.append(first)
        text = first.text
    text = _lower(text)
    for transducer in (digits_of_words, at_and_dot):
        step = transducer(text)
        if step is not None:
            chain.append(step)
            text = step.text
    if not chain:
        return []
    out = []
    covered = {kind: [s for s in base if s.kind == kind] for kind in range(len(KINDS))}
    starts = {kind: [s.start for s in own] for kind, own in covered.items()}
    for kind, start, end in spans(text):
        for step in reversed(chain):
            start, end = step.back(start, end)
        at = bisect_right(starts[kind], start) - 1
        if at < 0 or covered[kind][at].end < end:
            out.append(Span(kind, start, end))
    return list(dict.fromkeys(out))


def joined(found: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in found)


def _kind_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per span: (id, kind, start, end, added, source), ``source`` being the text it covers."""

    def run(batches):
        for batch in batches:
            for rows in few_rows(batch):
                out = []
                for i, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                    base = spans(text or "")
                    for extra, found in ((False, base), (True, added_spans(text or "", base))):
                        out += [(i, KINDS[s.kind], s.start, s.end, extra, text[s.start : s.end]) for s in found]
                values = list(zip(*out)) if out else [()] * 6
                kinds = [rows.schema.field(0).type, pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

    names = [id_col, "kind", "start", "end", "added", "source"]
    schema = f"{id_col} {_kind_of(docs, id_col)}, kind string, start bigint, end bigint, added boolean, source string"
    return docs.select(id_col, text_col).mapInArrow(run, schema)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added).

    The counts and ``base_sha256`` are of the base spans, ``spans`` has all.
    """

    def run(batches):
        for batch in batches:
            for rows in few_rows(batch):
                out = []
                for text in rows.column(1).to_pylist():
                    base = spans(text or "")
                    more = added_spans(text or "", base)
                    counts = [sum(s.kind == k for s in base) for k in range(len(KINDS))]
                    digest = hashlib.sha256(joined(base).encode()).hexdigest()
                    out.append((*counts, digest, joined(sorted(base + more)), len(more)))
                values = list(zip(*out)) if out else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, values, kinds)], [id_col, *names])

    names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
    schema = (
        f"{id_col} {_kind_of(docs, id_col)}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string, n_added bigint"
    )
    return docs.select(id_col, text_col).mapInArrow(run, schema)
