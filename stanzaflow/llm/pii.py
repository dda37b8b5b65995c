"""Personal data with offset-preserving deobfuscation.

Four base detectors (email, ip, card, phone) read the text itself. Three
transducers then rewrite disguises while every character of the rewritten text
keeps the span of source characters it came from: homoglyphs and invisible
characters, spelled digits (and dots and a plus beside numerals), and at/dot in words or brackets. The same detectors
read the rewritten text, and what they find is mapped back. A found span is
added if it covers something rewritten and overlaps no base span of its kind.

Offsets are in code points, ends exclusive. The detectors are linear in the
length of the text: no pattern rescans a run it has failed on.

Defined results: a null text is empty and has no spans; an empty table gives no
rows; repeated rows get equal values; a null doc_id is passed on; extra columns
are ignored. The counts ``n_*`` are of base spans; ``added`` counts the others.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> list[Span]:
    """A match is tied to its one ``@``; its start is the run of local characters before it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        else:
            free = at + 1  # a local part can't hold this @
        at = text.find("@", max(free, at + 1))
    return out


def ips(text: str) -> list[Span]:
    small = lambda x: len(x := x.lstrip("0")) <= 3 and int(x or 0) <= 255
    return [m.span() for m in _IP.finditer(text) if all(map(small, m[0].split(".")))]


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(d):
            out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


DETECT = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def base(text: str) -> dict[str, list[Span]]:
    return {kind: DETECT[kind](text) for kind in KINDS}


# -- transducers -----------------------------------------------------------------------------------

_LOOKS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K",
    "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɑ": "a", "ɡ": "g", "ո": "n", "օ": "o", "ս": "u", "․": ".", "。": ".",
    "｡": ".", "‧": ".", "∙": ".", "·": ".", "•": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "﹫": "@", "ⓐ": "@",
    " ": " ", " ": " ", " ": " ", " ": " ", "　": " ",
}
_GONE = "​‌‍⁠﻿­᠎"


@cache
def _glyphs() -> dict[int, str]:
    table = {ord(k): v for k, v in _LOOKS.items()} | {ord(c): "" for c in _GONE}
    for first, last in ((0xFF01, 0xFF5E), (0x1D400, 0x1D7FF), (0x2460, 0x24EA), (0x2070, 0x2089)):
        for i in range(first, last + 1):
            plain = unicodedata.normalize("NFKC", chr(i))
            if len(plain) == 1 and plain.isascii() and plain.isprintable():
                table.setdefault(i, plain)
    for first in (0x660, 0x6F0, 0x966, 0x9E6):
        table |= {first + d: str(d) for d in range(10)}
    return table


_WIDE = re.compile("[^\x00-\xff]|[\xa0\xad\xb7]")


@cache
def _odd():
    return re.compile("[" + "".join(re.escape(chr(i)) for i in _glyphs()) + "]")


_DIGITS = {
    "zero": 0, "oh": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "zéro": 0, "un": 1, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "null": 0, "eins": 1, "zwei": 2, "zwo": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
_TIMES = {"double": 2, "triple": 3}
_NAME = "|".join(sorted(map(re.escape, _DIGITS), key=len, reverse=True))
_DOT = r"(?:dot|punto|punkt|point)"
_WORDS = rf"(?:(?:double|triple)[ -])?(?:{_NAME})"
_BETWEEN = rf"(?:[ \t,-]{{1,3}}|[ \t]*(?:\.|[(\[{{<][ \t]*{_DOT}[ \t]*[)\]}}>]|(?<=[ \t]){_DOT}(?=[ \t]))[ \t]*)"
#: A run with a spelled digit or more, numerals and dots between them allowed; ``plus`` may lead. No identifier has
#: more than 19 digits, so no more numerals than that belong to it.
_SPELLED = re.compile(
    rf"(?i)(?<!\w)(?:plus[ \t-]+|\+[ \t]?)?(?:[0-9]+{_BETWEEN}){{0,19}}{_WORDS}(?!\w)(?:{_BETWEEN}(?:{_WORDS}|[0-9]+)(?!\w))*"
)
_PART = re.compile(rf"(?i)(?P<plus>plus[ \t-]+|\+[ \t]?)|(?P<digit>{_WORDS})(?!\w)|(?P<number>[0-9]+)|(?P<dot>[ \t]*(?:\.|[(\[{{<]?[ \t]*{_DOT}[ \t]*[)\]}}>]?)[ \t]*)|(?P<gap>[ \t,-]+)")

_OPEN, _SHUT = r"[ \t]{0,3}[(\[{<][ \t]{0,2}", r"[ \t]{0,2}[)\]}>][ \t]{0,3}"
_AT_MARK = rf"(?:{_OPEN}(?:at|ät|arroba|chez|@){_SHUT}|[ \t]{{1,3}}(?:at|arroba)[ \t]{{1,3}}|[ \t]{{0,3}}@[ \t]{{0,3}}|[ \t]{{0,2}}(?:_at_|-at-)[ \t]{{0,2}})"
_DOT_MARK = rf"(?:{_OPEN}(?:{_DOT}|\.){_SHUT}|[ \t]{{1,3}}{_DOT}[ \t]{{1,3}}|[ \t]{{0,2}}(?:_dot_|-dot-)[ \t]{{0,2}})"
_LOCAL_DOT = re.compile(rf"(?i){_OPEN}(?:{_DOT}|\.){_SHUT}|[ \t]{{1,3}}dot[ \t]{{1,3}}")
_AT = re.compile(rf"(?i){_AT_MARK}")
_DOTS = re.compile(rf"(?i){_DOT_MARK}|\.")
_LOCALS = re.compile(r"[A-Za-z0-9._%+-]+")
_HOSTS = re.compile(r"[A-Za-z0-9-]+")
_ALNUM = re.compile(r"[A-Za-z0-9]")
_BARE_AT = re.compile(r"(?i)[ \t]+(?:at|arroba)[ \t]+$")
_BRACKETED = re.compile(rf"(?i)[(\[{{<][ \t]{{0,2}}(?:at|ät|arroba|chez|@|{_DOT}|\.)[ \t]{{0,2}}[)\]}}>]")
_PLAIN = ("_at_", "-at-", "_dot_", "-dot-", "_AT_", "-AT-", "_DOT_", "-DOT-", " @", "@ ")
#: Words that make a rewriting possible: d a digit, n what may stand between digits, a an at.
_CLASS = (
    {w.encode(): "d" for d in _DIGITS for w in (d, d.upper().encode().lower().decode())}
    | {w.encode(): "n" for w in ("dot", "punto", "punkt", "point", "double", "triple")}
    | {b"at": "a", b"arroba": "a", b"plus": "p"}
)
_APART = bytes(32 if i < 128 and not chr(i).isalnum() else i for i in range(256))
_RUN = re.compile("[dn]{2,}")
_BLOCK = 1 << 20


def _hints(text: str) -> str:
    """One letter a word, in order; cheap enough for every text. Long texts are read block by block."""
    out, at = [], 0
    while at < len(text):
        end = text.find(" ", at + _BLOCK)
        end = len(text) if end < 0 else end
        words = text[at:end].encode("utf-8", "replace").lower().translate(_APART).split()
        out.append("".join([_CLASS.get(w) or ("n" if w.isdigit() else ".") for w in words]))
        at = end
    return "".join(out)


class Tape:
    """A rewritten text that knows where it came from.

    Each rewriting keeps its edits and the stretches between them, so memory goes
    with the edits, not with the text. ``changed``: rewritten characters, in order.
    """

    def __init__(self, text: str):
        self.text, self.changed = text, []
        self.maps: list[tuple[list[int], list[tuple[int, int | None]]]] = []

    def span(self, first: int, last: int) -> Span:
        """What the characters from ``first`` to ``last`` came from, in the source."""
        for places, old in reversed(self.maps):
            k = bisect_right(places, first) - 1
            a, b = old[k]
            first = a if b is not None else a + first - places[k]
            k = bisect_right(places, last) - 1
            a, b = old[k]
            last = b - 1 if b is not None else a + last - places[k]
        return first, last + 1

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """edits: (start, end, new text) in order, apart from each other."""
        if not edits:
            return
        out, places, old, changed, at, now = [], [], [], [], 0, 0
        before, i = self.changed, 0
        for a, b, new in [*edits, (len(self.text), len(self.text), "")]:
            while i < len(before) and before[i] < at:
                i += 1
            while i < len(before) and before[i] < a:
                changed.append(before[i] - at + now)
                i += 1
            if a > at:
                places.append(now)
                old.append((at, None))
                out.append(self.text[at:a])
                now += a - at
            if new:
                places.append(now)
                old.append((a, b))
                out.append(new)
                changed += range(now, now + len(new))
                now += len(new)
            elif b > a:  # the character after a deleted one counts as rewritten
                changed.append(now)
            at = b
        self.text, self.changed = "".join(out), changed
        self.maps.append((places, old))


def _unglyph(tape: Tape) -> None:
    if not tape.text.isascii() and _WIDE.search(tape.text):
        table = _glyphs()
        tape.rewrite([(m.start(), m.end(), table[ord(m[0])]) for m in _odd().finditer(tape.text)])


def _unspell(tape: Tape, hints: str, least: int) -> None:
    """Digits for their names, in runs that have ``least`` spelled ones; the detectors check how many digits they need."""
    if not any("d" in run for run in _RUN.findall(hints)):
        return
    edits = []
    for m in _SPELLED.finditer(tape.text):
        pieces, digits, at = [], 0, m.start()
        while at < m.end() and (p := _PART.match(tape.text, at, m.end())):
            if p["plus"]:
                pieces.append((p.start(), p.end(), "+"))
            elif p["digit"]:
                *times, name = re.split(r"[ -]", p["digit"].lower())
                new = str(_DIGITS[name]) * (_TIMES[times[0]] if times else 1)
                pieces.append((p.start(), p.end(), new))
                digits += len(new)
            elif p["dot"]:
                pieces.append((p.start(), p.end(), "."))
            elif p["gap"] and p.end() < m.end():
                pieces.append((p.start(), p.end(), ""))
            at = p.end()
        if digits >= least:
            edits += pieces
    tape.rewrite(edits)


#: Numerals between disguised dots, and a spelled plus before one.
_DOTTED = re.compile(rf"(?i)(?<![\w.])[0-9]++(?:(?:\.|{_DOT_MARK})[0-9]++){{3,}}")
_DISGUISED_DOT = re.compile(rf"(?i){_DOT_MARK}")
_PLUS = re.compile(r"(?i)(?<!\w)plus[ \t]{1,3}(?=[0-9])")


def _unjoin(tape: Tape, hints: str) -> None:
    """Dots between numerals, and a plus, in words or brackets."""
    edits = []
    if "nnnn" in hints:
        for m in _DOTTED.finditer(tape.text):
            edits += [(*x.span(), ".") for x in _DISGUISED_DOT.finditer(tape.text, m.start(), m.end())]
    if "p" in hints:
        edits += [(*m.span(), "+") for m in _PLUS.finditer(tape.text)]
    tape.rewrite(sorted(edits))


_NEAR = re.compile("a.*n")


def _chains(text: str) -> tuple[list[int], list[int], list[int]]:
    """Runs of local characters: starts, ends, and where the chain of runs begins that spelled dots join."""
    dots = {m.end(): m.start() for m in _LOCAL_DOT.finditer(text)}
    starts, ends, begins, at = [], [], [], {}
    for m in _LOCALS.finditer(text):
        starts.append(m.start())
        ends.append(m.end())
        begins.append(at.get(dots.get(m.start()), m.start()))
        at[m.end()] = begins[-1]
    return starts, ends, begins


#: No local part, mark or host goes beyond such a stretch.
_ISLAND = re.compile(r"[A-Za-z0-9._%+@ \t()\[\]{}<>äÄ-]{5,}")


def _unmark(tape: Tape, hints: str) -> None:
    """At and dot in words or brackets. A bare ``at`` counts only if the host has a disguised dot too."""
    text = tape.text
    if not (_NEAR.search(hints) or any(x in text for x in _PLAIN) or _BRACKETED.search(text)):
        return
    edits = []
    for m in _ISLAND.finditer(text):
        if _AT.search(text, m.start(), m.end()):
            edits += [(a + m.start(), b + m.start(), new) for a, b, new in _marks(m[0])]
    tape.rewrite(edits)


def _marks(text: str) -> list[tuple[int, int, str]]:
    """The marks of addresses, with what they stand for.

    Local part and host are followed outward from each at-mark, over any number
    of characters and dots; runs and dots are listed once, so the work is linear.
    """
    ats = [m.span() for m in _AT.finditer(text)]
    starts, ends, begins = _chains(text)
    dots = [m.span() for m in _DOTS.finditer(text)]
    hosts = [m.span() for m in _HOSTS.finditer(text)]
    edits, free = [], 0
    for a, b in ats:
        k = bisect_left(starts, a) - 1  # the run that holds the character before the mark
        if a < free or k < 0 or ends[k] < a or max(starts[k], free) >= a or not _ALNUM.match(text, b):
            continue
        host, at = [], b
        i = bisect_left(dots, (b, b))
        h = bisect_left(hosts, (b + 1, 0)) - 1
        while h < len(hosts):
            while h < len(hosts) and hosts[h][1] <= at:
                h += 1
            if h == len(hosts) or hosts[h][0] > at:
                break
            while i < len(dots) and dots[i][0] <= at:
                i += 1
            if i == len(dots) or dots[i][0] > hosts[h][1] or not _ALNUM.match(text, dots[i][1]):
                break
            host.append(dots[i])
            at = dots[i][1]
        marked = [x for x in host if text[x[0] : x[1]] != "."]
        mark = text[a:b]
        if not host or (not marked and (_BARE_AT.search(mark) or mark == "@")):
            continue
        first = max(begins[k], free)
        i = bisect_left(dots, (first, first))
        while i < len(dots) and dots[i][1] <= a:
            if dots[i][1] - dots[i][0] > 1:
                edits.append((*dots[i], "."))
            i += 1
        edits.append((a, b, "@"))
        edits += [(*x, ".") for x in marked]
        free = next(x for x in hosts[bisect_left(hosts, (at + 1, 0)) - 1 :] if x[1] > at)[1]
    return edits


def added(text: str, found: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans behind a disguise, in source characters.

    Where names of digits are few they may be plain words beside an identifier:
    what is found without rewriting them stands, and what needs them is added.
    """
    more: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    hints = ""
    for least in (3, 1):
        tape = Tape(text)
        _unglyph(tape)
        hints, before = hints or _hints(tape.text), tape.text
        _unspell(tape, hints, least)
        if least == 1 and tape.text == before:
            break
        _unjoin(tape, hints)
        _unmark(tape, hints)
        if not tape.changed:
            continue
        for kind in KINDS:
            known = sorted(found[kind] + more[kind])
            for a, b in DETECT[kind](tape.text):
                i = bisect_left(tape.changed, a)
                if i == len(tape.changed) or tape.changed[i] >= b:
                    continue
                start, end = tape.span(a, b - 1)
                k = bisect_left(known, (start, start))
                if all(end <= s or e <= start for s, e in known[max(0, k - 1) : k + 2]):
                    more[kind].append((start, end))
    return {kind: sorted(x) for kind, x in more.items()}


def detect(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """(base spans, added spans) by kind, each in order."""
    found = base(text)
    return found, added(text, found)


def listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in spans[kind])


def spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, added."""
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, added long"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                found, more = detect(text or "")
                both = {k: sorted(found[k] + more[k]) for k in KINDS}
                sha = hashlib.sha256(listed(found).encode()).hexdigest()
                rows.append([*[len(found[k]) for k in KINDS], sha, listed(both), sum(map(len, more.values()))])
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
