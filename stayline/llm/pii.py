"""Personal data: e-mail addresses, IP addresses, card and phone numbers, also where they are disguised.

The base kinds are found in the text as it stands. A transducer then rewrites disguises (homoglyphs and full-width
forms, spelled digits, ``at`` and ``dot`` in words or brackets), keeping for each written character the source characters
it came from; the same detectors run on what it wrote, and spans that stem from a disguise are mapped back and added.

Offsets count code points, the end is exclusive. Null texts count as empty and have no spans. Rows are independent:
repeated rows give repeated results, an empty table an empty one; every scan is linear in the text, so very long texts
only take their share of time. Base spans always stay. An added span that overlaps some is added too if it holds each of
them whole, as where a disguise stands for a part of an identifier only; else it gives way, also to added ones before it.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# Letters of other scripts that look like a Latin one.
LOOKALIKES = str.maketrans(
    "аеорсухіјѕһԁɡոѵԛԝ" "АВЕКМНОРСТУХІЅЈ" "οανιρυκ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ſıİ\u212a",
    "aeopcyxijshdgnvqw" "ABEKMHOPCTYXISJ" "oavipuk" "ABEZHIKMNOPTYX" "siIK",
)
SPELLED = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_NUMERIC = re.compile(r"[0-9+][\x20().0-9+-]{5,}")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT_WORD = "|".join(SPELLED)
_OPEN, _SHUT = r"\s{0,3}[\[({<]\s{0,3}", r"\s{0,3}[\])}>]\s{0,3}"
#: What follows a bare ``at``: a name with a spelled dot, or one that ends in two letters, so that no "at 3.5" or "at U.S." counts.
_HOST = rf"[a-z0-9-]{{1,63}}(?:\.[a-z0-9-]{{1,63}})*(?:\s{{1,3}}dot\s{{1,3}}|{_OPEN}dot{_SHUT}|\.(?:[a-z]{{2,63}}|xn--[a-z0-9-]{{1,59}})(?![a-z0-9-]))"
_DISGUISE = re.compile(
    rf"(?P<at>{_OPEN}at{_SHUT}|(?<=[a-z0-9])\s{{1,3}}at\s{{1,3}}(?={_HOST}))"
    rf"|(?P<dot>{_OPEN}dot{_SHUT}|(?<=[a-z0-9])\s{{1,3}}dot\s{{1,3}}(?=[a-z0-9]))"
    rf"|(?P<plus>\bplus[\s-]{{1,3}}(?=(?:{_DIGIT_WORD})\b))"
    rf"|(?P<digit>(?<![a-z])(?:{_DIGIT_WORD})(?![a-z])(?:[\s,-]{{1,3}}(?=(?:{_DIGIT_WORD})(?![a-z])))?)",
    re.IGNORECASE,
)
# Necessary for a span to hold a disguise, each read in lower case: a spelled sign where _DISGUISE takes it, or a spelled
# digit with another digit, in figures or spelled, before or after it. A digit word that stands alone is in no number, and
# in an address it is found as it stands.
_AT = re.compile(rf"at(?=\s{{0,3}}[\])}}>]|\s{{1,3}}{_HOST})")
_DOT = re.compile(r"dot(?=\s{0,3}[\])}>]|\s{1,3}[a-z0-9])")
_BETWEEN = r"[\s,().+-]*"
_SPELLED = re.compile(rf"(?:{_DIGIT_WORD}){_BETWEEN}(?:[0-9]|{_DIGIT_WORD})|[0-9]{_BETWEEN}(?:{_DIGIT_WORD})")

Span = tuple[int, int, str]


def _plain_forms() -> dict[int, str]:
    """Characters that stand for one ASCII letter, digit or sign: look-alikes, and full-width, mathematical and enclosed
    forms by their Unicode decomposition, and the digits of all scripts."""
    out = {code: chr(plain) for code, plain in LOOKALIKES.items()}
    formed = [*range(0x660, 0xA00), *range(0x2070, 0x20A0), *range(0x2460, 0x2500), *range(0xFE50, 0xFF5F), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200)]
    digits = [code for code in range(0x80, sys.maxunicode + 1) if chr(code).isdecimal()]
    for code in dict.fromkeys([*formed, *digits]):
        shown = unicodedata.normalize("NFKC", chr(code))
        number = unicodedata.decimal(chr(code), None)
        if number is not None:
            shown = str(number)
        if len(shown) == 1 and shown.isascii() and (shown.isalnum() or shown in "@.+-_()"):
            out[code] = shown
    return out


PLAIN = _plain_forms()
#: Two classes, as the compiled form of one that also holds characters beyond the first plane is slow.
_ODD = re.compile("[" + "".join(re.escape(chr(c)) for c in PLAIN if c < 0x10000) + "]")
_ODD_HIGH = re.compile("[\U00010000-\U0010ffff]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Each @ with the longest local part before it, not reaching into the address before, and a dotted domain after."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            out.append((start, free, "email"))
        at = text.find("@", max(at + 1, free))
    return out


def numbers(text: str) -> list[Span]:
    """IP addresses, cards and phones; each lies within one run of digits and separators."""
    out = []
    for run in _NUMERIC.finditer(text):
        lo, hi = run.span()
        for m in _IP.finditer(text, lo, hi):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
                out.append((m.start(), m.end(), "ip"))
        if hi - lo >= 12:
            for m in _CARD.finditer(text, lo, hi):
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), m.end(), "card"))
        if "+" in run[0]:
            for m in _PHONE.finditer(text, lo, hi):
                if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
                    out.append((m.start(), m.end(), "phone"))
    return out


def base_spans(text: str) -> list[Span]:
    return [*(emails(text) if "@" in text else ()), *numbers(text)]


def rewrite(text: str) -> tuple[str, list[int], list[int], list[bool]] | None:
    """The text without disguises and, for each of its characters, where its source starts and ends and whether it was
    disguised. None if there is nothing to rewrite."""
    plain = text.translate(PLAIN) if not text.isascii() and (_ODD.search(text) or _ODD_HIGH.search(text)) else text
    lower = plain.lower()
    spelled = any(word in lower for word in SPELLED) and _SPELLED.search(lower)
    if plain == text and not spelled and not _DOT.search(lower) and not _AT.search(lower):
        return None
    out: list[str] = []
    starts: list[int] = []
    ends: list[int] = []
    odd: list[bool] = []

    def copy(lo: int, hi: int) -> None:
        out.append(plain[lo:hi])
        starts.extend(range(lo, hi))
        ends.extend(range(lo + 1, hi + 1))
        odd.extend(map(str.__ne__, plain[lo:hi], text[lo:hi]))

    at = 0
    for m in _DISGUISE.finditer(plain):
        copy(at, m.start())
        at = m.end()
        shown = {"at": "@", "dot": ".", "plus": "+"}.get(m.lastgroup) or SPELLED[re.match("[a-z]+", m[0], re.IGNORECASE)[0].lower()]
        out.append(shown)
        starts.append(m.start())
        ends.append(m.start() + len(m[0].rstrip(" \t\n,-")) if m.lastgroup == "digit" else m.end())
        odd.append(True)
    copy(at, len(plain))
    return "".join(out), starts, ends, odd


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Identifiers that show only without disguises, at their place in the source; each is clear of the base spans or holds
    those it meets whole and more."""
    written = rewrite(text)
    if written is None:
        return []
    shown, starts, ends, odd = written
    free = 0  # end of the last added span
    out: list[Span] = []
    for start, end, kind in sorted(base_spans(shown), key=lambda s: (s[0], KINDS.index(s[2]))):
        if not any(odd[start:end]):
            continue
        span = starts[start], ends[end - 1]
        met = [(s, e) for s, e, _ in base if s < span[1] and e > span[0]]
        if span[0] >= free and all(span[0] <= s and e <= span[1] and (s, e) != span for s, e in met):
            out.append((*span, kind))
            free = span[1]
    return out


def find(text: str) -> list[tuple[int, int, str, bool]]:
    """All spans as (start, end, kind, whether added), by start and then kind."""
    base = base_spans(text)
    spans = [(*s, False) for s in base] + [(*s, True) for s in added_spans(text, base)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def masked(text: str) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping spans share the first one's."""
    out, at = [], 0
    for start, end, kind, _ in find(text):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


SPANS = "array<struct<start: int, end: int, kind: string, added: boolean>>"


def spans(text: Column) -> Column:
    """The spans of each text, by start and then kind."""

    @F.arrow_udf(SPANS)
    def found(texts: pa.Array) -> pa.Array:
        shape = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("added", pa.bool_())]))
        rows = [[dict(zip(("start", "end", "kind", "added"), s)) for s in find(value.as_py() or "")] for value in texts]
        return pa.array(rows, shape)

    return found(text)


def mask(text: Column) -> Column:
    """The text with what ``spans`` finds replaced; null stays null."""

    @F.arrow_udf("string")
    def hidden(texts: pa.Array) -> pa.Array:
        return pa.array([None if value.as_py() is None else masked(value.as_py()) for value in texts], pa.string())

    return hidden(text)
