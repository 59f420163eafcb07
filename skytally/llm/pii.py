"""Personal data by anchors: an Aho-Corasick pass finds cues, small parsers expand and check each.

Anchors are at-signs, plus signs, digits, ``://`` and words that announce an identifier. Around each anchor a
parser takes the whole candidate and then accepts or drops it. Spans of one kind never overlap; spans of
different kinds may. Positions are code points, the end is exclusive.

Null and empty texts have no spans. A text is read once from beginning to end, each parser goes on behind its last match
and looks at a bounded stretch or at each character a fixed number of times, so the time of a very long text grows with
its length; one text is held whole. The text column's other columns pass through; a column that has the name of
the result is replaced. Rows are judged one by one, so repeated rows and ties don't matter.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds in the order in which spans with one start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("login", "iban", "ssn", "secret")
KINDS = BASE_KINDS + MORE_KINDS

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DIGITS = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_USER = re.compile(r"[^\s/?#@]+@[A-Za-z0-9.-]+")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyz0123456789+.-")
_IBAN = re.compile(r"[ :=#.]{0,4}([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30})")
_SSN = re.compile(r"[ :=#.]{0,4}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])")
_SECRET = re.compile(r"[ :='\"]{1,6}([A-Za-z0-9_/+=.-]{16,})")

#: Words that announce an identifier, in lower case, and the kind that may follow.
CUES = {
    "iban": "iban",
    "ssn": "ssn",
    "social security number": "ssn",
    "token": "secret",
    "secret": "secret",
    "password": "secret",
    "passwd": "secret",
    "api_key": "secret",
    "api key": "secret",
    "apikey": "secret",
    "access_key": "secret",
}

_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])
)


@cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for cue, kind in CUES.items():
        found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _fits_byte(digits: str) -> bool:
    """Whether a number is at most 255, with any number of zeros before it."""
    digits = digits.lstrip("0") or "0"
    return len(digits) <= 3 and int(digits) <= 255


def _iban_fits(text: str) -> bool:
    text = text.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all personal data in a text, by start and then by kind."""
    folded = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only
    free = dict.fromkeys(KINDS, 0)  # where the next match of a kind may start
    found: list[tuple[int, str, int]] = []

    def take(kind: str, start: int, end: int) -> None:
        found.append((start, kind, end))

    for last, (cue, size) in _automaton().iter(folded):
        at = last - size + 1
        if cue == "digit":
            if at >= free["card"]:
                match = _CARD.match(text, at)
                free["card"] = match.end() if match else at + 1
                if match:
                    digits = match[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        take("card", at, match.end())
            if at >= free["ip"]:
                match = _IP.match(text, at)
                free["ip"] = (match or _DIGITS.match(text, at)).end()
                if match and all(_fits_byte(part) for part in match[0].split(".")):
                    take("ip", at, match.end())
        elif cue == "plus":
            match = _PHONE.match(text, at) if at >= free["phone"] else None
            if match:
                free["phone"] = match.end()
                if 9 <= sum(c.isdigit() for c in match[0]) <= 15:
                    take("phone", at, match.end())
        elif cue == "at":
            start = at
            while start > free["email"] and text[start - 1] in _LOCAL:
                start -= 1
            match = _DOMAIN.match(text, at + 1) if start < at else None
            if match:
                free["email"] = match.end()
                take("email", start, match.end())
        elif cue == "scheme":
            match = _USER.match(text, at + 3)
            start = at
            while start > free["login"] and folded[start - 1] in _SCHEME:
                start -= 1
            if match and start < at:
                free["login"] = match.end()
                take("login", start, match.end())
        else:
            parser = {"iban": _IBAN, "ssn": _SSN, "secret": _SECRET}[cue]
            # A value begins at most six characters behind its cue.
            match = parser.match(text, last + 1) if last + 7 >= free[cue] else None
            if match and match.start(1) >= free[cue]:
                fits = True
                if cue == "iban":
                    fits = _iban_fits(match[1])
                elif cue == "secret":  # a word is no key, nor is any later part of it
                    fits = any(c.isdigit() for c in match[1])
                    free[cue] = match.end(1)
                if fits:
                    free[cue] = match.end(1)
                    take(cue, match.start(1), match.end(1))
    found.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    return found


_SPANS = T.ArrayType(
    T.StructType()
    .add("kind", T.StringType())
    .add("start", T.LongType())
    .add("end", T.LongType())
    .add("value", T.StringType())
)


@F.arrow_udf(_SPANS)
def _spans(column: pa.Array) -> pa.Array:
    result = []
    for value in column:
        text = value.as_py() or ""
        result.append(
            [{"kind": k, "start": s, "end": e, "value": text[s:e]} for s, k, e in spans(text)] if text else []
        )
    return pa.array(result, _TYPE)


def find_pii(docs: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with the array of (kind, start, end, value) of all personal data in ``text``."""
    return docs.withColumn(into, _spans(F.col(text)))
