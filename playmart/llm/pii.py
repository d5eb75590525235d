"""Personal data: patterns propose, checksums confirm, context adjusts the score.

Base kinds (email, ip, card, phone) follow fixed rules and are always reported. The further
kinds (iban, id) are reported where their score reaches the threshold: an IBAN has to pass
mod 97, a number with dashes needs a context word. Every finding carries a score: what its
pattern is worth alone, plus what a passed checksum and a near context word add.

A null text is an empty one: no findings. Rows are independent, so repeated rows give the
same findings twice, null ids stay null, and an empty table gives an empty result. Other
columns are not read. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_map, slices, texts

#: Kinds in their order, patterns and limits.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "id")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}")
#: Characters of an account number by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


def _iban_of(length: int) -> re.Pattern:
    """A number of so many characters, in groups of four or without blanks."""
    groups, rest = divmod(length - 4, 4)
    last = rf"(?: ?[A-Z0-9]{{{rest}}})" if rest else ""
    return re.compile(rf"[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{last}(?![A-Za-z0-9])")


IBANS = {country: _iban_of(n) for country, n in IBAN_LENGTHS.items()}
NATIONAL_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)
#: Fixed word lists, looked for near a finding.
CONTEXT = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "server", "host", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "id": ("ssn", "social security", "national id", "tax"),
}
#: What a pattern alone is worth; a passed checksum and a context word add the next two.
WORTH = {"email": 0.8, "ip": 0.5, "card": 0.3, "phone": 0.5, "iban": 0.3, "id": 0.2}
CHECKED, NEAR, THRESHOLD, REACH = 0.5, 0.2, 0.4, 48

#: Context counts as whole words, plural included.
CONTEXT_WORDS = {k: re.compile(rf"(?<![^\W_])(?:{'|'.join(words)})s?(?![^\W_])", re.I) for k, words in CONTEXT.items()}

SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string,"
    " findings array<struct<kind:string,start:int,end:int,score:double>>"
)
_FINDING = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    """The check of account numbers: country and check digits moved to the end, letters as 10 to 35."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _digits(s: str) -> str:
    return "".join(filter("0123456789".__contains__, s))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards, so that no run is scanned twice."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_PART:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def _proposed(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, whether a checksum confirmed it)."""
    for start, end in _emails(text):
        yield "email", start, end, False
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m[0].split(".")):
            yield "ip", *m.span(), False
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            yield "card", *m.span(), True
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]:
                yield "phone", *m.span(), False
    for m in IBAN_START.finditer(text):
        found = IBANS[m[1]].match(text, m.start()) if m[1] in IBANS else None
        if found and mod97(found[0].replace(" ", "")):
            yield "iban", *found.span(), True
    for m in NATIONAL_ID.finditer(text):
        yield "id", *m.span(), False


def _near(kind: str, text: str, start: int, end: int) -> bool:
    """Whether a context word stands within ``REACH`` characters before or behind."""
    words, stop = CONTEXT_WORDS[kind], min(len(text), end + REACH)
    while stop < min(len(text), end + 2 * REACH) and text[stop].isalnum():
        stop += 1  # not inside a word
    return bool(words.search(text, max(0, start - REACH), start) or words.search(text, end, stop))


def findings(text: str) -> list[tuple[str, int, int, float]]:
    """All findings by start, then kind as listed."""
    out = []
    for kind, start, end, checked in _proposed(text):
        score = WORTH[kind] + CHECKED * checked + NEAR * _near(kind, text, start, end)
        if kind in BASE or score >= THRESHOLD:
            out.append((kind, start, end, round(min(1.0, score), 2)))
    out.sort(key=lambda f: (f[1], KINDS.index(f[0])))
    return out


def joined(found, kinds=KINDS) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in found if kind in kinds)


def _scan(batches: Iterator[pa.RecordBatch]):
    names = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "findings")
    for batch in slices(batches):
        found = [findings(t) for t in texts(batch)]
        columns = [batch.column("doc_id").cast(pa.int64())]
        columns += [pa.array([sum(x[0] == kind for x in f) for f in found], pa.int64()) for kind in BASE]
        columns.append(pa.array([hashlib.sha256(joined(f, BASE).encode()).hexdigest() for f in found]))
        columns.append(pa.array([joined(f) for f in found]))
        keys = ("kind", "start", "end", "score")
        columns.append(pa.array([[dict(zip(keys, x)) for x in f] for f in found], pa.list_(_FINDING)))
        yield pa.RecordBatch.from_arrays(columns, names=list(names))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, their digest, all spans and scored findings."""
    return arrow_map(docs.select("doc_id", "text"), SCHEMA, _scan)
