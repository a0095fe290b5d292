"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Base kinds are kept whatever surrounds them: email, ip (parts up to 255), card (16 to 19 digits that
pass Luhn) and phone (8 to 15 digits). Further kinds start at a score of their own, which checksums
and context words raise or lower, and are kept from ``threshold`` on:

* ``iban``: country, check digits and account in either case, confirmed by mod-97 and the country's length;
  the search goes on behind it, or behind the check digits of a candidate that fails;
* ``short_card``: 13 to 15 digits that pass Luhn, which needs a card word nearby or an issuer prefix;
* ``ssn``: ``ddd-dd-dddd`` with legal parts, which needs a context word;
* ``secret``: a key word, ``=`` or ``:`` and a quoted or bare token of 20 characters or more with digits;
* ``api_key``: a key with its issuer's prefix, alphabet and length; one issuer's keys end in a CRC-32 in base 62,
  which raises the score;
* ``web_token``: three base64 parts whose first is a JSON object that names an algorithm;
* ``private_key``: a PEM block from its opening line to the closing line with the same label.

Every scan is linear in the text: patterns begin only at the start of a run of their characters and
are possessive, and e-mail addresses grow outwards from each ``@``; a run of a million digits is one
step, not a square. Whole texts are scanned.

Defined results: a null text is empty and has no spans; repeated rows give repeated results; an
empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import base64
import bisect
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.common import tidy

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "short_card", "ssn", "secret", "api_key", "web_token", "private_key")
KINDS = BASE + ADDED

# Total lengths of account numbers by country, as in the public registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29,
    "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29,
    "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
    "YE": 30,
}
# Prefixes, alphabets and lengths of issuers' keys.
_API_KEY = re.compile(
    r"(?<![A-Za-z0-9_])(?:"
    r"(?:AKIA|ASIA|AIDA|AROA|AGPA|ANPA)[A-Z2-7]{16}(?![A-Za-z0-9])"
    r"|gh[oprsu]_[A-Za-z0-9]{36,}+"
    r"|github_pat_[A-Za-z0-9]{22}_[A-Za-z0-9]{59}(?![A-Za-z0-9])"
    r"|AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])"
    r"|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}+"
    r"|xox[abeoprs]-[A-Za-z0-9-]{10,}+"
    r"|glpat-[A-Za-z0-9_-]{20,}+"
    r"|npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"
    r")"
)
_WEB_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]*+")
_PEM = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}")
_IBAN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_SECRET = re.compile(
    r"(?i:\b(?:token|secret|passwd|password|api[_-]?key|access[_-]?key|auth)\b)\x20{0,3}[=:]\x20{0,3}[\"']?([A-Za-z0-9+/_-]{20,}+)"
)
_CONTEXT = {
    "iban": re.compile(r"(?i)\b(?:iban|account|konto|cuenta|compte|bank)"),
    "short_card": re.compile(r"(?i)\b(?:card|visa|amex|american express|karte|carte|tarjeta|cvv|credit)"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social security|sozialversicherung|tax id)"),
}
_AGAINST = re.compile(r"(?i)\b(?:isbn|order|invoice|tracking|version|serial)\b")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def _digits(piece: str) -> str:
    return "".join(c for c in piece if "0" <= c <= "9")


def _base(text: str, chains: list[tuple[int, int, str]]) -> Iterator[Span]:
    for a, b in _emails(text):
        yield Span("email", a, b, 0.95)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield Span("ip", *m.span(), 0.9)
    for a, b, digits in chains:
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield Span("card", a, b, 0.95)
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            yield Span("phone", *m.span(), 0.8)


def _near(kind: str, text: str, start: int, end: int, reach: int) -> float:
    """What the words within ``reach`` characters add to a score."""
    around = text[max(0, start - reach) : start] + "\n" + text[end : end + reach // 2]
    return 0.4 * bool(_CONTEXT[kind].search(around)) - 0.3 * bool(_AGAINST.search(around))


def _added(text: str, chains: list[tuple[int, int, str]], reach: int) -> Iterator[Span]:
    done = 0
    for m in _IBAN_HEAD.finditer(text):
        end = _iban_end(text, m) if m.start() >= done else None
        if end:
            done = end
            yield Span("iban", m.start(), end, 0.8 + _near("iban", text, m.start(), end, reach))
    for a, b, digits in chains:
        if 13 <= len(digits) <= 15 and luhn(digits):
            issued = 0.3 * (len(digits) == 15 and digits[:2] in ("34", "37"))
            yield Span("short_card", a, b, 0.3 + issued + _near("short_card", text, a, b, reach))
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield Span("ssn", *m.span(), 0.3 + _near("ssn", text, *m.span(), reach))
    for m in _SECRET.finditer(text) if "=" in text or ":" in text else ():
        mixed = any("0" <= c <= "9" for c in m[1]) and any(c.isalpha() for c in m[1])
        yield Span("secret", *m.span(1), 0.5 + 0.3 * mixed)
    for m in _API_KEY.finditer(text):
        yield Span("api_key", *m.span(), 0.75 + 0.2 * _signed(m[0]))
    for m in _WEB_TOKEN.finditer(text) if "eyJ" in text else ():
        yield Span("web_token", *m.span(), 0.9 if _names_algorithm(m[1]) else 0.3)
    for a, b in _pem_blocks(text):
        yield Span("private_key", a, b, 0.95)


def _signed(key: str) -> bool:
    """Whether a 40-character key with a two-letter issuer prefix ends in the CRC-32 of its random part."""
    if len(key) != 40 or not key.startswith("gh") or key[3] != "_":
        return False
    said = 0
    for c in key[34:]:
        said = said * 62 + _BASE62.index(c)
    return said == zlib.crc32(key[4:34].encode())


def _names_algorithm(head: str) -> bool:
    if len(head) > 4096:  # of a token's head; longer ones are something else
        return False
    try:
        fields = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except (ValueError, RecursionError):
        return False
    return isinstance(fields, dict) and "alg" in fields


def _pem_blocks(text: str) -> Iterator[tuple[int, int]]:
    if "PRIVATE KEY-----" not in text:
        return
    opened: tuple[str, int] | None = None
    for m in _PEM.finditer(text):
        if m[1] == "BEGIN":
            opened = (m[2], m.start())
        elif opened and opened[0] == m[2]:
            yield opened[1], m.end()
            opened = None


def _iban_end(text: str, m: re.Match) -> int | None:
    """Walks from the head to the country's length, over single spaces."""
    want, account, at = IBAN_LENGTHS.get(m[0][:2].upper(), 0), m[0], m.end()
    while len(account) < want:
        at += text[at : at + 1] == " "
        if text[at : at + 1] not in _IBAN_CHARS:
            return None
        account += text[at]
        at += 1
    return at if want and not text[at : at + 1].isalnum() and mod97(account.upper()) else None


def find_spans(text: str | None, threshold: float = 0.6, reach: int = 60) -> list[Span]:
    """All spans of one text, by kind as listed in ``KINDS``, then by start."""
    if not text:
        return []
    # Chains of 13 to 19 digits have at most 18 separators.
    chains = [(*m.span(), _digits(m[0])) for m in _CHAIN.finditer(text) if 13 <= m.end() - m.start() <= 37]
    base = list(_base(text, chains))
    starts, ends = [], []
    for s in sorted(base, key=lambda s: s.start):
        starts.append(s.start)
        ends.append(max(s.end, ends[-1] if ends else 0))

    def free(s: Span) -> bool:
        """Apart from all base spans, or around those that it meets."""
        first, last = bisect.bisect_right(ends, s.start), bisect.bisect_left(starts, s.end) - 1
        return first > last or starts[first] >= s.start and ends[last] <= s.end

    added = [s for s in _added(text, chains, reach) if s.score >= threshold and free(s)]
    return sorted(base + added, key=lambda s: (KINDS.index(s.kind), s.start))


def mask(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span replaced by its kind in angle brackets; what overlaps one goes with it."""
    if not spans:
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at : s.start], f"<{s.kind.upper()}>"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def tag_spans(docs: DataFrame, threshold: float = 0.6, reach: int = 60) -> DataFrame:
    """doc_id, spans (array of kind, start, end, score; code points, end exclusive) and the masked text."""

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [find_spans(t, threshold, reach) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([[s.__dict__ for s in spans] for spans in found], pa.list_(_SPAN)),
                    pa.array([mask(t, spans) for t, spans in zip(texts, found, strict=True)], pa.string()),
                ],
                ["doc_id", "spans", "masked"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    spans = "array<struct<kind:string,start:long,end:long,score:double>>"
    return docs.select("doc_id", "text").mapInArrow(tidy(tag), f"doc_id {kind}, spans {spans}, masked string")


def masked_texts(docs: DataFrame, threshold: float = 0.6, reach: int = 60) -> DataFrame:
    """The documents with masked texts and their new ``n_chars``; other columns and their order stay."""

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: mask(t, find_spans(t, threshold, reach)) if t else t)

    out = docs.withColumn("text", masked("text"))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def op4(docs: DataFrame) -> DataFrame:
    tagged = tag_spans(docs)
    text = lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))
    base = F.filter("spans", lambda s: s.kind.isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    return tagged.select(
        "doc_id",
        *[count(kind) for kind in BASE],
        F.sha2(F.array_join(F.transform(base, text), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", text), ",").alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )
