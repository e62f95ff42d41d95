"""Format-preserving pseudonyms for personal numbers, dates, addresses and secrets.

A candidate found by pattern is validated (Luhn, IBAN check digits, octets,
calendar, issued ranges); what fails stays as it is. A valid value is the index
of an element of its format's finite set, and a keyed Feistel network with
cycle walking permutes that set: the pseudonym is a valid value of the same
format, distinct values stay distinct, and equal values (however they are
punctuated) get equal pseudonyms in every document, so they stay linked. The
key is a parameter or the setting ``SETTING`` of the session; there is no default,
and whoever lacks the key cannot invert the permutation. ``TEST_KEY`` is public
and only for the registered query and the pipeline over the given test tables;
a session with the setting overrides it there.

Null text stays null with no finds; a text is read whole, in one pass. Finds do
not overlap: the leftmost wins, of several at one place the kind that stands
first in ``PATTERN``. Rows that repeat are each replaced, alike.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tavola.llm.common import map_arrow, table

KINDS = ("card", "date", "email", "iban", "ip", "phone", "secret", "ssn")
SETTING = "spark.tavola.pseudonyms.key"
TEST_KEY = "corpus-pseudonyms"
ROUNDS = 8

# Shapes of the values looked for.
PATTERN = re.compile(r"""
  (?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24})
| (?P<secret>(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|[0-9a-f]{32,64}|(?<=password=)[0-9a-fA-F]{8,64})(?![A-Za-z0-9]))
| (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
| (?P<phone>(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])
    |(?<![\w+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])
    |(?<![\w+.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w-]))
| (?P<card>(?<![\w.-])(?:[0-9]{13,19}|[0-9]{4}(?P<sep>[ -])[0-9]{4}(?P=sep)[0-9]{4}(?P=sep)[0-9]{1,7})(?![0-9]))
| (?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))
| (?P<date>(?<![\w./-])(?:[12][0-9]{3}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[12][0-9]{3}|[0-9]{1,2}\.[0-9]{1,2}\.[12][0-9]{3})(?![0-9]))
| (?P<ip>(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9]))
""", re.VERBOSE)
MAYBE = re.compile(r"[0-9@]|AKIA|password=")
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def permute(value: int, size: int, key: bytes, valid: Callable[[int], bool] | None = None) -> int:
    """Keyed permutation of range(size), restricted to its valid elements."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for r in range(ROUNDS):
            h = hashlib.blake2b(bytes([r]) + right.to_bytes(width, "big"), key=key, digest_size=width)
            left, right = right, left ^ (int.from_bytes(h.digest(), "big") & mask)
        value = left << half | right
        if value < size and (valid is None or valid(value)):
            return value


def _digits_into(shape: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def luhn_digit(body: str) -> int:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c)
        total += d if i % 2 else (d * 2 - 9 if d > 4 else d * 2)
    return -total % 10


def _characters(text: str, key: bytes, hexadecimal: bool = False) -> str:
    """Permute letters and digits within their own alphabets; other characters stay."""
    sets = ("0123456789abcdef",) if hexadecimal else (
        "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    value, size, places = 0, 1, []
    for c in text:
        s = next((s for s in sets if c in s), None)
        places.append(s)
        if s:
            value, size = value * len(s) + s.index(c), size * len(s)
    value, out = permute(value, size, key), []
    for c, s in zip(reversed(text), reversed(places)):
        if s:
            value, at = divmod(value, len(s))
            c = s[at]
        out.append(c)
    return "".join(reversed(out))


def _card(text, key):
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    n = len(digits) - 2
    body = digits[0] + str(permute(int(digits[1:-1]), 10 ** n, key)).zfill(n)
    return _digits_into(text, body + str(luhn_digit(body)))


def _phone(text, key):
    digits = re.sub(r"\D", "", text)
    if not 8 <= len(digits) <= 15:
        return None
    code = re.match(r"\+([0-9]{1,3})(?=[ .(-])", text)
    lead = code[1] if code else digits[:max(0, len(digits) - 10)]
    n = len(digits) - len(lead)
    return _digits_into(text, lead + str(permute(int(digits[len(lead):]), 10 ** n, key)).zfill(n))


def _ssn(text, key):
    def issued(v):
        area, group, serial = v // 1_000_000, v // 10_000 % 100, v % 10_000
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0
    value = int(text.replace("-", ""))
    return _digits_into(text, f"{permute(value, 10 ** 9, key, issued):09d}") if issued(value) else None


def _ip(text, key):
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    value = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key)
    return ".".join(map(str, value.to_bytes(4, "big")))


def _date(text, key):
    order = [0, 1, 2] if "-" in text else [2, 0, 1] if "/" in text else [2, 1, 0]
    parts = re.split(r"[-/.]", text)
    year, month, day = (int(parts[i]) for i in order)
    if "/" in text and month > 12:
        order, month, day = [2, 1, 0], day, month
    try:
        at = dt.date(year, month, day).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= at <= LAST_DAY:
        return None
    new = dt.date.fromordinal(FIRST_DAY + permute(at - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key))
    fields = dict(zip(order, (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}")))
    sep = "-" if "-" in text else "/" if "/" in text else "."
    # day and month keep two places only where the original has them
    return sep.join(fields[i] if len(parts[i]) > 1 else str(int(fields[i])) for i in range(3))


def _iban_check(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _iban(text, key):
    flat = text.replace(" ", "")
    if not 15 <= len(flat) <= 34 or int(flat[2:4]) != _iban_check(flat[:2], flat[4:]):
        return None
    body = _characters(flat[4:], key)
    it = iter(flat[:2] + f"{_iban_check(flat[:2], body):02d}" + body)
    return "".join(c if c == " " else next(it) for c in text)


def _email(text, key):
    local, _, domain = text.rpartition("@")
    return _characters(local, key) + "@" + domain


def _secret(text, key):
    if text.startswith("AKIA"):
        return "AKIA" + _characters(text[4:], key)
    return _characters(text.lower(), key, hexadecimal=True)


RULES = {"card": _card, "date": _date, "email": _email, "iban": _iban, "ip": _ip, "phone": _phone,
         "secret": _secret, "ssn": _ssn}


@lru_cache(maxsize=100_000)
def pseudonym(kind: str, text: str, key: str) -> str | None:
    """The pseudonym of a found value, or None if the value is not valid."""
    return RULES[kind](text, hashlib.blake2b(f"{kind}:{key}".encode(), digest_size=32).digest())


def replace(text: str, key: str, counts: dict[str, int]) -> str:
    def one(m: re.Match) -> str:
        new = pseudonym(kind := m.lastgroup if m.lastgroup != "sep" else "card", m[0], key)
        if new is None:
            return m[0]
        counts[kind] = counts.get(kind, 0) + 1
        return new
    return PATTERN.sub(one, text) if MAYBE.search(text) else text


def key_of(spark: SparkSession, default: str | None = None) -> str:
    """The key that the session sets; without it ``default``, and an error without either."""
    key = spark.conf.get(SETTING, None) or default
    if not key:
        raise ValueError(f"pseudonyms need a key: pass one or set {SETTING}")
    return key


def pseudonymise(docs: DataFrame, key: str | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry``, text (values replaced) and the number of finds by kind, per input row."""
    key = key or key_of(docs.sparkSession)
    docs = docs.select(*carry, F.col("text").cast("string"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != "text")

    def fn(batch: pa.RecordBatch):
        out, counts = [], []
        for text in batch.column("text").to_pylist():
            found: dict[str, int] = {}
            out.append(replace(text, key, found) if text else text)
            counts.append(found)
        yield {c: batch.column(c) for c in carry} | {"text": out} | {f"n_{k}": [c.get(k, 0) for c in counts] for k in KINDS}

    return map_arrow(docs, fn, kinds + "text string, " + ", ".join(f"n_{k} int" for k in KINDS))


def op9_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents", "doc_id", "text"), key_of(spark, TEST_KEY))
