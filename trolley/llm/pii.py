"""Format-preserving pseudonyms for private values.

Values are found by their format and validated: card numbers by their check
digit, social-security numbers by the ranges in use, IBANs by their remainder,
IPv4 addresses by their octets, dates by the calendar. Phone numbers of any area
code count, and names of secrets in any case. A keyed
Feistel network permutes each value within the values of its format: digits
stay digits, a valid card number becomes a valid card number, a date a date. A
permutation maps equal values to equal pseudonyms, so documents stay linked,
and different values to different ones. Mail addresses, access keys, passwords
and tokens go through the same network over their own characters.

Domains are walked in cycles: the network works on the next larger rectangle
and is applied again until the value is a valid one, which keeps it a
permutation. The length of a text does not change.

Null and empty texts stay; every row gives one row, whatever its id; all other
columns, whatever their names, pass through.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .text import bound_batches, joined

ROUNDS = 10
KEY = b"trolley pseudonyms"  # a parameter; keep a secret one for real data

_DIGITS = "0123456789"
_HEX = _DIGITS + "abcdef"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY


def permute(value: int, size: int, key: bytes, tweak: str, valid: Callable[[int], bool] = lambda _: True) -> int:
    """The image of ``value`` under a keyed permutation of the valid numbers
    below ``size``."""
    side = isqrt(size - 1) + 1
    while True:
        left, right = divmod(value, side)
        for turn in range(ROUNDS):
            word = hashlib.blake2b(f"{tweak}/{size}/{turn}/{right}".encode(), key=key, digest_size=32).digest()
            left, right = right, (left + int.from_bytes(word)) % side
        value = left * side + right
        if value < size and valid(value):
            return value


def _mapped(text: str, alphabets: list[str], key: bytes, tweak: str, valid=lambda _: True) -> str:
    """``text`` permuted within the strings over ``alphabets``, one for each
    character."""
    value = size = 0
    size = 1
    for char, alphabet in zip(text, alphabets):
        value = value * len(alphabet) + alphabet.index(char)
        size *= len(alphabet)

    def spelt(number: int) -> str:
        chars = []
        for alphabet in reversed(alphabets):
            number, at = divmod(number, len(alphabet))
            chars.append(alphabet[at])
        return "".join(reversed(chars))

    if size < 2:
        return text
    return spelt(permute(value, size, key, tweak, lambda n: valid(spelt(n))))


def _shaped(text: str, key: bytes, tweak: str) -> str:
    """Letters and digits permuted, each within its class; the rest stays."""
    at = [i for i, c in enumerate(text) if c in _DIGITS or c in _LOWER or c in _UPPER]
    classes = [_DIGITS if text[i] in _DIGITS else _LOWER if text[i] in _LOWER else _UPPER for i in at]
    chars = list(text)
    for i, c in zip(at, _mapped("".join(text[i] for i in at), classes, key, tweak)):
        chars[i] = c
    return "".join(chars)


def _digits_into(template: str, digits: str) -> str:
    fresh = iter(digits)
    return "".join(next(fresh) if c in _DIGITS else c for c in template)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def _check_digit(digits: str) -> str:
    """The digit that makes the sum, every second digit doubled, end in 0."""
    total = sum(sum(divmod(int(d) * 2, 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _card(found: str, key: bytes) -> str | None:
    digits = _only_digits(found)
    if _check_digit(digits[:-1]) != digits[-1]:
        return None
    body = _mapped(digits[:-1], [_DIGITS] * (len(digits) - 1), key, "card")
    return _digits_into(found, body + _check_digit(body))


def _phone_valid(digits: str) -> bool:
    return digits[0] in "23456789" and digits[3] in "23456789"


def _phone(found: str, key: bytes) -> str | None:
    """Numbers in use are permuted among themselves, and so are all others."""
    digits = _only_digits(found)
    national = digits[-10:]
    planned = _phone_valid(national)
    fresh = _mapped(national, [_DIGITS] * 10, key, "phone", lambda d: _phone_valid(d) == planned)
    return _digits_into(found, digits[:-10] + fresh)


def _ssn_valid(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def _ssn(found: str, key: bytes) -> str | None:
    digits = _only_digits(found)
    if not _ssn_valid(digits):
        return None
    return _digits_into(found, _mapped(digits, [_DIGITS] * 9, key, "ssn", _ssn_valid))


def _iban_rest(country: str, check: str, body: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + check)) % 97


def _iban(found: str, key: bytes) -> str | None:
    chars = found.replace(" ", "")
    country, check, body = chars[:2], chars[2:4], chars[4:]
    if not 11 <= len(body) <= 30 or _iban_rest(country, check, body) != 1:
        return None
    body = _shaped(body, key, "iban " + country)
    fresh = iter(country + f"{98 - _iban_rest(country, '00', body):02d}" + body)
    return "".join(c if c == " " else next(fresh) for c in found)


def _ipv4(found: str, key: bytes) -> str | None:
    """Permuted among the addresses whose octets have as many digits."""
    octets = found.split(".")
    if any(int(o) > 255 or str(int(o)) != o for o in octets):
        return None
    value = int.from_bytes(bytes(map(int, octets)))
    spelt = lambda n: ".".join(map(str, n.to_bytes(4)))
    widths = [len(o) for o in octets]
    same = lambda n: [len(str(o)) for o in n.to_bytes(4)] == widths
    return spelt(permute(value, 1 << 32, key, "ipv4", same))


def _date(found: str, key: bytes) -> str | None:
    """Permuted among the days of two centuries that the same format spells."""
    parts = re.split(r"([-/.])", found)
    fields, marks = parts[::2], parts[1::2]
    if marks[0] != marks[1]:
        return None
    orders = [(0, 1, 2)] if len(fields[0]) == 4 else [(2, 1, 0), (2, 0, 1)]

    def read(texts: list[str], order: tuple[int, int, int]) -> int | None:
        try:
            day = datetime.date(*(int(texts[i]) for i in order)).toordinal() - _FIRST_DAY
        except ValueError:
            return None
        return day if 0 <= day < _DAYS else None

    def spelt(day: int, order: tuple[int, int, int]) -> list[str]:
        date = datetime.date.fromordinal(day + _FIRST_DAY)
        texts = [""] * 3
        for i, number in zip(order, (date.year, date.month, date.day)):
            texts[i] = f"{number:0{len(fields[i])}d}"
        return texts

    for n, order in enumerate(orders):
        day = read(fields, order)
        if day is None:
            continue

        def same(d: int, n: int = n, order: tuple[int, int, int] = order) -> bool:
            texts = spelt(d, order)
            return [*map(len, texts)] == [*map(len, fields)] and all(read(texts, o) is None for o in orders[:n])

        texts = spelt(permute(day, _DAYS, key, "date", same), order)
        return texts[0] + marks[0] + texts[1] + marks[1] + texts[2]
    return None


def _mail(found: str, key: bytes) -> str | None:
    name, _, domain = found.rpartition("@")
    return f"{_shaped(name, key, 'mail ' + domain)}@{domain}"


def _access_key(found: str, key: bytes) -> str | None:
    return found[:4] + _mapped(found[4:], [_DIGITS + _UPPER] * (len(found) - 4), key, "access")


def _secret(found: str, key: bytes) -> str | None:
    cut = re.match(r"\w+\s*[=:]\s*[\"']?", found).end()
    name, value = found[:cut], found[cut:]
    if all(c in _HEX for c in value):
        return name + _mapped(value, [_HEX] * len(value), key, "secret")
    return name + _shaped(value, key, "secret")


#: Kinds in the order in which they are tried at a place.
KINDS: dict[str, tuple[str, Callable[[str, bytes], str | None]]] = {
    "mail": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _mail),
    "access": (r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b", _access_key),
    "secret": (
        r"\b(?i:password|passwd|token|secret|api_?key)\s*[=:]\s*[\"']?[A-Za-z0-9_/+.-]*[A-Za-z0-9_/+-]",
        _secret,
    ),
    "iban": (r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban),
    "ipv4": (r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", _ipv4),
    "date": (r"(?<![\d./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-])", _date),
    "ssn": (r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _ssn),
    "phone": (r"(?<!\d)(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)", _phone),
    "card": (r"(?<!\d)(?:\d{4}(?P<sep>[ -])\d{4}(?P=sep)\d{4}(?P=sep)\d{1,7}|\d{13,19})(?!\d)", _card),
}
_ANY = re.compile("|".join(f"(?P<{name}>{pattern})" for name, (pattern, _) in KINDS.items()), re.ASCII)
_HINTS = np.isin(np.arange(256), list(b"0123456789@=:"))


def pseudonymized(text: str, key: bytes = KEY) -> tuple[str, list[str]]:
    """The text with pseudonyms in place, and the kinds replaced."""
    kinds: list[str] = []
    parts: list[str] = []
    done = at = 0
    while found := _ANY.search(text, at):
        fresh = KINDS[found.lastgroup][1](found.group(), key) if found.lastgroup in KINDS else None
        if fresh is None:  # not a valid value: go on behind its first character
            at = found.start() + 1
            continue
        kinds.append(found.lastgroup)
        parts += [text[done : found.start()], fresh]
        done = at = found.end()
    return "".join(parts) + text[done:], kinds


def pseudonymize(
    docs: DataFrame, key: bytes = KEY, text_col: str = "text", kinds_col: str | None = None
) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``; ``kinds_col`` names a further
    column for the kinds replaced, in text order."""
    bound_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    fields = list(docs.schema.fields)
    if kinds_col:
        fields.append(T.StructField(kinds_col, T.ArrayType(T.StringType())))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at)
            buffer, offsets = joined(column)
            hints = np.append(0, np.cumsum(_HINTS[buffer]))[offsets]
            texts = column.to_pylist()
            kinds: list[list[str]] = [[] for _ in texts]
            for i in np.flatnonzero(np.diff(hints)).tolist():
                texts[i], kinds[i] = pseudonymized(texts[i], key)
            arrays = list(batch.columns)
            arrays[at] = pa.array(texts, column.type)
            names = list(batch.schema.names)
            if kinds_col:
                arrays.append(pa.array(kinds, pa.list_(pa.string())))
                names.append(kinds_col)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.mapInArrow(replace, T.StructType(fields))
