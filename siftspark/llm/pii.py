"""Format-preserving pseudonyms for personal data.

Values are found by pattern and kept only if they validate: card numbers by
their check digit, account numbers (IBAN) by theirs, addresses by their octets,
dates by the calendar, and so on. A valid value is ranked within the set of all
valid values of its format, permuted there by a keyed Feistel network, and
written back in the same format. Equal values get equal pseudonyms in all
documents, different values different ones, and the key holder can go back.
Whatever doesn't validate stays as it is; where a number runs into its neighbours,
the groups of digits inside are tried as well, and the search goes on after the
first of them.

Defined results: null text stays null, with no values found; empty text stays
empty. Repeated rows come out alike; an empty table gives an empty result; a
value that a line break cuts in two is not one value. Other columns are
ignored. A permutation may map a value to itself, with a chance of one in the
number of values of its format. Going back is exact for values that stand alone;
where a value was found next to other digits, a longer run of digits may validate
by chance afterwards (one in 10 for cards, one in 97 for accounts).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, timedelta
from functools import lru_cache
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame

from siftspark.llm.tokens import pieces
from siftspark.session import find_package

ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

PATTERN = re.compile(
    r"""
      (?P<email>(?<![\w.+-])[A-Za-z0-9_](?:[\w.+-]{0,62}[\w+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}(?![\w-]))
    | (?P<secret>(?<![\w/+])(?=[A-Fa-f]*[0-9])(?=[0-9]*[A-Fa-f])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![\w/+]))
    | (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
    | (?P<phone>(?<![\w+.])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?![\w]) | (?<![\w+.])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w]) | (?<![\w.-])\d{3}-\d{3}-\d{4}(?![\w-]))
    | (?P<ssn>(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-]))
    | (?P<date>(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w/-]))
    | (?P<ip>(?<![\w.-])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d))
    | (?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?!\w|[.-]\d))
    """,
    re.VERBOSE,
)
_MAYBE = re.compile(r"[0-9@]")


@dataclass(frozen=True)
class Params:
    """``key``: the secret of the permutation; pass your own, the default is only for trials."""

    key: bytes = b"siftspark trial key"


def _feistel(x: int, n: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0 .. n-1: a Feistel network on a square that holds the range,
    repeated while it leads outside the range."""
    if n < 2:
        return x
    a = isqrt(n - 1) + 1
    width = (a.bit_length() + 7) // 8 + 8

    def noise(i: int, half: int) -> int:
        message = f"{tweak}|{n}|{i}|{half}".encode()
        out = b"".join(blake2b(message + bytes([j]), key=key[:64], digest_size=64).digest() for j in range((width + 63) // 64))
        return int.from_bytes(out[:width], "big") % a

    while True:
        left, right = divmod(x, a)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = (right - noise(i, left)) % a, left
            else:
                left, right = right, (left + noise(i, right)) % a
        x = left * a + right
        if x < n:
            return x


def _class_of(c: str) -> str:
    return next((s for s in (DIGITS, LOWER, UPPER) if c in s), c)


def _permute_string(value: str, key: bytes, tweak: str, back: bool, only: str = "") -> str:
    """Permute the letters and digits of a string (or only those of one alphabet), each within its class."""
    classes = [only if only and c in only else (_class_of(c) if not only else c) for c in value]
    n, x = 1, 0
    for c, s in zip(value, classes, strict=True):
        n, x = n * len(s), x * len(s) + s.index(c)
    x = _feistel(x, n, key, tweak, back)
    out = []
    for s in reversed(classes):
        x, k = divmod(x, len(s))
        out.append(s[k])
    return "".join(reversed(out))


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        v = int(c) * (2 if i % 2 == 0 else 1)
        total += v - 9 if v > 9 else v
    return str(-total % 10)


def _iban_check(country: str, rest: str) -> str:
    digits = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(digits) % 97:02d}"


def _refill(shape: str, chars: str, alphabet: str) -> str:
    """Put chars where the shape has characters of the alphabet."""
    it = iter(chars)
    return "".join(next(it) if c in alphabet else c for c in shape)


def _email(v: str, key: bytes, back: bool) -> str:
    name, _, host = v.rpartition("@")
    return _permute_string(name, key, "email", back) + "@" + host


def _secret(v: str, key: bytes, back: bool) -> str:
    return _permute_string(v, key, "secret", back, DIGITS + (LOWER if v.lower() == v else UPPER)[:6])


def _iban(v: str, key: bytes, back: bool) -> str | None:
    plain = v.replace(" ", "")
    country, check, rest = plain[:2], plain[2:4], plain[4:]
    if _iban_check(country, rest) != check:
        return None
    rest = _permute_string(rest, key, "iban" + country, back)
    return _refill(v, country + _iban_check(country, rest) + rest, DIGITS + UPPER)


def _phone(v: str, key: bytes, back: bool) -> str | None:
    digits = "".join(c for c in v if c in DIGITS)
    if not 7 <= len(digits) <= 15:
        return None
    m = re.match(r"\+(\d{1,3}?)(?=[ .(-])", v)
    code = m[1] if m else (digits[:1] if v[0] == "+" else "")
    return _refill(v, code + _permute_string(digits[len(code) :], key, "phone" + code, back), DIGITS)


def _ssn(v: str, key: bytes, back: bool) -> str | None:
    area, group, serial = map(int, v.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    rank = (area - 1 - (area > 666)) * 99 * 9999 + (group - 1) * 9999 + serial - 1
    rank, serial = divmod(_feistel(rank, 898 * 99 * 9999, key, "ssn", back), 9999)
    area, group = divmod(rank, 99)
    area += 1
    return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def _date(v: str, key: bytes, back: bool) -> str | None:
    parts = re.split(r"\D", v)
    # Day and month as written where that is a date, else month and day.
    order = (0, 1, 2) if len(parts[0]) == 4 else (2, 1, 0)
    for y, m, d in (order,) if len(parts[0]) == 4 or v[2] == "." else (order, (2, 0, 1)):
        try:
            day = date(int(parts[y]), int(parts[m]), int(parts[d]))
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        rank, n = (day - FIRST_DAY).days, (LAST_DAY - FIRST_DAY).days + 1
        monthly = (y, m, d) == (2, 0, 1)
        while True:
            rank = _feistel(rank, n, key, "date" + ("m" if monthly else ""), back)
            got = FIRST_DAY + timedelta(rank)
            if not monthly or got.day > 12:  # else it would read as day first
                break
        text = [f"{got.year:04d}", f"{got.month:02d}", f"{got.day:02d}"]
        out = [""] * 3
        out[y], out[m], out[d] = text
        sep = re.search(r"\D", v)[0]
        return sep.join(out)
    return None


def _ip(v: str, key: bytes, back: bool) -> str | None:
    octets = v.split(".")
    if any(int(o) > 255 or (len(o) > 1 and o[0] == "0") for o in octets):
        return None
    x = _feistel(int.from_bytes(bytes(map(int, octets)), "big"), 2**32, key, "ip", back)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _card(v: str, key: bytes, back: bool) -> str | None:
    digits = "".join(c for c in v if c in DIGITS)
    if luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
        return None
    payload = _permute_string(digits[:-1], key, "card", back)
    return _refill(v, payload + luhn_digit(payload), DIGITS)


#: Digits by group as cards are written; such runs are tried before others.
WRITTEN = {(4, 4, 4, 4, 3), (4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 5), *((n,) for n in range(13, 20))}
_GROUP = re.compile(r"[A-Za-z0-9]+")


def _inside(kind: str, value: str) -> list[tuple[int, int]]:
    """Where else a value may lie in a match, in the order of trial: runs of whole groups, the likely and long ones first."""
    groups = [m.span() for m in _GROUP.finditer(value)]
    if kind == "iban":  # a later one is found when the search goes on
        return [(0, b) for _, b in reversed(groups) if len(value[:b].replace(" ", "")) >= 12]
    if kind != "card":
        return [(0, len(value))]
    found = []
    for i in range(len(groups)):
        for j in range(i, len(groups)):
            sizes = tuple(b - a for a, b in groups[i : j + 1])
            if 13 <= sum(sizes) <= 19:
                whole = j - i + 1 == len(groups)
                found.append((sizes not in WRITTEN, not whole, -sum(sizes), groups[i][0], groups[j][1]))
    return [f[-2:] for f in sorted(found)]


_KINDS = {"email": _email, "secret": _secret, "iban": _iban, "phone": _phone, "ssn": _ssn, "date": _date, "ip": _ip, "card": _card}
KINDS = tuple(_KINDS)


@lru_cache(maxsize=1 << 16)
def pseudonym(kind: str, value: str, key: bytes, back: bool = False) -> str | None:
    """The pseudonym of one value, or the value of a pseudonym; None where the value isn't valid."""
    return _KINDS[kind](value, key, back)


def pseudonymised(text: str, key: bytes, back: bool = False) -> tuple[str, Counter]:
    """The whole text with its values replaced, and how many of each kind there were."""
    found: Counter = Counter()

    def put(line: str) -> str:
        out, done, at = [], 0, 0
        while m := PATTERN.search(line, at):
            kind, start = m.lastgroup, m.start()
            for a, b in _inside(kind, m[0]):
                new = pseudonym(kind, m[0][a:b], key, back)
                if new is not None:
                    found[kind] += 1
                    out += [line[done:start], put(m[0][:a]) if a else "", new]
                    done = at = start + b
                    break
            else:
                first = _GROUP.search(line, start)
                at = max(start + 1, first.end() if first else 0)
        return "".join([*out, line[done:]])

    if not _MAYBE.search(text):
        return text, found
    return "\n".join(put(line) if _MAYBE.search(line) else line for line in text.split("\n")), found


def pseudonymise(docs: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per document: the rewritten text, the number of values, and their number by kind."""
    find_package(docs.sparkSession)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts, counts = [], []
            for text in batch.column("text").to_pylist():
                new, found = (None, Counter()) if text is None else pseudonymised(text, params.key)
                texts.append(new)
                counts.append(found)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array([sum(c.values()) for c in counts], pa.int64()), *(pa.array([c[k] for c in counts], pa.int64()) for k in KINDS)],
                names=["doc_id", "text", "n_values", *(f"n_{k}" for k in KINDS)],
            )

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, text string, n_values bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(rewrite, schema)
