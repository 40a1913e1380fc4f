"""Pseudonyms for personal data that keep the format of each value.

Patterns find candidates; numbers and dates must also be valid (check digits,
ranges, the calendar). A valid value is a number in the range of its format,
and a keyed Feistel network permutes that range; results outside the range
are permuted again (cycle walking). Where a candidate fails, because it has
taken in a neighbour, the whole groups of characters within it are tried. So a card stays a valid card, a date a
valid date, an address an address, equal values stay equal across documents,
and the key's owner can go back. Letters keep their case.

Null texts stay null and empty ones empty. Text outside the found values is
unchanged, whatever its length. Every row is treated by itself.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, StructField, StructType

from logtrail.llm.byte_text import slices
from logtrail.session import configure

ROUNDS = 8
#: Dates are permuted within these years.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
_DAYS = (LAST_DAY - FIRST_DAY).days + 1


def _walk(value: int, size: int, step: Callable[[int], int]) -> int:
    value = step(value)
    while value >= size:
        value = step(value)
    return value


def permute(value: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A keyed permutation of the numbers below ``size``."""
    if size < 2:
        return value
    half = max((size - 1).bit_length() + 1, 2) // 2
    mask = (1 << half) - 1
    width = (half + 7) // 8
    hashers = [hashlib.blake2b(tweak, key=key[:64], person=b"round%03d" % r, digest_size=64) for r in range(ROUNDS)]

    def f(r: int, side: int) -> int:
        out, block = 0, 0
        while block * 512 < half:
            h = hashers[r].copy()
            h.update(block.to_bytes(2, "big") + side.to_bytes(width, "big"))
            out = (out << 512) | int.from_bytes(h.digest(), "big")
            block += 1
        return out & mask

    def forth(x: int) -> int:
        left, right = x >> half, x & mask
        for r in range(ROUNDS):
            left, right = right, left ^ f(r, right)
        return left << half | right

    def undo(x: int) -> int:
        left, right = x >> half, x & mask
        for r in reversed(range(ROUNDS)):
            left, right = right ^ f(r, left), left
        return left << half | right

    return _walk(value, size, undo if back else forth)


def _alphabet(c: str) -> str:
    for letters in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
        if c in letters:
            return letters
    return ""


def permute_characters(text: str, key: bytes, tweak: bytes, back: bool = False) -> str:
    """Digits to digits, letters to letters of the same case, the rest in place."""
    value, size, sets = 0, 1, []
    for c in text:
        letters = _alphabet(c)
        sets.append(letters)
        if letters:
            value, size = value * len(letters) + letters.index(c), size * len(letters)
    shape = "".join({"": c, "0": "0", "a": "a", "A": "A"}[s[:1]] for c, s in zip(text, sets, strict=True))
    value = permute(value, size, key, tweak + b":" + shape.encode(), back)
    out = []
    for c, letters in zip(reversed(text), reversed(sets), strict=True):
        if letters:
            value, digit = divmod(value, len(letters))
            c = letters[digit]
        out.append(c)
    return "".join(reversed(out))


def _refill(text: str, digits: str) -> str:
    """The text with its digits replaced in order."""
    left = iter(digits)
    return "".join(next(left) if c.isdigit() else c for c in text)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def luhn_digit(digits: str) -> int:
    """Check digit that makes ``digits`` with it valid."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _card(text: str, key: bytes, back: bool) -> str | None:
    d = _digits(text)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != int(d[-1]):
        return None
    # The first digit tells the kind of card and stays.
    body = d[0] + permute_characters(d[1:-1], key, b"card" + d[0].encode(), back)
    return _refill(text, body + str(luhn_digit(body)))


def _iban_check(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in body + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _iban(text: str, key: bytes, back: bool) -> str | None:
    plain = text.replace(" ", "")
    country, check, body = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(body) <= 30 or _iban_check(country, body) != check:
        return None
    body = permute_characters(body, key, b"iban" + country.encode(), back)
    new = iter(country + _iban_check(country, body) + body)
    return "".join(c if c == " " else next(new) for c in text)


def _valid_ssn(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def _ssn(text: str, key: bytes, back: bool) -> str | None:
    d = _digits(text)
    if not _valid_ssn(d):
        return None
    d = permute_characters(d, key, b"ssn", back)
    while not _valid_ssn(d):
        d = permute_characters(d, key, b"ssn", back)
    return _refill(text, d)


def _ipv4(text: str, key: bytes, back: bool) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    value = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, b"ipv4", back)
    return ".".join(str(b) for b in value.to_bytes(4, "big"))


def _phone(text: str, key: bytes, back: bool) -> str | None:
    d = _digits(text)
    if not 10 <= len(d) <= 15:
        return None
    prefix = d[: len(d) - 10]
    return _refill(text, prefix + permute_characters(d[len(prefix) :], key, b"phone", back))


def _date(order: str) -> Callable[[str, bytes, bool], str | None]:
    def change(text: str, key: bytes, back: bool) -> str | None:
        parts = re.findall(r"\d+", text)
        try:
            day = datetime.date(**{{"y": "year", "m": "month", "d": "day"}[o]: int(p) for o, p in zip(order, parts, strict=True)})
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        day = FIRST_DAY + datetime.timedelta(permute((day - FIRST_DAY).days, _DAYS, key, b"date", back))
        new = {"y": f"{day.year:04d}", "m": f"{day.month:02d}", "d": f"{day.day:02d}"}
        return _refill(text, "".join(new[o] for o in order))

    return change


def _characters(name: str, keep: str) -> Callable[[str, bytes, bool], str | None]:
    """Permute the characters after a fixed beginning (a pattern)."""

    def change(text: str, key: bytes, back: bool) -> str | None:
        fixed = re.match(keep, text).end()
        return text[:fixed] + permute_characters(text[fixed:], key, name.encode(), back)

    return change


def _hexadecimal(text: str, key: bytes, back: bool) -> str | None:
    return f"{permute(int(text, 16), 16 ** len(text), key, b'hex%d' % len(text), back):0{len(text)}x}"


def _email(text: str, key: bytes, back: bool) -> str | None:
    local, domain = text.rsplit("@", 1)
    return permute_characters(local, key, b"email", back) + "@" + domain


#: Kind, pattern of candidates, and the change; None means the candidate is not valid. Earlier kinds win.
KINDS: tuple[tuple[str, str, Callable[[str, bytes, bool], str | None]], ...] = (
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*\.)+[A-Za-z]{2,}", _email),
    ("secret", r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b", _characters("key", "....")),
    ("hex", r"(?<=[\"'])[0-9a-f]{32,64}(?=[\"'])", _hexadecimal),
    ("password", r"\b(?:password|passwd|pwd|token|secret|api[_-]?key)[ \t]*[=:][ \t]*[\"']?[A-Za-z0-9+/_-]{6,}", _characters("password", r"\w+?(?:[_-]key)?[ \t]*[=:][ \t]*[\"']?")),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", _iban),
    ("ipv4", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", _ipv4),
    ("date", r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])", _date("ymd")),
    ("date", r"(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])", _date("mdy")),
    ("date", r"(?<![\d.])\d{2}\.\d{2}\.\d{4}(?!\d|\.\d)", _date("dmy")),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _ssn),
    ("card", r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])", _card),
    ("phone", r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\w)", _phone),
    ("phone", r"(?<![\w+(])\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\w)", _phone),
)


#: Every value has a digit or an @, but for keys of letters alone.
_HINT = re.compile(r"[0-9@]|A[KS]IA|(?:passw|pwd|token|secret|api)", re.ASCII)
_FIND = [(name, re.compile(pattern, re.ASCII), change) for name, pattern, change in KINDS]
#: Values of these kinds may stand beside other groups of the same characters: all groups from a failed candidate on.
_RUNS = {name: re.compile(run, re.ASCII) for name, run in (("iban", r"[A-Z0-9]+(?: [A-Z0-9]+)*"), ("card", r"\d+(?:[ -]\d+)*"), ("phone", r"\+?[\d(][\d .()-]*\d"))}
_GROUP = re.compile(r"[+(]*[A-Z0-9]+", re.ASCII)
#: Characters of the longest value of these kinds, and the usual ways to write a card, tried first.
_LONGEST = 48
_USUAL = re.compile(r"\d{13,19}|\d{4}(?:([ -])\d{4}(?:\1\d{4}){2}(?:\1\d{1,3})?|([ -])\d{6}\2\d{4,5})", re.ASCII)


def _inside(
    text: str, first: int, last: int, name: str, pattern: re.Pattern, change: Callable[[str, bytes, bool], str | None], key: bytes, back: bool, free: Callable[[int, int], bool]
) -> list[tuple[int, int, str, str]]:
    """Valid values of whole groups within a run whose first candidate is not valid."""
    groups = [m.span() for m in _GROUP.finditer(text, first, last)]
    spans = []
    for g, (begin, _) in enumerate(groups):
        for _, end in groups[g:]:
            if end - begin > _LONGEST:
                break
            if pattern.fullmatch(text[begin:end]) and free(begin, end):
                spans.append((begin, end))
    spans.sort(key=lambda s: (name == "card" and not _USUAL.fullmatch(text[s[0] : s[1]]), s[0], -s[1]))
    found: list[tuple[int, int, str, str]] = []
    failed: list[tuple[int, int]] = []
    for begin, end in spans:
        at = bisect_left(found, (end,))
        if at and found[at - 1][1] > begin:
            continue
        new = change(text[begin:end], key, back)
        if new is None:
            insort(failed, (begin, end))
            continue
        # The new value must be found at the same place on the way back, so whatever failed before must fail beside it, too.
        near = [(b, e) for b, e in failed[bisect_left(failed, (begin - _LONGEST,)) : bisect_left(failed, (end,))] if e > begin]
        while any(change(text[b : max(b, begin)] + new[max(b - begin, 0) : max(e - begin, 0)] + text[min(end, e) : e], key, back) is not None for b, e in near):
            new = change(new, key, back)
        insort(found, (begin, end, name, new))
    return found


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its values replaced, and kind, begin and end (in the given text) of each."""
    if not _HINT.search(text):
        return text, []
    taken: list[tuple[int, int, str, str]] = []
    for name, pattern, change in _FIND:
        begins = [t[0] for t in taken]
        more = []

        def free(begin: int, end: int, begins=begins, taken=taken) -> bool:
            at = bisect_left(begins, end)
            return not at or taken[at - 1][1] <= begin

        run, found = _RUNS.get(name), pattern.search(text)
        while found:
            begin, end = found.span()
            new = change(found.group(), key, back) if free(begin, end) else None
            # A card in unusual groups may be part of a usual one and a neighbour, so its whole run is looked at.
            if new is not None and (name != "card" or _USUAL.fullmatch(found.group())):
                more.append((begin, end, name, new))
            elif run:
                end = max(end, run.match(text, begin).end())
                more += _inside(text, begin, end, name, pattern, change, key, back, free)
            found = pattern.search(text, end)
        taken = sorted(taken + more) if more else taken
    out, at = [], 0
    for begin, end, _, new in taken:
        out += [text[at:begin], new]
        at = end
    return "".join([*out, text[at:]]), [(name, begin, end) for begin, end, name, _ in taken]


def pseudonymise_column(documents: DataFrame, key: bytes, text: str = "text", back: bool = False, into: str = "pii_count") -> DataFrame:
    """All columns, ``text`` with pseudonyms, and the number of values; a column of that name is replaced."""
    configure(documents.sparkSession)
    rows = documents.drop(into)
    schema = StructType([*rows.schema.fields, StructField(into, IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in slices(batches, text):
            at = batch.schema.get_field_index(text)
            done = [(None, []) if t is None else pseudonymise(t, key, back) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in done], batch.schema.field(at).type)
            counts = pa.array([len(found) for _, found in done], pa.int32())
            yield pa.RecordBatch.from_arrays([*columns, counts], [*batch.schema.names, into])

    return rows.mapInArrow(run, schema)
