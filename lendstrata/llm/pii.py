"""Personal data replaced by format-preserving Feistel pseudonyms.

What looks like a number, date or address is validated (check digits, calendar, ranges), read
as an integer of the finite set that its format allows, and permuted within that set by a
keyed Feistel network; values outside the set are walked on until they are inside. Separators,
letter case, country codes and check digits fit the result. The permutation depends on the key,
the kind and the size of the set alone, so equal values stay linked across documents and
layouts, different values stay different, and who has the key can restore them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date
from functools import lru_cache
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

ROUNDS = 10
DIGITS, SMALL = "0123456789", "abcdefghijklmnopqrstuvwxyz"
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


class Feistel:
    """Keyed permutation of ``range(size)`` for each kind and size that leaves no value in its
    place: each run of values that the network would leave takes turns with the value after."""

    def __init__(self, key: bytes):
        self.key = key

    def _mixed(self, kind: str, size: int, step: int, half: int) -> int:
        message = f"{kind}:{size}:{step}:{half}".encode()
        return int.from_bytes(blake2b(message, key=self.key, digest_size=32).digest(), "big")

    def _network(self, kind: str, value: int, size: int, sign: int) -> int:
        """Forwards with sign 1, backwards with -1."""
        a = isqrt(size - 1) + 1
        b = -(-size // a)
        while True:
            right, left = divmod(value, a)
            for step in range(ROUNDS)[::sign]:
                if step % 2:
                    right = (right + sign * self._mixed(kind, size, step, left)) % b
                else:
                    left = (left + sign * self._mixed(kind, size, step, right)) % a
            value = right * a + left
            if value < size:
                return value

    def _stays(self, kind: str, value: int, size: int) -> bool:
        return self._network(kind, value, size, 1) == value

    def permute(self, kind: str, value: int, size: int) -> int:
        if size < 2:
            return value
        if self._stays(kind, value, size):
            source = (value + 1) % size
        else:
            source = value
            while self._stays(kind, before := (source - 1) % size, size):
                source = before
        return self._network(kind, source, size, 1)

    def restore(self, kind: str, value: int, size: int) -> int:
        if size < 2:
            return value
        source = self._network(kind, value, size, -1)
        if self._stays(kind, (source - 1) % size, size):
            return (source - 1) % size
        while self._stays(kind, source, size):
            source = (source + 1) % size
        return source


Walk = Callable[[str, int, int], int]


def luhn_digit(payload: str) -> int:
    """Check digit of a card number without it."""
    doubled = (int(c) * (2 - n % 2) for n, c in enumerate(reversed(payload)))
    return -sum(d - 9 * (d > 9) for d in doubled) % 10


def iban_checks(country: str, account: str) -> str:
    """Both check digits of an IBAN."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in account + country + '00')) % 97:02d}"


@lru_cache(maxsize=1 << 16)
def letters_like(c: str) -> str:
    """The characters that may stand for a lower-case one: digits for a digit, a to z for one of
    these, and for another letter the lower-case letters of its stretch of 128 characters.
    Nothing for a character that stays as it is."""
    if c.isascii():
        return DIGITS if c in DIGITS else SMALL if c in SMALL else ""
    first = ord(c) >> 7 << 7
    like = "".join(x for x in map(chr, range(first, first + 128)) if x.isalpha() and x != x.upper() and x.upper().lower() == x)
    return like if c in like else ""


def lowered(text: str) -> str:
    """In lower case, character by character."""
    return "".join(low if len(low := c.lower()) == 1 and low.upper() in (c, c.upper()) else c for c in text)


def refill(layout: str, characters: str) -> str:
    """``layout`` with its letters and digits replaced in turn, in its letter case."""
    fresh = iter(characters)
    out = []
    for c in layout:
        new = next(fresh) if letters_like(lowered(c)) else c
        out.append(new.upper() if c.isupper() else new.lower() if c.islower() else new)
    return "".join(out)


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def permute_characters(walk: Walk, kind: str, text: str) -> str:
    """Letters become letters and digits digits, by one number over all of them."""
    sets = [letters_like(c) for c in text]
    value, total = 0, 1
    for c, like in zip(text, sets):
        value = value * len(like) + like.index(c)
        total *= len(like)
    # texts with letters in the same places share a set
    shape = "".join({DIGITS: "9", SMALL: "a"}.get(like, like[:1]) for like in sets)
    value, out = walk(f"{kind}:{shape}", value, total), []
    for like in reversed(sets):
        value, rest = divmod(value, len(like))
        out.append(like[rest])
    return "".join(reversed(out))


def email(walk: Walk, m: re.Match) -> str | None:
    local = "".join(c for c in lowered(m["local"]) if letters_like(c))
    return f"{refill(m['local'], permute_characters(walk, 'email', local))}@{m['host']}" if local else None


def ipv4(walk: Walk, m: re.Match) -> str | None:
    parts = [int(p) for p in m[0].split(".")]
    if max(parts) > 255:
        return None
    value = walk("ipv4", int.from_bytes(bytes(parts), "big"), 1 << 32)
    return ".".join(map(str, value.to_bytes(4, "big")))


def iban(walk: Walk, m: re.Match) -> str | None:
    plain = m[0].replace(" ", "").upper()
    country, checks, account = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(account) <= 30 or iban_checks(country, account) != checks:
        return None
    fresh = permute_characters(walk, f"iban:{country}", account.lower()).upper()
    return refill(m[0], country + iban_checks(country, fresh) + fresh)


def card(walk: Walk, m: re.Match) -> str | None:
    digits = _digits(m[0])
    payload = digits[:-1]
    if not 13 <= len(digits) <= 19 or luhn_digit(payload) != int(digits[-1]):
        return None
    fresh = f"{walk('card', int(payload), 10 ** len(payload)):0{len(payload)}d}"
    return refill(m[0], fresh + str(luhn_digit(fresh)))


def ssn(walk: Walk, m: re.Match) -> str | None:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = int(m["area"]), int(m["group"]), int(m["serial"])
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value, serial = divmod(walk("ssn", value, 898 * 99 * 9999), 9999)
    area, group = divmod(value, 99)
    return refill(m[0], f"{area + 1 + (area >= 665):03d}{group + 1:02d}{serial + 1:04d}")


def phone(walk: Walk, m: re.Match) -> str | None:
    """The country code stays; 7 to 14 digits follow it."""
    head = m["country"] or ""
    rest = m[0][len(head) :]
    digits = _digits(rest)
    if not 7 <= len(digits) <= 14:
        return None
    return head + refill(rest, f"{walk('phone', int(digits), 10 ** len(digits)):0{len(digits)}d}")


def calendar_day(walk: Walk, m: re.Match) -> str | None:
    """Year first, or day first, or else month first, whichever is a day from 1900 to 2099. Where
    the day or month has one digit, so may those of the pseudonym."""
    if m["y1"]:
        orders = [("y1", "m1", "d1")]
    else:
        orders = [("y2", "a2", "b2"), ("y2", "b2", "a2")][:: -1 if m["sep2"] != "/" else 1]
    for order in orders:
        try:
            day = date(*(int(m[k]) for k in order)).toordinal()
        except ValueError:
            continue
        if FIRST_DAY <= day <= LAST_DAY:
            fresh = date.fromordinal(FIRST_DAY + walk("date", day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1))
            width = min(len(m[k]) for k in order[1:])
            new = dict(zip(order, (f"{fresh.year:04d}", f"{fresh.month:0{width}d}", f"{fresh.day:0{width}d}")))
            starts = sorted(order, key=lambda k: m.start(k))
            return (m["sep1"] or m["sep2"]).join(new[k] for k in starts)
    return None


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: re.Pattern
    pseudonym: Callable[[Walk, re.Match], str | None]


#: Commas, colons and semicolons part values, points and hyphens join them to longer ones.
_ALONE, _END = r"(?<![0-9A-Za-z])(?<![0-9][.-])", r"(?![0-9A-Za-z])(?![.-][0-9])"
#: Cards as they are printed.
_PRINTED = r"(?:[0-9]{13,19}|[0-9]{4}(?P<gap>[ -])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{4}|[0-9]{4}(?P<cut>[ -])[0-9]{6}(?P=cut)[0-9]{4,5})"

#: In order of precedence where finds overlap.
KINDS = (
    Kind("email", re.compile(r"(?<![\w.%+-])(?P<local>[\w.%+-]{1,64})@(?P<host>(?:[^\W_]{1,63}(?:-+[^\W_]{1,63}){0,8}\.){1,8}[^\W\d_]{2,24})(?!\w)"), email),
    Kind("ipv4", re.compile(_ALONE + r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}" + r"(?![0-9A-Za-z])(?!\.[0-9])"), ipv4),
    Kind("iban", re.compile(r"(?<![0-9A-Za-z])[A-Za-z]{2}[0-9]{2}(?: ?[0-9A-Za-z]{4}){2,7}(?: ?[0-9A-Za-z]{1,4})?(?![0-9A-Za-z])"), iban),
    Kind("date", re.compile(_ALONE + r"(?:(?P<y1>(?:19|20)[0-9]{2})(?P<sep1>[-/.])(?P<m1>[0-9]{1,2})(?P=sep1)(?P<d1>[0-9]{1,2})|(?P<a2>[0-9]{1,2})(?P<sep2>[-/.])(?P<b2>[0-9]{1,2})(?P=sep2)(?P<y2>(?:19|20)[0-9]{2}))(?:(?=[Tt][0-9])|" + _END + ")"), calendar_day),
    Kind("ssn", re.compile(_ALONE + r"(?P<area>[0-9]{3})-(?P<group>[0-9]{2})-(?P<serial>[0-9]{4})" + _END), ssn),
    Kind("card", re.compile(r"(?<!\+)" + _ALONE + _PRINTED + r"(?![0-9A-Za-z])(?!\.[0-9])"), card),
    Kind("card", re.compile(r"(?<!\+)" + _ALONE + r"[0-9](?:[ -]?[0-9]){12,18}" + _END), card),
    Kind("phone", re.compile(r"(?<![0-9A-Za-z+])(?P<country>\+[0-9]{1,3})[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}" + _END), phone),
    Kind("phone", re.compile(r"(?<![0-9A-Za-z+])(?P<country>)\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}" + _END), phone),
    Kind("phone", re.compile(_ALONE + r"(?P<country>)[0-9]{3}(?P<sep>[ .-])[0-9]{3}(?P=sep)[0-9]{4}" + _END), phone),
)
_MAYBE = "[0-9@]"


def candidates(m: re.Match) -> Iterator[re.Match]:
    """A match, then what is left of it as its last groups of letters and digits are cut off:
    a number or word after a value can look like a part of it."""
    yield m
    for end in range(m.end() - 1, m.start(), -1):
        if m.string[end] in " .-" and (shorter := m.re.fullmatch(m.string, m.start(), end)):
            yield shorter


def find(text: str, walk: Walk) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, pseudonym)`` of the validated finds, by start, none overlapping.
    After a match of which no part validates, the search goes on behind its first character."""
    taken: list[tuple[int, int, str, str]] = []
    for kind in KINDS:
        if kind.name == "email" and "@" not in text:
            continue
        starts, found = [t[0] for t in taken], []
        at = 0
        while m := kind.pattern.search(text, at):
            at = m.start() + 1
            for c in candidates(m):
                # the finds so far don't overlap: only the last that starts before c ends can reach in
                before = bisect_left(starts, c.end())
                if before and taken[before - 1][1] > c.start():
                    continue
                if (fresh := kind.pseudonym(walk, c)) is not None:
                    found.append((c.start(), c.end(), kind.name, fresh))
                    at = c.end()
                    break
        taken = sorted(taken + found)
    return taken


def replace(text: str, finds: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for start, end, _, fresh in finds:
        out += [text[at:start], fresh]
        at = end
    return "".join([*out, text[at:]])


@lru_cache(maxsize=4)
def _walk(key: str) -> Walk:
    return lru_cache(maxsize=100_000)(Feistel(key.encode()).permute)


def pseudonymized(text: Column, key: str) -> Column:
    """Struct of ``text`` with its finds replaced, their number ``n_found``, and ``kinds``, the
    kinds in order of place, comma-joined. NULL text stays NULL with 0 finds."""

    @arrow_udf("struct<text: string, n_found: bigint, kinds: string>")
    def run(texts: pa.Array) -> pa.Array:
        maybe = pc.match_substring_regex(texts, _MAYBE).fill_null(False).to_pylist()
        fresh, counts, kinds = texts.to_pylist(), [0] * len(texts), [""] * len(texts)
        for n, may in enumerate(maybe):
            if may and (finds := find(fresh[n], _walk(key))):
                fresh[n], counts[n] = replace(fresh[n], finds), len(finds)
                kinds[n] = ",".join(kind for _, _, kind, _ in finds)
        return pa.StructArray.from_arrays(
            [pa.array(fresh, pa.string()), pa.array(counts, pa.int64()), pa.array(kinds, pa.string())],
            ["text", "n_found", "kinds"],
        )

    return run(text.cast("string"))


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the finds in column ``text`` replaced; all columns and rows stay as they
    are otherwise. NULL and empty texts stay; an empty table stays empty."""
    return docs.withColumn(text, pseudonymized(F.col(f"`{text}`"), key)["text"])
