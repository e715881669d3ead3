"""Format-preserving pseudonyms: validated values permuted by a keyed Feistel network.

A value found in a text is validated (check digits, calendar, ranges), turned into
a number of its format's domain, permuted there, and written back in the same
layout. The permutation depends on the key and the kind of value alone, so equal
values get equal pseudonyms in all documents, whatever their punctuation, and
different values stay different, and no value is its own pseudonym. Pseudonyms are valid: a
card number passes the Luhn test, an IBAN its check digits, a date is on the calendar.

Kinds: card numbers, IBANs, US social security numbers, phone numbers, IPv4
addresses, dates of 1900 to 2099, e-mail addresses (the part before the @; domains are
never changed) and secrets (access key ids, values assigned to password, token and the
like). Digits become digits and letters letters of the same sort: of ASCII, else of the
block of their script and their case. Other signs stay; a value of nothing else is left.

Defined results: a null text stays null and an empty one empty, both with counts
0; texts without such values come back as they are; repeated rows get equal
results; an empty table gives no rows; other columns pass untouched.
"""

from __future__ import annotations

import bisect
import datetime as dt
import functools
import re
import unicodedata
from collections.abc import Callable, Iterator
from hashlib import blake2b
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def permute(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """The image of ``value`` under the keyed permutation of 0 to ``size - 1``.

    An alternating Feistel network over two halves whose product covers ``size``;
    values beyond it are permuted again until one falls inside. ``back`` inverts.
    """
    if size < 2:
        return value
    left_size = isqrt(size - 1) + 1
    right_size = -(-size // left_size)
    # 16 bytes more than the modulus, so that the remainder is even.
    width = min(64, (left_size.bit_length() + 7) // 8 + 16)
    seed = f"{tweak}/{size}".encode()

    def shift(round_: int, half: int) -> int:
        data = seed + bytes([round_]) + half.to_bytes(80, "big")
        return int.from_bytes(blake2b(data, digest_size=width, key=key).digest(), "big")

    while True:
        left, right = divmod(value, right_size)
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if r % 2:
                step = shift(r, left)
                right = (right - step if back else right + step) % right_size
            else:
                step = shift(r, right)
                left = (left - step if back else left + step) % left_size
        value = left * right_size + right
        if value < size:
            return value


def moved(value: int, size: int, key: bytes, tweak: str) -> int:
    """The image of ``value`` under a keyed permutation that leaves no value in its place:
    the next one in the order that :func:`permute` gives."""
    if size < 2:
        return value
    return permute((permute(value, size, key, tweak) + 1) % size, size, key, tweak, back=True)


def _within(value: int, size: int, key: bytes, tweak: str, valid: Callable[[int], bool]) -> int:
    """Permutes the valid values among themselves."""
    while True:
        value = moved(value, size, key, tweak)
        if valid(value):
            return value


def _fill(layout: str, digits: str) -> str:
    """``layout`` with its digits replaced in order."""
    own = iter(digits)
    return "".join(next(own) if "0" <= c <= "9" else c for c in layout)


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> int:
    """Check digit that completes ``digits``."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _card(m: re.Match, key: bytes) -> str | None:
    digits = _digits(m[0])
    if luhn(digits[:-1]) != int(digits[-1]) or not digits.strip("0"):
        return None
    n = len(digits) - 1
    body = str(moved(int(digits[:-1]), 10**n, key, "card")).zfill(n)
    return _fill(m[0], body + str(luhn(body)))


def _iban_check(country: str, body: str) -> int:
    moved = "".join(str(int(c, 36)) for c in body + country + "00")
    return 98 - int(moved) % 97


def _iban(m: re.Match, key: bytes) -> str | None:
    # Words in capitals may follow the number, so shorter ends count as well.
    ends = [len(m[0]), *(k for k, c in enumerate(m[0]) if c == " ")]
    for end in sorted(ends, reverse=True):
        plain = m[0][:end].replace(" ", "")
        country, check, body = plain[:2], plain[2:4], plain[4:]
        if len(body) < 11 or int(check) != _iban_check(country, body):
            continue
        new = _by_class(body, key, f"iban{country}")
        chars = iter(f"{country}{_iban_check(country, new):02d}{new}")
        return "".join(c if c == " " else next(chars) for c in m[0][:end]) + m[0][end:]
    return None


def _ssn(m: re.Match, key: bytes) -> str | None:
    def valid(v: int) -> bool:
        area, group, serial = v // 1_000_000, v // 10_000 % 100, v % 10_000
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    value = int(_digits(m[0]))
    if not valid(value):
        return None
    return _fill(m[0], f"{_within(value, 10**9, key, 'ssn', valid):09d}")


def _phone(m: re.Match, key: bytes) -> str | None:
    country, rest = m["country"] or "", m["national"]
    digits = _digits(rest)
    n = len(digits)
    if not 7 <= n + len(_digits(country)) <= 15 or n < 6:
        return None
    edge = 2 * 10 ** (n - 1)  # area codes start with 2 to 9; others stay others
    value = int(digits)
    new = _within(value, 10**n, key, "phone", lambda v: (v >= edge) == (value >= edge))
    return country + _fill(rest, str(new).zfill(n))


def _ipv4(m: re.Match, key: bytes) -> str | None:
    parts = [int(p) for p in m[0].split(".")]
    if max(parts) > 255:
        return None
    value = moved(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ipv4")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _date(m: re.Match, key: bytes) -> str | None:
    a, b, c = m["a"], m["b"], m["c"]
    orders = ("abc",) if len(a) == 4 else ("cba", "cab")  # day first, else month first
    for order in orders:
        parts = {"a": a, "b": b, "c": c}
        year, month, day = (parts[k] for k in order)
        try:
            number = dt.date(int(year), int(month), int(day)).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= number <= LAST_DAY:
            return None
        size = LAST_DAY - FIRST_DAY + 1
        new = dt.date.fromordinal(FIRST_DAY + moved(number - FIRST_DAY, size, key, "date"))
        texts = (f"{new.year}", f"{new.month:0{len(month)}d}", f"{new.day:0{len(day)}d}")
        own = dict(zip(order, texts))
        return m["s"].join(own[k] for k in "abc")
    return None


ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
HEX = "0123456789abcdef"


@functools.lru_cache(maxsize=4096)
def _alphabet(c: str) -> str:
    """What may stand in the place of ``c``."""
    for alphabet in ALPHABETS:
        if c in alphabet:
            return alphabet
    kind = unicodedata.category(c)
    if not kind.startswith(("L", "N")):
        return c
    block = ord(c) & ~0xFF
    # Letters that a script writes with several signs stay out: they have no case of one sign.
    own = (chr(k) for k in range(max(block, 0x80), block + 0x100) if not 0xD800 <= k < 0xE000)
    return "".join(x for x in own if unicodedata.category(x) == kind and len(x.lower()) == 1)


def _by_class(text: str, key: bytes, tweak: str) -> str:
    """Every digit and letter becomes one of its alphabet; hex text stays hex."""
    hexed = len(text) >= 16 and re.fullmatch("[0-9]*[a-f][0-9a-f]*", text) is not None
    out = []
    for at in range(0, len(text), 40):
        value, size, places = 0, 1, []
        for c in text[at : at + 40]:
            alphabet = HEX if hexed else _alphabet(c)
            if c not in alphabet:
                alphabet = c
            places.append(alphabet)
            value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
        value = moved(value, size, key, f"{tweak}{at}")
        chars = []
        for alphabet in reversed(places):
            value, digit = divmod(value, len(alphabet))
            chars.append(alphabet[digit])
        out.append("".join(reversed(chars)))
    return "".join(out)


def _email(m: re.Match, key: bytes) -> str | None:
    new = _by_class(m["local"], key, "email")
    return None if new == m["local"] else new + m["domain"]


def _secret(m: re.Match, key: bytes) -> str | None:
    new = _by_class(m["value"], key, "secret")
    return None if new == m["value"] else m["name"] + new


# Calling codes of one and two digits; all others have three.
COUNTRY_CODES = "[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2}"

# (kind, counted as, characters one of which a text must hold, pattern, pseudonym);
# where matches overlap the earlier kind holds.
KINDS = (
    ("secret", "n_others", "=:", re.compile(
        r"(?P<name>\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b"
        r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?)(?P<value>[A-Za-z0-9+/_.\-]{8,}+)", re.I | re.A), _secret),
    ("access key", "n_others", "A", re.compile(
        r"(?P<name>\b(?:AKIA|ASIA))(?P<value>[A-Z0-9]{16})\b", re.A), _secret),
    ("email", "n_others", "@", re.compile(
        r"(?P<local>(?<![\w.+-])[\w.+-]++)(?P<domain>@[\w-]+(?:\.[\w-]+)+)"), _email),
    ("iban", "n_numbers", "0", re.compile(
        r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", re.A), _iban),
    ("ssn", "n_numbers", "-", re.compile(
        r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"), _ssn),
    ("date", "n_dates", "-/.", re.compile(
        r"(?<![\w./-])(?P<a>[0-9]{4})(?P<s>[-/.])(?P<b>[0-9]{1,2})(?P=s)(?P<c>[0-9]{1,2})(?=T[0-9]|(?![\w/-]))"),
     _date),
    ("date", "n_dates", "-/.", re.compile(
        r"(?<![\w./-])(?P<a>[0-9]{1,2})(?P<s>[-/.])(?P<b>[0-9]{1,2})(?P=s)(?P<c>[0-9]{4})(?![\w/-])"),
     _date),
    ("ipv4", "n_numbers", ".", re.compile(
        r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\w|\.[0-9])"), _ipv4),
    ("card", "n_numbers", "0", re.compile(
        r"(?<![\w-])(?:[0-9]{13,19}|[0-9]{4}(?:([ -])[0-9]{4}(?:\1[0-9]{4}\1[0-9]{1,7}"
        r"|[0-9]{2}\1[0-9]{5})))(?![\w-])"), _card),
    ("phone", "n_numbers", "+", re.compile(
        r"(?<![\w+])(?P<country>\+(?:" + COUNTRY_CODES + r"))(?P<national>[ .-]?\(?[0-9]{2,4}\)?"
        r"(?:[ .-]?[0-9]{2,4}){1,4})(?![\w-])"), _phone),
    ("phone", "n_numbers", "-.(", re.compile(
        r"(?<![\w+.-])(?P<country>)(?P<national>\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}"
        r"|[0-9]{3}([.-])[0-9]{3}\3[0-9]{4})(?![\w-])"), _phone),
)
COUNTS = ("n_numbers", "n_dates", "n_others")
DIGIT = re.compile("[0-9]")


def pseudonymise(text: str, key: bytes) -> tuple[str, dict[str, int]]:
    """The text with its values replaced, and how many of each sort."""
    counts = dict.fromkeys(COUNTS, 0)
    has_digit = DIGIT.search(text) is not None
    found: list[tuple[int, int, str]] = []
    for _, counted, signs, pattern, pseudonym in KINDS:
        if counted != "n_others" and not has_digit:
            continue
        if signs != "0" and not any(s in text for s in signs):
            continue
        for m in pattern.finditer(text):
            begin, end = m.span()
            at = bisect.bisect(found, (begin, end))
            if at and found[at - 1][1] > begin or at < len(found) and found[at][0] < end:
                continue
            new = pseudonym(m, key)
            if new is not None:
                found.insert(at, (begin, end, new))
                counts[counted] += 1
    if not found:
        return text, counts
    out, at = [], 0
    for begin, end, new in found:
        out += [text[at:begin], new]
        at = end
    out.append(text[at:])
    return "".join(out), counts


def pseudonymised(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc, text, n_numbers, n_dates, n_others): each row and its new text.

    ``doc`` holds the row's own columns.
    """

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for own in texts:
            rows = []
            for text in own:
                new, counts = (None, {}) if text is None else pseudonymise(text, key)
                rows.append((new, *(counts.get(c, 0) for c in COUNTS)))
            yield pd.DataFrame(rows, columns=["text", *COUNTS])

    replaced = F.pandas_udf(run, "text string, n_numbers int, n_dates int, n_others int")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return docs.select(
        F.struct(*columns).alias("doc"), replaced(F.col("text")).alias("new")
    ).select("doc", "new.*")


def replaced(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with the texts of ``pseudonymised``, and ``n_chars`` to match if there is one."""
    own = {c: F.col("doc").getField(c) for c in docs.columns}
    own["text"] = F.col("text")
    if "n_chars" in own:
        own["n_chars"] = F.coalesce(F.length("text").cast("long"), own["n_chars"])
    return pseudonymised(docs, key).select(*(v.alias(c) for c, v in own.items()))
