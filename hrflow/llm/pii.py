"""Personal data replaced by format-preserving pseudonyms.

Detected values are validated (check digits, octets, calendar) and then permuted within their
own format by a keyed Feistel network with cycle walking: a card number becomes another valid
card number with the same separators, a date another date of the same layout. The permutation
depends on the key, the kind and the digits, not on separators or place, so equal values
get equal pseudonyms in all documents and stay linked. Without the key it can't be undone.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import small_batches

ROUNDS = 8
LOWER = "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"
HEX = "0123456789abcdef"
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def permute(x: int, n: int, key: bytes, tweak: bytes, valid: Callable[[int], bool] = lambda v: True) -> int:
    """Keyed permutation of the valid numbers of range(n): Feistel rounds, walked until valid."""
    half = max(1, (max(1, (n - 1).bit_length()) + 1) // 2)
    mask, size = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = x >> half, x & mask
        for r in range(ROUNDS):
            f = hashlib.shake_256(key + tweak + bytes([r]) + right.to_bytes(size, "big")).digest(size)
            left, right = right, left ^ (int.from_bytes(f, "big") & mask)
        x = (left << half) | right
        if x < n and valid(x):
            return x


def _digits_of(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def _refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c in DIGITS else c for c in text)


def luhn_digit(digits: str) -> str:
    """Check digit for ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 == 0 else 1)
        total += v - 9 if v > 9 else v
    return str(-total % 10)


def _alphabets(c: str) -> str:
    return DIGITS if c in DIGITS else LOWER if c.islower() else LOWER.upper()


def _mixed(text: str, key: bytes, tweak: bytes, alphabet=None) -> str:
    """ASCII letters and digits of ``text`` permuted as one number of mixed radix; other characters stay."""
    at = [i for i, c in enumerate(text) if c.isascii() and c.isalnum()]
    sets = [alphabet or _alphabets(text[i]) for i in at]
    n, x = 1, 0
    for i, s in zip(at, sets):
        n, x = n * len(s), x * len(s) + s.index(text[i])
    if n < 2:
        return text
    y = permute(x, n, key, tweak + b"%d:" % n)
    out = list(text)
    for i, s in zip(reversed(at), reversed(sets)):
        y, r = divmod(y, len(s))
        out[i] = s[r]
    return "".join(out)


def _email(text: str, key: bytes) -> str | None:
    local, _, domain = text.rpartition("@")
    host, _, top = domain.rpartition(".")
    return f"{_mixed(local, key, b'email')}@{_mixed(host, key, b'host')}.{top}"


def _card(text: str, key: bytes) -> str | None:
    d = _digits_of(text)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    body = str(permute(int(d[:-1]), 10 ** (len(d) - 1), key, b"card%d" % len(d), lambda v: v >= 10 ** (len(d) - 2)
                       if d[0] != "0" else True)).zfill(len(d) - 1)
    return _refill(text, body + luhn_digit(body))


def _phone(text: str, key: bytes) -> str | None:
    m = re.match(r"\+\d{1,3}(?=\D)", text) or re.match(r"\+1(?=\d{10}$)", text)
    head = m[0] if m else ""
    d = _digits_of(text[len(head):])
    if not 7 <= len(d) <= 14 or len(set(d)) == 1:
        return None
    low = 2 * 10 ** (len(d) - 1)  # the first digit stays in its class: 0-1, or 2-9
    same = (lambda v: v >= low) if int(d) >= low else (lambda v: v < low)
    return head + _refill(text[len(head):], str(permute(int(d), 10 ** len(d), key, b"phone%d" % len(d), same)).zfill(len(d)))


def _ssn(text: str, key: bytes) -> str | None:
    d = _digits_of(text)

    def valid(v: int) -> bool:
        area, group, serial = v // 10 ** 6, v // 10 ** 4 % 100, v % 10 ** 4
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    return _refill(text, str(permute(int(d), 10 ** 9, key, b"ssn", valid)).zfill(9)) if valid(int(d)) else None


def _ip(text: str, key: bytes) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = int.from_bytes(bytes(map(int, parts)), "big")
    usable = lambda v: 0 < v >> 24 < 224 and v >> 24 != 127
    y = permute(x, 1 << 32, key, b"ip", usable if usable(x) else lambda v: not usable(v))
    return ".".join(map(str, y.to_bytes(4, "big")))


def _iban(text: str, key: bytes) -> str | None:
    flat = text.replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(flat) <= 34 or number(flat[4:] + flat[:4]) % 97 != 1:
        return None
    body = _mixed(flat[4:], key, b"iban" + flat[:2].encode())
    new = flat[:2] + "%02d" % (98 - number(body + flat[:2] + "00") % 97) + body
    it = iter(new)
    return "".join(c if c == " " else next(it) for c in text)


#: Month names (fixed values).
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
_MONTH = r"(?:%s)" % "|".join(f"{m[:3]}(?:{m[3:]})?" if len(m) > 3 else m for m in MONTHS)


def _new_day(year: str, month: str | int, day: str, key: bytes) -> dt.date | None:
    """The pseudonym of a day of 1900 to 2099; None if there is no such day."""
    try:
        at = dt.date(int(year), int(month), int(day)).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= at <= LAST_DAY:
        return None
    return dt.date.fromordinal(FIRST_DAY + permute(at - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, b"date"))


def _date(text: str, key: bytes) -> str | None:
    """A day of 1900 to 2099 in the layout found: y-m-d, d.m.y, and m/d/y (d/m/y if only that is a date).

    Days and months are padded to two digits if both are in the date found.
    """
    mark = re.search(r"\D", text)[0]
    a, b, c = text.split(mark)
    orders = ("ymd",) if len(a) == 4 else ("mdy", "dmy") if mark == "/" else ("dmy", "mdy")
    for order in orders:
        at = dict(zip(order, (a, b, c)))
        new = _new_day(at["y"], at["m"], at["d"], key)
        if new is not None:
            wide = 2 if len(at["m"]) == len(at["d"]) == 2 else 1
            parts = {"y": f"{new.year:04d}", "m": f"{new.month:0{wide}d}", "d": f"{new.day:0{wide}d}"}
            return mark.join(parts[o] for o in order)
    return None


def _named_date(text: str, key: bytes) -> str | None:
    """A date with the month's name, in its layout: the name whole or its first three letters, in its case."""
    name = re.search(r"[A-Za-z]{3,}", re.sub(r"(?i)(?<=\d)(st|nd|rd|th)", "  ", text))
    month = [m[:3].lower() for m in MONTHS].index(name[0][:3].lower()) + 1
    numbers = re.findall("[0-9]+", text)
    day, year = sorted(numbers, key=len)
    new = _new_day(year, month, day, key)
    if new is None:
        return None
    word = MONTHS[new.month - 1] if len(name[0]) > 3 or month == 5 else MONTHS[new.month - 1][:3]
    word = word.upper() if name[0].isupper() else word.lower() if name[0].islower() else word
    end = "th" if new.day in (11, 12, 13) else {1: "st", 2: "nd", 3: "rd"}.get(new.day % 10, "th")
    wide = 2 if day[0] == "0" else 1

    def part(m: re.Match) -> str:
        if m[0][0].isalpha():
            return word
        return str(new.year) if len(m[0]) == 4 else f"{new.day:0{wide}d}" + (end if m["nth"] else "")

    return re.sub(r"(?i)[0-9]+(?P<nth>st|nd|rd|th)?|[a-z]{3,}", part, text)


def _access_key(text: str, key: bytes) -> str | None:
    return text[:4] + "".join(_mixed(text[4:], key, b"access", LOWER.upper() + DIGITS))


def _secret(text: str, key: bytes) -> str | None:
    hexed = all(c in HEX for c in text) and len(text) >= 16
    return _mixed(text, key, b"secret", HEX if hexed else None)


#: Detectors: kind, text that must occur ("=:" either, "year" four digits after a space or hyphen), pattern, replacement. In order of precedence at one place.
DETECTORS: list[tuple[str, str, str, Callable[[str, bytes], str | None]]] = [
    ("secret", "=:", r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b[ \t]*[=:][ \t]*[\"']?)(?P<v>[^\s\"',;]{6,})", _secret),
    ("access_key", "AKIA", r"(?<![A-Za-z0-9])(?P<v>AKIA[A-Z0-9]{16})(?![A-Za-z0-9])", _access_key),
    ("iban", "", r"(?<![A-Za-z0-9])(?P<v>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])", _iban),
    ("date", "", r"(?<![\w./-])(?P<v>[0-9]{4}([./-])[0-9]{1,2}\2[0-9]{1,2}|[0-9]{1,2}([./-])[0-9]{1,2}\3[0-9]{4})(?![\w/-]|\.[0-9])", _date),
    ("date", "year", r"(?i:(?<![\w./-])(?P<v>[0-9]{1,2}(?:st|nd|rd|th)?(?: of)?[ -]%s\.?,?[ -][0-9]{4}|%s\.? [0-9]{1,2}(?:st|nd|rd|th)?,? [0-9]{4})(?![\w/-]|\.[0-9]))"
     % (_MONTH, _MONTH), _named_date),
    ("ssn", "-", r"(?<![\w-])(?P<v>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![\w-])", _ssn),
    ("ip", ".", r"(?<![\w.])(?P<v>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?!\w|\.[0-9])", _ip),
    ("phone", "", r"(?<![\w.])(?P<v>\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}"
                  r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?!\w|[.-][0-9])", _phone),
    ("phone", "", r"(?P<v>[2-9](?<![\w.+-].)(?<![0-9][ .-].)[0-9]{2} [2-9][0-9]{2}[ -][0-9]{4})(?![\w+-]|[ .-][0-9])", _phone),
]
#: Digits with single separators: a run may hold several numbers side by side.
_RUN = r"(?<![0-9A-Za-z_])(?<![0-9]\.)[0-9]+(?:[ -][0-9]+)*(?![0-9A-Za-z_])"
_LOCAL = r"[A-Za-z0-9._%+-]{1,64}$"
_DOMAIN = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}(?![A-Za-z0-9-])"


class Scanner:
    """Finds and replaces the values of one text at a time; keeps recent pseudonyms."""

    def __init__(self, key: bytes, kinds: tuple[str, ...] | None = None):
        self.key, self.known = key, {}
        self.email = kinds is None or "email" in kinds
        self.run = re.compile(_RUN) if kinds is None or "card" in kinds else None
        self.long = re.compile("[0-9](?:[ -]?[0-9]){12}")
        self.rest = [(k, need, re.compile(p), f) for k, need, p, f in DETECTORS if kinds is None or k in kinds]
        self.year = re.compile("[ -][0-9]{4}(?![0-9])")
        self.digit, self.local, self.domain = re.compile("[0-9]"), re.compile(_LOCAL), re.compile(_DOMAIN)

    def _new(self, kind: str, value: str, f) -> str | None:
        if (kind, value) not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            self.known[kind, value] = f(value, self.key)
        return self.known[kind, value]

    def _found(self, text: str) -> Iterator[tuple[int, int, int, str, str]]:
        at = text.find("@") if self.email else -1
        while at >= 0:
            a, b = self.local.search(text[max(0, at - 65):at]), self.domain.match(text, at + 1)
            if a and b:
                s = at - len(a[0])
                yield s, -b.end(), -1, "email", self._new("email", text[s:b.end()], _email)
            at = text.find("@", at + 1)
        if not self.digit.search(text) and not any(c in text for c in "=:"):
            return
        if self.run and self.long.search(text):
            yield from self._cards(text)
        for order, (kind, need, pattern, f) in enumerate(self.rest):
            if need and not (any(c in text for c in need) if need == "=:" else self.year.search(text) if need == "year" else need in text):
                continue
            for m in pattern.finditer(text):
                new = self._new(kind, m["v"], f)
                if new is not None:
                    yield m.start("v"), -m.end("v"), order, kind, new

    def _cards(self, text: str) -> Iterator[tuple[int, int, int, str, str]]:
        """Card numbers: in a run of digit groups, the fewest groups from the left that are valid together."""
        for m in self.run.finditer(text):
            groups = [g.span() for g in re.finditer("[0-9]+", m[0])]
            i = 0
            while i < len(groups):
                step, digits = 1, 0
                for j in range(i, len(groups)):
                    digits += groups[j][1] - groups[j][0]
                    if digits > 19:
                        break
                    s, e = m.start() + groups[i][0], m.start() + groups[j][1]
                    new = self._new("card", text[s:e], _card) if digits >= 13 else None
                    if new is not None:
                        yield s, -e, len(self.rest), "card", new
                        step = j - i + 1
                        break
                i += step

    def replace(self, text: str) -> tuple[str, list[dict]]:
        """The new text, and kind, start and end of each value (code points; equal in both texts)."""
        out, spans, end = [], [], 0
        for s, e, _, kind, new in sorted(self._found(text)):
            if s >= end:
                out += [text[end:s], new]
                end = -e
                spans.append({"kind": kind, "start": s, "end": end, "moved": len(new) - (end - s)})
        if not spans:
            return text, []
        shift = 0
        for x in spans:  # an address may be a few characters longer or shorter than the one it replaces
            x["start"], x["end"] = x["start"] + shift, x["end"] + shift + x["moved"]
            shift += x.pop("moved")
        return "".join(out) + text[end:], spans


PII_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                     T.StructField("end", T.IntegerType())]))


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", kinds: tuple[str, ...] | None = None,
                 out_col: str = "pii") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced, and ``out_col``: kind and place (in the
    new text) of each value.

    Other columns pass through; a column called ``out_col`` is replaced. NULL text stays NULL, an
    empty one empty, both with no places. Each row stands alone, so order, repeats and empty tables
    need no care.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(out_col).withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    names = docs.columns
    at = names.index(text_col)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(key, kinds)
        for b in batches:
            texts, spans = [], []
            for x in b.column(at):
                t = x.as_py()
                new, found = (None, []) if t is None else scanner.replace(t)
                texts.append(new)
                spans.append(found)
            columns = list(b.columns)
            columns[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], names=[*names, out_col])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out_col, PII_TYPE)]))
