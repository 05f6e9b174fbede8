"""Format-preserving pseudonyms for personal data (operator 3).

Values are recognised by pattern and validated (Luhn and mod-97 check
digits, existing dates, number plans, octets), mapped to an index within
their format and replaced by a keyed permutation of that format: an
alternating Feistel network over the index range, walked until the result
is valid too. So equal values get equal pseudonyms in all documents, the
pseudonym has the same format and valid check digits, and whoever holds the
key can undo it.

Covered: e-mail addresses, payment cards, IBANs, telephone numbers, social
security numbers, IPv4 addresses, dates, access keys and values of
password, token, secret and api_key settings.

A match that fails its check may hold a value next to other digits or
capitals: its shorter spans at group borders are tried, and the search goes
on behind its first group. There a pseudonym that would make such a failed
span valid is passed over (else it could not be undone), so it may differ
from that of the same value elsewhere.

Rows are independent: one pass, no shuffle; rows without a digit or an @
are passed on as they came. Null texts stay null, empty ones empty; long
texts are handled whole, repeated rows alike, other columns are kept; an
input column named like the count column is replaced. An empty table gives
an empty one. A value that is alone in its format (a range of one) cannot
change.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import _text
from tessera.llm._store import frugal

ROUNDS = 8
CACHE = 200_000

# The lengths of IBANs of some countries do not matter here;
# the mod-97 check decides, also which of the blanks ends one.
PATTERN = re.compile(
    r"(?P<email>(?<!\w)\w[\w.+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}(?![\w-]))"
    r"|(?P<secret>(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\b)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
    r"(?P<value>[A-Za-z0-9+/_.-]{6,}))"
    r"|(?P<access>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b)"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b)"
    r"|(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))"
    r"|(?P<date>(?<![\w./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}[./-]\d{1,2}[./-]\d{4})(?![\w]|[./-]\d))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w]|-\d))"
    r"|(?P<card>(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d))")

FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY


class Feistel:
    """Keyed permutations of ranges 0..n-1; ``tag`` keeps formats apart."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _f(self, tag: bytes, i: int, x: int, n: int) -> int:
        data = b"%d|%d|%s" % (i, x, tag)
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=(n.bit_length() + 71) // 8 if n < 1 << 400 else 64).digest(), "big") % n

    def _once(self, tag: bytes, x: int, a: int, b: int) -> int:
        left, right = divmod(x, b)
        for i in range(0, ROUNDS, 2):
            left = (left + self._f(tag, i, right, a)) % a
            right = (right + self._f(tag, i + 1, left, b)) % b
        return left * b + right

    def _undo(self, tag: bytes, x: int, a: int, b: int) -> int:
        left, right = divmod(x, b)
        for i in range(ROUNDS - 2, -1, -2):
            right = (right - self._f(tag, i + 1, left, b)) % b
            left = (left - self._f(tag, i, right, a)) % a
        return left * b + right

    def permute(self, tag: str, x: int, n: int, valid: Callable[[int], bool] = lambda x: True, back: bool = False) -> int:
        """The image of valid x among the valid numbers below n (walks the
        cycle until it meets one, so it is a permutation of them)."""
        if n < 2:
            return x
        a = _root(n)
        b = -(-n // a)
        name = f"{tag}/{n}".encode()
        step = self._undo if back else self._once
        while True:
            x = step(name, x, a, b)
            if x < n and valid(x):
                return x


def _root(n: int) -> int:
    import math
    r = math.isqrt(n)
    return r if r * r == n else r + 1


def luhn(digits: str) -> int:
    """The check digit that completes ``digits``."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        if i % 2 == 0:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return -total % 10


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def refill(shape: str, chars: str) -> str:
    """``chars`` put into the letter and digit places of ``shape``."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _alphabet(c: str) -> str:
    if c.isdigit():
        return "0123456789"
    return "abcdefghijklmnopqrstuvwxyz" if c.islower() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Pseudonyms:
    """Replaces the values of a text; one per worker and key."""

    def __init__(self, key: bytes, back: bool = False):
        self.feistel, self.back = Feistel(key), back
        self.cache: dict[tuple[str, str], str | None] = {}

    def forget(self) -> None:
        """Drops the values seen, at the end of a task (``frugal`` frees them)."""
        self.cache.clear()

    def _perm(self, tag: str, x: int, n: int, valid=lambda x: True) -> int:
        return self.feistel.permute(tag, x, n, valid, self.back)

    def letters(self, tag: str, s: str) -> str:
        """ASCII letters and digits of s permuted, each within its kind."""
        hexa = len(s) >= 6 and re.fullmatch(r"[0-9a-f]+", s) and not s.isdigit()
        alphabets = ["0123456789abcdef" if hexa else _alphabet(c) if c.isascii() and c.isalnum() else c for c in s]
        n = x = 0
        n = 1
        for c, a in zip(s, alphabets):
            x, n = x * len(a) + a.index(c), n * len(a)
        shape = "".join("h" if hexa else "0" if len(a) == 10 else a[0] if len(a) == 26 else c for c, a in zip(s, alphabets))
        y = self._perm(f"{tag}:{shape}", x, n, (lambda v: _looks_hex(v, alphabets)) if hexa else lambda v: True)
        out = []
        for a in reversed(alphabets):
            y, r = divmod(y, len(a))
            out.append(a[r])
        return "".join(reversed(out))

    def email(self, s: str) -> str | None:
        local, _, host = s.rpartition("@")
        labels = host.split(".")
        own = ".".join(labels[:-2])
        mixed = self.letters("email", f"{local}@{own}")
        local, _, own = mixed.partition("@")
        return f"{local}@{'.'.join([own] * bool(own) + labels[-2:])}"

    def card(self, s: str) -> str | None:
        d = re.sub(r"\D", "", s)
        if not 13 <= len(d) <= 19 or len(set(d)) == 1 or luhn(d[:-1]) != int(d[-1]):
            return None
        n = 10 ** (len(d) - 2)
        first = d[0]
        make = lambda y: first + str(y).zfill(len(d) - 2)
        y = self._perm(f"card{first}", int(d[1:-1]), n, lambda y: len(set(make(y))) > 1)
        return refill(s, make(y) + str(luhn(make(y))))

    def iban(self, s: str) -> str | None:
        c = s.replace(" ", "")
        if not 15 <= len(c) <= 34 or iban_check(c[:2], c[4:]) != c[2:4]:
            return None
        account = self.letters("iban" + c[:2], c[4:])
        return refill(s, c[:2] + iban_check(c[:2], account) + account)

    def ip(self, s: str) -> str | None:
        o = [int(x) for x in s.split(".")]
        valid = lambda v: 0 < v >> 24 < 224 and v >> 24 != 127
        x = int.from_bytes(bytes(o), "big") if max(o) < 256 else -1
        if x < 0 or not valid(x):
            return None
        return ".".join(map(str, self._perm("ip", x, 1 << 32, valid).to_bytes(4, "big")))

    def date(self, s: str) -> str | None:
        a, p, b, q, c = re.fullmatch(r"(\d+)(\D)(\d+)(\D)(\d+)", s).groups()
        iso = len(a) == 4
        month_first = not iso and p == "/" and int(a) <= 12 < int(b)
        year, month, day = (a, b, c) if iso else (c, a, b) if month_first else (c, b, a)
        if p != q:
            return None
        try:
            x = datetime.date(int(year), int(month), int(day)).toordinal() - FIRST_DAY
        except ValueError:
            return None
        if not 0 <= x < DAYS:
            return None
        # stays within what is written in the same way: order of the parts
        order = iso or p != "/"

        def same(v: int) -> bool:
            t = datetime.date.fromordinal(v + FIRST_DAY)
            return order or (t.day > 12) == month_first
        t = datetime.date.fromordinal(self._perm(f"date{order}{month_first}", x, DAYS, same) + FIRST_DAY)
        two = "02d" if len(a) != 1 and len(b) != 1 and len(c) != 1 else "d"
        parts = (f"{t.year:04d}", f"{t.month:{two}}", f"{t.day:{two}}")
        y, m, d = parts
        return p.join((y, m, d) if iso else (m, d, y) if month_first else (d, m, y))

    def ssn(self, s: str) -> str | None:
        def valid(v: int) -> bool:
            area, group, serial = v // 1_000_000, v // 10_000 % 100, v % 10_000
            return 0 < area < 900 and area != 666 and group > 0 and serial > 0
        x = int(s.replace("-", ""))
        if not valid(x):
            return None
        return refill(s, f"{self._perm('ssn', x, 10 ** 9, valid):09d}")

    def phone(self, s: str) -> str | None:
        d = re.sub(r"\D", "", s)
        if not 7 <= len(d) <= 15:
            return None
        head = re.match(r"\+(\d{1,3})(?=[ .(-])", s)
        code = head[1] if head else ""
        rest = d[len(code):]
        if len(rest) == 10 and code in ("", "1"):  # ten-digit plan: area and exchange start at 2
            valid = lambda v: v // 10 ** 9 > 1 and v // 10 ** 6 % 10 > 1
            if not valid(int(rest)):
                return None
            y = self._perm("phone1", int(rest), 10 ** 10, valid)
        else:
            y = self._perm(f"phone{code}", int(rest), 10 ** len(rest))
        return refill(s, code + str(y).zfill(len(rest)))

    def access(self, s: str) -> str | None:
        return s[:4] + self.letters("access" + s[:4], s[4:])

    def value(self, kind: str, s: str) -> str | None:
        got = self.cache.get((kind, s), "")
        if got == "":
            got = self.letters("secret", s) if kind == "secret" else getattr(self, kind)(s)
            if len(self.cache) < CACHE:
                self.cache[kind, s] = got
        return got

    def fitting(self, kind: str, s: str, a: int, b: int, failed: list[tuple[str, int, int]]) -> str | None:
        """The pseudonym of s[a:b], walked on until no failed span around it
        gets valid by it: so the result is read, and undone, the same way."""
        def clash(new: str) -> bool:
            for k, x, y in failed:
                if x < b and a < y and len(new) == b - a:
                    near = s[min(a, x):a] + new + s[b:max(b, y)]
                    if self.value(k, near[x - min(a, x):y - min(a, x)]) is not None:
                        return True
            return False
        new = self.value(kind, s[a:b])
        while new is not None and clash(new):
            new = self.value(kind, new)
        return new

    def scan(self, s: str, done: int, at: int, end: int, out: list[str]) -> int:
        """Puts s[done:end] into ``out`` with the values from ``at`` on
        replaced; returns their number. If a match fails its check, shorter
        spans of it are tried, then the search goes on behind its first group."""
        found = 0
        failed: list[tuple[str, int, int]] = []
        while m := PATTERN.search(s, at, end):
            kind = m.lastgroup if m.lastgroup != "value" else "secret"
            new = None
            for a, b in ([m.span("value")] if kind == "secret" else shorter(kind, s, *m.span())):
                new = self.fitting(kind, s, a, b, failed)
                if new is not None:
                    break
                failed.append((kind, a, b))
            if new is None:
                at = FIRST.match(s, m.start()).end()
                failed = [x for x in failed if x[2] > at]
                continue
            found += self.scan(s, done, m.start(), a, out) if a > m.start() and kind != "secret" else 0
            if a == m.start() or kind == "secret":
                out.append(s[done:a])
            out.append(new)
            done = at = b
            found += 1
        out.append(s[done:end])
        return found

    def text(self, s: str) -> tuple[str, int]:
        """The text with all values replaced, and their number."""
        out: list[str] = []
        found = self.scan(s, 0, 0, len(s), out)
        return "".join(out), found


FIRST = re.compile(r"\W*\w+")
DIGITS = re.compile(r"\d+")
PRINTED = [(4, 4, 4, 4), (4, 6, 5), (4, 6, 4)]  # digit groups of cards
GROUPS = 5  # of a card with other digits around it, at most


def shorter(kind: str, s: str, a: int, b: int):
    """The spans of a match that may be the value, in the order of trial.
    Cards: groups as printed or in one piece, then the whole match, then what
    starts with it. IBANs: the whole match, then shorter ends at blanks."""
    if kind == "card":
        groups = [m.span() for m in DIGITS.finditer(s, a, b)]
        sizes = [y - x for x, y in groups]
        for i in range(len(groups)):
            for shape in [*PRINTED, (sizes[i],)]:
                if tuple(sizes[i:i + len(shape)]) == shape and sum(shape) >= 13:
                    yield groups[i][0], groups[i + len(shape) - 1][1]
        yield a, b
        for j in range(min(GROUPS, len(groups) - 1), 1, -1):
            if sum(sizes[:j]) >= 13:
                yield a, groups[j - 1][1]
        return
    yield a, b
    if kind == "iban":
        for i in range(b - 1, a, -1):
            if s[i] == " ":
                yield a, i


def _looks_hex(v: int, alphabets: list[str]) -> bool:
    """Whether hexadecimal v has a letter (else it would be a number)."""
    s = f"{v:0{len(alphabets)}x}"
    return not s.isdigit()


REACH = 160  # bytes around digits, @, = and : that are searched (then up to white space)


def spans(data: np.ndarray) -> list[tuple[int, int]]:
    """The parts of a text that can hold values: around candidate bytes, cut
    at white space, so that no value is split (values hold a candidate byte
    every few characters, or no white space)."""
    at = np.flatnonzero(CANDIDATE[data])
    if not len(at):
        return []
    space = np.flatnonzero(_text.IS_SPACE[data])
    new = np.flatnonzero(np.diff(at) > 2 * REACH) + 1
    lo = np.maximum(at[np.concatenate([[0], new])] - REACH, 0)
    hi = np.minimum(at[np.concatenate([new - 1, [len(at) - 1]])] + REACH, len(data))
    i = np.searchsorted(space, lo, side="right") - 1
    j = np.searchsorted(space, hi, side="left")
    border = np.concatenate([[-1], space, [len(data)]])
    lo, hi = border[i + 1] + 1, border[j + 1]
    out: list[tuple[int, int]] = []
    for a, b in zip(lo.tolist(), hi.tolist()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_workers: dict[tuple[bytes, bool], Pseudonyms] = {}
CANDIDATE = np.zeros(256, dtype=np.int64)
CANDIDATE[list(b"0123456789@=:")] = 1


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str = "n_private", back: bool = False) -> DataFrame:
    """``docs`` with the text replaced and the number of replaced values
    (long). ``back`` undoes it with the same key."""
    keep = [f for f in docs.schema.fields if f.name.lower() != count.lower()]
    schema = T.StructType([T.StructField(f.name, T.StringType() if f.name == text else f.dataType, True) for f in keep]
                          + [T.StructField(count, T.LongType())])
    at = [f.name for f in keep].index(text)
    secret = key.encode()
    source = docs.select(*[F.col("`" + f.name.replace("`", "``") + "`") for f in keep])

    @frugal
    def run(batches):
        names = _workers.setdefault((secret, back), Pseudonyms(secret, back))
        for batch in batches:
            texts = batch.column(at).cast(pa.string())
            mask = np.zeros(len(texts), dtype=bool)
            counts = np.zeros(len(texts), dtype=np.int64)
            new = []
            for first, data, offsets in _text.slices(texts):
                hits = np.concatenate([[0], np.cumsum(CANDIDATE[data])])
                for i in np.flatnonzero(hits[offsets[1:]] > hits[offsets[:-1]]).tolist():
                    row = data[offsets[i]:offsets[i + 1]]
                    pieces, done, n = [], 0, 0
                    for a, b in spans(row):
                        s, k = names.text(row[a:b].tobytes().decode("utf-8", "replace"))
                        pieces += [row[done:a].tobytes().decode("utf-8", "replace"), s]
                        done, n = b, n + k
                    if n:
                        s = "".join([*pieces, row[done:].tobytes().decode("utf-8", "replace")])
                        mask[first + i], counts[first + i] = True, n
                        new.append(s)
            if new:
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array(new, pa.string()))
            columns = list(batch.columns)
            columns[at] = texts
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=[f.name for f in schema.fields])
        names.forget()

    return source.mapInArrow(run, schema)
