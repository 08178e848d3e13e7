"""Personal data replaced by pseudonyms of the same form, from keyed permutations.

A value that passes its form's own check (check digit, calendar, ranges) is mapped
inside the set of all values of that form by a Feistel network: two halves of its
number take turns in being changed by a keyed hash of the other. Numbers outside the
set are sent on until one falls inside (cycle walking), so the mapping is a
permutation: equal values stay equal in every document, different ones different,
and whoever holds the key can invert it.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from jobweft.llm.common import map_batches

ROUNDS = 8


@dataclass(frozen=True)
class Permutation:
    """Keyed permutation of ``0 .. size - 1`` for one form."""

    key: bytes
    form: str
    size: int

    def _walk(self, value: int, rounds: range) -> int:
        half = max(1, (self.size - 1).bit_length() + 1 >> 1)
        mask = (1 << half) - 1
        while True:
            left, right = value >> half, value & mask
            for turn in rounds:
                seed = b"%d:%d:" % (turn, half)
                width = half // 8 + 8
                if rounds.step > 0:
                    mixed = self._hash(seed, right, width) & mask
                    left, right = right, left ^ mixed
                else:
                    mixed = self._hash(seed, left, width) & mask
                    left, right = right ^ mixed, left
            value = left << half | right
            if value < self.size:
                return value

    def _hash(self, seed: bytes, half: int, width: int) -> int:
        body = seed + self.form.encode() + half.to_bytes(width, "big")
        return int.from_bytes(hashlib.blake2b(body, key=self.key, digest_size=min(64, width)).digest(), "big")

    def forward(self, value: int) -> int:
        return self._walk(value, range(ROUNDS)) if self.size > 1 else value

    def back(self, value: int) -> int:
        return self._walk(value, range(ROUNDS - 1, -1, -1)) if self.size > 1 else value


def luhn_digit(digits: str) -> str:
    """Check digit that follows ``digits``."""
    doubled = [int(d) * 2 if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits))]
    return str(-sum(d - 9 if d > 9 else d for d in doubled) % 10)


def refill(template: str, symbols: str, alphabet: str) -> str:
    """``template`` with its characters of ``alphabet`` replaced in turn by ``symbols``."""
    fresh = iter(symbols)
    return "".join(next(fresh) if c in alphabet else c for c in template)


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
HEX = "0123456789abcdef"

Move = Callable[[Permutation, int], int]


class Forms:
    """The forms that are recognised, each with its check and its number of values."""

    def __init__(self, key: bytes, inverse: bool = False):
        self.key, self.inverse = key, inverse
        self.held: dict[tuple[str, int], Permutation] = {}

    def move(self, form: str, size: int, value: int) -> int:
        found = self.held.get((form, size))
        if found is None:
            found = self.held[form, size] = Permutation(self.key, form, size)
        return found.back(value) if self.inverse else found.forward(value)

    def text_in(self, form: str, text: str, alphabet: str) -> str:
        """Permute the characters of ``alphabet`` in ``text`` among texts of the same length."""
        base, value, n = len(alphabet), 0, 0
        for c in text:
            at = alphabet.find(c)
            if at >= 0:
                value, n = value * base + at, n + 1
        value = self.move(f"{form}/{n}", base**n, value)
        out = []
        for _ in range(n):
            value, at = divmod(value, base)
            out.append(alphabet[at])
        return refill(text, "".join(reversed(out)), alphabet)

    def card(self, text: str) -> str | None:
        """13 to 19 digits; a valid check digit stays valid, another one stays invalid by as much."""
        digits = digits_of(text)
        if not 13 <= len(digits) <= 19:
            return None
        off = (int(digits[-1]) - int(luhn_digit(digits[:-1]))) % 10
        body = self.text_in("number", digits[:-1], DIGITS)
        return refill(text, body + str((int(luhn_digit(body)) + off) % 10), DIGITS)

    def iban(self, text: str) -> str | None:
        """Country and length stay; the check number is made to fit the new account."""
        packed = text.replace(" ", "")
        if not 15 <= len(packed) <= 34 or self._iban_rest(packed[4:] + packed[:4]) != 1:
            return None
        body = self.text_in("iban" + packed[:2], packed[4:], DIGITS)
        check = 98 - self._iban_rest(body + packed[:2] + "00")
        fresh = iter(packed[:2] + f"{check:02d}" + body)
        return "".join(c if c == " " else next(fresh) for c in text)

    @staticmethod
    def _iban_rest(text: str) -> int:
        return int("".join(str(int(c, 36)) for c in text)) % 97

    def date(self, text: str) -> str | None:
        """A day between 1900 and 2099 becomes another one, written the same way.

        With slashes, a first number above 12 is a day, any other a month. The former
        texts are permuted among themselves, by going on until the day is above 12
        again; so no text can be read in the other way afterwards.
        """
        parts = re.findall(r"\d+", text)
        slashes = text[len(parts[0])] == "/"
        day_first = slashes and int(parts[0]) > 12
        if len(parts[0]) == 4:
            order = (0, 1, 2)
        else:
            order = (2, 0, 1) if slashes and not day_first else (2, 1, 0)
        try:
            day = datetime.date(*(int(parts[i]) for i in order))
        except ValueError:
            return None
        first, last = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)
        if not first <= day <= last:
            return None
        span = (last - first).days + 1
        new = first + datetime.timedelta(self.move("date", span, (day - first).days))
        while day_first and new.day <= 12:
            new = first + datetime.timedelta(self.move("date", span, (new - first).days))
        fields = dict(zip(order, (new.year, new.month, new.day), strict=True))
        out, at = [], 0
        for i, part in enumerate(parts):
            start = text.index(part, at)
            out.append(text[at:start] + f"{fields[i]:0{4 if i == order[0] else 2}d}")
            at = start + len(part)
        return "".join(out) + text[at:]

    def address(self, text: str) -> str | None:
        """Four numbers below 256 are one 32-bit number."""
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255:
            return None
        value = self.move("ip", 1 << 32, int.from_bytes(bytes(parts), "big"))
        return ".".join(map(str, value.to_bytes(4, "big")))

    def phone(self, text: str) -> str | None:
        """The country code and the punctuation stay, the national digits are permuted."""
        code = re.match(r"\+\d{1,3}(?=\D)|\+\d", text)
        head = code[0] if code else ""
        rest = text[len(head):]
        if not 7 <= len(digits_of(rest)) <= 14:
            return None
        return head + self.text_in("phone" + head, rest, DIGITS)

    def national(self, text: str) -> str | None:
        """Nine digits as three, two and four; area 000, 666 and 9xx, and zero groups, are no numbers."""
        area, group, serial = (int(p) for p in text.split("-"))
        areas = [a for a in range(1, 900) if a != 666]
        if area not in areas or not group or not serial:
            return None
        value = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
        value, serial = divmod(self.move("national", len(areas) * 99 * 9999, value), 9999)
        area, group = divmod(value, 99)
        return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"

    def email(self, text: str) -> str | None:
        """Letters (of any script) and digits before the @ are permuted; other characters and the domain stay."""
        local, _, domain = text.rpartition("@")
        local = local.lower()
        shape = re.sub(r"\d", "0", re.sub(r"[^\W\d_]", "a", local))
        for name, alphabet in (("letters", LETTERS), *OTHER_LETTERS.items()):
            if name == "letters" or not local.isascii():
                local = self.text_in(f"mail/{name}/{shape}", local, alphabet)
        return self.text_in("mail/digits", local, DIGITS) + "@" + domain

    def secret(self, text: str) -> str | None:
        """A quoted run of hexadecimal digits."""
        return self.text_in("hex", text, HEX if text == text.lower() else HEX.upper())


#: Letters of mail names beyond a to z, by ranges of code points; those of a range take each other's places.
OTHER_LETTERS = {
    name: "".join(c for c in map(chr, range(first, last)) if c.isalpha() and c.lower() == c)
    for name, first, last in (
        ("latin", 0xAA, 0x250), ("greek", 0x370, 0x400), ("cyrillic", 0x400, 0x530), ("near east", 0x530, 0x900),
        ("south asia", 0x900, 0x1100), ("kana", 0x3040, 0x3100), ("han", 0x4E00, 0xA000), ("hangul", 0xAC00, 0xD7A4),
    )
}

#: What is looked for, in this order at each place. Fixed values.
PATTERNS = [
    ("email", r"(?<![\w.+-])[^\W_][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("secret", r"(?<=[\"'])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?=[\"'])"),
    ("address", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"),
    ("date", r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-]|\.\d)"),
    ("national", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("card", r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d-])"),
    ("phone", r"\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]\d{4}(?!\d)|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d(])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\d)"),
]
FINDER = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern in PATTERNS))

#: Length of an IBAN by its country.
IBAN_LENGTHS = {
    code: length
    for length, codes in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for code in codes.split()
}
#: Groups of capitals after the last digit, which an IBAN may end with.
CAPITALS = re.compile(r"(?: [A-Z]{1,4}\b){0,8}")

#: Every form has a digit or an @; most texts are passed over by this alone.
ANCHORS = re.compile(r"[0-9@](?:.{0,40}[0-9@])*", re.DOTALL)
SPACE = re.compile(r"\s")
#: Code points before the first anchor that a form other than a mail address can begin at.
REACH = 8


def iban_ends(text: str, start: int, end: int) -> list[int]:
    """Ends of groups that an IBAN in ``text[start:end]`` may have: that of its country's length first, then the longest."""
    ends = [end, *(at for at in range(end - 1, start, -1) if text[at] == " ")]
    length = IBAN_LENGTHS.get(text[start : start + 2])
    return sorted(ends, key=lambda at: (at - start - text.count(" ", start, at) != length, -at))


def name_start(text: str, at: int, least: int) -> int:
    """Where the run of characters of a mail name that ends before ``at`` begins, however long it is."""
    while at > least and (text[at - 1].isalnum() or text[at - 1] in "_.+-"):
        at -= 1
    return at


def replacements(text: str, forms: Forms):
    """Valid values with their pseudonyms, as ``(form, start, end, pseudonym)``, looked for around digits and @ only.

    What follows an IBAN may look like one more group of it, so its shorter ends are tried too.
    """
    at = 0
    for near in ANCHORS.finditer(text):
        if near.end() <= at:
            continue
        stop = SPACE.search(text, near.end())
        end = CAPITALS.match(text, stop.start()).end() if stop else len(text)
        at = max(at, min(near.start() - REACH, name_start(text, near.start(), at)))
        while found := FINDER.search(text, at, end):
            form, (start, last) = found.lastgroup, found.span()
            ends = iban_ends(text, start, last) if form == "iban" else [last]
            for last in ends:
                fresh = getattr(forms, form)(text[start:last])
                if fresh is not None:
                    yield form, start, last, fresh
                    break
            at = start + 1 if fresh is None else last
        at = max(at, near.end())


def pseudonymise(text: str, forms: Forms) -> tuple[str, list[tuple[str, int, int]]]:
    """New text, and form, start and length of what was replaced, in the new text."""
    out, spans, at, size = [], [], 0, 0
    for form, start, end, fresh in replacements(text, forms):
        before = text[at:start]
        out += [before, fresh]
        spans.append((form, size + len(before), len(fresh)))
        size += len(before) + len(fresh)
        at = end
    return "".join([*out, text[at:]]), spans


def replace_personal_data(
    docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", inverse: bool = False
) -> DataFrame:
    """``(doc_id, text, n_replaced, spans)`` for every row, in one pass without a shuffle.

    ``spans`` lists form, start and length (code points) in the new text. Recognised
    are e-mail addresses (names of any length and script), IBANs, quoted hexadecimal secrets, network addresses,
    dates, card and telephone numbers and nine-digit national numbers; what fails its
    form's check is left as it is, except that a run of 13 to 19 digits with a wrong
    check digit is replaced too, its error kept. ``inverse`` undoes it with the same
    key. Mail addresses are lower-cased before the @, which is the one thing that is
    not undone. A null text stays null with no spans; an empty one stays empty.
    Repeated rows give equal rows; other columns are not read.
    """

    def replace(batch: pa.RecordBatch):
        forms = Forms(key, inverse)
        texts, counts, spans = [], [], []
        for text in batch.column("text").to_pylist():
            fresh, found = (None, []) if text is None else pseudonymise(text, forms)
            texts.append(fresh)
            counts.append(len(found))
            spans.append([dict(zip(("form", "start", "length"), s, strict=True)) for s in found])
        kind = pa.list_(pa.struct([("form", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(spans, kind)],
            names=["doc_id", "text", "n_replaced", "spans"],
        )

    return map_batches(
        docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS id", f"`{text_col}` AS text"),
        replace,
        "doc_id bigint, text string, n_replaced bigint, spans array<struct<form:string,start:bigint,length:bigint>>",
    )
