"""Personal data replaced by format-preserving Feistel pseudonyms.

A value is found by its form, validated (Luhn, IBAN check digits, calendar, address
ranges, number plans), mapped to a number below the count of valid values of its
form, permuted by a keyed Feistel network with cycle walking, and written back in
the same form: separators, letter case and check digits stay right
(mixed-case hexadecimal becomes lower case).  The key and the
form fix the permutation, so equal values get equal pseudonyms in all documents,
different values of one form different ones, and the holder of the key can
reverse it.  Invalid numbers (a card number that no issuer has or that fails Luhn,
31 February) are not personal data and stay.

Forms: e-mail addresses (all but the last two host labels; letters of any script),
telephone numbers (+country code, or North American groups; area and exchange that
the North American plan has become such ones), IPv4 addresses, payment cards (the
first KEPT_DIGITS digits name the issuer and stay), IBANs, US social security numbers,
numeric dates, also before a time of day, MAC addresses, and hexadecimal secrets that
follow a word such as `token`.

Defined results: null text stays null and counts 0; text is read whole, and comes back
unchanged where nothing is found; repeated rows are treated alike; other columns pass
through replace(), and are ignored by pseudonyms().
"""

from __future__ import annotations

import datetime
import functools
import hashlib
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_texts

ROUNDS = 10
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX, HEX_UPPER = "0123456789abcdef", "0123456789ABCDEF"

EMAIL = re.compile(r"(?<![\w.+%-])[\w+%-]+(?:\.[\w+%-]+)*@(?:[^\W_](?:[\w-]*[^\W_])?\.)+[^\W\d_]{2,}(?![\w-])")
NUMBERS = re.compile(
    r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<mac>(?<![\w:-])[0-9A-Fa-f]{2}(?P<m>[:-])[0-9A-Fa-f]{2}(?:(?P=m)[0-9A-Fa-f]{2}){4}(?![\w:-]))"
    r"|(?P<secret>(?i:(?<![A-Za-z])(?:token|secret|api[_-]?key|access[_-]?key|password|passwd)\b[\"']?\s*[=:]\s*[\"']?)[0-9A-Fa-f]{16,128}(?![0-9A-Za-z]))"
    r"|(?<![\w.])(?:(?P<ip>\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))"
    r"|(?P<date>\d{4}(?P<d>[-/.])\d{1,2}(?P=d)\d{1,2}(?=[T_]\d\d:|(?!\w|[-/.]\d))|\d{1,2}(?P<e>[-/.])\d{1,2}(?P=e)\d{4}(?!\w|[-/.]\d))"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4}(?![\w]|-\d))"
    r"|(?P<card>(?:\d{4}(?P<k>[ -])\d{4}(?P=k)\d{4}(?P=k)\d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\w)))"
    r"|(?P<phone>(?<![\w+.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|(?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4})(?![\w]|[ .-]\d))"
)
#: First digits of payment cards by issuer, from and to, and how many digits such a card has.
ISSUERS = (
    ("4", "4", (13, 16, 19)), ("51", "55", (16,)), ("2221", "2720", (16,)), ("34", "34", (15,)), ("37", "37", (15,)), ("6011", "6011", (16, 19)), ("644", "659", (16, 19)),
    ("3528", "3589", (16, 17, 18, 19)), ("300", "305", (14, 16)), ("3095", "3095", (14, 16)), ("36", "36", (14, 15, 16, 17, 18, 19)), ("38", "39", (14, 16)), ("62", "62", (16, 17, 18, 19)), ("50", "50", (13, 14, 15, 16, 17, 18, 19)), ("56", "58", (13, 14, 15, 16, 17, 18, 19)),
)
#: First digits of a card that its pseudonym keeps: every issuer above can be told by them.
KEPT_DIGITS = 4
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()
#: Lengths of country codes by their first digits; all others have three digits.
ONE_DIGIT_CODES = ("1", "7")
TWO_DIGIT_CODES = ("20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98")


def luhn(digits: str) -> bool:
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def is_card(digits: str) -> bool:
    """Whether an issuer has cards of these first digits and this length, and the check digit is right."""
    return any(low <= digits[: len(low)] <= high and len(digits) in sizes for low, high, sizes in ISSUERS) and luhn(digits)


def is_north_american(body: str) -> bool:
    """Whether area and exchange are as the North American plan has them: neither begins with 0 or 1 nor ends in 11."""
    return len(body) == 10 and all(x[0] not in "01" and x[1:] != "11" for x in (body[:3], body[3:6]))


@functools.lru_cache(4096)
def alike(c: str) -> str:
    """The letters of a character's kind among the 64 around it; nothing for what isn't a letter."""
    first = ord(c) & ~63
    return "".join(x for x in map(chr, range(first, first + 64)) if unicodedata.category(x) == unicodedata.category(c)) if c.isalpha() else ""


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


class Pseudonyms:
    """The permutations of a key; reverse=True undoes them."""

    def __init__(self, key: bytes, reverse: bool = False):
        self.key, self.reverse = hashlib.blake2b(key, digest_size=32).digest(), reverse

    def _round(self, form: bytes, i: int, x: int) -> int:
        return int.from_bytes(hashlib.blake2b(x.to_bytes(64, "little"), digest_size=32, key=self.key, salt=form + bytes([i]), person=b"feistel").digest(), "little")

    def permute(self, x: int, n: int, form: str) -> int:
        """A keyed permutation of 0..n-1, by form."""
        tag = hashlib.blake2b(form.encode(), digest_size=15).digest()
        a = isqrt(max(n - 1, 0)) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(x, b)
            m, k = a, b  # left < m, right < k
            if not self.reverse:
                for i in range(ROUNDS):
                    left, right, m, k = right, (left + self._round(tag, i, right)) % m, k, m
            else:
                for i in reversed(range(ROUNDS)):
                    left, right, m, k = (right - self._round(tag, i, left)) % k, left, k, m
            x = left * b + right
            if x < n:
                return x

    def characters(self, text: str, form: str) -> str:
        """Digits to digits and letters to letters of the same case and script, as one number; other characters stay."""
        sets = [DIGITS if c in DIGITS else LOWER if c in LOWER else UPPER if c in UPPER else alike(c) for c in text]
        return self._spelled(text, sets, form + "".join(s[:1] or c for s, c in zip(sets, text, strict=True)))

    def _spelled(self, text: str, sets: list[str], form: str) -> str:
        x, n = 0, 1
        for c, s in zip(text, sets, strict=True):
            if s:
                x, n = x * len(s) + s.index(c), n * len(s)
        if n > 1 << 480:  # in halves, so that round inputs stay bounded
            half = len(text) // 2
            return self._spelled(text[:half], sets[:half], form + "<") + self._spelled(text[half:], sets[half:], form + ">")
        x, out = self.permute(x, n, form), []
        for c, s in zip(reversed(text), reversed(sets), strict=True):
            if s:
                x, k = divmod(x, len(s))
                c = s[k]
            out.append(c)
        return "".join(reversed(out))

    @staticmethod
    def _shortened(text: str, form) -> str | None:
        """The pseudonym of the longest valid start of text that ends before a separator, with the rest as it is."""
        end = len(text)
        while end > 0:
            new = form(text[:end])
            if new is not None:
                return new + text[end:]
            end = max(text.rfind(c, 0, end) for c in " .-")
        return None

    # -- forms: each gives the pseudonym, or None if the value isn't valid ---

    def email(self, text: str) -> str | None:
        name, _, hosts = text.partition("@")
        labels = hosts.split(".")
        keep = ".".join(labels[-2:])
        return self.characters(text[: len(text) - len(keep)], "email") + keep

    def ip(self, text: str) -> str | None:
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
            return None
        x = self.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
        return ".".join(map(str, x.to_bytes(4, "big")))

    def card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not is_card(digits):
            return None
        kept, n = digits[:KEPT_DIGITS], len(digits) - KEPT_DIGITS - 1
        new = kept + f"{self.permute(int(digits[KEPT_DIGITS:-1]), 10**n, f'card{len(digits)}/{kept}'):0{n}d}"
        new += next(c for c in DIGITS if luhn(new + c))
        found = iter(new)
        return re.sub(r"\d", lambda _: next(found), text)

    def iban(self, text: str) -> str | None:
        return self._shortened(text, self._iban)

    def _iban(self, text: str) -> str | None:
        tight = text.replace(" ", "")
        if not 15 <= len(tight) <= 34 or iban_rest(tight) != 1:
            return None
        body = self.characters(tight[4:], "iban" + tight[:2])
        found = iter(f"{tight[:2]}{98 - iban_rest(tight[:2] + '00' + body):02d}{body}")
        return "".join(c if c == " " else next(found) for c in text)

    def ssn(self, text: str) -> str | None:
        area, group, serial = map(int, text.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        place = area - 1 - (area > 666)
        x = self.permute((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, "ssn")
        x, serial = divmod(x, 9999)
        place, group = divmod(x, 99)
        return f"{place + 1 + (place >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def date(self, text: str) -> str | None:
        mark = re.search(r"\D", text)[0]
        parts = text.split(mark)
        sizes = [len(p) for p in parts]
        year_first, numbers = sizes[0] == 4, [int(p) for p in parts]
        y, (a, b) = (numbers[0], numbers[1:]) if year_first else (numbers[2], numbers[:2])
        month_first = year_first or mark == "/" and a <= 12
        padded = all(len(p) == 2 for p in parts if len(p) != 4)
        try:
            day = datetime.date(y, a if month_first else b, b if month_first else a).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        while True:
            day = FIRST_DAY + self.permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, f"date{mark}{year_first}{month_first}{padded}")
            d = datetime.date.fromordinal(day)
            # what would be read or spelt another way belongs to another form: walk on
            if mark == "/" and not year_first and not month_first and d.day <= 12:
                continue
            if not padded and (d.month >= 10 and d.day >= 10):
                continue
            break
        pad = 2 if padded else 1
        two = [f"{d.month:0{pad}d}", f"{d.day:0{pad}d}"] if month_first else [f"{d.day:0{pad}d}", f"{d.month:0{pad}d}"]
        return mark.join([f"{d.year:04d}", *two] if year_first else [*two, f"{d.year:04d}"])

    def phone(self, text: str) -> str | None:
        return self._shortened(text, self._phone)

    def _phone(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if not 8 <= len(digits) <= 15:
            return None
        code = 0
        if text.startswith("+"):
            code = 1 if digits.startswith(ONE_DIGIT_CODES) else 2 if digits.startswith(TWO_DIGIT_CODES) else 3
            if digits[0] == "1" and len(digits) != 11:
                return None
        elif len(digits) == 11:
            code = 1
        new = body = digits[code:]
        north = len(body) == 10 and digits[:code] in ("", "1")
        while True:
            new = f"{self.permute(int(new), 10 ** len(body), f'phone{digits[:code]}/{len(body)}'):0{len(body)}d}"
            if is_north_american(new) == is_north_american(body) if north else (new[0] == "0") == (body[0] == "0"):
                break  # else what was in the number plan has left it, or the reverse: walk on
        found = iter(digits[:code] + new)
        return re.sub(r"\d", lambda _: next(found), text)

    def mac(self, text: str) -> str | None:
        return self._hex(text, "mac")

    def secret(self, text: str) -> str | None:
        value = re.search(r"[0-9A-Fa-f]+$", text)[0]
        return text[: len(text) - len(value)] + self._hex(value, f"secret{len(value)}")

    def _hex(self, text: str, form: str) -> str:
        digits = HEX_UPPER if re.search("[A-F]", text) and not re.search("[a-f]", text) else HEX
        new = self._spelled(text if digits is HEX_UPPER else text.lower(), [digits if c.lower() in HEX else "" for c in text], form + digits[-1])
        return new

    def replace(self, text: str) -> tuple[str, Counter]:
        """The text with pseudonyms, and how many of each form were replaced."""
        counts: Counter = Counter()

        def put(form: str, value: str) -> str:
            new = getattr(self, form)(value)
            counts[form] += new is not None
            return value if new is None else new

        if "@" in text:
            out, last = [], 0
            for m in EMAIL.finditer(text):
                out += [self._numbers(text[last : m.start()], put), put("email", m[0])]
                last = m.end()
            text = "".join(out) + self._numbers(text[last:], put)
        else:
            text = self._numbers(text, put)
        return text, +counts

    def _numbers(self, text: str, put) -> str:
        return NUMBERS.sub(lambda m: put(next(k for k in ("iban", "mac", "secret", "ip", "date", "ssn", "card", "phone") if m[k] is not None), m[0]), text) if DIGIT.search(text) else text


DIGIT = re.compile(r"\d")


def _run(key: bytes, text_at: int | None = None):
    """For mapInArrow, text in column 0: all columns with the new text in place text_at, or just text, count and kinds after column 1."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pseudonyms(key)
        for batch in batches:
            texts, n, kinds = [], [], []
            for t in batch.column(0).to_pylist():
                new, counts = (t, {}) if t is None else p.replace(t)
                texts.append(new)
                n.append(sum(counts.values()))
                kinds.append(",".join(f"{k}:{counts[k]}" for k in sorted(counts)))
            text = pa.array(texts, pa.string())
            if text_at is None:
                yield pa.RecordBatch.from_arrays([batch.column(1), text, pa.array(n, pa.int64()), pa.array(kinds, pa.string())], names=["doc_id", "text", "n_replaced", "kinds"])
            else:
                columns = batch.columns[1:]
                columns[text_at] = text
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[1:])

    return run


def pseudonyms(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n_replaced and kinds (`form:count`, by name) of each row."""
    own = docs.select(F.col(text_col).cast("string"), F.col(id_col).cast("long"))
    return own.mapInArrow(_run(key), "doc_id long, text string, n_replaced long, kinds string")


def replace(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """docs, all columns in place, with pseudonyms in the text column."""
    return with_texts(docs, text_col, _run(key, docs.columns.index(text_col)))
