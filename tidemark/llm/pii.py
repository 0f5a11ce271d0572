"""Format-preserving pseudonyms for personal data by a keyed Feistel network.

Every kind of value has a format: how many valid values there are, which number a value has among them, and back. A
validated value's number is permuted with a key and turned back into text, so that the result is valid too, equal
values stay equal in all documents whatever their punctuation, and the key's owner can undo it.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .common import map_batches, rows_of

ROUNDS = 10
KINDS = ("email", "card", "iban", "ssn", "phone", "ip", "date", "secret")


class Permutation:
    """A keyed permutation of the numbers below ``size`` that leaves none in its place (from two numbers on)."""

    def __init__(self, key: bytes, label: str, size: int):
        self.size, self.half = size, max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.state = hashlib.blake2b(f"{label}/{size}".encode(), key=hashlib.sha256(key).digest())
        self.width = (self.half + 7) // 8

    def _round(self, i: int, value: int) -> int:
        state = self.state.copy()
        state.update(bytes([i]) + value.to_bytes(self.width, "big"))
        digest = state.digest()
        while len(digest) < self.width:
            state.update(digest)
            digest += state.digest()
        return int.from_bytes(digest[: self.width], "big") & self.mask

    def _walk(self, x: int, back: bool) -> int:
        """The Feistel network, repeated until the number is below ``size`` again (cycle walking)."""
        while True:
            left, right = x >> self.half, x & self.mask
            if back:
                for i in reversed(range(ROUNDS)):
                    left, right = right ^ self._round(i, left), left
            else:
                for i in range(ROUNDS):
                    left, right = right, left ^ self._round(i, right)
            x = left << self.half | right
            if x < self.size:
                return x

    def forward(self, x: int) -> int:
        return self._walk((self._walk(x, False) + 1) % self.size, True)

    def backward(self, x: int) -> int:
        return self._walk((self._walk(x, False) - 1) % self.size, True)


# ---- Numbers of values within their formats

Coded = tuple[str, int, int, Callable[[int], str]]
"""Label of the permutation, size of the format, number of the value, number to text."""


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _refill(text: str, digits: str) -> str:
    """The text with its digits replaced in order; punctuation stays."""
    return re.sub(r"\d", lambda m, d=iter(digits): next(d), text)


def luhn_check(payload: str) -> str:
    """The digit that makes payload + digit pass the Luhn test."""
    total = sum(d * 2 - 9 * (d > 4) if i % 2 == 0 else d for i, d in enumerate(map(int, reversed(payload))))
    return str(-total % 10)


def _classes(text: str) -> list[str]:
    """The alphabet of each sign; signs other than ASCII letters and digits stand for themselves."""
    sets = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return [next((s for s in sets if c in s), c) for c in text]


def _mixed(label: str, text: str, alphabets: list[str], wrap: Callable[[str], str] = str) -> Coded:
    """A text as a number of mixed radix over an alphabet for each place."""
    size, number = 1, 0
    for c, alphabet in zip(text, alphabets):
        number = number * len(alphabet) + alphabet.index(c)
        size *= len(alphabet)

    def back(n: int) -> str:
        out = []
        for alphabet in reversed(alphabets):
            n, i = divmod(n, len(alphabet))
            out.append(alphabet[i])
        return wrap("".join(reversed(out)))

    shape = hashlib.sha256("|".join(alphabets).encode()).hexdigest()[:16]
    return f"{label}/{shape}", size, number, back


def code_email(text: str) -> Coded | None:
    local, _, domain = text.rpartition("@")
    # What stands before the first letter or digit of ASCII stays, and has no part in the pseudonym: it may be a bullet.
    lead = len(re.match(r"[^A-Za-z0-9]*", local)[0])
    before, local = local[:lead], local[lead:]
    return _mixed("email/" + domain.lower(), local, _classes(local), lambda s: f"{before}{s}@{domain}")


#: Three groups of digits in a row that may be a day of these centuries, in the order y-m-d, d-m-y or m-d-y.
DAY = re.compile(r"(?<!\d)(?:(?:19|20)\d\d([ -])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([ -])(?:0?[1-9]|[12]\d|3[01])\2(?:19|20)\d\d)(?!\d)")


def code_card(text: str) -> Coded | None:
    """Numbers that pass the Luhn test; dates in a row are none, whatever their digits add up to."""
    if DAY.search(text):
        return None
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or digits[0] not in "23456" or luhn_check(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    first, body = digits[0], digits[1:-1]
    return f"card/{first}", 10 ** len(body), int(body), lambda n: _refill(text, (p := first + str(n).zfill(len(body))) + luhn_check(p))


def code_iban(text: str) -> Coded | None:
    plain = text.replace(" ", "")
    as_number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or as_number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    country, body = plain[:2], plain[4:]

    def wrap(s: str) -> str:
        whole = iter(f"{country}{98 - as_number(s + country + '00') % 97:02d}{s}")
        return "".join(c if c == " " else next(whole) for c in text)

    return _mixed(f"iban/{country}", body, _classes(body), wrap)


def code_ssn(text: str) -> Coded | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    area_at = area - 1 - (area > 666)

    def back(n: int) -> str:
        n, s = divmod(n, 9999)
        a, g = divmod(n, 99)
        return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"

    return "ssn", 898 * 99 * 9999, (area_at * 99 + group - 1) * 9999 + serial - 1, back


def code_phone(text: str) -> Coded | None:
    """North American numbers keep their plan's rules; others with a + keep their country code's first two digits.

    Numbers that the plan doesn't allow are taken only if +1 says what they are, and stay among themselves.
    """
    digits = _digits(text)
    if not text.startswith("+") or digits.startswith("1"):
        national = digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
        if len(national) != 10:
            return None
        area, exchange, line = int(national[:3]), int(national[3:6]), int(national[6:])
        lead = digits[: len(digits) - 10]
        if area < 200 or exchange < 200:
            if not text.startswith("+"):
                return None
            low = 200 * 1000  # area codes under 200 with any exchange come first, then the others with low exchanges
            pair = area * 1000 + exchange if area < 200 else low + (area - 200) * 200 + exchange

            def unplanned(n: int) -> str:
                n, last = divmod(n, 10_000)
                a, e = divmod(n, 1000) if n < low else divmod(n - low, 200)
                return _refill(text, f"{lead}{a + 200 * (n >= low):03d}{e:03d}{last:04d}")

            return "phone/unplanned", (low + 800 * 200) * 10_000, pair * 10_000 + line, unplanned

        def back(n: int) -> str:
            n, last = divmod(n, 10_000)
            a, e = divmod(n, 800)
            return _refill(text, f"{lead}{a + 200}{e + 200}{last:04d}")

        return "phone", 800 * 800 * 10_000, ((area - 200) * 800 + exchange - 200) * 10_000 + line, back
    if not 8 <= len(digits) <= 15:
        return None
    body = digits[2:]
    return f"phone/{digits[:2]}", 10 ** len(body), int(body), lambda n: _refill(text, digits[:2] + str(n).zfill(len(body)))


def code_ip(text: str) -> Coded | None:
    try:
        address = ipaddress.IPv4Address(text)
    except ValueError:
        return None
    if address.is_loopback or address.is_unspecified or address == ipaddress.IPv4Address("255.255.255.255"):
        return None
    return "ip", 1 << 32, int(address), lambda n: str(ipaddress.IPv4Address(n))


#: Dates are permuted among the days of these years.
FIRST, LAST = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)


def code_date(text: str) -> Coded | None:
    sign = next(c for c in text if not c.isdigit())
    parts = text.split(sign)
    year_first = len(parts[0]) == 4
    orders = [(0, 1, 2)] if year_first else [(2, 1, 0), (2, 0, 1)]
    for y, m, d in orders:
        try:
            day = datetime.date(*(int(parts[i]) for i in (y, m, d)))
        except ValueError:
            continue
        if not FIRST <= day <= LAST:
            return None

        def back(n: int) -> str:
            to = FIRST + datetime.timedelta(n)
            said = [""] * 3
            said[y], said[m], said[d] = f"{to.year:04d}", f"{to.month:02d}", f"{to.day:02d}"
            return sign.join(said)

        return "date", (LAST - FIRST).days + 1, (day - FIRST).days, back
    return None


def code_secret(text: str) -> Coded | None:
    """Access keys and password values, place by place; a known prefix stays."""
    keep = len(re.match(r"(?:AKIA|ASIA|ghp_|sk-)?", text)[0])
    body = text[keep:]
    if re.fullmatch(r"[0-9a-f]+", body):
        alphabets = ["0123456789abcdef"] * len(body)
    elif re.fullmatch(r"[0-9A-Z]+", body):
        alphabets = ["0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"] * len(body)
    else:
        alphabets = _classes(body)
    return _mixed("secret", body, alphabets, lambda s: text[:keep] + s)


# What values look like before they are validated. The first kind that holds at a place is taken.
PATTERNS: list[tuple[str, str, Callable[[str], Coded | None]]] = [
    ("email", r"[\w.+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", code_email),
    ("secret", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])", code_secret),
    ("secret", r"(?<![A-Za-z0-9])(?:ghp_|sk-)[A-Za-z0-9]{20,}(?![A-Za-z0-9])", code_secret),
    ("secret", r"(?i:(?<=password=)|(?<=passwd=)|(?<=api_key=)|(?<=apikey=)|(?<=secret=)|(?<=token=))[A-Za-z0-9_\-+/.]{6,}(?<!\.)", code_secret),
    ("secret", r"(?<![A-Za-z0-9])(?=[a-f]*[0-9])[0-9a-f]{40}(?![A-Za-z0-9])", code_secret),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", code_iban),
    ("card", r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d)", code_card),
    ("ip", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", code_ip),
    ("date", r"(?<![\w./-])(?:\d{4}(?P<a>[-/.])\d{1,2}(?P=a)\d{1,2}|\d{1,2}(?P<b>[-/.])\d{1,2}(?P=b)\d{4})(?![\w]|[./-]\d)", code_date),
    ("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", code_ssn),
    ("phone", r"(?<![\w.+])\+\d(?:[ .-]?\(?\d\)?){7,16}(?!\w)", code_phone),
    ("phone", r"(?<![\w.+-])(?:1[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])", code_phone),
]
#: Kinds whose patterns may run on into digits or words that follow the value.
OPEN_ENDED = ("card", "iban", "phone")
#: Signs of an IBAN by country.
IBAN_SIGNS = {
    c: n
    for n, of in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in of.split()
}


#: Groups of digits in which cards are written.
CARD_GROUPS = re.compile(r"\d{13,19}|(?:\d{4}[ -]){3}\d{1,4}|(?:\d{4}[ -]){4}\d{1,3}|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{6}[ -]\d{13}")
#: No value of an open-ended kind is longer, punctuation included.
LONGEST = 80


def _ends(kind: str, pattern: re.Pattern, text: str, start: int, longest: int, inside: bool, usual: bool) -> Iterator[int]:
    """Where a value that starts at ``start`` may end: an IBAN at its country's length first, then the longest first.

    Shorter ends lie between groups of signs. Cards are looked for in their usual groups first. In other groups, the
    whole match may be one; shorter ends, and starts ``inside`` a match without a value, only with three digits in all groups
    but the last, as small numbers in a row are a list.
    """
    if kind not in OPEN_ENDED:
        yield longest
        return
    ends = [e for e in range(longest - 1, start, -1) if not text[e].isalnum() and text[e] != ")" and (text[e - 1].isalnum() or text[e - 1] == ")")]
    ends = [longest, *(e for e in ends if pattern.fullmatch(text, start, e))]
    if kind == "iban":
        ends.sort(key=lambda e: len(text[start:e].replace(" ", "")) != IBAN_SIGNS.get(text[start : start + 2]))
    for end in ends:
        if kind != "card" or (CARD_GROUPS.fullmatch(text, start, end) if usual else end == longest and not inside or all(len(g) > 2 for g in re.split("[ -]", text[start:end])[:-1])):
            yield end


#: A value of any kind has one of these signs.
SIGN = re.compile(r"[0-9@=]|ghp_|sk-")


class Pseudonyms:
    """Replaces what PATTERNS find and the formats accept."""

    def __init__(self, key: bytes, kinds: tuple[str, ...] = KINDS):
        if not key:
            raise ValueError("a key is needed")
        self.key = key
        self.patterns = [(kind, re.compile(pattern), code) for kind, pattern, code in PATTERNS if kind in kinds]
        self._permutation = lru_cache(4096)(lambda label, size: Permutation(key, label, size))

    def replace(self, kind: str, text: str, code: Callable[[str], Coded | None], undo: bool = False, fits: Callable[[str], bool] | None = None) -> str | None:
        """The pseudonym, or None where the text isn't a valid value of its kind.

        With ``fits`` it is the next one along the permutation's cycle that fits. A card's is one that reads as a card again.
        """
        coded = code(text)
        if coded is None or coded[1] < 2:
            return None
        label, size, number, back = coded
        permutation = self._permutation(label, size)
        step = permutation.backward if undo else permutation.forward
        new = back(number := step(number))
        while new != text and (kind == "card" and code(new) is None or fits and not fits(new)):
            new = back(number := step(number))
        return new

    def apply(self, text: str | None, undo: bool = False) -> tuple[str | None, dict[str, int], list[tuple[str, int, int]]]:
        """The text with pseudonyms, how many of each kind, and their spans (kind, start, end) in the text given.

        Where a match is no value, shorter ones from its start are tried, then those that start further on. What was tried
        around a value must be none beside its pseudonym either, so that undoing finds the same span; a number among others
        may so get another pseudonym than it has alone. (Two values that run into each other may still come back wrong.)
        """
        if not text or not SIGN.search(text):
            return text, {}, []
        taken: list[tuple[int, int, str, str]] = []
        used = bytearray(len(text))
        for kind, pattern, code in self.patterns:
            if kind == "email" and "@" not in text:
                continue
            failed: dict[int, list[int]] = {}
            for usual in (True, False) if kind == "card" else (False,):
                at, seen = 0, 0
                while match := pattern.search(text, at):
                    start, longest = match.span()
                    at = start + 1
                    for end in _ends(kind, pattern, text, start, longest, start < seen, usual):
                        if 1 in used[start:end]:
                            continue
                        near = [(s, e) for s in range(start - LONGEST, end) for e in failed.get(s, ()) if e > start] if failed else []

                        def fits(new: str) -> bool:
                            beside = lambda s, e: text[s:start] + new[max(0, s - start) : e - start] + text[end:e]
                            return not any(code(beside(s, e)) for s, e in near)

                        new = self.replace(kind, text[start:end], code, undo, fits if near else None)
                        if new is not None:
                            taken.append((start, end, kind, new))
                            used[start:end] = b"\1" * (end - start)
                            at = end
                            break
                        if kind in OPEN_ENDED:
                            failed.setdefault(start, []).append(end)
                    seen = max(seen, longest)
        taken.sort()
        out, at, counts = [], 0, {}
        for start, end, kind, new in taken:
            out += [text[at:start], new]
            at = end
            counts[kind] = counts.get(kind, 0) + 1
        return "".join([*out, text[at:]]), counts, [(k, s, e) for s, e, k, _ in taken]


def pseudonymise(docs: DataFrame, key: bytes, kinds: tuple[str, ...] = KINDS, text_col: str = "text", details: bool = True) -> DataFrame:
    """The input's rows with the values in the text replaced, and n_private (how many) and kinds (sorted, comma-joined).

    A null text stays null; without values a text is left exactly as it is. Every row is handled by itself and
    nothing is shuffled; repeated rows give equal results, an empty table an empty one. With ``details`` false only
    the input's columns come out; with it, input columns of the two names are replaced.
    """
    given = docs.drop(*[c for c in docs.columns if details and c.lower() in ("n_private", "kinds")])

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pseudonyms = Pseudonyms(key, kinds)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            done = [pseudonyms.apply(t) for (texts,) in rows_of([batch], text_col) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array([d[0] for d in done], pa.string())
            names = batch.schema.names
            if details:
                columns += [pa.array([sum(d[1].values()) for d in done], pa.int64()), pa.array([",".join(sorted(d[1])) for d in done], pa.string())]
                names = [*names, "n_private", "kinds"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = StructType(list(given.schema.fields))
    if details:
        schema = schema.add("n_private", "long").add("kinds", "string")
    return map_batches(given, replace, schema)
