"""Personal data replaced by pseudonyms of the same format.

Numbers and dates are found by their shape, validated (check digits, ranges, the calendar) and moved by a keyed Feistel
permutation within all values of their format: a card number becomes a valid card number, a date a
date. Equal values become equal pseudonyms in every document, however they are punctuated, and no two values
of a format meet. What fails its validation is left as it is. A date with slashes is read with the day first, and with the month first only
where it has no other reading; days up to the 12th stay among themselves, so a pseudonym is read the same way.

A shape may take in a neighbour, such as a card's expiry. So a match is also tried at its shorter ends, and what
fails is searched again from its next group on.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Letters and digits that one permutation takes; longer values go through it in parts that depend on each other.
WIDTH = 64
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), 73049

# The shapes that are looked for, by kind, in the order in which they are tried.
SHAPES = {
    "email": r"(?<![\w.+-])[\w+-]+(?:\.[\w+-]+){0,8}@(?:[A-Za-z0-9-]+\.){1,8}[A-Za-z]{2,24}",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "secret": r"",  # see SECRET_NAMES
    "ipv4": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.]*\d)",
    "date": r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\d/-]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])",
}

# Names that a secret is assigned to, and what stands between: a quote that ends the name, a blank, the sign, a blank, a quote.
SECRET_NAMES = ("token", "key", "secret", "password", "passwd", "pwd")
SECRET_BETWEEN = (("", r"[\"']"), ("", " "), ("[=:]",), ("", " "), ("", r"[\"']"))
_before = "|".join(f"(?<={name}{''.join(parts)})" for name in SECRET_NAMES for parts in product(*SECRET_BETWEEN))
SHAPES["secret"] = rf"(?<=[\"'=: ])(?=[0-9A-Za-z]{{16}})(?i:{_before})[0-9A-Za-z]{{16,128}}(?![\w+/-])"

#: Lengths of IBANs by country, and of numbers after a calling code where all have one length.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_LENGTHS = {country: n for n, countries in IBAN_COUNTRIES.items() for country in countries.split()}
PHONE_LENGTHS = {"1": 10, "7": 10, "27": 9, "30": 10, "31": 9, "33": 9, "34": 9, "41": 9, "45": 8, "47": 8, "48": 9, "52": 10, "61": 9, "65": 8, "91": 10, "351": 9, "420": 9, "852": 8}
IBAN_HEAD = re.compile(r"\b[A-Z]{2}\d{2}")
#: How the digits of a printed card are grouped, and which first digits go with which lengths.
CARD_GROUPS = re.compile(r"\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1(?:\d|\d{4}(?:\1\d{1,3})?)|\d{4}([ -])\d{6}\2\d{4,5}")
CARD_ISSUERS = re.compile(
    r"4(?:\d{12}|\d{15}|\d{18})|(?:5[1-5]\d\d|222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720)\d{12}|3[47]\d{13}|3(?:0[0-5]|[689]\d)\d{11}|"
    r"(?:6011|64[4-9]\d|65\d\d|62\d\d|35[2-8]\d|220[0-4])\d{12,15}"
)
GROUP = re.compile(r"\d+")
CHAIN = re.compile(r"\d+(?:[ -]\d+)*")
#: The most characters of a card, with separators.
CARD_WIDTH = 37


class Feistel:
    """A keyed permutation of 0 .. size - 1: rounds over the two halves of a square number, walked until within the size."""

    def __init__(self, key: bytes):
        self.key = key

    def move(self, value: int, size: int, tweak: str, allowed: Callable[[int], bool] = lambda _: True) -> int:
        """Where the value goes; `allowed` (true for the value itself) narrows the format, and the walk goes on until it holds."""
        side = 1
        while side * side < size:
            side *= 2
        while True:
            left, right = divmod(value, side)
            for r in range(ROUNDS):
                text = f"{tweak}|{size}|{r}|{right}".encode()
                noise = int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=64).digest(), "big")
                left, right = right, (left + noise) % side
            value = left * side + right
            if value < size and allowed(value):
                return value


def _luhn(digits: str) -> int:
    """The check digit of the digits before it."""
    twice = [int(d) * 2 for d in digits[::-2]]
    return -(sum(d - 9 * (d > 9) for d in twice) + sum(map(int, digits[-2::-2]))) % 10


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _refill(shape: str, characters: str, kept: str = r"[0-9]") -> str:
    """The shape with its characters of a kind replaced in order."""
    left = iter(characters)
    return re.sub(kept, lambda _: next(left), shape)


def _mixed(f: Feistel, text: str, tweak: str) -> str:
    """Every digit becomes a digit and every letter a-z a letter of its case; other characters stay.

    A value of more than WIDTH letters and digits is moved a part at a time, first from the front, each part under a tweak of all
    parts before it, then from the back, each under one of the moved parts behind it: any change of the value changes every part.
    """
    classes = [("0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if c.islower() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ", i) for i, c in enumerate(text) if c.isascii() and c.isalnum()]
    # The format, not only its size, tells one permutation from another.
    shape = "".join("9" if c.isascii() and c.isdigit() else "a" if c.isascii() and c.isalpha() else c for c in text)
    if len(classes) > WIDTH:
        tweak, shape = f"{tweak}wide|", hashlib.blake2b(shape.encode("utf-8", "surrogatepass")).hexdigest()
    parts = []
    for low in range(0, len(classes), WIDTH):
        value, size = 0, 1
        for letters, i in classes[low : low + WIDTH]:
            value, size = value * len(letters) + letters.index(text[i]), size * len(letters)
        parts.append((value, size))
    if len(parts) < 2:
        moved = [f.move(value, size, f"{tweak}{shape}") for value, size in parts]
    else:
        moved = _chained(f, [value for value, _ in parts], [size for _, size in parts], f"{tweak}{shape}front")
        moved = _chained(f, moved[::-1], [size for _, size in parts[::-1]], f"{tweak}{shape}back")[::-1]
    out = list(text)
    for n, value in enumerate(moved):
        for letters, i in reversed(classes[n * WIDTH : (n + 1) * WIDTH]):
            value, rest = divmod(value, len(letters))
            out[i] = letters[rest]
    return "".join(out)


def _chained(f: Feistel, values: list[int], sizes: list[int], tweak: str) -> list[int]:
    """Each value moved under a tweak of those before it; from the moved values the first, and so all, can be found again."""
    before, out = hashlib.blake2b(tweak.encode("utf-8", "surrogatepass"), digest_size=32), []
    for value, size in zip(values, sizes, strict=True):
        out.append(f.move(value, size, before.hexdigest()))
        before.update(f"{value}|".encode())
    return out


def _email(f: Feistel, text: str) -> str | None:
    local, _, domain = text.rpartition("@")
    return f"{_mixed(f, local, f'email@{domain.lower()}|')}@{domain}"


def _secret(f: Feistel, text: str) -> str | None:
    if not re.fullmatch("[0-9a-f]+|[0-9A-F]+", text):
        # Letters alone may be a word.
        return _mixed(f, text, "secret|") if re.search(r"\d", text) else None
    value = f.move(int(text, 16), 16 ** len(text), f"secret{len(text)}")
    out = f"{value:0{len(text)}x}"
    return out.upper() if text.isupper() else out


def _ipv4(f: Feistel, text: str) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255 or any(str(n) != p for n, p in zip(parts, text.split("."), strict=True)):
        return None
    return ".".join(str(b) for b in f.move(int.from_bytes(bytes(parts), "big"), 2**32, "ipv4").to_bytes(4, "big"))


def _date(f: Feistel, text: str) -> str | None:
    forms = ["%Y-%m-%d"] if text[4] == "-" else ["%d.%m.%Y"] if "." in text else ["%d/%m/%Y", "%m/%d/%Y"]
    for form in forms:
        try:
            day = datetime.datetime.strptime(text, form).date().toordinal() - FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < DAYS:
            return None
        shown = lambda d: datetime.date.fromordinal(FIRST_DAY + d)
        # All forms share one permutation, so one with the month first must stay one that can't be read with the day first.
        late = shown(day).day > 12
        return shown(f.move(day, DAYS, "date", lambda d: (shown(d).day > 12) == late)).strftime(form)
    return None


def _ssn(f: Feistel, text: str) -> str | None:
    valid = lambda v: not (v // 10**6 in (0, 666) or v >= 900 * 10**6 or v // 10**4 % 100 == 0 or v % 10**4 == 0)
    value = int(_digits(text))
    return _refill(text, f"{f.move(value, 10**9, 'ssn', valid):09d}") if valid(value) else None


def _calling_code(digits: str) -> str:
    """The calling code under which the digits have the length of its numbers, or nothing."""
    return next((digits[:n] for n in (1, 2, 3) if PHONE_LENGTHS.get(digits[:n]) == len(digits) - n), "")


def _phone(f: Feistel, text: str) -> str | None:
    digits = _digits(text)
    if not 9 <= len(digits) <= 15:
        return None
    country = re.match(r"\+(\d{1,3})[ .(-]", text)
    head = country[1] if country else _calling_code(digits) if text[0] == "+" else ""
    rest = digits[len(head) :]
    return _refill(text, head + f"{f.move(int(rest), 10 ** len(rest), f'phone{head or 1}:{len(rest)}'):0{len(rest)}d}")


def _card(f: Feistel, text: str) -> str | None:
    digits = _digits(text)
    if not _valid_card(digits):
        return None
    body = f"{f.move(int(digits[:-1]), 10 ** (len(digits) - 1), 'card'):0{len(digits) - 1}d}"
    return _refill(text, body + str(_luhn(body)))


def _iban_remainder(plain: str) -> int:
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def _iban_checked(plain: str) -> bool:
    """Check digits are 02 to 98; 00, 01 and 99 pass modulo 97 beside 97, 98 and 02, but are no IBAN's."""
    return _iban_remainder(plain) == 1 and 2 <= int(plain[2:4]) <= 98


def _iban(f: Feistel, text: str) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or not _iban_checked(plain):
        return None
    moved = plain[:2] + "00" + _mixed(f, plain[4:], f"iban{plain[:2]}")
    return _refill(text, moved[:2] + f"{98 - _iban_remainder(moved):02d}" + moved[4:], "[A-Z0-9]")


MOVES: dict[str, Callable[[Feistel, str], str | None]] = {
    "email": _email, "iban": _iban, "secret": _secret, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card,
}
SPAN = "struct<kind:string,begin:long,end:long,pseudonym:string>"


def _iban_end(text: str, begin: int, limit: int) -> int | None:
    """Where the valid IBAN of its country's length ends that begins here, if one does before the limit."""
    size = IBAN_LENGTHS.get(text[begin : begin + 2])
    m = size and re.compile(rf"[A-Z0-9](?: ?[A-Z0-9]){{{size - 1}}}\b").match(text, begin, min(limit, len(text)))
    if not m or m.end() < len(text) and (text[m.end()].isalnum() or text[m.end()] == "_"):
        return None
    return m.end() if _iban_checked(m.group().replace(" ", "")) else None


def _ends(kind: str, text: str, begin: int, end: int) -> list[int]:
    """Where a match may end, in the order in which that is tried."""
    if kind not in ("iban", "phone"):
        return [end]
    edges = [e for e in range(end, begin, -1) if e == end or text[e - 1].isalnum() != text[e].isalnum() and text[e - 1] not in " .-("]
    if kind == "iban":
        # The match as a whole comes last, and gives way to an IBAN of its country's length that begins within.
        within = any(_iban_end(text, m.start(), end + 40) for m in IBAN_HEAD.finditer(text, begin + 1, end))
        own = [e for e in [_iban_end(text, begin, end)] if e]
        return own if within else [*own, end]
    country = re.match(r"\+(\d{1,3})[ .(-]", text[begin:end])
    # Without a separator the code is the one that gives a whole number at a group's end; the greedy match comes last.
    own = [e for e in edges if (PHONE_LENGTHS.get(country[1]) == len(_digits(text[begin:e])) - len(country[1]) if country else text[begin] == "+" and _calling_code(_digits(text[begin:e])))]
    return [*own, end]


def _valid_card(digits: str) -> bool:
    return _luhn(digits[:-1]) == int(digits[-1]) and len(set(digits)) > 1


def _card_end(text: str, begin: int, end: int, greedy: bool) -> tuple[int | None, tuple[int, int] | None]:
    """Where the card that begins here ends, if one does, and the first card of the match that begins after a hyphen.

    Of the valid numbers between group boundaries, printed as cards are and of a known issuer come first, then those printed as cards are,
    16 digits and fewer before more; then the match as a whole, if `greedy`. A number gives way to a better one that overlaps it.
    """
    chain = CHAIN.match(text, begin, end + CARD_WIDTH)
    groups = [m.span() for m in GROUP.finditer(text, begin, chain.end())]
    found = []
    for i, (low, first) in enumerate(groups):
        if low >= end:
            break
        # Printed cards begin with four digits or have no groups, and have five groups at most.
        ends = {high for _, high in groups[i : i + 5]} if first - low == 4 or first - low >= 13 else set()
        for high in ends | ({end} if low == begin and greedy else set()):
            regular = CARD_GROUPS.fullmatch(text, low, high)
            if not regular and (low, high) != (begin, end) or text[high : high + 1].isalnum() or text[high : high + 1] == "_":
                continue
            digits = _digits(text[low:high])
            if _valid_card(digits) and (regular or greedy):
                known = CARD_ISSUERS.fullmatch(digits)
                found.append(((not (regular and known), not regular, len(digits) > 16, -len(digits)), low, high))
    best = min((c for c in found if c[1] == begin), default=None)
    if best and any(c[0][:2] < best[0][:2] and begin < c[1] < best[2] for c in found):
        best = None
    after = min(((low, high) for rank, low, high in found if low > begin and text[low - 1] == "-" and not rank[0]), default=None)
    return (best[2] if best else None), (None if best else after)


class Pseudonymizer:
    """The shapes as one pattern, and the moves under a key."""

    def __init__(self, key: bytes):
        self.feistel = Feistel(key)
        self.pattern = re.compile("|".join(f"(?P<{kind}>{shape})" for kind, shape in SHAPES.items()))
        self.shapes = {kind: re.compile(shape) for kind, shape in SHAPES.items()}
        # Everything that is moved has a digit, an at-sign or a long hexadecimal number; most texts have none of these.
        self.worth = re.compile(r"\d|@|[a-fA-F]{16}")

    def spans(self, text: str) -> list[tuple[str, int, int, str]]:
        """(kind, begin, end, pseudonym) of what is replaced, in order."""
        out, at, failed, later = [], 0, 0, None
        if not self.worth.search(text):
            return out
        while True:
            m = self.pattern.search(text, at)
            if later and later[0] >= at and (m is None or m.start() >= later[0]):
                # A card after a hyphen, where the shape does not begin.
                begin, end = later
                out.append(("card", begin, end, _card(self.feistel, text[begin:end])))
                at, later = end, None
                continue
            if m is None:
                return out
            # What is not valid under its shape may be under a later one.
            for kind in list(SHAPES)[list(SHAPES).index(m.lastgroup) :]:
                other = m if kind == m.lastgroup else self.shapes[kind].match(text, m.start())
                if not other:
                    continue
                if kind == "card":
                    end, later = _card_end(text, m.start(), other.end(), m.start() >= failed)
                    ends = [end] if end else []
                else:
                    ends = _ends(kind, text, m.start(), other.end())
                moved = next(((e, p) for e in ends if (p := MOVES[kind](self.feistel, text[m.start() : e]))), None)
                if moved:
                    out.append((kind, m.start(), *moved))
                    at = moved[0]
                    break
                failed = max(failed, other.end())
            else:
                at = m.start() + 1


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_replaced, spans) of every row: the text with pseudonyms, and where they stand for what in the original text.

    The key is the secret that ties the pseudonyms together; whoever has it can link, so it is no column. NULL texts stay NULL with
    no spans. Columns other than doc_id and text are not read.
    """
    if not 16 <= len(key.encode()) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Pseudonymizer(key.encode())
        kind = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("pseudonym", pa.string())])
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts, counts, spans = [], [], []
                for text in part.column(1).to_pylist():
                    found = worker.spans(text or "")
                    out, at = [], 0
                    for _, begin, end, moved in found:
                        out += [text[at:begin], moved]
                        at = end
                    texts.append(text if not found else "".join([*out, text[at:]]))
                    counts.append(len(found))
                    spans.append([{"kind": k, "begin": b, "end": e, "pseudonym": p} for k, b, e, p in found])
                columns = [part.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(kind))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_replaced", "spans"])

    asked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return asked.mapInArrow(replaced, f"doc_id long, text string, n_replaced long, spans array<{SPAN}>")
