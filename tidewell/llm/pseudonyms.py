"""Format-preserving pseudonyms of personal data by a keyed Feistel network.

Found and validated: payment card numbers (Luhn), telephone numbers (+ and 8 to 15
digits, or a North American form), IPv4 addresses (octets up to 255), US social security numbers
(no reserved area, group or serial), account numbers (IBAN, modulo 97), e-mail addresses and calendar dates.
Each value is permuted, under a key, among the valid values of its own
format, so its spelling, length and separators stay, the result is valid again, and
equal values have equal pseudonyms in every document. Who has the key can reverse it.

A permutation of 0 .. n - 1 is a Feistel network over the smallest pair of halves that holds n,
walked along its cycle until it falls below n again.

Overlapping finds: the leftmost wins, then the kind listed first. Digits or capitals that follow a number after a
separator may not belong to it: an account number ends at its country's length if a separator stands there, and a card
that is not valid as a whole ends at the last separator that leaves a valid one, unless a valid card of more digits
begins within it. Where digits stand beside a card, its pseudonym is the next one of its cycle that is found at the
same place again, so that it can be reversed; in these few texts it differs from the card's usual pseudonym.

Defined results: a null text stays null, an empty one empty; a text without finds is
unchanged; equal texts have equal results.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewell.llm.arrays import per_slice

ROUNDS = 8
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY


def permute(value: int, n: int, key: bytes, tweak: str, backward: bool = False) -> int:
    """A keyed permutation of the numbers below n."""
    if n < 2:
        return value
    half = 1
    while half * half < n:
        half *= 2
    order = range(ROUNDS - 1, -1, -1) if backward else range(ROUNDS)
    while True:
        left, right = divmod(value, half)
        for i in order:
            if backward:
                left, right = (right - _round(key, tweak, n, i, left, half)) % half, left
            else:
                left, right = right, (left + _round(key, tweak, n, i, right, half)) % half
        value = left * half + right
        if value < n:
            return value


def _round(key: bytes, tweak: str, n: int, i: int, part: int, half: int) -> int:
    digest = hashlib.blake2b(f"{tweak}:{n}:{i}:{part}".encode(), key=key[:64], digest_size=32).digest()
    return int.from_bytes(digest) % half


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _refill(text: str, digits: str) -> str:
    """``text`` with its digits replaced in order."""
    fresh = iter(digits)
    return "".join(next(fresh) if c.isdigit() else c for c in text)


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


Step = Callable[[int, int, str], int]  # (value, n, tweak) -> value


def _card(text: str, step: Step) -> str | None:
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    n = len(digits) - 1
    payload = f"{step(int(digits[:-1]), 10**n, f'card{n}'):0{n}d}"
    return _refill(text, payload + luhn_digit(payload))


def _phone(text: str, step: Step) -> str | None:
    digits = _digits(text)
    if not 8 <= len(digits) <= 15:
        return None
    kept = 1 if text.startswith("+1") else 2 if text.startswith("+") else 0
    n = len(digits) - kept
    return _refill(text, digits[:kept] + f"{step(int(digits[kept:]), 10**n, 'phone' + digits[:kept]):0{n}d}")


def _address(text: str, step: Step) -> str | None:
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    value = step(int.from_bytes(bytes(map(int, parts))), 1 << 32, "ipv4")
    return ".".join(map(str, value.to_bytes(4)))


def _social(text: str, step: Step) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = [a for a in range(1, 900) if a != 666]
    value = step((areas.index(area) * 99 + group - 1) * 9999 + serial - 1, len(areas) * 99 * 9999, "ssn")
    rest, serial = divmod(value, 9999)
    area, group = divmod(rest, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _account(text: str, step: Step) -> str | None:
    plain = text.replace(" ", "")

    def rest(body: str) -> int:
        return int("".join(str(int(c, 36)) for c in body)) % 97

    if not 15 <= len(plain) <= 34 or rest(plain[4:] + plain[:4]) != 1:
        return None
    body = _within_classes(plain[4:], step, "iban" + plain[:2])
    fresh = iter(plain[:2] + f"{98 - rest(body + plain[:2] + '00'):02d}" + body)
    return "".join(c if c == " " else next(fresh) for c in text)


def _within_classes(text: str, step: Step, tweak: str) -> str:
    """Digits stay digits, letters letters of their case; the string is one number in mixed radix."""
    classes = []
    for c in text:
        size, first = (10, "0") if "0" <= c <= "9" else (26, "a") if "a" <= c <= "z" else (26, "A") if "A" <= c <= "Z" else (1, c)
        classes.append((size, ord(first)))
    value, n = 0, 1
    for c, (size, first) in zip(text, classes):
        value, n = value * size + ord(c) - first, n * size
    shape = "".join("." if s == 1 else chr(f) for s, f in classes)
    value = step(value, n, tweak + shape)
    out = []
    for size, first in reversed(classes):
        value, rest = divmod(value, size)
        out.append(chr(first + rest))
    return "".join(reversed(out))


def _mail(text: str, step: Step) -> str | None:
    local, domain = text.rsplit("@", 1)
    return _within_classes(local, step, "mail") + "@" + domain


def _date(order: str) -> Callable[[str, Step], str | None]:
    def change(text: str, step: Step) -> str | None:
        numbers = dict(zip(order, map(int, re.findall(r"\d+", text))))
        try:
            day = datetime.date(numbers["y"], numbers["m"], numbers["d"]).toordinal() - FIRST_DAY
        except ValueError:
            return None
        if not 0 <= day < DAYS:
            return None
        new = datetime.date.fromordinal(step(day, DAYS, "date") + FIRST_DAY)
        filled = iter({"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}[c] for c in order)
        return re.sub(r"\d+", lambda _: next(filled), text)

    return change


# Kinds in order of precedence: name, pattern, and how a valid value changes (None: not valid).
KINDS: list[tuple[str, str, Callable[[str, Step], str | None]]] = [
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _mail),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])", _account),
    ("ymd", r"(?<![\d.-])\d{4}(?:-\d{2}-|/\d{2}/|\.\d{2}\.)\d{2}(?![\d-])", _date("ymd")),
    ("dmy", r"(?<![\d.-])\d{2}\.\d{2}\.\d{4}(?![\d-])", _date("dmy")),
    ("mdy", r"(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])", _date("mdy")),
    ("ipv4", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", _address),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])", _social),
    ("card", r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)", _card),
    ("phone", r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
              r"|(?<![\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])", _phone),
]
# Characters of an account number by country.
ACCOUNT_LENGTHS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE IM GG JE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GF GP GQ GR IT KM MC MF MG MQ MR NC PF PM RE "
    "SM TD TF WF YT BL", 28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}.items() for country in countries.split()}
FINDER = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern, _ in KINDS), re.ASCII)
CHANGE = {name: change for name, _, change in KINDS}


def _steps(key: bytes, backward: bool) -> Step:
    @lru_cache(65_536)
    def step(value: int, n: int, tweak: str) -> int:
        return permute(value, n, key, tweak, backward)

    return step


def _ends(name: str, own: re.Match) -> list[int]:
    """Where a find may end, in the order in which the ends are tried."""
    text, start, end = own.string, own.start(), own.end()
    if name == "card":
        return [end, *(i for i in range(end - 1, start, -1) if text[i] in " -")]
    if name == "iban":
        size = ACCOUNT_LENGTHS.get(own[0][:2])
        stops = (i for i in range(start, end + 1) if i == end or text[i] == " ")
        return [*(i for i in stops if i - start - text.count(" ", start, i) == size), end]
    return [end]


def _outdone(text: str, start: int, end: int) -> bool:
    """Whether a valid card of more digits begins behind a separator in text[start:end] and ends beyond it."""
    size = len(_digits(text[start:end]))
    for gap in re.finditer("[ -]", text[start:end]):
        own = _CARD.match(text, start + gap.end())
        for to in _ends("card", own) if own else ():
            value = text[own.start() : to]
            if to > end and len(_digits(value)) > size and _card(value, lambda v, n, tweak: v) is not None:
                return True
    return False


def _next_find(text: str, at: int, step: Step) -> tuple[str, int, int, str] | None:
    """(kind, start, end, pseudonym) of the first valid find from ``at`` on."""
    while (m := FINDER.search(text, at)) is not None:
        # a find that is not valid under its kind may hide one of a later kind at the same place
        for name, pattern in _PATTERNS:
            if name != m.lastgroup and _ORDER[name] < _ORDER[m.lastgroup]:
                continue
            own = m if name == m.lastgroup else pattern.match(text, m.start())
            for end in _ends(name, own) if own else ():
                fresh = CHANGE[name](text[m.start() : end], step)
                if fresh is not None:
                    if name == "card" and end < own.end() and _outdone(text, m.start(), end):
                        break
                    return name, m.start(), end, fresh
        at = m.start() + 1
    return None


def _found_again(text: str, at: int, find: tuple[str, int, int, str], step: Step) -> str:
    """The first pseudonym along the card's cycle that is found where the card was, whatever digits stand beside it."""
    name, start, end, fresh = find
    if not (_DIGIT_BEFORE.search(text[max(start - 2, 0) : start]) or _DIGIT_AFTER.match(text, end)):
        return fresh
    while True:
        again = _next_find(text[max(at - 1, 0) : start] + fresh + text[end : end + 64], min(at, 1), step)
        if again and (again[0], again[1] + max(at - 1, 0), again[2] + max(at - 1, 0)) == (name, start, end):
            return fresh
        fresh = CHANGE[name](fresh, step)


def pseudonymise(text: str, step: Step) -> tuple[str, dict[str, int]]:
    """The text with every valid find replaced, and how many of each kind."""
    out, counts, done = [], {}, 0
    if not _MARK.search(text):
        return text, counts
    while (find := _next_find(text, done, step)) is not None:
        name, start, end, fresh = find
        if name == "card":
            fresh = _found_again(text, done, find, step)
        out += [text[done:start], fresh]
        counts[name] = counts.get(name, 0) + 1
        done = end
    return "".join([*out, text[done:]]), counts


_PATTERNS = [(name, re.compile(pattern, re.ASCII)) for name, pattern, _ in KINDS]
_CARD = dict(_PATTERNS)["card"]
_DIGIT_BEFORE, _DIGIT_AFTER = re.compile("[0-9][ -]$"), re.compile("[ -][0-9]")
_MARK = re.compile("[0-9@]")  # every kind holds one of these
_ORDER = {name: i for i, (name, _, _) in enumerate(KINDS)}


def mask(docs: DataFrame, key: bytes, text: str = "text", id_column: str = "doc_id", backward: bool = False) -> DataFrame:
    """(id, text, n_found, kinds) of every row; ``backward`` restores the values of an earlier call with the key.

    ``kinds`` lists each kind found with its count. Texts without a digit or an @ are only copied.
    """
    if not key:
        raise ValueError("an empty key hides nothing")

    def make():
        step = _steps(key, backward)

        def work(batch, texts):
            out, found, kinds = [], [], []
            for text in batch.column("text").to_pylist():
                fresh, counts = (text, {}) if text is None else pseudonymise(text, step)
                out.append(fresh)
                found.append(sum(counts.values()))
                kinds.append(",".join(f"{k}:{counts[k]}" for k in sorted(counts)))
            return pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(out, pa.string()), pa.array(found, pa.int64()), pa.array(kinds, pa.string())],
                ["id", "text", "n_found", "kinds"],
            )

        return work

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    return source.mapInArrow(per_slice(make, "text"), "id long, text string, n_found long, kinds string").withColumnRenamed(
        "id", id_column
    )
