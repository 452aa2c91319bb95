"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

Found are e-mail addresses, IBANs (check digits right), payment cards (Luhn right), IPv4 and IPv6 addresses, US social security
numbers, phone numbers (with country code, with a leading 0 and 9 to 12 digits in groups, or three, three and four digits), and
persons named after a title or an introduction, with every other capitalised whole-word mention of their names in the same text. The same entity gets the same surrogate everywhere
in the corpus under one key, also where its case or punctuation differ.

Numbers, addresses and the letters of e-mail addresses go through a keyed permutation (a step along a cycle that a Feistel network
lays through all strings over one alphabet, tweaked by type and pattern). A permutation cannot map two entities to one surrogate,
so they stay distinct without a table, and a step never ends where it began, so none stays as it was. Letters are exchanged among
those of their script, case and Unicode block. Decimal digits of any script are permuted by value and written in the script of the
digit whose place they take: cards keep issuer digit, length and Luhn, IBANs country and check digits, phones punctuation and
country code (told by its digits, whether or not a separator follows), IPv4 addresses stay public or in their private net, IPv6 addresses keep
their first group, e-mail addresses keep their pattern and move below `.example`.

Names are built from syllables: the ending follows the gender, the letters the script; hyphens and apostrophes stay. Names in
scripts without syllables here take other letters of their blocks. A name is one entity in the whole corpus,
whether given or family name; its gender is what most of its mentions as a given name after a title tell, "" if as many tell
the other. Two names can meet on one
surrogate, or on a name that really occurs. So all names of the corpus are collected as distinct rows, their surrogates are
grouped, and all but the first of a group, and those that really occur, move on to their next candidate, until none meet.
Names that had to move, and those to which some text alone gives another gender than the corpus does, are looked up: in a
broadcast table of at most `most_known` rows, beyond that in a list that is joined to each text that has such names.

Rules. Null text stays null, text without findings stays as it is. Findings that overlap: the kind named first above wins.
Rows that repeat get the same text; columns other than text are handed on untouched. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import ipaddress
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.common import arrow_map, steps, table, written

#: Fixed: letters of the alphabets whose letters are exchanged among themselves.
ALPHABETS = {
    "digit": "0123456789",
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "accent": "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿœß",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
    "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
}
_ALPHABET_OF = {c: name for name, letters in ALPHABETS.items() for c in letters}

#: Fixed: titles and introductions with the gender they tell ("" if none); names follow them.
TITLES = {
    "f": ["Mrs.", "Mrs", "Ms.", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra.", "Signora", "Госпожа", "Κυρία"],
    "m": ["Mr.", "Mr", "Herr", "Monsieur", "Señor", "Sr.", "Signor", "Господин", "Κύριος"],
    "": ["Dr.", "Prof.", "my name is", "My name is", "ich heiße", "Ich heiße", "je m'appelle", "Je m'appelle", "me llamo", "Me llamo"],
}
_GENDER_OF = {title: gender for gender, titles in TITLES.items() for title in titles}

#: Syllables: consonants, vowels, endings by gender; for each script.
SYLLABLES = {
    "latin": ("bdfgklmnprstvz", "aeiou", {"f": ["a", "ina", "ela"], "m": ["o", "an", "er"], "": ["en", "is", "y"]}),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", {"f": ["а", "ина", "ова"], "m": ["ов", "ин", "ан"], "": ["ко", "ик", "юк"]}),
    "greek": ("βγδζκλμνπρστ", "αειου", {"f": ["α", "η", "ου"], "m": ["ος", "ης", "ας"], "": ["ι", "ιδ", "ου"]}),
}

#: Fixed: characters of an IBAN by country.
IBAN_LENGTHS = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST",
        26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
        28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
        31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}

#: Fixed: country calling codes of one and two digits; all others have three.
CALLING_CODES = set(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)

KINDS = ["email", "iban", "card", "ip", "ssn", "phone", "person"]
_EMAIL = re.compile(r"[\w.+-]*[\w+-]@[\w-]+(?:\.[\w-]+)+")
_IBAN = re.compile(r"(?<![A-Za-z\d])[A-Z]{2}\d{2}(?: ?[A-Z\d]{4}){2,7}(?: ?[A-Z\d]{1,3})?(?![A-Za-z\d])")
_CARD_RUN = re.compile(r"(?<![\d.,-])\d(?:[ -]?\d){12,}")
_DIGITS = re.compile(r"\d+")
_IP = re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)")
_IP6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f:]{5,39}(?![\w:])")
_SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
_PHONE = re.compile(
    r"(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d(?:[ .-]?\d){4,12}|(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4})(?!\d)"
)
_TRUNK = re.compile(r"(?<![\d+.,/-])(?<!\d )(?:\(0[1-9]\d{0,3}\) ?|0[1-9]\d{0,3}[ /-])\d{2,8}(?:[ -]\d{2,5}){0,3}(?![ /-]?\d)")
_NAME = r"[^\W\d_a-z](?:['’][^\W\d_a-z])?[^\W\d_]+(?:-[^\W\d_]+)*"
_PERSON = re.compile(
    r"(?<!\w)(" + "|".join(re.escape(t) for t in sorted(_GENDER_OF, key=len, reverse=True)) + rf")[ \xa0]({_NAME})(?:[ \xa0]({_NAME}))?"
)
_WORD = re.compile(r"(?<!\w)[^\W\d_a-z][^\W\d_]+(?!\w)")
_PARTS = re.compile(r"[^\W\d_]+")


def small(c: str) -> str:
    """A character in lower case, if that is one character."""
    return c.lower() if len(c.lower()) == 1 else c


def folded(name: str) -> str:
    """What tells a name from others: small letters, one kind of apostrophe."""
    return "".join(map(small, name)).replace("’", "'")


@functools.lru_cache(64)
def _block(number: int) -> dict[str, str]:
    """Letter -> the letters of its kind, for the letters of a block of 256 characters that no list above has. A letter alone of
    its kind is exchanged with others of the block that are alone too."""
    kinds: dict[tuple, list[str]] = {}
    for c in map(chr, range(number << 8, (number + 1) << 8)):
        if c.isalnum() and not c.isdecimal() and c not in _ALPHABET_OF and small(c) == c:
            cased = c.upper() != c and len(c.upper()) == 1 and small(c.upper()) == c
            kinds.setdefault((unicodedata.name(c, "").split(" ")[0], unicodedata.category(c), cased), []).append(c)
    groups = [g for g in kinds.values() if len(g) > 1]
    alone = [c for g in kinds.values() if len(g) == 1 for c in g]
    if len(alone) == 1 and groups:
        groups[-1] = sorted(groups[-1] + alone)
    elif alone:
        groups.append(alone)
    return {c: "".join(g) for g in groups for c in g}


def alphabet_of(c: str) -> str:
    """The letters or digits that a character, in lower case and with digits as 0 to 9, is exchanged with; "" for the rest."""
    if c in _ALPHABET_OF:
        return ALPHABETS[_ALPHABET_OF[c]]
    return "" if c.isascii() else _block(ord(c) >> 8).get(c, "")


def values(text: str) -> str:
    """Decimal digits of any script as 0 to 9, the rest as it is."""
    return text if text.isascii() else "".join(str(unicodedata.decimal(c)) if c.isdecimal() else c for c in text)


def like(digit: str, place: str) -> str:
    """A digit 0 to 9 in the script of the digit at its place."""
    return digit if place.isascii() else chr(ord(place) - unicodedata.decimal(place) + int(digit))


def luhn(digits: str) -> int:
    """Sum over a number with its check digit; right if divisible by ten."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)


def iban_rest(iban: str) -> int:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def ibans(text: str):
    """(start, end) of IBANs: by the length of the country if a group ends there, else all of a match."""
    at = 0
    while m := _IBAN.search(text, at):
        at = m.start() + 1
        length = IBAN_LENGTHS.get(m[0][:2])
        ends = {}  # characters without blanks -> end, where no letter or digit follows
        n = 0
        for end in range(m.start() + 1, m.end() + 1):
            n += text[end - 1] != " "
            if end == m.end() or text[end] == " ":
                ends.setdefault(n, end)
        for k in (length, n):
            if k in ends and 15 <= k <= 34 and iban_rest(values(text[m.start() : ends[k]]).replace(" ", "")) == 1:
                yield m.start(), ends[k]
                at = ends[k]
                break


def cards(text: str):
    """(start, end) of cards in runs of digits with single blanks or hyphens: the longest of 13 to 19 digits that fits, in any
    groups, and if its check digit fails, shorter ones and later starts at the borders of groups of four digits or more."""
    for run in _CARD_RUN.finditer(text):
        groups = [(run.start() + m.start(), run.start() + m.end(), values(m[0])) for m in _DIGITS.finditer(run[0])]
        i = loose = 0  # from loose on, groups of any size may begin a card
        while i < len(groups):
            start, digits, ends, even = groups[i][0], "", [], True
            for j in range(i, len(groups)):
                _, end, more = groups[j]
                digits += more
                if len(digits) > 19:
                    break
                if len(digits) >= 13:
                    whole = not (text[end : end + 1] in (".", ",", "-") and text[end + 1 : end + 2].isdecimal())
                    inside = text[end : end + 1] == "-" and j + 1 < len(groups)
                    if whole or (inside and even):
                        ends.append((j, end, digits, whole, even))
                even &= len(more) >= 4
            first = next((e for e in reversed(ends) if e[3]), None)
            begins = i >= loose and (i == 0 or text[start - 1] == " ")
            tried = [first] if begins and first else []
            tried += [e for e in reversed(ends) if e[4] and e not in tried]
            good = next((e for e in tried if luhn(e[2]) % 10 == 0 and len(set(e[2])) > 1), None)
            if good:
                yield start, good[1]
                i = loose = good[0] + 1
                continue
            if begins and first:
                loose = first[0] + 1
            i += 1


class Permuter:
    """Keyed permutations of strings over one alphabet."""

    def __init__(self, key: bytes):
        self._key = key
        self.letters = functools.lru_cache(200_000)(self._letters)

    def number(self, *parts: object) -> int:
        text = "\x1f".join(map(str, parts)).encode()
        return int.from_bytes(hashlib.blake2b(text, key=self._key, digest_size=16).digest(), "big")

    def step(self, left: int, right: int, sizes: list[int], by: int, *tweak: object) -> tuple[int, int]:
        """The pair that lies by steps further on the cycle of all pairs below these sizes."""
        for i in range(8):
            left, right = right, (left + self.number("round", i, *tweak, right)) % sizes[i % 2]
        left, right = divmod((left * sizes[1] + right + by) % (sizes[0] * sizes[1]), sizes[1])
        for i in reversed(range(8)):
            left, right = (right - self.number("round", i, *tweak, left)) % sizes[i % 2], left
        return left, right

    def _letters(self, text: str, alphabet: str, tweak: str) -> str:
        """One to one among strings of this length, none to itself."""
        base, n = len(alphabet), len(text)
        if n == 1:
            order = sorted(alphabet, key=lambda c: self.number("one", tweak, alphabet, c))
            return order[(order.index(text) + 1) % base]
        value = [alphabet.index(c) for c in text]
        half = n // 2
        sizes = [base**half, base ** (n - half)]
        by = 1 + self.number("by", tweak, n, base) % (sizes[0] * sizes[1] - 1)
        left, right = self.step(self._value(value[:half], base), self._value(value[half:], base), sizes, by, tweak, n, base)
        out = []
        for v, k in ((left, half), (right, n - half)):
            digits = []
            for _ in range(k):
                v, d = divmod(v, base)
                digits.append(alphabet[d])
            out.extend(reversed(digits))
        return "".join(out)

    @staticmethod
    def _value(digits: list[int], base: int) -> int:
        total = 0
        for d in digits:
            total = total * base + d
        return total

    def pattern(self, text: str, tweak: str) -> str:
        """All letters and digits permuted within their alphabets; places, case and other characters stay."""
        low = "".join(map(small, values(text)))
        kinds = [alphabet_of(c) for c in low]
        shape = tweak + "|" + "".join(k[:1] or c for k, c in zip(kinds, low, strict=True))
        out = list(text)
        for alphabet in sorted(set(kinds) - {""}):
            at = [i for i, k in enumerate(kinds) if k == alphabet]
            new = self.letters("".join(low[i] for i in at), alphabet, shape)
            for i, c in zip(at, new, strict=True):
                if alphabet == ALPHABETS["digit"]:
                    out[i] = like(c, text[i])
                else:
                    out[i] = c.upper() if text[i] != low[i] and len(c.upper()) == 1 else c
        return "".join(out)


class Surrogates:
    """Finds entities in a text and writes their surrogates."""

    def __init__(self, key: str, known: dict[str, tuple[str, int]] | None = None, syllables: int = 4):
        """known: gender and attempt of the names that have another than their text tells, or an attempt above 0."""
        self.permuter = Permuter(hashlib.blake2b(key.encode(), digest_size=32).digest())
        self.known, self.syllables = known or {}, syllables

    # what is found: (start, end, kind, surrogate)

    def find(self, text: str) -> list[tuple[int, int, str, str]]:
        found = []
        if "@" in text:
            found += [(m.start(), m.end(), "email", self.email(m[0])) for m in _EMAIL.finditer(text)]
        if _HAS_DIGITS.search(text):
            found += [(start, end, "iban", self.iban(text[start:end])) for start, end in ibans(text)]
            found += [(start, end, "card", self.card(text[start:end])) for start, end in cards(text)]
            for m in _IP.finditer(text):
                if all(int(x) < 256 for x in m[0].split(".")):
                    found.append((m.start(), m.end(), "ip", self.ip(m[0])))
            found += [(m.start(), m.end(), "ssn", self.permuter.pattern(m[0], "ssn")) for m in _SSN.finditer(text)]
            found += [(m.start(), m.end(), "phone", self.phone(m[0])) for m in _PHONE.finditer(text)]
            for m in _TRUNK.finditer(text):
                if 9 <= sum(c.isdecimal() for c in m[0]) <= 12:
                    found.append((m.start(), m.end(), "phone", self.phone(m[0])))
        if text.count(":") > 1:
            found += [(m.start(), m.end(), "ip", self.ip6(m[0])) for m in _IP6.finditer(text) if _is_ip6(m[0])]
        spans, genders = mentions(text)
        found += [(start, end, "person", self.name("", genders[folded(name)], name)) for start, end, name in spans]
        found = [one for one in found if one[3] != text[one[0] : one[1]]]  # as "_@mail.example": nothing there to replace
        if len(found) < 2:
            return found
        spans: list[tuple[int, int]] = []
        out = []
        for one in sorted(found, key=lambda x: (KINDS.index(x[2]), x[0])):
            i = bisect.bisect_left(spans, one[:2])
            if (i and spans[i - 1][1] > one[0]) or (i < len(spans) and spans[i][0] < one[1]):
                continue
            spans.insert(i, one[:2])
            out.append(one)
        return sorted(out)

    def replace(self, text: str) -> tuple[str, list[str]]:
        found = self.find(text)
        parts, at = [], 0
        for start, end, _, new in found:
            parts += [text[at:start], new]
            at = end
        return "".join([*parts, text[at:]]), [kind for _, _, kind, _ in found]

    # one surrogate each

    def email(self, text: str) -> str:
        local, _, domain = text.rpartition("@")
        labels = domain.split(".")
        known = len(labels) >= 2 and labels[-2].lower() == "example"
        tail = labels[-2:] if known else labels[-1:]
        head = labels[: -len(tail)]
        new = self.permuter.pattern("@".join([local, ".".join(head)]), "email " + ".".join(tail).lower())
        end = ".".join(tail) if known else f"{tail[0]}.{'EXAMPLE' if tail[0].isupper() else 'example'}"
        return f"{new}.{end}" if head else f"{new}{end}"

    def _into(self, text: str, digits: str) -> str:
        """The digits put in the places of text's digits."""
        it = iter(digits)
        return "".join(like(next(it), c) if c.isdecimal() else c for c in text)

    def card(self, text: str) -> str:
        digits = re.sub(r"\D", "", values(text))
        middle = self.permuter.letters(digits[1:-1], ALPHABETS["digit"], f"card {digits[0]}")
        body = digits[0] + middle
        return self._into(text, body + str(-luhn(body + "0") % 10))

    def iban(self, text: str) -> str:
        plain = values(text).replace(" ", "")
        body = self.permuter.pattern(plain[4:], "iban " + plain[:2])
        check = 98 - iban_rest(plain[:2] + "00" + body)
        it = iter(f"{plain[:2]}{check:02d}{body}")
        new = "".join(c if c == " " else next(it) for c in text)
        return "".join(like(c, old) if old.isdecimal() else c for c, old in zip(new, text, strict=True))

    def phone(self, text: str) -> str:
        """Country code and trunk prefix 0 stay."""
        digits = re.sub(r"\D", "", values(text))
        if text.startswith("+"):
            code = next((digits[:n] for n in (1, 2) if digits[:n] in CALLING_CODES), digits[:3])
        else:
            code = "0" if digits[0] == "0" else ""
        kind = f"phone {'+' if text.startswith('+') else ''}{code}"
        return self._into(text, code + self.permuter.letters(digits[len(code) :], ALPHABETS["digit"], kind))

    def ip(self, text: str) -> str:
        """Addresses of private and reserved nets stay in their net; public ones stay public."""
        octets = [int(x) for x in text.split(".")]
        host = _host_bits(octets)
        number = int.from_bytes(bytes(octets), "big")
        net, rest = number >> host << host, number & ((1 << host) - 1)
        half = host // 2
        by = 1
        while True:  # the first later address of the net's cycle that is of the same kind
            left, right = self.permuter.step(rest >> half, rest & ((1 << half) - 1), [1 << half, 1 << half], by, "ip", net)
            value = list((net | left << half | right).to_bytes(4, "big"))
            if _host_bits(value) == host:
                return ".".join("".join(like(d, old[0]) for d in str(v)) for v, old in zip(value, text.split("."), strict=True))
            by += 1

    def ip6(self, text: str) -> str:
        """Written out in full if the text is, in capitals if it has any."""
        number = int(ipaddress.IPv6Address(text))
        first, rest = number >> 112, number & ((1 << 112) - 1)
        left, right = self.permuter.step(rest >> 56, rest & ((1 << 56) - 1), [1 << 56, 1 << 56], 1, "ip6", first)
        new = ipaddress.IPv6Address(first << 112 | left << 56 | right)
        out = new.exploded if all(len(group) == 4 for group in text.split(":")) else new.compressed
        return out.upper() if text != text.lower() else out

    def name(self, role: str, gender: str, name: str) -> str:
        """Given and family names alike; the gender is what the text tells, unless the corpus knows better."""
        low = folded(name)
        gender, attempt = self.known.get(low, (gender, 0))
        new = self.candidate(low, gender, attempt)
        if "’" in name:
            new = new.replace("'", "’")
        return new.upper() if name.isupper() else _PARTS.sub(lambda m: m[0].capitalize(), new)

    def candidate(self, low: str, gender: str, attempt: int) -> str:
        """The attempt-th name for this one, in small letters: part by part, with the hyphens and apostrophes between them."""
        return _PARTS.sub(lambda m: self._part(low, m, gender, attempt), low)

    def _part(self, low: str, part: re.Match, gender: str, attempt: int) -> str:
        tail = [part.start()] if part.start() else []  # the first part as a name of one part
        number = self.permuter.number("name", low, attempt, *tail)
        letters = [alphabet_of(c) for c in part[0]]
        if not any(a in ALPHABETS.values() for a in letters):
            out = []
            for alphabet, c in zip(letters, part[0], strict=True):
                number, i = divmod(number, max(len(alphabet), 1))
                number = number or self.permuter.number("more", low, attempt, *tail, len(out))
                out.append(alphabet[i] if alphabet else c)
            return "".join(out)
        script = next((s for s in ("cyrillic", "greek") if any(c in ALPHABETS[s] for c in part[0])), "latin")
        consonants, vowels, endings = SYLLABLES[script]
        if len(part[0]) == 1:
            return consonants[number % len(consonants)]
        out = []
        for _ in range(self.syllables):
            number, c = divmod(number, len(consonants))
            number, v = divmod(number, len(vowels))
            out.append(consonants[c] + vowels[v])
        return "".join(out) + consonants[number % len(consonants)] + endings[gender][number // 97 % len(endings[gender])]


_HAS_DIGITS = re.compile(r"\d[\d .()/-]{5}")


def _host_bits(octets: list[int]) -> int:
    """Bits of an address behind what tells its private or reserved net; 32 if it is public."""
    a, b = octets[:2]
    if (a, b) in ((192, 168), (169, 254)):
        return 16
    if a == 172 and 16 <= b < 32:
        return 20
    return 24 if a in (0, 10, 127) or a >= 224 else 32


def _is_ip6(text: str) -> bool:
    """An address of three groups or more with a digit that names a single host of some net."""
    if len([g for g in text.split(":") if g]) < 3 or not any(c.isdecimal() for c in text):
        return False
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return True


def persons(text: str):
    """(start, end, role, gender, name) of names after titles: a lone name is a surname, the first of two a given name."""
    for m in _PERSON.finditer(text):
        gender = _GENDER_OF[m[1]]
        if m[3]:
            yield m.start(2), m.end(2), "given", gender, m[2]
            yield m.start(3), m.end(3), "family", "", m[3]
        else:
            yield m.start(2), m.end(2), "family", "", m[2]


def _told(votes: int) -> str:
    return "f" if votes > 0 else "m" if votes < 0 else ""


def mentions(text: str) -> tuple[list[tuple[int, int, str]], dict[str, str]]:
    """(start, end, name) of all mentions of the names that follow a title somewhere in the text, and the gender that the
    text tells of each name in small letters."""
    titled = list(persons(text))
    if not titled:
        return [], {}
    votes: dict[str, int] = {}
    for _, _, _, gender, name in titled:
        low = folded(name)
        votes[low] = votes.get(low, 0) + {"f": 1, "m": -1, "": 0}[gender]
    spans = {start: (start, end, name) for start, end, _, _, name in titled}
    taken = sorted((start, end) for start, end, _ in spans.values())
    double = [name for name in votes if "-" in name or "'" in name]
    if double:
        pattern = "|".join(re.escape(name).replace("'", "['’]") for name in sorted(double, key=lambda n: (-len(n), n)))
        further = [m for m in re.finditer(rf"(?<!\w)(?:{pattern})(?!\w)", text, re.IGNORECASE) if not m[0][0].islower()]
    else:
        further = []
    for m in [*further, *_WORD.finditer(text)]:
        if folded(m[0]) not in votes:
            continue
        i = bisect.bisect_left(taken, m.span())
        if (i and taken[i - 1][1] > m.start()) or (i < len(taken) and taken[i][0] < m.end()):
            continue
        taken.insert(i, m.span())
        spans[m.start()] = (m.start(), m.end(), m[0])
    return sorted(spans.values()), {name: _told(v) for name, v in votes.items()}


def _names(batches):
    """name, what one text tells of its gender, net votes for "f", summed up over a step."""
    for batch in batches:
        for part in steps(batch):
            votes: dict[tuple[str, str], int] = {}
            for text in part.column("text").to_pylist():
                mine: dict[str, int] = {}
                for _, _, _, gender, name in persons(text or ""):
                    low = folded(name)
                    mine[low] = mine.get(low, 0) + {"f": 1, "m": -1, "": 0}[gender]
                for name, v in mine.items():
                    votes[name, _told(v)] = votes.get((name, _told(v)), 0) + v
            rows = sorted(votes)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([r[i] for r in rows], pa.string()) for i in range(2)], pa.array([votes[r] for r in rows], pa.int64())],
                ["name", "told", "votes"],
            )


def known_names(docs: DataFrame, key: str, syllables: int, most_rounds: int = 20) -> DataFrame:
    """name, gender, attempt of the names whose first candidate met another name's, or to which a text gives another gender."""
    told = arrow_map(docs.select("text"), _names, "name string, told string, votes long")
    names = told.groupBy("name").agg(F.sum("votes").alias("_votes"), F.min("told").alias("_least"), F.max("told").alias("_most"))
    gender = F.when(F.col("_votes") > 0, "f").when(F.col("_votes") < 0, "m").otherwise("")
    names = names.withColumn("gender", gender).withColumn("mixed", (F.col("_least") != F.col("gender")) | (F.col("_most") != F.col("gender")))
    real = written(names.select("name", "gender", "mixed"), "surrogate-names")

    def candidates(batches):
        maker = Surrogates(key, syllables=syllables)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("name", "gender", "attempt")), strict=True)
            new = [maker.candidate(*r) for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], [*batch.schema.names, "new"])

    schema = "name string, gender string, mixed boolean, attempt int, new string"
    now = real.withColumn("attempt", F.lit(0))
    for _ in range(most_rounds):
        made = arrow_map(now, candidates, schema)
        # whoever moved least stays; the names that meet on one candidate are few
        order = Window.partitionBy("new").orderBy("attempt", "name")
        taken = real.select(F.col("name").alias("new")).withColumn("_real", F.lit(True))
        judged = made.withColumn("_r", F.row_number().over(order)).join(taken, "new", "left")
        meets = (F.col("_r") > 1) | F.col("_real").isNotNull()
        now = written(judged.select("name", "gender", "mixed", (F.col("attempt") + meets.cast("int")).alias("attempt"), meets.alias("_m")), "surrogate-round")
        done = now.where("_m").limit(1).count() == 0
        now = now.drop("_m")
        if done:
            return now.where("attempt > 0 OR mixed").drop("mixed")
    raise RuntimeError("names still meet; use more syllables")


def _names_of_texts(batches):
    """h, name: the names in each text, once each."""
    for batch in batches:
        for part in steps(batch):
            rows = []
            for h, text in zip(part.column("h").to_pylist(), part.column("text").to_pylist(), strict=True):
                rows += [(h, name) for name in sorted({folded(n) for *_, n in persons(text or "")})]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], ["h", "name"])


def _with_known(docs: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """docs with one more column: the known names of each text, null if it has none."""
    h = F.sha2("text", 256)
    names = arrow_map(docs.select(h.alias("h"), "text"), _names_of_texts, "h string, name string").distinct()
    lists = names.join(known, "name").groupBy("h").agg(F.collect_list(F.struct("name", "gender", "attempt")).alias(column))
    lists = lists.withColumnRenamed("h", f"{column}_h")
    return docs.join(lists, h == F.col(f"{column}_h"), "left").drop(f"{column}_h")


def with_surrogates(docs: DataFrame, key: str, *, syllables: int = 4, most_known: int = 100_000) -> DataFrame:
    """docs with text replaced, and n_email ... n_person: how many of each kind were replaced; columns of docs called so are
    replaced, all others are handed on. Up to most_known names whose surrogate a text alone does not tell are broadcast; more
    are joined to the texts that have them, with the same result."""
    known = known_names(docs, key, syllables)
    names = docs.columns
    own = "_new"
    while any(name.lower().startswith(own) for name in names):
        own = f"_{own}"
    if few := known.limit(most_known + 1).count() <= most_known:
        sent = docs.sparkSession.sparkContext.broadcast({r.name: (r.gender, r.attempt) for r in known.collect()})
        rows = docs
    else:
        sent = None
        rows = _with_known(docs, known, f"{own}_known")
    at = names.index("text")

    def run(batches):
        maker = Surrogates(key, sent.value if few else None, syllables)
        for batch in batches:
            for part in steps(batch):
                texts = part.column("text").to_pylist()
                lists = [None] * len(texts) if few else part.column(f"{own}_known").to_pylist()
                done = []
                for text, mine in zip(texts, lists, strict=True):
                    if not few:
                        maker.known = {r["name"]: (r["gender"], r["attempt"]) for r in mine or []}
                    done.append((None, []) if text is None else maker.replace(text))
                columns = [part.column(i) for i in range(len(names))]
                columns[at] = pa.array([t for t, _ in done], pa.string())
                counts = [pa.array([kinds.count(k) for _, kinds in done], pa.int64()) for k in KINDS]
                yield pa.RecordBatch.from_arrays([*columns, *counts], [*names, *[f"{own}_n_{k}" for k in KINDS]])

    fields = [*docs.schema.fields, *[T.StructField(f"{own}_n_{k}", T.LongType()) for k in KINDS]]
    out = rows.mapInArrow(run, T.StructType(fields))
    clash = [f"n_{k}" for k in KINDS if f"n_{k}" in names]
    return out.drop(*clash).withColumnsRenamed({f"{own}_n_{k}": f"n_{k}" for k in KINDS})


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: doc_id, the new text and the counts. A real run takes its key from a secret store."""
    return with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), key="a key for tests")
