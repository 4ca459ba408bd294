"""Personal data in texts: detection, canonical forms and keyed surrogates
(no Spark here; see ``pii.py``)."""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator

# Titles that precede a name, and the gender they give ("" for neither).
# Fixed values.
TITLES = {
    "Mr.": "m", "Mr": "m", "Mrs.": "f", "Mrs": "f", "Ms.": "f", "Ms": "f", "Miss": "f", "Dr.": "", "Prof.": "",
    "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Señor": "m", "Señora": "f",
    "господин": "m", "Господин": "m", "госпожа": "f", "Госпожа": "f",
}
# Given names by script and gender, and syllables of family names by script.
# Fixed values.
GIVEN = {
    ("latin", "m"): "Adam Bruno Carl David Edgar Felix Georg Hugo Ivan Jonas Karim Leon Marco Nils Oscar Paul".split(),
    ("latin", "f"): "Alma Berta Clara Diana Elena Flora Greta Hanna Irene Julia Karla Laura Maria Nora Olga Paula".split(),
    ("latin", ""): "Alex Chris Dana Eden Frankie Gale Jamie Kim Lee Morgan Noel Robin Sam Sasha Toni Val".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Захар Иван".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина".split(),
    ("cyrillic", ""): "Саша Женя Валя Слава Шура Паша Вася Миша".split(),
}
SYLLABLES = {
    "latin": "ba de fi go lu ma ne pi ro su ta ve wi ka lo mi".split(),
    "cyrillic": "ба ве ги до лу ма не по ри су та фе".split(),
}
#: Endings of made-up given names.
ENDINGS = {("latin", "m"): "n", ("latin", "f"): "na", ("latin", ""): "s",
           ("cyrillic", "m"): "н", ("cyrillic", "f"): "на", ("cyrillic", ""): "ша"}

_NAME = "|".join(re.escape(t) for t in sorted(TITLES, key=len, reverse=True))
_FINDERS = [
    ("email", re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+"), "@"),
    ("secret", re.compile(
        r"(?i:\b(?:token|api[_-]?key|secret|password|passwd)\s*[=:]\s*[\"']?)(?P<e>(?=[+/_-]*[A-Za-z0-9])[A-Za-z0-9+/_-]{8,})"
        # a bare digest is one of many things; behind a keyword of its line it is a secret
        r"|(?i:\b(?:api[_-]?key|key|token|secret|password|passwd|credential|auth)s?)\b[^\w\n]{1,3}(?:[a-z]{1,8}[^\w\n]{1,3}){0,2}"
        r"(?P<h>[0-9a-fA-F]{32,128})\b"
        r"|\b(?P<k>AKIA[A-Z0-9]{16})\b"), None),
    ("ip", re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)"), "."),
    ("phone", re.compile(
        r"(?<![\w+])(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}"
        r"|\+(?!1[ .(-])\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
        r"|\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)"), None),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"), "-"),
    ("card", re.compile(r"(?<![\w.])(?:\d{4}([ -]?)\d{4}\1\d{4}\1\d{1,7}|\d{13,19})(?!\w)"), None),
    ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"), None),
    ("ipv6", re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:.])"), ":"),
]
#: What says that a four-part number is a version.
_VERSION = re.compile(r"(?i)(?:\bv|\b(?:ver|version|release|build|rev)\.?\s*)$")
_TITLE = re.compile(rf"(?<!\w)({_NAME})(?=\s)")
_TITLE_WORDS = {t.rstrip(".") for t in TITLES}
_WORD = re.compile(r"(?<![^\W_])[^\W\d_][\w'’-]*")
_NEXT = re.compile(r"\s+(?:(?P<initial>[^\W\d_])\.(?=\s+[^\W\d_])|(?P<word>[^\W\d_][\w'’-]*))")
_TAIL = re.compile(r"['’]s$|[_'’-]+$")
#: Words of a name after its titles, initials apart.
NAME_WORDS = 3
_DIGIT = re.compile(r"\d")
#: Attempts after which a surrogate varies in more places and grows with each
#: further attempt, so that a crowded format always leaves room in the end.
CROWDED = 8
#: Attempts for which a given name is drawn from ``GIVEN``; later ones are made up.
LISTED = 2
#: Attempts after which an address, which cannot grow, becomes one of IPv6.
EXHAUSTED = 64


#: A mention: kind, start, end, and the entities in it with their places.
Mention = tuple[str, int, int, list[tuple[str, int, int]]]


def _trimmed(text: str, start: int, end: int) -> int:
    """The end of a word without a possessive ending or trailing signs."""
    tail = _TAIL.search(text[start:end])
    return start + tail.start() if tail else end


def _titled(text: str) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Gender and places of the words of every name behind one or more titles:
    the capitalised words that are no titles."""
    gender, ended = "", 0
    for m in _TITLE.finditer(text):
        chained = ended and not text[ended : m.start()].strip()
        gender, ended = (gender if chained else "") or TITLES[m.group(1)], m.end()
        words, initials, at = [], [], m.end()
        while len(words) < NAME_WORDS and (w := _NEXT.match(text, at)):
            start, at = w.span("word" if w["word"] else "initial")
            if not text[start].isupper() or text[start:at] in _TITLE_WORDS:
                break
            if w["initial"]:
                initials.append((start, at))
                at = w.end()
                continue
            end = _trimmed(text, start, at)
            words.append((start, end))
            if end < at:
                break
        if words or initials:
            yield gender, words or initials[:1]


def _names(text: str, taken: list[tuple[int, int]]) -> list[Mention]:
    """Names behind titles, and all further mentions of their words outside
    the taken spans.  The last word is the family name and the others are
    given names, wherever in the text a longer name tells so."""
    if not any(t in text for t in TITLES):
        return []
    titled = list(_titled(text))
    if not titled:
        return []
    family: dict[str, str] = {}  # each with the gender that a title of this text gives
    given: dict[str, str] = {}
    by_length = sorted(titled, key=lambda n: len(n[1]) == 1)
    for gender, places in by_length:
        words = [canonical("name", text[a:b]) for a, b in places]
        for w in words[:-1]:
            given[w] = given.get(w) or gender
        alone = len(words) == 1 and words[0] in given and words[0] not in family
        of = given if alone else family
        of[words[-1]] = of.get(words[-1]) or gender

    def mention(places: list[tuple[int, int]], gender: str | None) -> Mention:
        words = [canonical("name", text[a:b]) for a, b in places]
        parts = []
        for k, (w, (a, b)) in enumerate(zip(words, places)):
            if (w in family) if k == len(words) - 1 else (w not in given):
                parts.append(("family", a, b))
            else:
                parts.append((f"given{gender or given[w]}", a, b))
        if gender is None:
            gender = next((g for w in words for g in (given.get(w), family.get(w)) if g), "")
        return f"name{gender}", places[0][0], places[-1][1], parts

    out = [mention(places, gender) for gender, places in titled]
    held = sorted([*taken, *((a, b) for _, a, b, _ in out)])
    k, run = 0, []
    for m in _WORD.finditer(text):
        a, b = m.start(), _trimmed(text, *m.span())
        while k < len(held) and held[k][1] <= a:
            k += 1
        known = text[a].isupper() and b - a > 1 and not (k < len(held) and held[k][0] < b)
        w = canonical("name", text[a:b]) if known else ""
        known = w in family or w in given
        # a given name and the known word right behind it are one mention
        if run and not (known and text[run[-1][1] : a].isspace() and canonical("name", text[slice(*run[-1])]) in given):
            out.append(mention(run, None))
            run = []
        if known:
            run.append((a, b))
    if run:
        out.append(mention(run, None))
    return out


def _plausible(kind: str, text: str, start: int, end: int) -> bool:
    """Whether what a pattern found is what it looks like: check digits of
    cards and IBANs, addresses that are no versions, whole IPv6 addresses."""
    shown = text[start:end]
    if kind == "card":
        return _luhn("".join(c for c in shown if c.isdigit())) == 0
    if kind == "iban":
        return _iban_rest(canonical(kind, shown)) == 1
    if kind == "ip":
        alone = all(len(part) == 1 for part in shown.split("."))
        return not alone and _VERSION.search(text, max(0, start - 12), start) is None
    if kind == "ipv6":
        try:
            return ipaddress.IPv6Address(shown).packed != bytes(16)
        except ValueError:
            return False
    return True


def mentions(text: str | None) -> list[Mention]:
    """Mentions in text order, none overlapping: where two patterns meet, the
    earlier start wins, then the longer one.  A name's entities are its given
    names and its family name; any other mention is one entity."""
    if not text:
        return []
    found: list[Mention] = []
    if "@" in text or _DIGIT.search(text) or '"' in text or "=" in text or ":" in text:
        digits = _DIGIT.search(text) is not None
        for kind, pattern, needs in _FINDERS:
            if (needs and needs not in text) or (not digits and kind not in ("email", "secret")):
                continue
            for m in pattern.finditer(text):
                group = next((g for g in ("e", "h", "k") if kind == "secret" and m.group(g)), 0)
                a, b = m.span(group)
                if _plausible(kind, text, a, b):
                    found.append((kind, a, b, [(kind, a, b)]))
    found += _names(text, [(a, b) for _, a, b, _ in found])
    out, end = [], 0
    for m in sorted(found, key=lambda m: (m[1], -m[2], m[0])):
        if m[1] >= end:
            out.append(m)
            end = m[2]
    return out


def find(text: str | None) -> list[tuple[str, int, int]]:
    """Kind, start and end of the mentions."""
    return [m[:3] for m in mentions(text)]


def entities(text: str | None) -> list[tuple[str, str]]:
    """The distinct entities ``(kind, canonical form)`` of a text."""
    return sorted({(k, canonical(k, text[a:b])) for *_, parts in mentions(text) for k, a, b in parts})


def canonical(kind: str, mention: str) -> str:
    """The entity of a mention: all spellings of one entity share it."""
    mention = unicodedata.normalize("NFC", mention)
    if kind in ("phone", "card", "ssn"):
        digits = "".join(c for c in mention if c.isdigit())
        # a number of ten digits is the same with and without the country code 1
        return digits[1:] if kind == "phone" and len(digits) == 11 and digits[0] == "1" else digits
    if kind == "iban":
        return "".join(mention.casefold().split())
    if kind == "ipv6":
        return ipaddress.IPv6Address(mention).exploded
    return " ".join(mention.casefold().split())


class _Stream:
    """Keyed pseudo-random numbers, always the same for the same entity."""

    def __init__(self, key: bytes, *parts: str):
        self.seed = hmac.new(key, "\x1f".join(parts).encode("utf-8", "surrogatepass"), hashlib.sha256).digest()
        self.block, self.left = 0, b""

    def below(self, n: int) -> int:
        if len(self.left) < 4:
            self.left += hashlib.sha256(self.seed + self.block.to_bytes(8, "big")).digest()
            self.block += 1
        value, self.left = int.from_bytes(self.left[:4], "big"), self.left[4:]
        return value % n


def _script(text: str) -> str:
    return "cyrillic" if any("\u0400" <= c <= "\u04ff" for c in text) else "latin"


def _luhn(digits: str) -> int:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _iban_rest(iban: str) -> int:
    """The remainder that is 1 where an IBAN's check digits are right."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _letters(text: str, s: _Stream, hexa: bool = False) -> str:
    """Letters and digits replaced in place by others of their kind."""
    out = []
    for c in text:
        if hexa and c in "0123456789abcdefABCDEF":
            out.append("0123456789abcdef"[s.below(16)])
        elif c.isdigit():
            out.append("0123456789"[s.below(10)])
        elif "\u0400" <= c <= "\u04ff":
            out.append("абвгдежзиклмнопрст"[s.below(18)])
        elif c.isalpha():
            out.append("abcdefghijklmnopqrstuvwxyz"[s.below(26)])
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, entity: str, attempt: int, key: bytes) -> str:
    """The entity's canonical replacement at this attempt, of its kind, script,
    gender and format."""
    s = _Stream(key, kind, entity, str(attempt))
    crowded = attempt > CROWDED
    grown = max(0, attempt - CROWDED)
    if kind == "email":
        local, _, domain = entity.partition("@")
        # a domain's replacement does not depend on the mailbox
        d = _Stream(key, "domain", domain)
        reserved = re.search(r"(?:^|\.)(example\.(?:com|org|net))$", domain)
        host = "".join("bcdfghjklmnpqrstvwxz"[d.below(20)] for _ in range(8))
        domain = f"{host}.{reserved.group(1)}" if reserved else f"{host}.example"
        return f"{_letters(local, s)}{s.below(10**6) if crowded else ''}{_letters('0' * (grown - 1), s)}@{domain}"
    if kind == "secret":
        prefix = "akia" if re.fullmatch("akia[a-z0-9]{16}", entity) else ""
        body = entity[len(prefix) :] + "0" * grown
        return prefix + _letters(body, s, hexa=re.fullmatch("[0-9a-f]+", entity) is not None)
    if kind == "iban":
        body = _letters(entity[4:] + "0" * grown, s)
        return f"{entity[:2]}{98 - _iban_rest(f'{entity[:2]}00{body}'):02d}{body}"
    if kind == "ipv6":
        return "2001:db8:" + ":".join(f"{s.below(1 << 16):x}" for _ in range(6))
    if kind == "ip":
        if attempt > EXHAUSTED:
            return "2001:db8:" + ":".join(f"{s.below(1 << 16):x}" for _ in range(6))
        first = 10 if not crowded else 11 + s.below(200)
        return ".".join([str(first), *(str(s.below(256)) for _ in range(3))])
    if kind == "card":
        body = "".join(str(s.below(10)) for _ in range(len(entity) + grown))
        if _luhn(entity) == 0:  # a valid number stays valid
            body = next(body[:-1] + str(c) for c in range(10) if _luhn(body[:-1] + str(c)) == 0)
        elif _luhn(body) == 0:
            body = body[:-1] + str((int(body[-1]) + 1) % 10)
        return body
    if kind == "phone":
        # the country code and, while there is room, a fictitious 555 exchange stay
        keep = max(0, len(entity) - 10)
        digits = entity[:keep] + "".join(str(s.below(10)) for _ in entity[keep:])
        at = len(entity) - 7
        if not crowded and at >= 0 and entity[at : at + 3] == "555":
            digits = digits[:at] + "555" + digits[at + 3 :]
        return digits + _letters("0" * grown, s)
    if kind == "ssn":
        return "".join(str(s.below(10)) for _ in range(len(entity) + grown))
    script = _script(entity)
    syllables = SYLLABLES[script]
    if kind == "family":
        # its form follows the name's, whatever title stands before it
        end = "n" if script == "latin" else "ова" if entity[-1] in "ая" else "ов" if entity[-1] in "внй" else "енко"
        return "".join(syllables[s.below(len(syllables))] for _ in range(3 + attempt)) + end
    gender = kind.removeprefix("given")
    if attempt < LISTED:
        given = GIVEN[script, gender]
        return given[s.below(len(given))].lower()
    return "".join(syllables[s.below(len(syllables))] for _ in range(1 + attempt)) + ENDINGS[script, gender]


def render(kind: str, mention: str, replacement: str) -> str:
    """A canonical replacement in the format of the mention."""
    if kind == "iban":
        signs = iter(replacement.upper())
        return "".join([*(c if c == " " else next(signs) for c in mention), *signs])
    if kind in ("phone", "card", "ssn"):
        # a country code that the entity leaves out stays
        code = sum(c.isdigit() for c in mention) - len(canonical(kind, mention))
        digits = iter("1" * code + replacement)
        return "".join([*(next(digits) if c.isdigit() else c for c in mention), *digits])
    letters = [c for c in mention if c.isalpha()]
    if letters and all(c.isupper() for c in letters):
        return replacement.upper()
    if kind == "family" or kind.startswith("given"):
        return replacement[:1].upper() + replacement[1:]
    return replacement


def replace(text: str | None, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str | None, list[tuple[str, int, int]]]:
    """The text with every entity replaced, and the replacements' spans
    ``(kind, start, end)`` in the new text.  ``attempts`` names the entities
    whose first surrogate was not free."""
    found = mentions(text)
    if not found:
        return text, []
    out, done, at, new = [], [], 0, 0
    for kind, start, _, parts in found:
        out.append(text[at:start])
        at = start
        first = new = new + len(out[-1])
        for part, a, b in parts:
            entity = canonical(part, text[a:b])
            shown = render(part, text[a:b], surrogate(part, entity, attempts.get((part, entity), 0), key))
            out += [text[at:a], shown]
            new += a - at + len(shown)
            at = b
        done.append((kind, first, new))
    out.append(text[at:])
    return "".join(out), done
