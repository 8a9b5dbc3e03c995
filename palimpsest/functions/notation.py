"""How phones, numbers, passports and addresses are written, built from their rules in one place for the text pass and for detection."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

#: Country codes and digit groups of a phone, digits of a passport's series and number, fewest and most digits of an identifier.
COUNTRY, PHONE_GROUPS = ("+7", "8", "7"), (3, 3, 2, 2)
SERIES, NUMBER = 4, 6
LEAST, MOST = 10, 19

ALONE, ENDS = r"(?<!\d)", r"(?!\d)"


def _digits(n: int) -> str:
    return rf"\d{{{n}}}"


def _phone() -> str:
    """A country code and the groups; blanks of any kind, brackets and hyphens may stand between."""
    between = r"[\s()\-]*"
    return f"(?:{'|'.join(map(re.escape, COUNTRY))}){between}{between.join(map(_digits, PHONE_GROUPS))}"


def _passport() -> str:
    """Series and number, something between them: blanks, hyphens, commas or the words for series and number."""
    return rf"({_digits(SERIES)})((?:[\s,\-]|серия|номер|№)+)({_digits(NUMBER)})"


PHONE = re.compile(ALONE + _phone() + ENDS)
PASSPORT = re.compile(ALONE + _passport() + ENDS)
EMAIL = re.compile(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+")
_CHAIN, _GROUP, _SPAN = re.compile(r"\d+(?:[\s-]\d+)*"), re.compile(r"\d+"), re.compile(r".*", re.DOTALL)


def identifiers(text: str, valid: Callable[[str], bool] = lambda digits: True) -> Iterator[re.Match]:
    """Numbers of LEAST to MOST digits whose groups are parted by single blanks or hyphens: from each group on the longest
    that is valid, so that numbers side by side don't hide each other. The group behind a plus is a country code and
    belongs to none."""
    for chain in _CHAIN.finditer(text):
        groups = list(_GROUP.finditer(text, chain.start(), chain.end()))
        i = 1 if text[: chain.start()].endswith("+") else 0
        while i < len(groups):
            ends, digits = [], ""
            for j in range(i, len(groups)):
                digits += groups[j][0]
                if len(digits) > MOST:
                    break
                if len(digits) >= LEAST:
                    ends.append((j, digits))
            last = next((j for j, d in reversed(ends) if valid(d)), None)
            if last is None:
                i += 1
            else:
                yield _SPAN.match(text, groups[i].start(), groups[last].end())
                i = last + 1


#: Words and abbreviations that mark a part of an address.
MARKERS = ["обл", "область", "край", "респ", "республика", "г", "город", "пос", "дер", "ул", "улица", "пр", "проспект", "пер", "переулок", "шоссе", "д", "дом", "корп", "стр", "кв", "оф"]
_MARKED = re.compile(rf"(?:{'|'.join(sorted(MARKERS, key=len, reverse=True))})\.?\s+[\w\-]+(?:[ \-][\w\-]+){{0,2}}", re.IGNORECASE)
_REGION = re.compile(r"[а-яё\-]+(?: [а-яё\-]+)? (?:обл\.?|область|край|республика)", re.IGNORECASE)
_HOUSE = re.compile(r"\d{1,4}[а-я]?(?:/\d{1,3})?|\d{6}", re.IGNORECASE)
_HINT = re.compile(r"addr|адрес|street|улиц", re.IGNORECASE)


def is_address(value: str) -> bool:
    """Every part between commas is a marked part, a region, or a house or post code, and two at least are marked."""
    parts = [p.strip() for p in value.split(",")]
    marked = sum(bool(_MARKED.fullmatch(p) or _REGION.fullmatch(p)) for p in parts)
    return marked >= 2 and all(_MARKED.fullmatch(p) or _REGION.fullmatch(p) or _HOUSE.fullmatch(p) for p in parts)


def looks_like_addresses(name: str, samples: list[str]) -> bool:
    """By the column's name, or by two samples of the first twenty that have two markers."""
    marks = re.compile(rf"\b(?:{'|'.join(MARKERS)})\b\.?", re.IGNORECASE)
    return bool(_HINT.search(name)) or sum(len(marks.findall(x)) >= 2 and "," in x for x in samples[:20]) >= 2
