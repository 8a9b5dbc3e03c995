"""Replacement corpora: loading, normalising and validating their components."""

from __future__ import annotations

import json
import re
from collections import Counter

#: Components that a corpus file must have, by the file's format.
REQUIRED = ["family", "name_m", "name_f", "patronymic_m", "patronymic_f", "phone_code", "email_domain", "region", "city", "street", "org"]

#: Our own components, lower case.
COMPONENTS = {
    "family": ["иванов", "петров", "сидоров", "кузнецов", "соколов", "лебедев", "новиков", "морозов", "волков", "павлов", "семенов", "голубев", "виноградов", "богданов", "воробьев", "федоров", "михайлов", "беляев", "тарасов", "белов", "комаров", "орлов", "киселев", "макаров", "андреев"],
    "name_m": ["александр", "дмитрий", "сергей", "андрей", "алексей", "максим", "иван", "михаил", "николай", "павел", "роман", "виктор"],
    "name_f": ["анна", "мария", "елена", "ольга", "наталья", "татьяна", "ирина", "светлана", "юлия", "вера", "дарья", "полина"],
    "patronymic_m": ["александрович", "дмитриевич", "сергеевич", "андреевич", "иванович", "михайлович", "николаевич", "павлович"],
    "patronymic_f": ["александровна", "дмитриевна", "сергеевна", "андреевна", "ивановна", "михайловна", "николаевна", "павловна"],
    "phone_code": ["903", "905", "909", "910", "915", "916", "921", "925"],
    "email_domain": ["example.com", "example.org", "example.net"],
    "region": ["московская область", "тверская область", "калужская область", "рязанская область"],
    "city": ["москва", "тверь", "калуга", "рязань", "тула", "самара", "казань", "пермь"],
    "street": ["ленина", "мира", "садовая", "лесная", "новая", "полевая", "школьная", "речная"],
    "org": ["ооо ромашка", "ооо вектор", "ао север", "ооо горизонт", "ао прогресс", "ооо меридиан", "ооо альфа", "ао восток"],
}

#: Patterns that entries must match.
PATTERNS = {
    "phone_code": r"[0-9]{3}",
    "email_domain": r"[a-z0-9-]+(\.[a-z0-9-]+)+",
    "family": r"[а-яе-]{2,}",
    "name_m": r"[а-яе-]{2,}",
    "name_f": r"[а-яе-]{2,}",
    "patronymic_m": r"[а-яе]{4,}",
    "patronymic_f": r"[а-яе]{4,}",
}

#: Corpora that feed a semantic type.
SEM_TO_CORPUS = {
    "family": ["family"],
    "name": ["name_m", "name_f"],
    "patronymic": ["patronymic_m", "patronymic_f"],
    "fio_full": ["family", "name_m", "name_f", "patronymic_m", "patronymic_f"],
    "city": ["city"],
    "region": ["region"],
    "address": ["region", "city", "street"],
    "org_name": ["org"],
}


def normalise(values: list[str]) -> list[str]:
    """Trimmed, lower case, ё as е; duplicates dropped, order kept; empty entries go."""
    return [v for v in dict.fromkeys(v.strip().lower().replace("ё", "е") for v in values) if v]


def build(components: dict[str, list[str]]) -> dict[str, list[str]]:
    missing = [k for k in REQUIRED if not components.get(k)]
    if missing:
        raise ValueError(f"the corpus lacks {', '.join(missing)}")
    return {k: normalise(components[k]) for k in REQUIRED}


def load(path: str) -> dict[str, list[str]]:
    with open(path, encoding="utf-8") as f:
        return build(json.load(f))


def select(path: str | None = None, generate=None, cache_path: str | None = None) -> dict[str, list[str]]:
    """The corpus of a run: a cache file if there is one, else what ``generate()`` gives (then cached), else a file, else our own."""
    import os

    if generate is not None and cache_path is not None:
        if not os.path.exists(cache_path):
            made = build(generate())
            with open(cache_path, "w", encoding="utf-8") as f:
                json.dump(made, f, ensure_ascii=False)
        return load(cache_path)
    return load(path) if path else build(COMPONENTS)


def limits(columns: list[tuple[str, int | None]]) -> dict[str, int]:
    """Shortest consumer column of each corpus; columns: (semantic type, length or None)."""
    out: dict[str, int] = {}
    for sem, length in columns:
        for corpus in SEM_TO_CORPUS.get(sem, []) if length else []:
            out[corpus] = min(length, out.get(corpus, length))
    return out


#: What may be wrong with a component: a message and the entries (or the component's own) that it holds for.
FAULTS = {
    "fewer than two entries": lambda name, values, most: values[:1] or ["none"] if len(values) < 2 else [],
    "given twice": lambda name, values, most: [v for v, n in Counter(values).items() if n > 1],
    "of a wrong form": lambda name, values, most: [v for v in values if not re.fullmatch(PATTERNS.get(name, ".+"), v)],
    "longer than its shortest column": lambda name, values, most: [v for v in values if len(v) > most],
}


def validate(corpora: dict[str, list[str]], longest: dict[str, int] | None = None) -> list[str]:
    """What is wrong with corpora, by FAULTS. longest: the shortest consumer column of a component."""
    room = longest or {}
    return [f"{name}: {fault}: {entry!r}" for name, values in corpora.items() for fault, holds in FAULTS.items() for entry in holds(name, values, room.get(name, 2**31))]
