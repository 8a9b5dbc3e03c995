"""A language model's part: transport, tolerant reading of answers, the four roles, and caches that make a run need no model.

Every role takes ``ask``, a callable from (prompt, system) to the answer's text; a
``Client`` is one. Live text is shown to a model on this machine only. Without a
model and without a cached answer a role says nothing, which is no error.
"""

from __future__ import annotations

import json
import os
import re
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

Ask = Callable[[str, str], str]

#: Hosts that count as this machine, and where the two kinds of provider listen.
LOCAL = {"localhost", "127.0.0.1", "::1", "host.docker.internal", "ollama"}
PROVIDERS = {"ollama": ("http://127.0.0.1:11434", "/api/chat"), "openai": ("https://api.openai.com", "/v1/chat/completions")}
#: Columns that one question names.
BATCH = 20
#: Fragments with known answers, and the share of them that a model must get right before it judges live text.
ACCEPTANCE = {
    "Иванов Пётр": True, "Смирнова Анна Ивановна": True, "Кузнецов Олег": True, "Мария Соколова": True, "Орлов Павел Николаевич": True,
    "Красная Площадь": False, "Нижний Новгород": False, "Общество Ромашка": False, "Технический Отдел": False, "Новый Год": False,
}
ACCEPTED = 0.8


class Unavailable(RuntimeError):
    """No provider, no answer, or no right to this role."""


@dataclass
class Client:
    provider: str
    model: str
    url: str = ""
    key: str = ""
    timeout: int = 120

    def __post_init__(self):
        if self.provider not in PROVIDERS:
            raise Unavailable(f"unknown provider {self.provider!r}")
        self.url = (self.url or PROVIDERS[self.provider][0]).rstrip("/")

    @property
    def local(self) -> bool:
        """Whether it may see live text."""
        return urllib.parse.urlsplit(self.url).hostname in LOCAL

    def __call__(self, prompt: str, system: str = "") -> str:
        messages = [{"role": r, "content": t} for r, t in (("system", system), ("user", prompt)) if t]
        body = {"model": self.model, "messages": messages} | ({"stream": False, "think": False, "options": {"temperature": 0}} if self.provider == "ollama" else {"temperature": 0})
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        request = urllib.request.Request(self.url + PROVIDERS[self.provider][1], json.dumps(body).encode(), headers)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                got = json.loads(reply.read())
        except (urllib.error.URLError, OSError, ValueError) as e:
            raise Unavailable(f"{self.provider} doesn't answer: {e}") from e
        return (got if self.provider == "ollama" else got["choices"][0])["message"]["content"]


def from_environment() -> Client | None:
    """The client that LLM_PROVIDER, LLM_MODEL, LLM_BASE_URL, LLM_API_KEY and LLM_TIMEOUT name; None without a provider."""
    name = os.environ.get("LLM_PROVIDER", "").strip().lower()
    if not name:
        return None
    default = {"ollama": "qwen3:8b", "openai": "gpt-4o-mini"}.get(name, "")
    return Client(name, os.environ.get("LLM_MODEL", default), os.environ.get("LLM_BASE_URL", ""), os.environ.get("LLM_API_KEY", ""), int(os.environ.get("LLM_TIMEOUT", "120")))


# -- reading answers


def first_json(answer: str) -> object:
    """The first object or array in an answer, whatever stands around it; thoughts don't count. None raises."""
    text = re.sub(r"<think>.*?</think>", "", answer, flags=re.DOTALL)
    decoder = json.JSONDecoder()
    for m in re.finditer(r"[{\[]", text):
        try:
            return decoder.raw_decode(text, m.start())[0]
        except ValueError:
            continue
    raise Unavailable("an answer without JSON")


def _of(item: dict, *names: str) -> object:
    return next((item[n] for n in names if n in item), None)


def votes_in(raw: object) -> Iterator[tuple[str, object, object]]:
    """(column, type, confidence) of an answer: an object, or an array of objects, of triples or of one-key objects."""
    for item in raw.items() if isinstance(raw, dict) else raw if isinstance(raw, list) else ():
        if isinstance(item, dict) and (column := _of(item, "column", "name", "колонка")):
            yield str(column), _of(item, "type", "sem_type", "тип"), _of(item, "confidence", "уверенность") or 0.0
        elif isinstance(item, dict) and len(item) == 1:
            yield from votes_in(item)
        elif isinstance(item, tuple) and isinstance(item[1], list) and len(item[1]) == 2:
            yield str(item[0]), *item[1]
        elif isinstance(item, list) and len(item) == 3:
            yield str(item[0]), item[1], item[2]


def renames_in(raw: object) -> Iterator[tuple[str, str]]:
    """(source, replacement) of an answer: an object, or an array of one-key objects or of pairs."""
    for item in raw.items() if isinstance(raw, dict) else raw if isinstance(raw, list) else ():
        if isinstance(item, dict):
            yield from renames_in(item) if len(item) == 1 else [(str(_of(item, "from", "source")), str(_of(item, "to", "target")))] if len(item) == 2 else []
        elif isinstance(item, (tuple, list)) and len(item) == 2:
            yield str(item[0]), str(item[1])


def match_column(name: str, known: dict) -> str | None:
    """The known column that an answer means: its full name, or the only one with that last part."""
    if name in known:
        return name
    ends = [k for k in known if k.rpartition(".")[2] == name.rpartition(".")[2]]
    return ends[0] if len(ends) == 1 else None


# -- roles


def vote(ask: Ask, meta: dict[str, dict], allowed: set[str]) -> dict[str, tuple[str | None, float]]:
    """Types of columns by their metadata alone; no value is shown. Asked BATCH columns at a time, once more where an answer names none.
    A type that isn't allowed is no vote; a confidence outside 0 to 1 drops the vote."""
    out: dict[str, tuple[str | None, float]] = {}
    names = sorted(meta)
    system = "You tell the semantic type of database columns by metadata alone. Answer with one JSON object."
    for at in range(0, len(names), BATCH):
        part = {n: meta[n] for n in names[at : at + BATCH]}
        prompt = (
            f"Types: {', '.join(sorted(allowed))}. An integer id or *_id is technical; person_id is a number that people know a person by; a short code of few values is category; "
            'free_text is long human text. Where in doubt answer null. Form: {"table.column": ["type", 0.9], "table.other": [null, 0]}, names are needed.\n' + json.dumps(part, ensure_ascii=False)
        )
        for more in ("", "\nThe last answer named no columns."):
            found = list(votes_in(first_json(ask(prompt + more, system))))
            if found:
                break
        for name, kind, sure in found:
            column = match_column(name, part)
            try:
                sure = float(sure)
            except (TypeError, ValueError):
                continue
            if column is not None and 0 <= sure <= 1:
                out[column] = (kind, sure) if kind in allowed else (None, 0.0)
    return out


def words(ask: Ask, kind: str, n: int = 300) -> list[str]:
    """Entries for a corpus component; the corpus checks them."""
    raw = first_json(ask(f"Give {n} different lower-case Russian entries for the dictionary '{kind}' as a JSON array.", "You make up dictionaries of invented values. Answer with one JSON array."))
    return [x.strip().lower() for x in map(str, raw if isinstance(raw, list) else []) if x.strip()]


def renames(ask: Ask, values: list[str]) -> dict[str, str]:
    """One-to-one replacements of values that name no person; only known sources with a new, non-empty value count."""
    raw = first_json(ask("Replace each name by an invented one of its kind, all different: a JSON object from old to new.\n" + json.dumps(values, ensure_ascii=False), "You rename organisations. Answer with JSON."))
    known, out, used = set(values), {}, set()
    for old, new in renames_in(raw):
        if old in known and old not in out and new.strip() and new not in used and new != old:
            out[old] = new
            used.add(new)
    return out


def verdict(ask: Ask, fragment: str) -> bool | None:
    """Whether a fragment of text names a person; None if the model doesn't know."""
    said = ask(f"Is this a person's name? Answer yes, no or unknown.\n{fragment}", "You judge fragments of text in one word.").strip().lower()
    said = re.sub(r"<think>.*?</think>", "", said, flags=re.DOTALL).strip(" .!\n")
    return {"yes": True, "да": True, "no": False, "нет": False}.get(said.split()[0] if said else "")


def accepted(ask: Ask) -> bool:
    """Whether the model gets enough of the known fragments right to judge live text."""
    return sum(verdict(ask, x) is is_person for x, is_person in ACCEPTANCE.items()) >= ACCEPTED * len(ACCEPTANCE)


# -- caches


def _load(path: str | None) -> dict:
    if path and os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    return {}


def _save(path: str | None, known: dict) -> None:
    if path:
        with open(f"{path}.part", "w", encoding="utf-8") as f:
            json.dump(known, f, ensure_ascii=False, indent=1, sort_keys=True)
        os.replace(f"{path}.part", path)


def cached_votes(path: str | None, meta: dict[str, dict], allowed: set[str], ask: Ask | None = None) -> dict[str, tuple[str | None, float]]:
    """The second vote: from the cache file, and for columns that it lacks from the model, whose votes join the cache."""
    known = {k: tuple(v) for k, v in _load(path).items()}
    missing = {k: v for k, v in meta.items() if k not in known}
    if ask is not None and missing:
        known |= vote(ask, missing, allowed)
        _save(path, known)
    return {k: (v[0] if v[0] in allowed else None, float(v[1])) for k, v in known.items() if k in meta}


def cached_verdicts(path: str | None, fragments: list[str], client: Client | Ask | None = None) -> dict[str, bool]:
    """Verdicts on lower-case fragments: cached ones, and those of a model that is local and accepted. "Unknown" is not cached."""
    known = _load(path)
    missing = [x for x in fragments if x not in known]
    if client is not None and missing:
        if isinstance(client, Client) and not client.local:
            raise Unavailable("live text is shown to a model on this machine only")
        if accepted(client):
            known |= {x: v for x in missing if (v := verdict(client, x)) is not None}
            _save(path, known)
    return {x: known[x] for x in fragments if x in known}
