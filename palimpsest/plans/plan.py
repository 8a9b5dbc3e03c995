"""The plan: one reviewed strategy per column, and its compilation to projections."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import columns as c
from palimpsest.functions.columns import quoted

#: Strategies, json field types, default strategy of a semantic type.
STRATEGIES = ["direct", "fake", "generate", "generalize", "shuffle", "keep", "null", "freetext", "jsonb", "unresolved"]
JSON_TYPES = ["phone", "fio_full", "snils", "inn", "email", "passport", "person_id", "keep"]
DEFAULTS = {
    "family": "fake", "name": "fake", "patronymic": "fake", "fio_full": "fake", "phone": "fake", "address": "fake", "city": "fake", "region": "fake",
    "email": "generate", "inn": "generate", "snils": "generate", "ogrn": "generate", "passport": "generate", "person_id": "generate",
    "kpp": "keep", "category": "keep", "technical": "keep", "org_name": "direct", "birth_date": "generalize", "salary": "shuffle", "free_text": "freetext",
}
#: Types whose replacement is one to one, that name no person, that frequency gives away; parameters and modes.
UNIQUE_SAFE = {"inn", "snils", "ogrn", "email", "person_id"}
NOT_PERSONAL = {"category", "city", "region", "org_name", "kpp", "technical"}
LOW_CARDINALITY = {"category", "city", "region", "org_name", "kpp"}
PARAMS = {"direct_threshold": 10_000, "fake_min_cardinality": 1_000, "addr_parse_threshold": 0.9, "max_degraded": 0, "llm_available": False}
LLM_MODES = {"none", "corpus", "direct", "ner"}
#: Fields that a person may change.
OVERRIDABLE = {"sem_type", "strategy", "llm_mode", "reason", "json_fields", "length_policy"}


@dataclass
class PlanColumn:
    table: str
    column: str
    sem_type: str | None
    strategy: str
    llm_mode: str = "none"
    reason: str = ""
    json_fields: dict[str, str] = field(default_factory=dict)
    length_policy: str = "fail"
    max_length: int | None = None
    confirmed: bool = False


@dataclass
class Plan:
    fingerprint: str
    columns: list[PlanColumn]
    params: dict = field(default_factory=lambda: dict(PARAMS))
    classes: list[list[str]] = field(default_factory=list)
    keys: dict[str, list[str]] = field(default_factory=dict)

    def dump(self) -> str:
        ordered = sorted(self.columns, key=lambda x: (x.table, x.column))
        return json.dumps({"fingerprint": self.fingerprint, "params": self.params, "classes": sorted(map(sorted, self.classes)), "keys": self.keys, "columns": [asdict(x) for x in ordered]}, ensure_ascii=False, indent=1)

    @staticmethod
    def load(text: str) -> Plan:
        """Unknown fields raise."""
        raw = json.loads(text)
        if bad := set(raw) - {"fingerprint", "params", "classes", "keys", "columns"}:
            raise ValueError(f"unknown fields {sorted(bad)}")
        return Plan(raw["fingerprint"], [PlanColumn(**x) for x in raw["columns"]], raw["params"], raw.get("classes", []), raw.get("keys", {}))

    def of(self, table: str) -> list[PlanColumn]:
        return [x for x in self.columns if x.table == table]


def schema_fingerprint(schema: list[tuple[str, str, str]]) -> str:
    """Hash of (table, column, type) rows, whatever their order."""
    return hashlib.sha256("\n".join("\t".join(x) for x in sorted(schema)).encode()).hexdigest()


def plan_diff(old: Plan, new: Plan) -> dict[str, list[str]]:
    """Columns added, changed and removed; audit fields (reason, confirmed) don't count."""
    strip = lambda x: {k: v for k, v in asdict(x).items() if k not in ("reason", "confirmed")}
    a, b = ({f"{x.table}.{x.column}": strip(x) for x in p.columns} for p in (old, new))
    return {"added": sorted(b.keys() - a.keys()), "removed": sorted(a.keys() - b.keys()), "changed": sorted(k for k in a.keys() & b.keys() if a[k] != b[k])}


def apply_overrides(plan: Plan, overrides: dict[str, dict]) -> Plan:
    """overrides: "table.column" to changed fields; fields outside the whitelist and unknown columns raise."""
    known = {f"{x.table}.{x.column}": x for x in plan.columns}
    for name, changes in overrides.items():
        if name not in known:
            raise ValueError(f"the plan has no column {name}")
        if bad := set(changes) - OVERRIDABLE:
            raise ValueError(f"{name}: {sorted(bad)} can't be overridden")
        for k, v in changes.items():
            setattr(known[name], k, v)
    return plan


def assign(profile: dict, sem_type: str | None, *, unique: bool, primary_key: bool, cardinality: int, params: dict | None = None, sensitive: bool = False, json_map: dict | None = None, addr_ratio: float = 1.0) -> tuple[str, str]:
    """(strategy, reason) of one column. params: what differs from PARAMS; profile: json, and json_keys found in the data."""
    params = PARAMS | (params or {})
    if sem_type is None:
        return "unresolved", "the votes don't settle its type"
    if profile.get("json"):
        if not json_map:
            return "unresolved", "json without a key map"
        if missing := sorted(set(profile.get("json_keys", ())) - set(json_map)):
            return "unresolved", f"json keys without a mark: {missing}"
        return "jsonb", "keys are mapped"
    strategy, reason = DEFAULTS.get(sem_type, "unresolved"), "default of its type"
    if sem_type == "address" and addr_ratio < params["addr_parse_threshold"]:
        strategy, reason = "freetext", "too few values parse as addresses"
    if sensitive:
        strategy, reason = "shuffle", "sensitive category"
    if strategy == "fake" and sem_type in LOW_CARDINALITY and not primary_key and cardinality < params["fake_min_cardinality"]:
        strategy, reason = "keep", "low cardinality: a fake could be inverted by frequency"
    if strategy == "direct" and (sem_type not in NOT_PERSONAL or cardinality > params["direct_threshold"]):
        strategy, reason = "fake", "no one-to-one map: personal, or too many values"
    if (unique or primary_key) and strategy in ("fake", "generate") and sem_type not in NOT_PERSONAL:
        return ("generate", "unique key") if sem_type in UNIQUE_SAFE else ("unresolved", "no injective replacement of a unique key of this type")
    return strategy, reason


def inherit(columns: list[PlanColumn], classes: list[set[str]]) -> list[PlanColumn]:
    """Linked columns agree: one strategy of a class goes to its kept members of the same type; members of several types are unresolved."""
    named = {f"{x.table}.{x.column}": x for x in columns}
    for group in classes:
        members = [named[n] for n in sorted(group) if n in named]
        kinds = {x.sem_type for x in members} - {"technical"}
        chosen = {x.strategy for x in members} - {"keep"}
        for x in members:
            if len(kinds) > 1:
                x.strategy, x.reason = "unresolved", f"linked columns of the types {sorted(map(str, kinds))}"
            elif len(chosen) == 1 and x.strategy == "keep" and x.sem_type != "technical":
                x.strategy, x.reason = next(iter(chosen)), f"{x.reason}; as the columns it is linked with"
    return columns


def validate_plan(plan: Plan, schema: list[tuple[str, str, str]], unique: set[str] = frozenset(), classes: list[set[str]] = (), cardinality: dict[str, int] | None = None) -> list[str]:
    """What stands against running a plan. unique: columns that are keys; classes: linked columns; cardinality: distinct values by column."""
    params = PARAMS | plan.params
    wrong = []
    have = {f"{t}.{col}" for t, col, _ in schema}
    mine = {f"{x.table}.{x.column}": x for x in plan.columns}
    if plan.fingerprint != schema_fingerprint(schema):
        wrong.append("the schema has changed since the plan was made")
    wrong += [f"{x}: not in the plan" for x in sorted(have - mine.keys())] + [f"{x}: not in the schema" for x in sorted(mine.keys() - have)]
    for name, x in mine.items():
        if x.strategy not in STRATEGIES:
            wrong.append(f"{name}: unknown strategy {x.strategy}")
        if x.sem_type is not None and x.sem_type not in DEFAULTS:
            wrong.append(f"{name}: unknown type {x.sem_type}")
        if x.llm_mode not in LLM_MODES:
            wrong.append(f"{name}: unknown model mode {x.llm_mode}")
        if x.llm_mode == "direct" and (x.strategy != "direct" or not params["llm_available"]):
            wrong.append(f"{name}: a model's map without a model, or without that strategy")
        if x.strategy == "fake" and x.sem_type in LOW_CARDINALITY and (cardinality or {}).get(name, params["fake_min_cardinality"]) < params["fake_min_cardinality"]:
            wrong.append(f"{name}: a fake of few values could be inverted by frequency")
        if x.strategy == "jsonb" and not x.json_fields:
            wrong.append(f"{name}: json without a key map")
        if x.strategy == "unresolved":
            wrong.append(f"{name}: unresolved")
        if x.strategy == "direct" and x.sem_type not in NOT_PERSONAL:
            wrong.append(f"{name}: a one-to-one map of personal data")
        if x.strategy == "null" and not x.confirmed:
            wrong.append(f"{name}: null needs a confirmation")
        if x.length_policy not in ("fail", "truncate"):
            wrong.append(f"{name}: unknown length policy")
        if bad := set(x.json_fields.values()) - set(JSON_TYPES):
            wrong.append(f"{name}: unknown json types {sorted(bad)}")
        if name in unique and x.strategy in ("fake", "generate") and x.sem_type not in UNIQUE_SAFE:
            wrong.append(f"{name}: not injective on a unique key")
    for group in [*classes, *map(set, plan.classes)]:
        if len({(mine[x].strategy, mine[x].sem_type) for x in group if x in mine and mine[x].sem_type != "technical"}) > 1:
            wrong.append(f"{', '.join(sorted(group))}: linked columns with different strategies")
    return wrong


def _generate(salt: str, corpora: dict, sem_type: str | None, value: str) -> Column:
    """The one replacement of an identifier, in a column as within json. value: SQL of its text."""
    make = {
        "inn": lambda: c.gen_inn(salt, value),
        "snils": lambda: c.gen_snils(salt, value),
        "ogrn": lambda: c.gen_ogrn(salt, value),
        "email": lambda: c.fake_email(salt, corpora, value),
        "person_id": lambda: c.gen_person_id(salt, value),
    }.get(sem_type, lambda: c.gen_digits_like(salt, value))
    return make()


def _fake(salt: str, corpora: dict, x: PlanColumn) -> Column:
    name = quoted(x.column)
    whole = {"phone": c.fake_phone, "address": c.fake_address, "email": c.fake_email, "fio_full": c.fake_fio_full}.get(x.sem_type)
    if whole is not None:
        return whole(salt, corpora, name)
    if x.sem_type in ("name", "patronymic"):  # without a surname beside it
        return c.fake_fio(salt, corpora, "cast(null as string)", *(name if x.sem_type == k else "cast(null as string)" for k in ("name", "patronymic")))[x.sem_type]
    corpus = {"city": "city", "region": "region", "org_name": "org"}.get(x.sem_type)
    if corpus is None:
        raise ValueError(f"{x.table}.{x.column}: no fake for {x.sem_type}")
    out = c.fake_pick(salt, corpora, corpus, name)
    return F.upper(out) if corpus == "org" else F.initcap(out)


def _json(df: DataFrame, salt: str, corpora: dict, x: PlanColumn) -> tuple[DataFrame, Column]:
    """The object with its keys in order: those with a type get that type's replacement as text, "keep" stays as it is,
    nulls stay, keys without a mark become null. What is no JSON object raises, without the value. Of a key that is
    given twice the last value counts."""
    own = f"cast({quoted(x.column)} as string)"
    parsed = f"palimpsest json {x.column}"
    df = df.withColumn(parsed, F.expr(f"from_json({own}, 'map<string,variant>')"))
    fields = F.col(quoted(parsed))

    def quote(column: Column) -> Column:
        wide = F.to_json(F.array(column))  # a string and two brackets
        return F.substring(wide, F.lit(2), F.length(wide) - 2)

    new: dict[str, Column] = {}
    for i, (key, kind) in enumerate(sorted(x.json_fields.items())):
        if kind == "keep":
            continue
        value = f"{parsed} {i}"
        df = df.withColumn(value, F.variant_get(F.try_element_at(fields, F.lit(key)), "$", "string"))
        whole = {"phone": c.fake_phone, "fio_full": c.fake_fio_full}.get(kind)
        new[key] = whole(salt, corpora, quoted(value)) if whole else _generate(salt, corpora, kind, quoted(value))

    def entry(e: Column) -> Column:
        raw = F.coalesce(F.to_json(e["value"]), F.lit("null"))
        out = F.when(F.lit(False), F.lit(""))
        for key in x.json_fields:
            out = out.when(e["key"] == key, F.when((raw == "null") | F.lit(key not in new), raw).otherwise(quote(new[key]) if key in new else raw))
        return F.concat(quote(e["key"]), F.lit(":"), out.otherwise(F.lit("null")))

    made = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(fields), entry), ","), F.lit("}"))
    return df, F.when(fields.isNotNull(), made).otherwise(F.raise_error(F.lit(f"{x.table}.{x.column}: not a JSON object")).cast("string"))


def passport_pairs(columns: list[str]) -> list[tuple[str, str]]:
    """Columns X_series and X_number with one prefix."""
    return [(x, x[: -len("series")] + "number") for x in columns if x.endswith("series") and x[: -len("series")] + "number" in columns]


def compile_table(df: DataFrame, plan: Plan, table: str, salt: str, corpora: dict, maps: dict[str, DataFrame] | None = None) -> DataFrame:
    """One projection for a table. maps: one-to-one maps (v, fake) by column; a value
    that a map lacks raises. The secret is bound as a broadcast row, so that no plan shows it. Shuffled columns pass: give
    them their values first. An unknown strategy raises."""
    by = {x.column: x for x in plan.of(table)}
    if missing := [n for n in df.columns if n not in by]:
        raise ValueError(f"{table}: columns without a strategy: {missing}")
    names, schema = df.columns, df.schema
    triple = {k: next((x.column for x in by.values() if x.sem_type == k and x.strategy == "fake"), None) for k in ("family", "name", "patronymic")}
    pairs = [(a, b) for a, b in passport_pairs(names) if all(by[n].strategy == "generate" and by[n].sem_type == "passport" for n in (a, b))]
    bound = salt
    if any(x.strategy in ("fake", "generate", "jsonb") for x in by.values()):
        df, bound = c.bind_secret(df, salt)
    whole = c.fake_fio(bound, corpora, *(quoted(triple[k]) if triple[k] else "cast(null as string)" for k in triple)) if triple["family"] else None
    document = {n: new for a, b in pairs for n, new in zip((a, b), c.fake_passport(bound, quoted(a), quoted(b)), strict=True)}
    out: list[Column] = []
    for n in names:
        x, kind, own = by[n], schema[n].dataType, F.col(quoted(n))
        if x.strategy in ("keep", "freetext", "shuffle"):
            new = own
        elif x.strategy == "null":
            new = F.lit(None).cast(kind)
        elif x.strategy == "generalize":
            if kind.typeName() not in ("date", "timestamp", "timestamp_ntz"):
                raise ValueError(f"{table}.{n}: only dates are generalised")
            new = F.date_trunc("year", own).cast(kind)
        elif x.strategy == "generate":
            new = (document[n] if n in document else _generate(bound, corpora, x.sem_type, f"cast({quoted(n)} as string)")).cast(kind)
        elif x.strategy == "fake" and whole is not None and n in triple.values():
            new = whole[next(k for k, v in triple.items() if v == n)]
        elif x.strategy == "fake":
            new = _fake(bound, corpora, x).cast(kind)
        elif x.strategy == "jsonb":
            df, new = _json(df, bound, corpora, x)
        elif x.strategy == "direct":
            m = (maps or {})[n].select(F.col("v").alias(f"palimpsest v {n}"), F.col("fake").alias(f"palimpsest f {n}"))
            df = df.join(m, own.cast("string") == F.col(quoted(f"palimpsest v {n}")), "left")
            fake = F.col(quoted(f"palimpsest f {n}"))
            new = F.when(fake.isNotNull(), fake).otherwise(F.raise_error(F.lit(f"{table}.{n}: a value that its map lacks")))
        else:
            raise ValueError(f"{table}.{n}: strategy {x.strategy} can't be compiled")
        if x.max_length and x.strategy in ("fake", "generate", "direct"):
            long = F.length(new.cast("string")) > x.max_length
            new = F.when(long, F.substring(new.cast("string"), 1, x.max_length) if x.length_policy == "truncate" else F.raise_error(F.lit(f"{table}.{n}: too long"))).otherwise(new)
        out.append(F.when(own.isNull(), F.lit(None).cast(kind)).otherwise(new).alias(n))
    return df.select(*out)
