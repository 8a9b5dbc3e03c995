"""The planning gate: a draft waits on disk until a person approves or rejects it."""

from __future__ import annotations

import hashlib
import json
import os

from palimpsest.plans.plan import Plan, apply_overrides, validate_plan


def digest(plan: Plan) -> str:
    return hashlib.sha256(plan.dump().encode()).hexdigest()


def _save(path: str, state: dict) -> None:
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        json.dump(state, f, ensure_ascii=False, indent=1)
    os.replace(f"{path}.part", path)


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def propose(path: str, plan: Plan, schema: list[tuple[str, str, str]], unique: set[str] = frozenset(), cardinality: dict[str, int] | None = None, snapshot: str = "") -> dict:
    """Puts a draft before the gate, with what stands against it and what profiling found."""
    state = {"stage": "gate", "digest": digest(plan), "plan": plan.dump(), "schema": [list(x) for x in schema], "unique": sorted(unique), "cardinality": cardinality or {}, "snapshot": snapshot}
    state["wrong"] = validate_plan(plan, schema, unique, cardinality=cardinality)
    _save(path, state)
    return state


def approve(path: str, seen: str, overrides: dict[str, dict] | None = None, confirm: list[str] = ()) -> Plan:
    """The approved plan. A draft other than the one that was seen, or one that doesn't validate, raises; the gate stays shut then."""
    state = load(path)
    if state["stage"] != "gate":
        raise ValueError(f"the gate is at {state['stage']}")
    if seen != state["digest"] or digest(Plan.load(state["plan"])) != seen:
        raise ValueError("the draft has changed since it was seen")
    plan = apply_overrides(Plan.load(state["plan"]), overrides or {})
    known = {f"{x.table}.{x.column}": x for x in plan.columns}
    for name in confirm:
        if name not in known:
            raise ValueError(f"the plan has no column {name}")
        known[name].confirmed = True
    if wrong := validate_plan(plan, [tuple(x) for x in state["schema"]], set(state["unique"]), cardinality=state.get("cardinality")):
        raise ValueError("; ".join(wrong))
    _save(path, state | {"stage": "final", "plan": plan.dump(), "wrong": []})
    return plan


def reject(path: str, reason: str) -> None:
    _save(path, load(path) | {"stage": "rejected", "reason": reason})


def approved(path: str) -> Plan:
    state = load(path)
    if state["stage"] != "final":
        raise ValueError(f"no approved plan: the gate is at {state['stage']}")
    return Plan.load(state["plan"])
