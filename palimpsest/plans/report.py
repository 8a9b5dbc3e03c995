"""Check reports as Markdown and HTML."""

from __future__ import annotations

import html

from palimpsest.operators.verify import Check


def markdown(head: list[str], rows: list[tuple]) -> str:
    cell = lambda x: str(x).replace("|", "\\|").replace("\n", " ")
    line = lambda xs: "| " + " | ".join(map(cell, xs)) + " |"
    return "\n".join([line(head), line(["-"] * len(head)), *map(line, rows)])


def checks(found: list[Check]) -> str:
    return markdown(["check", "subject", "result", "detail"], [(x.name, x.subject, x.result, x.detail) for x in found])


def page(title: str, found: list[Check], samples: dict[str, list[tuple[str, str]]], strategies: dict[str, int]) -> str:
    """HTML with the checks, the number of columns of each strategy, and values before and after by column."""
    esc = lambda x: html.escape(str(x))
    table = lambda head, rows: "<table><tr>" + "".join(f"<th>{esc(h)}</th>" for h in head) + "</tr>" + "".join("<tr>" + "".join(f"<td>{esc(c)}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
    parts = [f"<h1>{esc(title)}</h1>", table(["check", "subject", "result", "detail"], [(x.name, x.subject, x.result, x.detail) for x in found])]
    parts += ["<h2>Strategies</h2>", table(["strategy", "columns"], sorted(strategies.items()))]
    parts += [f"<h2>{esc(name)}</h2>{table(['before', 'after'], pairs)}" for name, pairs in sorted(samples.items())]
    return f"<!doctype html><html><head><meta charset='utf-8'><title>{esc(title)}</title></head><body>{''.join(parts)}</body></html>"
