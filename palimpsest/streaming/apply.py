"""Plans on a stream.

Fakes, permutations, generalisation, json, null and free text are functions of one
row, and one-to-one maps are static tables, so a plan's projection runs on a
streaming DataFrame as it does on a table. Shuffles need all values and are refused.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame

from palimpsest.operators.text import sanitize_table
from palimpsest.plans.plan import Plan, compile_table


def pseudonymise_stream(stream: DataFrame, plan: Plan, table: str, salt: str, corpora: dict, maps: dict[str, DataFrame] | None = None) -> DataFrame:
    """The columns' pass over a stream. maps: one-to-one maps made beforehand; a value that comes later and that a map lacks fails the query."""
    if not stream.isStreaming:
        raise ValueError("not a stream: use compile_table")
    if bad := [x.column for x in plan.of(table) if x.strategy == "shuffle" or (x.strategy == "direct" and x.column not in (maps or {}))]:
        raise ValueError(f"{table}: {bad} need all values and can't be streamed")
    return compile_table(stream, plan, table, salt, corpora, maps)


def sanitise_stream(stream: DataFrame, plan: Plan, table: str, salt: str, corpora: dict, names: Collection[str] = (), verdicts: Mapping[str, bool] | None = None, maps: dict[str, DataFrame] | None = None) -> DataFrame:
    """Both passes over a stream: columns, then free text; notes as in ``sanitize_table``."""
    return sanitize_table(pseudonymise_stream(stream, plan, table, salt, corpora, maps), plan, table, salt, corpora, names, verdicts)
