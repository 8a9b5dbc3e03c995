"""What profiling found, as a value that outlives the process: the planning gate keeps it beside the draft."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame

from palimpsest.operators import dataset, detect

#: Share of a text column's values that must be JSON objects for it to count as json.
JSON_SHARE = 0.99
#: Tables that are profiled side by side.
AT_ONCE = 6


@dataclass
class ColumnProfile:
    table: str
    column: str
    type: str
    n: int
    n_distinct: int
    null_share: float
    samples: list[str] = field(default_factory=list)
    json_keys: list[str] = field(default_factory=list)
    addr_ratio: float = 0.0
    unique: bool = False
    primary: bool = False

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column}"

    @property
    def json(self) -> bool:
        return bool(self.json_keys)


@dataclass
class Snapshot:
    columns: list[ColumnProfile]

    def to_json(self, samples: bool = False) -> str:
        """Without ``samples`` no value of the data is written."""
        rows = [asdict(x) | ({} if samples else {"samples": []}) for x in self.columns]
        return json.dumps(rows, ensure_ascii=False, indent=1)

    @staticmethod
    def from_json(text: str) -> Snapshot:
        return Snapshot([ColumnProfile(**x) for x in json.loads(text)])

    def col(self, name: str) -> ColumnProfile:
        """The profile of "table.column"; an unknown name raises."""
        found = next((x for x in self.columns if x.name == name), None)
        if found is None:
            raise KeyError(f"no column {name}")
        return found

    def metadata(self) -> dict[str, dict]:
        """What a model may see of each column: no values."""
        return {x.name: {"type": x.type, "cardinality": x.n_distinct, "null_share": round(x.null_share, 4), "json_keys": x.json_keys} for x in self.columns}


def take(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> Snapshot:
    """Profiles all tables. A column counts as unique if all its values are there and differ."""

    def one(item: tuple[str, DataFrame]) -> list[ColumnProfile]:
        (t, df), out = item, []
        for r in dataset.profile(df, t).orderBy("col").collect():
            found = dataset.json_keys(df, r["col"]) if r["type"] == "string" and r["json_share"] >= JSON_SHARE else []
            primary = r["col"] in keys.get(t, [])
            alone = r["n"] > 0 and r["n"] == r["n_distinct"]
            out.append(ColumnProfile(t, r["col"], r["type"], r["n"], r["n_distinct"], r["null_share"], list(r["samples"]), found, detect.address_ratio(r["samples"]), alone or (primary and len(keys[t]) == 1), primary))
        return out

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return Snapshot([x for part in pool.map(one, tables.items()) for x in part])
