"""Checks of a copy against its source, gathered into one verdict."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import columns as c
from palimpsest.functions.columns import quoted
from palimpsest.operators import dataset
from palimpsest.plans.plan import Plan, passport_pairs
from palimpsest.sources.corpus import SEM_TO_CORPUS

#: A copy keeps at least this share of the entropy that its strategy allows.
ENTROPY_SHARE = 0.9
CHANGED = {"fake", "generate", "direct"}
#: Checks whose jobs run side by side.
AT_ONCE = 6


@dataclass
class Check:
    """result: passed, failed or skipped; only passed counts as good."""

    name: str
    subject: str
    result: str
    detail: str = ""


def check(name: str, subject: str, good: bool, detail: object = "") -> Check:
    return Check(name, subject, "passed" if good else "failed", str(detail))


def ok(found: list[Check]) -> bool:
    return all(x.result == "passed" for x in found)


def ceiling(size: int, n_distinct: int) -> float:
    """Most bits that fakes from a corpus of ``size`` entries can keep of ``n_distinct`` source values: log2 of the entries expected to be hit."""
    return math.log2(max(size * (1 - math.exp(-n_distinct / size)), 1.0))


def composite_key(key: list[str]) -> Column:
    """One unambiguous text of a key of several columns."""
    return F.concat_ws("\u0001", *[F.coalesce(F.col(quoted(k)).cast("string"), F.lit("\u0000")) for k in key])


def identifiers(source: DataFrame, plan: Plan, table: str) -> DataFrame:
    """(x): identifiers of a source table, digits only: those with a valid checksum, and whole passports of ten digits."""
    out = source.sparkSession.createDataFrame([], "x string")
    for col in plan.of(table):
        if col.sem_type in ("inn", "snils", "ogrn"):
            valid = {"inn": c.valid_inn, "snils": c.valid_snils, "ogrn": c.valid_ogrn}[col.sem_type]
            out = out.unionByName(source.select(F.regexp_replace(F.col(quoted(col.column)).cast("string"), "[^0-9]", "").alias("x")).where(valid("x")))
    for series, number in passport_pairs(source.columns):
        out = out.unionByName(source.select(F.regexp_replace(F.concat(F.col(quoted(series)).cast("string"), F.col(quoted(number)).cast("string")), "[^0-9]", "").alias("x")).where("length(x) = 10"))
    return out.where("x is not null").distinct()


def degraded(summary: DataFrame, limit: int | None) -> Check:
    """summary: n_degraded by table. Without a limit the check fails."""
    n = summary.agg(F.coalesce(F.sum("n_degraded"), F.lit(0)).alias("n")).first()["n"]
    return check("degradation", "*", limit is not None and n <= limit, f"{n} of at most {limit}")


def occurs(df: DataFrame, columns: list[str], fragment: str, name: str = "preserved") -> Check:
    """A fragment stands literally in one of the columns."""
    text = F.concat_ws("\u0001", *[F.col(quoted(x)).cast("string") for x in columns])
    return check(name, fragment, not df.where(F.contains(text, F.lit(fragment))).limit(1).isEmpty())


def consistent(copy: DataFrame, key: str, value: object, column: str, elsewhere: list[tuple[DataFrame, str]]) -> list[Check]:
    """The replacement that one row got must stand in the other columns that named the same thing; without a replacement: skipped."""
    row = copy.where(F.col(key) == F.lit(value)).select(F.col(column).cast("string").alias("v")).where("v is not null").orderBy(F.desc("v")).first()
    if row is None:
        return [Check("consistency", column, "skipped", "no value")]
    return [occurs(df, [col], row["v"], "consistency") for df, col in elsewhere]


def same_value(left: DataFrame, right: DataFrame, on: list[str], a: str, b: str) -> Check:
    """Softly linked columns agree on every shared key, and are not null."""
    joined = left.select(*on, F.col(a).alias("_a")).join(right.select(*on, F.col(b).alias("_b")), on)
    row = joined.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(F.col("_a") == F.col("_b"), F.lit(False))).alias("bad")).first()
    return check("soft link", f"{a} = {b}", row["n"] > 0 and row["bad"] == 0, f"{row['bad']} of {row['n']} differ")


def classifier_metrics(found: DataFrame, truth: DataFrame) -> DataFrame:
    """(sem_type, tp, fp, fn, precision, recall); both inputs: tbl, col, sem_type."""
    key = ["tbl", "col", "sem_type"]
    both = found.select(*key).distinct().withColumn("f", F.lit(1)).join(truth.select(*key).distinct().withColumn("t", F.lit(1)), key, "full")
    n = lambda cond, name: F.count_if(F.expr(cond)).alias(name)
    counts = both.groupBy("sem_type").agg(n("f = 1 and t = 1", "tp"), n("f = 1 and t is null", "fp"), n("f is null and t = 1", "fn"))
    return counts.withColumn("precision", F.try_divide("tp", F.col("tp") + F.col("fp"))).withColumn("recall", F.try_divide("tp", F.col("tp") + F.col("fn")))


def correlation(left: DataFrame, right: DataFrame, key: str, by: str, a: str, b: str) -> float | None:
    """Correlation of a column with the mean of another table's column by key."""
    mean = right.groupBy(F.col(quoted(by)).alias("palimpsest by")).agg(F.avg(F.col(quoted(b))).alias("palimpsest mean"))
    return left.join(mean, F.col(quoted(key)) == F.col("`palimpsest by`")).agg(F.corr(F.col(quoted(a)).cast("double"), "`palimpsest mean`").alias("c")).first()["c"]


def probes(source: dict[str, DataFrame], copy: dict[str, DataFrame], manifest: dict) -> list[Check]:
    """The manifest's probes: one identity in column and texts, fragments that must stay, both sides of soft links, and
    correlations between linked tables. A kind that the manifest doesn't have is skipped, which is not passed."""
    out: list[Check] = []
    if who := manifest.get("identity"):
        # a woman's surname in the column, its masculine stem in texts with initials
        row = copy[who["table"]].where(F.col(who["key"]) == F.lit(who["value"])).select(F.col(who["column"]).alias("v")).first()
        if row is None or not row["v"]:
            out.append(Check("consistency", f"{who['table']}.{who['column']}", "skipped", "no value"))
        else:
            out += [occurs(copy[x["table"]], [x["column"]], row["v"].rstrip("а"), "consistency") for x in manifest.get("occurrences", [])]
    else:
        out.append(Check("consistency", "*", "skipped", "no probe"))
    kept = manifest.get("preserved", [])
    out += [occurs(copy[x["table"]], x["columns"], x["fragment"]) for x in kept] or [Check("preserved", "*", "skipped", "no probe")]
    links = manifest.get("soft_links", [])
    for x in links:
        before, after = (d[x["right"]].join(d[x["left"]].select(F.col(x["a"]).alias(x["b"])).distinct(), x["b"], "left_semi").count() for d in (source, copy))
        out.append(check("soft link", f"{x['left']}.{x['a']} = {x['right']}.{x['b']}", before > 0 and before == after, f"{before} rows met, now {after}"))
    if not links:
        out.append(Check("soft link", "*", "skipped", "no probe"))
    for x in manifest.get("correlated", []):
        was, now = (correlation(d[x["left"]], d[x["right"]], x["key"], x["by"], x["a"], x["b"]) for d in (source, copy))
        out.append(check("correlation", f"{x['left']}.{x['a']} ~ {x['right']}.{x['b']}", was is not None and now is not None and abs(was - now) < 0.01, f"{was} and {now}"))
    return out


def checksum_rows(copy: dict[str, DataFrame], plan: Plan, keys: dict[str, list[str]]) -> list[tuple[str, str, int]]:
    """(table, column, checksum) of all columns that were changed, one pass a table."""
    out = []
    for t, df in copy.items():
        columns = [x.column for x in plan.of(t) if x.strategy not in ("keep", "technical")]
        if columns and keys.get(t):
            row = dataset.checksums(df, keys[t], columns).first()
            out += [(t, n, row[n]) for n in columns]
    return sorted(out)


def verify(source: dict[str, DataFrame], copy: dict[str, DataFrame], plan: Plan, keys: dict[str, list[str]], links: list[tuple[str, list[str], str, list[str]]] = (), canaries: DataFrame | None = None, corpora: dict[str, list[str]] | None = None, manifest: dict | None = None) -> list[Check]:
    """All checks of a copy. keys: each table's key; links: child, columns, parent, its columns; canaries: column x;
    corpora: what fakes were taken from, which bounds the entropy to be expected of them; manifest: probes, see ``probes``.
    A table without a key, or absent from the copy, is a failed check, not an exception. Each check reads a table once
    for all its columns.
    """

    def table(item: tuple[str, DataFrame]) -> list[Check]:
        (t, df), out = item, []
        if t not in copy:
            return [check("volume", t, False, "not in the copy")]
        a, b = df.count(), copy[t].count()
        out.append(check("volume", t, a == b, f"{a} and {b} rows"))
        key = keys.get(t)
        if not key:
            return [*out, check("key", t, False, "no key is declared")]
        doubled = copy[t].groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        out.append(check("unique", t, doubled.isEmpty()))
        by = {x.column: x for x in plan.of(t)}
        moved = any(by[k].strategy in CHANGED for k in key if k in by)
        changed = [x.column for x in by.values() if x.strategy in CHANGED]
        if changed and moved:
            same = {r["i"]: r["n"] for r in dataset.shared_values(df, copy[t], changed).groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()}
            out += [check("replaced", f"{t}.{n}", not same.get(i), f"{same.get(i, 0)} values are the source's") for i, n in enumerate(changed)]
        elif changed:
            row = dataset.unchanged(df, copy[t], key, changed).first()
            out += [check("replaced", f"{t}.{n}", row[f"equal_{i}"] == 0, f"{row[f'equal_{i}']} values are the source's") for i, n in enumerate(changed)]
            out.append(check("keys", t, row["missing"] == 0, f"{row['missing']} source keys are not in the copy"))
        kept = [x.column for x in by.values() if x.strategy in CHANGED | {"keep", "shuffle"}]
        before, after = dataset.entropies(df, kept), dataset.entropies(copy[t], kept)
        for n in kept:
            x, (was, distinct), (now, _) = by[n], before[n], after[n]
            size = sum(len((corpora or {}).get(k, [])) for k in SEM_TO_CORPUS.get(x.sem_type, [])) if x.strategy == "fake" and x.sem_type not in ("address", "fio_full") else 0
            if was > 1:
                was = min(was, ceiling(size, distinct)) if size else was
                out.append(check("entropy", f"{t}.{n}", now >= ENTROPY_SHARE * was, f"{now:.3f} of {was:.3f} bits"))
        return out

    ids = None
    for t, df in source.items():
        if t in copy:
            mine = identifiers(df, plan, t)
            ids = mine if ids is None else ids.unionByName(mine)

    def link(item: tuple[str, list[str], str, list[str]]) -> list[Check]:
        child, cols, parent, parent_cols = item
        if child not in copy or parent not in copy:
            return [check("link", f"{child}.{','.join(cols)}", False, "not in the copy")]
        n = dataset.orphans(copy[child], cols, copy[parent], parent_cols).count()
        return [check("link", f"{child}.{','.join(cols)}", n == 0, f"{n} rows without a parent")]

    def texts(item: tuple[str, DataFrame]) -> list[Check]:
        (t, df), out = item, []
        readable = [f.name for f in df.schema if f.dataType.typeName() != "binary"]
        joined = df.select(F.concat_ws("\u0001", *[F.col(quoted(x)).cast("string") for x in readable]).alias("x_text"))
        if ids is not None:
            n = dataset.leaked_identifiers(ids, joined, "x_text").count()
            out.append(check("leak", t, n == 0, f"{n} identifiers"))
        if canaries is not None:
            n = dataset.canaries(canaries, joined, ["x_text"]).count()
            out.append(check("canaries", t, n == 0, f"{n} found"))
        return out

    # the checks don't wait for one another: Spark shares its cores among their jobs
    with ThreadPoolExecutor(AT_ONCE) as pool:
        found = [*pool.map(table, source.items()), *pool.map(link, links), *pool.map(texts, copy.items())]
    return [x for part in found for x in part] + (probes(source, copy, manifest) if manifest is not None else [])
