"""Commands: demo-seed, plan, approve, run, restore, verify, publish, report. Tables are Parquet folders of one directory, or members of a dump."""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palimpsest.functions.columns import effective_salt, quoted, salt_fingerprint
from palimpsest.operators import dataset, detect, text, verify
from palimpsest.plans import gate, report, snapshot
from palimpsest.plans.plan import DEFAULTS, PARAMS, Plan, PlanColumn, assign, compile_table, inherit, schema_fingerprint
from palimpsest.sources import corpus, demo, dump, model
from palimpsest.sources.runlog import RunLog

#: Rows of a column that a report shows before and after.
SHOWN = 3
CHECKS = "name string, subject string, result string, detail string"


def salt() -> str:
    """The secret has no default."""
    master = os.environ.get("MASTER_SALT")
    if not master:
        raise SystemExit("MASTER_SALT is not set")
    return effective_salt(master, os.environ.get("MASTER_SALT_VERSION", "1"), os.environ.get("RECIPIENT", "dev"), os.environ.get("GENERATION", "g1"))


def read_tables(spark: SparkSession, folder: str, config: dict | None = None) -> dict[str, DataFrame]:
    """The Parquet folders of a directory; with "dump" in the config (listing, schemas) the members of a dump."""
    if of_dump := (config or {}).get("dump"):
        schemas = {t: StructType.fromDDL(ddl) for t, ddl in of_dump["schemas"].items()}
        with open(of_dump["listing"], encoding="utf-8") as f:
            return dump.read_dump(spark, dump.locate(folder) if of_dump.get("toc") else folder, dump.listing(f.read()), schemas)
    return {x: spark.read.parquet(f"{folder}/{x}") for x in dump.folders(spark, folder)}


def read_manifest(spark: SparkSession, folder: str) -> dict | None:
    at = f"{folder}/_manifest"
    return json.loads(spark.read.text(at).first()["value"]) if dump.exists(spark, at) else None


def schema_of(tables: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    return [(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema]


def draft(tables: dict[str, DataFrame], config: dict, seen: snapshot.Snapshot | None = None, client: model.Ask | None = None) -> tuple[Plan, snapshot.Snapshot]:
    """Profiles every table and gives each column its strategy out of two votes, its class of linked columns and the config.

    config: keys, links, soft_links that a person has confirmed, votes (a cache file of the second vote), params, json (key
    maps by column), sensitive (columns), overrides, discover (keys and links out of the data where none are declared). Numbers and keys that no vote knows are technical.
    """
    keys, params = dict(config.get("keys", {})), PARAMS | config.get("params", {})
    seen = seen or snapshot.take(tables, keys)
    links = list(config.get("links", []))
    if config.get("discover"):
        for x in seen.columns:  # a table without a declared key: its first column whose values are all there and differ
            if x.unique and x.table not in keys:
                keys[x.table], x.primary = [x.column], True
        links += [x for x in dataset.links_found(tables, {t: k for t, k in keys.items() if len(k) == 1}) if list(x) not in [list(y) for y in links]]
    votes = model.cached_votes(config.get("votes"), seen.metadata(), set(DEFAULTS), client)
    columns = []
    for x in seen.columns:
        rules = detect.detect(x.column, x.type, x.samples, x.n_distinct) if not x.json else ("free_text", 1.0)
        said, why = dataset.classify(x.column, rules, votes.get(x.name, (None, 0.0)))
        if said is None and rules[0] is None and x.name not in votes and (x.type != "string" or x.primary):
            said, why = "technical", "no rule"
        marks = config.get("json", {}).get(x.name, {})
        strategy, reason = assign({"json": x.json, "json_keys": x.json_keys}, said, unique=x.unique and said != "technical", primary_key=x.primary and len(keys.get(x.table, [])) == 1, cardinality=x.n_distinct, params=params, sensitive=x.name in config.get("sensitive", []), json_map=marks, addr_ratio=x.addr_ratio)
        columns.append(PlanColumn(x.table, x.column, said, strategy, reason=f"{why}; {reason}", json_fields=dict(marks)))
    pairs = [(f"{child}.{a}", f"{parent}.{b}") for child, cols, parent, to in links for a, b in zip(cols, to, strict=True)]
    pairs += [(f"{a}.{x}", f"{b}.{y}") for a, x, b, y in config.get("soft_links", [])]
    classes = dataset.equivalence_classes(pairs)
    plan = Plan(schema_fingerprint(schema_of(tables)), columns, params, sorted(map(sorted, classes)), keys)
    gate.apply_overrides(plan, config.get("overrides", {}))
    inherit(plan.columns, classes)
    return plan, seen


def copy_table(df: DataFrame, plan: Plan, table: str, key: list[str], secret: str, corpora: dict, names: list[str], verdicts: dict[str, bool] | None = None, client: model.Ask | None = None) -> DataFrame:
    """Both passes over one table: shuffles and maps of the source first, then columns, then free text."""
    columns = plan.of(table)
    maps = {}
    for x in columns:
        if x.strategy == "direct":
            answers = None
            if x.llm_mode == "direct" and client is not None:
                values = df.select(F.col(quoted(x.column)).cast("string").alias("v")).where("v is not null").distinct().orderBy("v").limit(plan.params["direct_threshold"] + 1)
                answers = model.renames(client, [r["v"] for r in values.collect()])
            maps[x.column] = dataset.direct_map(df, x.column, corpora["org"], secret, plan.params["direct_threshold"], answers)
    moved = dataset.shuffled(df, key, [x.column for x in columns if x.strategy == "shuffle"], table, [set(c) for c in plan.classes], secret)
    return text.sanitize_table(compile_table(moved, plan, table, secret, corpora, maps), plan, table, secret, corpora, names, verdicts)


def judged(tables: dict[str, DataFrame], plan: Plan, corpora: dict, names: list[str], path: str | None, client: model.Ask | None) -> dict[str, bool]:
    """Verdicts on the fragments of all free texts that the rules leave open, each asked for once; more than the text pass takes raise."""
    if path is None and client is None:
        return {}
    found = None
    for x in plan.columns:
        if x.strategy == "freetext" and x.sem_type != "address":
            one = text.undecided(tables[x.table], x.column, corpora, names)
            found = one if found is None else found.unionByName(one)
    if found is None:
        return {}
    fragments = [r["fragment"] for r in found.distinct().orderBy("fragment").limit(text.MAX_VERDICTS + 1).collect()]
    if len(fragments) > text.MAX_VERDICTS:
        raise ValueError(f"more than {text.MAX_VERDICTS} undecided fragments")
    return model.cached_verdicts(path, fragments, client)


def run(spark: SparkSession, source: str, plan: Plan, work: str, config: dict, client: model.Ask | None = None) -> str:
    """Makes the copy under ``work``; tables that an earlier start of the same run finished are passed over."""
    tables, secret = read_tables(spark, source, config), salt()
    corpora = corpus.select(config.get("corpus"), (lambda: {k: model.words(client, k) for k in corpus.REQUIRED}) if client and config.get("corpus_cache") else None, config.get("corpus_cache"))
    wrong = gate.validate_plan(plan, schema_of(tables)) + corpus.validate(corpora, corpus.limits([(x.sem_type, x.max_length) for x in plan.columns]))
    if wrong:
        raise ValueError("; ".join(wrong))
    keys = plan.keys or config.get("keys", {})
    log, mark, made_by = RunLog(spark, f"{work}/log"), salt_fingerprint(secret), gate.digest(plan)
    name = log.start(made_by, mark)
    of_names = [(tables[x.table], x.column) for x in plan.columns if x.sem_type in ("family", "name", "patronymic")]
    names = [r["x"] for r in text.source_names(of_names).limit(text.MAX_VERDICTS + 1).collect()] if of_names else []
    verdicts = judged(tables, plan, corpora, names, config.get("verdicts"), client)
    for t, df in tables.items():
        if log.done(name, "pass1", t):
            continue
        dump.commit(copy_table(df, plan, t, keys.get(t, []), secret, corpora, names, verdicts, client), f"{work}/{name}/raw/{t}")
        raw = spark.read.parquet(f"{work}/{name}/raw/{t}")
        dump.commit(raw.drop("_notes"), f"{work}/{name}/copy/{t}")
        log.mark(name, "pass1", t, "done", made_by, mark)
    notes = None
    for t in tables:
        raw = spark.read.parquet(f"{work}/{name}/raw/{t}")
        row_key = verify.composite_key(keys[t]) if keys.get(t) else F.lit(None).cast("string")
        one = raw.select(F.lit(t).alias("tbl"), row_key.alias("key"), F.explode("_notes").alias("note"))
        notes = one if notes is None else notes.unionByName(one)
    dump.write_notes(notes, f"{work}/{name}/notes")
    if of_dump := config.get("dump"):
        with open(of_dump["listing"], encoding="utf-8") as f:
            dump.rewrite({t: spark.read.parquet(f"{work}/{name}/copy/{t}") for t in tables}, dump.listing(f.read()), f"{work}/{name}/dump")
    return name


def same_run(spark: SparkSession, plan: Plan, work: str, name: str, mark: str | None = None) -> RunLog:
    """The run's log; a plan, or a salt, other than the run's raises."""
    log = RunLog(spark, f"{work}/log")
    made_by, salted = log.meta(name)
    if made_by != gate.digest(plan) or (mark is not None and mark != salted):
        raise ValueError("the run was made with another plan or salt")
    return log


def check(spark: SparkSession, source: str, plan: Plan, work: str, name: str, config: dict) -> list[verify.Check]:
    """Checks a run's copy, writes the report and the checksums beside it, and journals the outcome."""
    mark = salt_fingerprint(salt())
    log = same_run(spark, plan, work, name, mark)
    keys, manifest = plan.keys or config.get("keys", {}), read_manifest(spark, source)
    copy = read_tables(spark, f"{work}/{name}/copy")
    canaries = spark.createDataFrame([(x,) for x in manifest["canaries"]], "x string") if manifest else None
    found = verify.verify(read_tables(spark, source, config), copy, plan, keys, config.get("links", []), canaries, corpus.select(config.get("corpus"), None, None), manifest)
    low = spark.read.parquet(f"{work}/{name}/notes/summary").select(F.when(F.col("note").endswith(text.LOW_CONFIDENCE), F.col("n")).otherwise(0).alias("n_degraded"))
    found.append(verify.degraded(low, plan.params.get("max_degraded")))
    sums = verify.checksum_rows(copy, plan, keys)
    spark.createDataFrame(sums, "tbl string, col string, checksum long").coalesce(1).write.mode("overwrite").parquet(f"{work}/{name}/checksums")
    spark.createDataFrame([(x.name, x.subject, x.result, x.detail) for x in found], CHECKS).coalesce(1).write.mode("overwrite").parquet(f"{work}/{name}/checks")
    spark.createDataFrame([(report.checks(found),)], "value string").coalesce(1).write.mode("overwrite").text(f"{work}/{name}/report")
    log.mark(name, "verify", "*", "done" if verify.ok(found) else "failed", gate.digest(plan), mark)
    return found


def publish(spark: SparkSession, plan: Plan, work: str, name: str, to: str) -> None:
    """Copies a run's tables out, all or none; refuses a run that isn't publishable or that another plan made, and a target that exists."""
    log = same_run(spark, plan, work, name)
    if not log.publishable(name):
        raise ValueError(f"{name} is not publishable")
    dump.publish(read_tables(spark, f"{work}/{name}/copy"), to)


def samples(source: dict[str, DataFrame], copy: dict[str, DataFrame], plan: Plan) -> dict[str, list[tuple[str, str]]]:
    """A few values before and after of each changed column whose table keeps its key."""
    out = {}
    for t, key in plan.keys.items():
        by = {x.column: x for x in plan.of(t)}
        changed = [n for n, x in by.items() if x.strategy not in ("keep", "null") and n not in key]
        if t in copy and changed and all(by[k].strategy == "keep" for k in key):
            before = source[t].orderBy(*key).limit(SHOWN)
            rows = before.select(*key, *[F.col(quoted(n)).cast("string").alias(f"b{i}") for i, n in enumerate(changed)]).join(copy[t].select(*key, *[F.col(quoted(n)).cast("string").alias(f"a{i}") for i, n in enumerate(changed)]), key).collect()
            out |= {f"{t}.{n}": [(str(r[f"b{i}"])[:80], str(r[f"a{i}"])[:80]) for r in rows] for i, n in enumerate(changed)}
    return out


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="palimpsest")
    p.add_argument("command", choices=["demo-seed", "plan", "approve", "run", "restore", "verify", "publish", "report"])
    for name in ("source", "work", "gate", "run-name", "to", "out", "config", "seen", "title"):
        p.add_argument(f"--{name}")
    p.add_argument("--rows", type=int, default=1000)
    p.add_argument("--confirm", action="append", default=[])
    p.add_argument("--reject", metavar="REASON")
    p.add_argument("--samples", action="store_true", help="show values of the source in the report")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 done, 1 refused, 2 the draft waits at the gate. config: JSON, see ``draft``; more keys: corpus, corpus_cache, verdicts, dump."""
    a = _parser().parse_args(argv)
    config: dict = {}
    if a.config:
        with open(a.config, encoding="utf-8") as f:
            config = json.load(f)
    if a.command == "approve":
        if a.reject:
            gate.reject(a.gate, a.reject)
            return 1
        gate.approve(a.gate, a.seen or "", config.get("approve", {}), a.confirm)
        return 0
    spark = spark or SparkSession.builder.appName("palimpsest").getOrCreate()
    client = model.from_environment()
    if a.command == "demo-seed":
        demo.write(spark, a.source, a.rows)
        return 0
    if a.command == "plan":
        tables = read_tables(spark, a.source, config)
        schema, seen = schema_of(tables), None
        if os.path.exists(a.gate) and gate.load(a.gate).get("snapshot") and gate.load(a.gate)["schema"] == [list(x) for x in schema] and config.get("keep_profile"):
            seen = snapshot.Snapshot.from_json(gate.load(a.gate)["snapshot"])
        plan, seen = draft(tables, config, seen, client)
        unique = {x.name for x in seen.columns if x.unique and seen.col(x.name).n > 0 and x.name in set(config.get("unique", [])) | {f"{t}.{k[0]}" for t, k in config.get("keys", {}).items() if len(k) == 1}}
        state = gate.propose(a.gate, plan, schema, unique, {x.name: x.n_distinct for x in seen.columns}, seen.to_json(samples=bool(config.get("keep_profile"))))
        print(state["digest"], *state["wrong"], sep="\n")
        return 2
    plan = gate.approved(a.gate)
    if a.command == "publish":
        publish(spark, plan, a.work, a.run_name, a.to)
        return 0
    if a.command == "restore":
        same_run(spark, plan, a.work, a.run_name)
        dump.restore(read_tables(spark, f"{a.work}/{a.run_name}/copy"), a.to, spark.read.parquet(f"{a.work}/{a.run_name}/notes/rows"))
        return 0
    if a.command == "run":
        print(run(spark, a.source, plan, a.work, config, client))
        return 0
    kept = f"{a.work}/{a.run_name}/checks"
    if a.command == "report" and dump.exists(spark, kept):  # what verify found
        same_run(spark, plan, a.work, a.run_name)
        found = [verify.Check(**r.asDict()) for r in spark.read.schema(CHECKS).parquet(kept).collect()]
    else:
        found = check(spark, a.source, plan, a.work, a.run_name, config)
    if a.command == "verify":
        print(report.checks(found))
    else:
        strategies: dict[str, int] = {}
        for x in plan.columns:
            strategies[x.strategy] = strategies.get(x.strategy, 0) + 1
        shown = samples(read_tables(spark, a.source, config), read_tables(spark, f"{a.work}/{a.run_name}/copy"), plan) if a.samples else {}
        with open(a.out, "w", encoding="utf-8") as f:
            f.write(report.page(a.title or a.run_name, found, shown, strategies))
    return 0 if verify.ok(found) else 1


if __name__ == "__main__":
    sys.exit(main())
