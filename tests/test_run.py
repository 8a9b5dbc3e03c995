import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from palimpsest import cli
from palimpsest.operators import dataset, detect, verify
from palimpsest.plans import gate, report, snapshot
from palimpsest.plans.plan import Plan, PlanColumn, schema_fingerprint
from palimpsest.sources import demo, dump, model
from palimpsest.sources.runlog import RunLog

def test_copy_text_round_trip(spark, tmp_path):
    texts = ["plain", "", "tab\there", "line\nbreak\r", "back\\slash\\n", "\\N", None, "\b\f\v", "ё" * 5000]
    schema = StructType([StructField("id", LongType()), StructField("t", StringType())])
    df = spark.createDataFrame(list(enumerate(texts)), schema)
    dump.write_copy(df, str(tmp_path / "c"))
    assert sorted(map(tuple, dump.read_copy(spark, str(tmp_path / "c"), schema).collect())) == list(enumerate(texts))
    assert dump.unescape(r"\101\x42\\n\q") == "AB\\nq" and dump.unescape(r"\320\226") == "Ж"


@settings(max_examples=50, deadline=None)
@given(st.text(alphabet="\\nNt0x1a\t\n", max_size=12))
def test_unescape_undoes_escape(x):
    coded = x.replace("\\", "\\\\").replace("\n", "\\n").replace("\t", "\\t")
    assert dump.unescape(coded) == x


def test_listing_and_location(tmp_path):
    text = '; a comment\n\n3456; 0 16385 TABLE DATA public person owner\n9; 0 1 TABLE DATA public "Odd name" owner\n10; 1259 1 TABLE public person owner\n'
    assert dump.listing(text) == {3456: "public.person", 9: "public.Odd name"}
    with pytest.raises(ValueError):
        dump.listing("nonsense")
    for x in ("2", "10", "x"):
        (tmp_path / x).mkdir()
        (tmp_path / x / "toc.dat").touch()
    assert dump.locate(str(tmp_path)) == str(tmp_path / "10")


def test_commit_is_done_once_and_notes_have_a_limit(spark, tmp_path):
    path = str(tmp_path / "out")
    assert dump.commit(spark.range(3), path) and not dump.commit(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    notes = spark.range(5).select(F.lit("t").alias("tbl"), F.col("id").alias("key"), F.lit("x").alias("note"))
    for limit, rows in ((5, 5), (4, 0)):
        dump.write_notes(notes, str(tmp_path / "n"), limit)
        assert spark.read.parquet(str(tmp_path / "n/rows")).count() == rows
        assert spark.read.parquet(str(tmp_path / "n/summary")).first()["n"] == 5


def test_run_log_resumes_refuses_and_publishes(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    run = log.start("p", "s")
    assert log.start("p", "s") == run
    with pytest.raises(ValueError):
        log.start("other", "s")
    log.mark(run, "pass1", "t", "failed", "p", "s")
    log.mark(run, "verify", "*", "done", "p", "s")
    assert not log.publishable(run)
    log.mark(run, "pass1", "t", "done", "p", "s")
    assert log.publishable(run) and log.done(run, "pass1", "t") and log.start("other", "s") != run


def test_gate_binds_the_draft(tmp_path):
    path, schema = str(tmp_path / "gate.json"), [("t", "a", "string")]
    state = gate.propose(path, Plan(schema_fingerprint(schema), [PlanColumn("t", "a", None, "unresolved")]), schema)
    with pytest.raises(ValueError):
        gate.approved(path)
    with pytest.raises(ValueError):
        gate.approve(path, "0" * 64)
    with pytest.raises(ValueError):
        gate.approve(path, state["digest"])
    gate.approve(path, state["digest"], {"t.a": {"strategy": "null"}}, ["t.a"])
    assert gate.approved(path).columns[0].confirmed


def test_detection_rules():
    assert detect.detect("mail", "string", ["a@b.ru", "c@d.org"], 2)[0] == "email"
    assert detect.detect("birth_date", "date", ["1990-01-01"], 1)[0] == "birth_date"
    assert detect.detect("x", "string", [], 0) == (None, 0.0)
    assert detect.detect("addr", "string", ["Тверь, ул. Мира, д. 5"], 1)[0] == "address"


def test_reports_escape():
    found = [verify.Check("a|b", "<x>", "passed"), verify.Check("c", "d", "skipped")]
    assert "a\\|b" in report.checks(found) and "&lt;x&gt;" in report.page("t", found, {"t.c": [("<", ">")]}, {"keep": 1})
    assert not verify.ok(found) and verify.ok(found[:1])


def test_probes(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "id long, v string")
    assert verify.same_value(a.where("id = 1"), a, ["id"], "v", "v").result == "passed" and verify.same_value(a, a, ["id"], "v", "v").result == "failed"
    assert verify.consistent(a, "id", 2, "v", [(a, "v")])[0].result == "skipped" and verify.consistent(a, "id", 1, "v", [(a, "v")])[0].result == "passed"
    found = spark.createDataFrame([("t", "a", "inn"), ("t", "b", "inn")], "tbl string, col string, sem_type string")
    row = verify.classifier_metrics(found, found.where("col = 'a'")).first()
    assert (row["tp"], row["fp"], row["fn"], row["precision"], row["recall"]) == (1, 1, 0, 0.5, 1.0)
    assert verify.degraded(spark.createDataFrame([], "n_degraded long"), None).result == "failed"


def _run_all(spark, tmp_path, monkeypatch, capsys, config, rows="200"):
    monkeypatch.setenv("MASTER_SALT", "secret")
    path = lambda x: str(tmp_path / x)
    (tmp_path / "config.json").write_text(json.dumps(config, ensure_ascii=False))
    common = ["--source", path("in"), "--gate", path("gate.json"), "--config", path("config.json"), "--work", path("work")]
    assert cli.main(["plan", *common], spark) == 2
    print(gate.load(path("gate.json"))["wrong"])
    assert cli.main(["approve", *common, "--seen", gate.load(path("gate.json"))["digest"]], spark) == 0, capsys.readouterr().out
    capsys.readouterr()
    assert cli.main(["run", *common], spark) == 0
    return common, capsys.readouterr().out.strip().splitlines()[-1], path


def test_commands_end_to_end(spark, tmp_path, monkeypatch, capsys):
    demo.write(spark, str(tmp_path / "in"), 120)
    config = {"keys": demo.KEYS, "links": demo.LINKS, "soft_links": demo.SOFT, "unique": demo.UNIQUE, "overrides": demo.OVERRIDES}
    common, name, path = _run_all(spark, tmp_path, monkeypatch, capsys, config)
    person, before = (spark.read.parquet(path(x)) for x in (f"work/{name}/copy/person", "in/person"))
    assert person.count() == 120 and person.agg(F.sum("salary")).first()[0] == before.agg(F.sum("salary")).first()[0]
    assert person.select("tab_no").distinct().count() == 120 and person.where("length(tab_no) not in (6, 7)").count() == 0
    with pytest.raises(ValueError):
        cli.main(["publish", *common, "--run-name", name, "--to", path("out")], spark)
    assert cli.main(["verify", *common, "--run-name", name], spark) == 0, capsys.readouterr().out
    assert spark.read.parquet(path(f"work/{name}/checksums")).where("tbl = 'person' and col = 'inn'").count() == 1
    assert "| correlation |" in "\n".join(r[0] for r in spark.read.text(path(f"work/{name}/report")).collect())
    assert cli.main(["publish", *common, "--run-name", name, "--to", path("out")], spark) == 0
    assert spark.read.parquet(path("out/ticket")).where("body rlike 'canary|000-11-22|Ястребинск'").count() == 0
    with pytest.raises(FileExistsError):
        cli.main(["publish", *common, "--run-name", name, "--to", path("out")], spark)
    assert cli.main(["restore", *common, "--run-name", name, "--to", path("db")], spark) == 0
    assert cli.main(["restore", *common, "--run-name", name, "--to", path("db")], spark) == 0
    assert spark.read.parquet(path("db/payroll")).count() == 480 and spark.read.parquet(path("db/_notes")).where("key is null").count() == 0
    assert cli.main(["report", *common, "--run-name", name, "--out", path("r.html"), "--samples"], spark) == 0
    assert "person.last_name" in (tmp_path / "r.html").read_text()
    # another approved plan can't publish this run
    state = gate.load(path("gate.json"))
    other = Plan.load(state["plan"])
    other.columns[0].reason = "changed"
    (tmp_path / "gate.json").write_text(json.dumps(state | {"plan": other.dump()}))
    with pytest.raises(ValueError, match="another plan"):
        cli.main(["publish", *common, "--run-name", name, "--to", path("out2")], spark)


def test_dump_to_dump(spark, tmp_path, monkeypatch, capsys):
    df = spark.createDataFrame([(1, "Иванов Пётр Ильич", "a@b.ru"), (2, None, "c\\td@e.org")], "id long, fio string, mail string")
    (tmp_path / "toc.txt").write_text("; listing\n7; 0 1 TABLE DATA hr person owner\n")
    dump.write_copy(df, str(tmp_path / "in/7.dat.gz"))
    config = {
        "keys": {"hr.person": ["id"]}, "dump": {"listing": str(tmp_path / "toc.txt"), "schemas": {"hr.person": "id long, fio string, mail string"}},
        "overrides": {"hr.person.fio": {"sem_type": "fio_full", "strategy": "fake"}, "hr.person.mail": {"sem_type": "email", "strategy": "generate"}},
    }
    _, name, path = _run_all(spark, tmp_path, monkeypatch, capsys, config)
    back = dump.read_copy(spark, path(f"work/{name}/dump/7.dat.gz"), df.schema).orderBy("id").collect()
    assert len(back) == 2 and len(back[0]["fio"].split()) == 3 and back[1]["fio"] is None and all("@example." in r["mail"] for r in back)
    with pytest.raises(ValueError, match="lacks"):
        dump.rewrite({"hr.other": df}, {7: "hr.person"}, path("x"))


def test_linked_columns_move_together(spark):
    t = demo.tables(spark, 300)
    classes = [{"person.id", "payroll.person_id"}]
    person = dataset.shuffled(t["person"], ["id"], ["salary"], "person", classes, "s")
    payroll = dataset.shuffled(t["payroll"], ["id"], ["amount"], "payroll", classes, "s")
    assert dataset.entity_column(classes, "payroll", "id") == ("person_id", "payroll.person_id|person.id")
    assert verify.correlation(person, payroll, "id", "person_id", "salary", "amount") > 0.99
    assert sorted(r[0] for r in person.select("salary").collect()) == sorted(r[0] for r in t["person"].select("salary").collect())
    alone = dataset.shuffled(t["payroll"], ["id"], ["amount"], "payroll", [], "s")
    assert abs(verify.correlation(person, alone, "id", "person_id", "salary", "amount")) < 0.5
    with pytest.raises(ValueError, match="one column"):
        dataset.shuffled(t["contract_item"], ["contract_id", "item_no"], ["quantity"], "contract_item", [], "s")


def test_model_answers_are_read_with_care(tmp_path, monkeypatch):
    assert model.first_json('<think>{"a": 1}</think> Sure: ```json\n[["t.a", "inn", 0.9], ["b", null, 0]]\n``` {"x": 2}') == [["t.a", "inn", 0.9], ["b", None, 0]]
    with pytest.raises(model.Unavailable):
        model.first_json("no json")
    meta = {f"t.c{i}": {} for i in range(25)} | {"u.c1": {}}
    asked = []

    def ask(prompt, system):
        asked.append(prompt)
        return json.dumps([{"column": "t.c2", "type": "inn", "confidence": 0.9}, {"c3": ["snils", 7]}, ["c4", "nonsense", 0.5], {"c1": ["inn", 1]}, {"t.c5": ["email", "high"]}])

    got = model.cached_votes(str(tmp_path / "v.json"), meta, {"inn", "snils", "email"}, ask)
    assert got["t.c2"] == ("inn", 0.9) and got["t.c4"] == (None, 0.0) and "t.c3" not in got and "t.c5" not in got and len(asked) == 2
    assert model.cached_votes(str(tmp_path / "v.json"), meta, {"inn"}) == got | {}
    assert model.renames(lambda p, s: '{"a": "x", "b": "x", "c": "c", "zz": "y"}', ["a", "b", "c"]) == {"a": "x"}
    right = lambda p, s: "yes" if model.ACCEPTANCE.get(p.splitlines()[-1], p.splitlines()[-1] == "пётр иванов") else "No."
    path = str(tmp_path / "n.json")
    assert model.cached_verdicts(path, ["пётр иванов", "красный цех"], right) == {"пётр иванов": True, "красный цех": False}
    assert model.cached_verdicts(path, ["пётр иванов", "new one"]) == {"пётр иванов": True}
    assert model.cached_verdicts(None, ["x"], lambda p, s: "yes") == {}
    with pytest.raises(model.Unavailable):
        model.cached_verdicts(None, ["x"], model.Client("openai", "m"))
    assert model.Client("ollama", "m").local and not model.Client("openai", "m").local
    monkeypatch.delenv("LLM_PROVIDER", raising=False)
    assert model.from_environment() is None


def test_draft_takes_votes_classes_and_json(spark, tmp_path):
    a = spark.createDataFrame([(i, f"v{i}", '{"k": 1, "m": "x"}') for i in range(30)], "id long, code string, props string")
    b = spark.createDataFrame([(i, i % 30, f"v{i % 30}") for i in range(60)], "id long, a_id long, code string")
    (tmp_path / "votes.json").write_text(json.dumps({"a.code": ["person_id", 0.95], "b.code": [None, 0.0]}))
    config = {"keys": {"a": ["id"], "b": ["id"]}, "votes": str(tmp_path / "votes.json"), "links": [["b", ["a_id"], "a", ["id"]]], "soft_links": [["a", "code", "b", "code"]], "json": {"a.props": {"k": "keep"}}}
    plan, seen = cli.draft({"a": a, "b": b}, config)
    by = {f"{x.table}.{x.column}": x for x in plan.columns}
    assert by["a.code"].strategy == "unresolved" or by["a.code"].strategy == "generate"
    assert by["a.props"].strategy == "unresolved" and "m" in by["a.props"].reason and by["b.a_id"].strategy == "keep"
    assert ["a.code", "b.code"] in plan.classes and by["b.code"].strategy == "unresolved"
    back = snapshot.Snapshot.from_json(seen.to_json(samples=True))
    assert back == seen and back.col("a.props").json_keys == ["k", "m"] and snapshot.Snapshot.from_json(seen.to_json()).col("a.code").samples == []
    with pytest.raises(KeyError):
        back.col("a.none")
    assert cli.draft({"a": a, "b": b}, config | {"json": {"a.props": {"k": "keep", "m": "keep"}}}, seen)[0].columns[-1] is not None
    found, _ = cli.draft({"a": a, "b": b.drop("code")}, {"discover": True})
    assert found.keys == {"a": ["code"], "b": ["id"]} and found.classes == []
    found, _ = cli.draft({"a": a.drop("code"), "b": b.drop("code")}, {"discover": True})
    assert found.keys == {"a": ["id"], "b": ["id"]} and found.classes == [["a.id", "b.a_id"]]
    odd = spark.createDataFrame([(1, "x@y.ru")], "`i``d` long, `e``mail` string")
    assert [r["col"] for r in dataset.profile(odd, "t").orderBy("col").collect()] == ["e`mail", "i`d"] and dataset.entropies(odd, ["e`mail"]) == {"e`mail": (0.0, 1)}
    assert dataset.candidate_keys(dataset.profile(a, "a")) == {"a": ["code", "id"]}
    assert dataset.links_found({"a": a, "b": b}, {"a": ["id"]}) == [("b", ["a_id"], "a", ["id"])]


def test_entropy_ceiling():
    assert verify.ceiling(1, 100) == 0 and verify.ceiling(10**6, 4) == pytest.approx(2, abs=1e-3)
