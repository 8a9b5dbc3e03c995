import json
import os
import pathlib
import re
import shutil
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from palimpsest.functions import columns as c
from palimpsest.functions import notation
from palimpsest.operators import dataset, text
from palimpsest.plans import registry
from palimpsest.plans.plan import Plan, PlanColumn, apply_overrides, assign, compile_table, inherit, plan_diff, schema_fingerprint, validate_plan
from palimpsest.sources import corpus

SF = "/root/testdata/sf0.001"
CORPORA = corpus.build(corpus.COMPONENTS)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in registry.TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(registry.ORACLE[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    text_of = lambda x: "" if x is None or x != x else str(x)
    rows = lambda df: sorted(tuple(map(text_of, r)) for r in df[cols].itertuples(index=False))
    assert rows(got) == rows(want)


def test_permutation_is_a_bijection_and_has_a_python_twin(spark):
    rows = spark.range(1000).select("id", c.fpe("s", "x", "id", 3).alias("y")).collect()
    assert sorted(r["y"] for r in rows) == list(range(1000))
    assert all(c.fpe_value("s", "x", r["id"], 3) == r["y"] for r in rows)


def test_generated_identifiers_are_valid(spark):
    df = spark.range(200).select(F.rpad(F.lpad(F.col("id").cast("string"), 8, "0"), 12, "1").alias("x"))
    out = df.select(c.gen_inn("s", "x").alias("inn"), c.gen_luhn_like("s", "concat(x, '0000')").alias("card"))
    rows = out.collect()
    assert all(text.inn_ok(r["inn"]) and text.luhn_ok(r["card"]) for r in rows)
    assert len({r["inn"] for r in rows}) == 200
    back = spark.createDataFrame(rows)
    assert back.where(~c.valid_inn("inn") | ~c.luhn_ok("card")).count() == 0


def test_text_agrees_with_columns(spark):
    s = text.Sanitizer("s", CORPORA)
    inn = text.replace_identifier("s", "0000000138")
    assert text.inn_ok("0000000138") and text.inn_ok(inn)
    assert spark.range(1).select(c.gen_inn("s", "'0000000138'").alias("x")).first()["x"] == inn
    new, notes = s.sanitize("a\\tb mail x.y+z@example.com, tel +7 (903) 123-45-67, 1234 567890")
    assert notes == ["email", "phone", "passport"] and "x.y" not in new and new.startswith("a\\tb mail ")
    assert s.sanitize("nothing 12345")[0] == "nothing 12345"
    got = spark.createDataFrame([(None,), ("",)], "t string").select(text.sanitize_text(F.col("t"), "s", CORPORA).alias("r")).collect()
    assert [r["r"]["text"] for r in got] == [None, ""]


def test_ring_and_shuffle(spark):
    ids = spark.range(50).select(F.col("id"))
    ring = {r["id"]: r["donor"] for r in dataset.ring(ids, "s").collect()}
    at, seen = 0, set()
    while at not in seen:
        seen.add(at)
        at = ring[at]
    assert len(seen) == 50
    df = spark.range(50).select("id", F.col("id").alias("e"), (F.col("id") * 2).alias("x"))
    out = dataset.shuffle_column(df, "id", "e", "x", "s")
    assert sorted(r["value"] for r in out.collect()) == [2 * i for i in range(50)]
    assert out.where("value = id * 2").count() == 0


def test_an_entity_with_most_rows_is_numbered_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(dataset, "HOT_ROWS", 20)
    monkeypatch.setattr(dataset, "HOT_PIECES", 8)
    df = spark.range(400).select("id", F.when(F.col("id") < 250, F.lit(0)).otherwise(F.col("id") % 30).alias("e"), (F.col("id") * 3).alias("x"))
    rows = dataset.numbered(df.select(F.col("id").alias("k"), "e")).collect()
    by = {}
    for r in rows:
        by.setdefault(r["e"], []).append(r["i"])
    assert len(rows) == 400 and all(sorted(v) == list(range(1, len(v) + 1)) for v in by.values()) and len(by[0]) >= 250
    out = dataset.shuffle_column(df, "id", "e", "x", "s")
    assert out.count() == 400 and out.where("value is null").count() == 0


def test_direct_map_is_injective(spark):
    df = spark.range(60).select(F.concat(F.lit("firm "), F.col("id")).alias("v"))
    m = dataset.direct_map(df, "v", CORPORA["org"], "s")
    assert m.count() == m.select("fake").distinct().count() == 60
    with pytest.raises(ValueError):
        dataset.direct_map(df, "v", CORPORA["org"], "s", limit=10)


def test_plan_round_trip_validation_and_compilation(spark):
    df = spark.createDataFrame([(1, "Иванова", "Анна", None, "5551234567"), (2, None, "Пётр", "Ильич", None)], "id long, f string, n string, p string, tel string")
    schema = [("t", x, df.schema[x].dataType.simpleString()) for x in df.columns]
    plan = Plan(schema_fingerprint(schema), [PlanColumn("t", "id", "technical", "keep"), PlanColumn("t", "f", "family", "fake"), PlanColumn("t", "n", "name", "fake"), PlanColumn("t", "p", "patronymic", "fake"), PlanColumn("t", "tel", "phone", "fake")])
    assert Plan.load(plan.dump()) == Plan(plan.fingerprint, sorted(plan.columns, key=lambda x: x.column), plan.params)
    assert validate_plan(plan, schema) == [] and validate_plan(plan, schema[:-1])
    rows = compile_table(df, plan, "t", "s", CORPORA).orderBy("id").collect()
    assert rows[0]["f"].endswith("а") and rows[0]["p"] is None and rows[1]["f"] is None and rows[1]["tel"] is None
    assert rows[0]["tel"].startswith("+7") and rows[0]["n"].lower() in CORPORA["name_f"] and rows[1]["n"].lower() in CORPORA["name_m"]
    other = Plan.load(plan.dump())
    apply_overrides(other, {"t.tel": {"strategy": "null"}})
    assert plan_diff(plan, other) == {"added": [], "removed": [], "changed": ["t.tel"]}
    assert any("confirmation" in x for x in validate_plan(other, schema))
    with pytest.raises(ValueError):
        apply_overrides(other, {"t.tel": {"confirmed": True}})
    with pytest.raises(ValueError):
        compile_table(df.withColumn("z", F.lit(1)), plan, "t", "s", CORPORA)


def test_assign_rules():
    kw = {"unique": False, "primary_key": False, "cardinality": 5}
    assert assign({}, None, **kw)[0] == "unresolved"
    assert assign({}, "city", **kw)[0] == "keep"
    assert assign({}, "inn", unique=True, primary_key=False, cardinality=5)[0] == "generate"
    assert assign({}, "phone", unique=True, primary_key=False, cardinality=5)[0] == "unresolved"
    assert assign({"json": True}, "free_text", **kw)[0] == "unresolved"
    assert dataset.classify("x_id", (None, 0), (None, 0)) == ("technical", "surrogate")
    assert dataset.classify("x", ("inn", 0.95), ("phone", 0.9)) == (None, "disagreement")


def test_checks_find_planted_faults(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string")
    bad = spark.createDataFrame([(1, "a"), (2, "c")], "k long, v string")
    row = dataset.unchanged(src, bad, ["k"], "v").first()
    assert (row["equal_values"], row["missing"]) == (1, 1)
    assert dataset.shared_values(src, bad, "v").count() == 1
    ids = spark.createDataFrame([("1234567890",)], "x string")
    leak = spark.createDataFrame([("call 123-456-78 90 11",), ("none 12",)], "t string")
    assert dataset.leaked_identifiers(ids, leak, "t").collect()[0]["n"] == 1
    assert dataset.orphans(src, ["k"], bad, ["k"]).count() == 1
    assert [r["x"] for r in dataset.canaries(spark.createDataFrame([("A",), ("z%",)], "x string"), src, ["v"]).collect()] == ["A"]
    assert dataset.checksum(src, ["k"], "v") != dataset.checksum(bad, ["k"], "v")
    assert dataset.entropy(spark.range(4).withColumn("g", F.col("id") % 2), "g") == 1.0


def test_identifiers_side_by_side_are_found(spark):
    a, b, c10 = "123456789012", "210987654321", "5556667778"
    ids = spark.createDataFrame([(a,), (b,), (c10,), ("123456789",), ("999999999999",)], "x string")
    found = lambda *texts: {r["x"]: r["n"] for r in dataset.leaked_identifiers(ids, spark.createDataFrame([(t,) for t in texts], "t string"), "t").collect()}
    assert found(f"{a} {b}") == {a: 1, b: 1, "123456789": 1}
    assert found(f"{c10}-{a} / ({b})", None, "") == {a: 1, b: 1, c10: 1, "123456789": 1}
    assert found("7" * 60 + b + "7" * 60) == {b: 1}
    assert found("no. 123456789, none") == {"123456789": 1}


def test_numbers_of_all_widths(spark):
    keys = [0, 9, *(10**w for w in range(1, 38)), *(10**w - 1 for w in range(2, 39))]
    df = spark.createDataFrame([(str(k),) for k in [*keys, *keys]] + [(None,)], "x string")
    got = {r["x"]: r["y"] for r in df.select("x", c.gen_int_like("s", "x").alias("y")).collect()}
    assert got.pop(None) is None and sorted(got) == sorted(map(str, keys)) and all(len(k) == len(v) and v == c.gen_int_like_value("s", k) for k, v in got.items())
    assert spark.range(1000).select(c.gen_int_like("s", "id").alias("y")).distinct().count() == 1000
    for bad in ("012", "-5", "x1", "1" * 39):
        with pytest.raises(Exception, match="gen_int_like|more than 38"):
            spark.createDataFrame([(bad,)], "x string").select(c.gen_int_like("s", "x")).collect()
    text_ = [f"a-{k}/b" for k in map(str, keys)]
    for r in spark.createDataFrame([(t,) for t in text_], "x string").select("x", c.gen_digits_like("s", "x").alias("y"), c.gen_luhn_like("s", "concat('1', x)").alias("z")).collect():
        n = r["x"][2:-2]
        assert r["y"] == f"a-{str(c.fpe_value('s', f'digits{len(n)}', int(n), len(n))).zfill(len(n))}/b"
        assert text.luhn_sum(r["z"][:-1]) % 10 == (10 - int(r["z"][-1])) % 10 and len(r["z"]) == len(n) + 1
    for make in (c.gen_digits_like, c.gen_luhn_like):
        with pytest.raises(Exception, match="more than 38"):
            spark.range(1).select(make("s", "repeat('1', 40)")).collect()


def test_a_plan_replaces_identifiers_alike_everywhere(spark):
    js = '{"inn": 7707083893, "fio": "Иванова Анна", "n": 5, "x": "drop", "z": null, "o": {"a": [1, 2.5]}, "q\\"k": "v"}'
    df = spark.createDataFrame([(1, js, "7707083893", "4501", "123456", 10, "a"), (2, None, None, "12", None, 11, None)], "id long, js string, inn string, doc_series string, doc_number string, pid int, `od``d` string")
    fields = {"inn": "inn", "fio": "fio_full", "n": "keep", "o": "keep", "z": "inn", 'q"k': "keep"}
    kinds = {"id": ("technical", "keep"), "js": ("free_text", "jsonb"), "inn": ("inn", "generate"), "doc_series": ("passport", "generate"), "doc_number": ("passport", "generate"), "pid": ("person_id", "generate"), "od`d": ("technical", "keep")}
    schema = [("t", f.name, f.dataType.simpleString()) for f in df.schema]
    plan = Plan(schema_fingerprint(schema), [PlanColumn("t", n, *k, json_fields=fields if n == "js" else {}) for n, k in kinds.items()])
    assert validate_plan(plan, schema) == []
    out = compile_table(df, plan, "t", "VERYSECRET", CORPORA)
    one, two = out.orderBy("id").collect()
    new = json.loads(one["js"])
    assert new["inn"] == one["inn"] != "7707083893" and (new["n"], new["x"], new["z"], new["o"], new['q"k']) == (5, None, None, {"a": [1, 2.5]}, "v") and list(new) == list(json.loads(js))
    assert new["fio"] == " ".join(spark.range(1).select(c.fake_fio("VERYSECRET", CORPORA, "'Иванова'", "'Анна'", "cast(null as string)").alias("f")).first()["f"][:2])
    assert f"{one['doc_series']} {one['doc_number']}" in text.Sanitizer("VERYSECRET", CORPORA).sanitize("паспорт 4501 123456")[0]
    assert two["js"] is None and two["doc_number"] is None and len(two["doc_series"]) == 2 and len(str(two["pid"])) == 2 and one["od`d"] == "a"
    assert "VERYSECRET" not in out._jdf.queryExecution().toString()
    with pytest.raises(Exception, match="not a JSON object"):
        compile_table(df.withColumn("js", F.lit("[1]")), plan, "t", "s", CORPORA).collect()
    ids = spark.range(1000).select("id", F.col("id").alias("pid"))
    own = Plan("", [PlanColumn("t", "id", "technical", "keep"), PlanColumn("t", "pid", "person_id", "generate")])
    assert compile_table(ids, own, "t", "s", CORPORA).select("pid").distinct().count() == 1000


def test_classes_share_a_strategy():
    make = lambda: [PlanColumn("a", "x", "inn", "generate"), PlanColumn("b", "x", "inn", "keep"), PlanColumn("c", "x", "phone", "fake"), PlanColumn("d", "id", "technical", "keep")]
    assert [x.strategy for x in inherit(make(), [{"a.x", "b.x", "d.id"}])] == ["generate", "generate", "fake", "keep"]
    assert [x.strategy for x in inherit(make(), [{"a.x", "c.x"}])] == ["unresolved", "keep", "unresolved", "keep"]
    assert assign({"json": True, "json_keys": ["a", "b"]}, "free_text", unique=False, primary_key=False, cardinality=1, json_map={"a": "keep"})[1].endswith("['b']")
    assert assign({}, "org_name", unique=False, primary_key=False, cardinality=50, params={"direct_threshold": 10})[0] == "fake"


def test_one_to_one_maps_do_not_hang_on_other_values(spark):
    df = spark.range(60).select(F.concat(F.lit("firm "), F.col("id")).alias("v"))
    few, all_ = ({r["v"]: r["fake"] for r in dataset.direct_map(x, "v", CORPORA["org"], "s").collect()} for x in (df.limit(20), df))
    assert all(all_[k] == v for k, v in few.items())
    told = {r["v"]: r["fake"] for r in dataset.direct_map(df, "v", CORPORA["org"], "s", answers={"firm 1": "New", "firm 2": "New", "firm 3": "firm 3", "firm 4": " ", "other": "x"}).collect()}
    assert told["firm 1"] == "New" and all(told[k] == all_[k] for k in told if k != "firm 1")


def test_forms_of_numbers():
    found = lambda t: [m[0] for m in notation.identifiers(t)]
    assert found("снилс 123-456-789 64, 12345  678901234567 +7 903 1234567890") == ["123-456-789 64", "678901234567", "903 1234567890"]
    assert found("12345 12345 12345 12345 12345") == ["12345 12345 12345", "12345 12345"] and found("123456789") == found("1" * 20) == []
    for good in ("+7 (903) 123-45-67", "8\t903\u00a0123 45 67", "79031234567"):
        assert notation.PHONE.fullmatch(good)
    assert not notation.PHONE.search("179031234567") and not notation.PHONE.search("+7 903 123-45-678")
    assert notation.is_address("Тверская область, г. Ржев, ул. Садовая, д. 5") and not notation.is_address("мск, Ленина 5, спросить Иванова")
    s = text.Sanitizer("s", CORPORA)
    ten = "8" + "".join(x for x in "9504206118")
    assert s.sanitize(f"{ten[0]} {ten[1:4]} {ten[4:7]} {ten[7:9]} {ten[9:]}")[1] == ["phone"]


def test_registry_scans_whole_texts(spark, tmp_path):
    def put(table, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{table}.parquet")

    put("documents", [(1, "see A short passage, and 12 000000001 000000002 3"), (2, "plain words, 12"), (3, None)], "doc_id long, text string")
    put("conversations", [(1, "id 000000003.")], "conv_id long, text string")
    put("benchmark", [(1, "a short passage"), (2, "not there"), (3, None)], "item_id long, text string")
    put("customer", [(i, f"Customer#{i:09d}") for i in range(1, 6)] + [(6, None)], "c_custkey long, c_name string")
    run = lambda name: [tuple(r) for r in registry.QUERIES[name](spark, str(tmp_path)).collect()]
    assert run("canary_search") == [(1,)]
    assert run("identifier_leak") == [(3,)]
    assert run("addr_parse_ratio") == [(0.5,)]


def test_the_rest_works_without_the_corpus_folders(tmp_path):
    root = pathlib.Path(__file__).parent.parent
    for name in ("palimpsest", "tests"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "bench.py"):
        shutil.copy(root / name, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(x.startswith('op') and x[2].isdigit() for x in q), set(e.oracle_sql()) <= set(q))"
    for gone in ((), ("corpus_pipeline.py",)):
        for name in gone:
            (tmp_path / name).unlink()
        said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
        assert said.stdout.split() == [str(len(registry.QUERIES)), "False", "False", "True"], said.stderr


def test_corpus_validation():
    assert corpus.validate(CORPORA) == []
    assert corpus.validate({"phone_code": ["12", "12"]}, {"phone_code": 1})
    with pytest.raises(ValueError):
        corpus.build({})


def test_entry_point():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["sanitize_planted", "sanitize_names", "sanitize_documents"])
def test_text_pass_over_one_row_group_is_dealt_out(spark, name):
    made = registry.QUERIES[name](spark, SF).groupBy(F.spark_partition_id()).count().collect()  # one file of one row group
    assert len(made) == 8 and max(r["count"] for r in made) < sum(r["count"] for r in made) / 3


def test_text_pass_over_a_table_is_dealt_out(spark):
    df = spark.range(400, numPartitions=1).select("id", F.lit("почта a@b.ru").alias("t"), F.create_map(F.lit("k"), "id").alias("m"))
    plan = Plan("", [PlanColumn("x", "id", "technical", "keep"), PlanColumn("x", "t", "free_text", "freetext"), PlanColumn("x", "m", "technical", "keep")])
    out = text.sanitize_table(df, plan, "x", "s", CORPORA)
    made = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(made) == 8 and sum(r["count"] for r in made) == 400 and max(r["count"] for r in made) < 100
    assert out.where("_notes <> array('t:email')").count() == 0


def test_profile_in_pieces_is_the_same_and_reads_once(spark, monkeypatch):
    few = F.when(F.col("id") % 3 != 0, F.col("id") % 7)
    df = spark.range(3000, numPartitions=1).select("id", few.alias("few"), F.lit("x").alias("one"), F.when(F.col("id") < 0, "").alias("none"), F.when(F.col("id") < 30, F.lit('{"a":1}')).alias("j"))
    rows = lambda: sorted(map(str, dataset.profile(df, "t").collect()))
    whole = rows()
    monkeypatch.setattr(dataset, "CELLS", 1000)
    assert rows() == whole and any("col='id', type='bigint', n=3000, n_distinct=3000" in x for x in whole)
    out = dataset.profile(df, "t")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    assert re.search(r"hashpartitioning\(p#\d+L?, 15\)", plan) and re.search(r"hashpartitioning\(i#\d+, v#\d+, 15\)", plan)  # 15,000 cells
    assert plan.count("Range (") == 1 and "ReusedExchange" in plan and "WindowGroupLimit" in plan
