"""Every check of a copy fails on its own planted fault and on no other copy; properties of the text pass."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.functions import columns as c
from palimpsest.functions import notation
from palimpsest.operators import dataset, text, verify
from palimpsest.plans.plan import Plan, PlanColumn, compile_table
from palimpsest.sources import corpus

CORPORA = corpus.build(corpus.COMPONENTS)
KEYS = {"p": ["id"], "n": ["id"]}
LINKS = [("n", ["p_id"], "p", ["id"])]
MANIFEST = {
    "identity": {"table": "p", "key": "id", "value": 1, "column": "fam"}, "occurrences": [{"table": "n", "column": "body"}], "preserved": [{"table": "n", "columns": ["body"], "fragment": "C:\\new"}],
    "soft_links": [{"left": "p", "a": "inn", "right": "n", "b": "inn"}], "correlated": [{"left": "p", "key": "id", "a": "pay", "right": "n", "by": "p_id", "b": "paid"}],
}
PLAN = Plan("", [
    PlanColumn("p", "id", "technical", "keep"), PlanColumn("p", "fam", "family", "fake"), PlanColumn("p", "inn", "inn", "generate"), PlanColumn("p", "pay", "salary", "shuffle"),
    PlanColumn("n", "id", "technical", "keep"), PlanColumn("n", "p_id", "technical", "keep"), PlanColumn("n", "inn", "inn", "generate"), PlanColumn("n", "paid", "salary", "shuffle"), PlanColumn("n", "body", "free_text", "freetext"),
])


@pytest.fixture(scope="module")
def both(spark):
    inn = c.gen_inn("seed", "rpad(lpad(cast(id as string), 9, '0'), 10, '0')")
    fam = F.initcap(F.element_at(F.array(*[F.lit(x) for x in CORPORA["family"]]), (F.col("id") % 25 + 1).cast("int")))
    p = spark.range(1, 61).select("id", fam.alias("fam"), inn.alias("inn"), (F.col("id") * 100.0).alias("pay"))
    n = p.select("id", F.col("id").alias("p_id"), "inn", (F.col("pay") / 12).alias("paid"), F.concat(F.lit("Пишет "), "fam", F.lit(" А.Б. про C:\\new, ИНН "), "inn").alias("body"))
    source = {"p": p, "n": n}
    classes = [{"p.id", "n.p_id"}]
    copy = {}
    for t, df in source.items():
        moved = dataset.shuffled(df, ["id"], [x.column for x in PLAN.of(t) if x.strategy == "shuffle"], t, classes, "s")
        copy[t] = text.sanitize_table(compile_table(moved, PLAN, t, "s", CORPORA), PLAN, t, "s", CORPORA).drop("_notes")
    return {t: spark.createDataFrame(df.collect(), df.schema) for t, df in source.items()}, {t: spark.createDataFrame(df.collect(), df.schema) for t, df in copy.items()}


def _failed(spark, source, copy, **more):
    found = verify.verify(source, copy, PLAN, KEYS, LINKS, spark.createDataFrame([("Тайный Знак",)], "x string"), CORPORA, more.get("manifest", MANIFEST))
    return {x.name for x in found if x.result != "passed"}


def test_a_good_copy_passes(spark, both):
    assert _failed(spark, *both) == set()


FAULTS = {
    "volume": lambda s, d: d | {"n": d["n"].unionByName(d["n"].where("id = 60").withColumn("id", F.lit(61).cast("long")))},
    "unique": lambda s, d: d | {"n": d["n"].withColumn("id", F.when(F.col("id") == 2, 1).otherwise(F.col("id")))},
    "replaced": lambda s, d: d | {"p": d["p"].join(s["p"].select("id", F.col("fam").alias("old")), "id").withColumn("fam", F.when(F.col("id") == 5, F.col("old")).otherwise(F.col("fam"))).select("id", "fam", "inn", "pay")},
    "keys": lambda s, d: d | {"n": d["n"].withColumn("id", F.when(F.col("id") == 2, 99).otherwise(F.col("id")))},
    "entropy": lambda s, d: d | {"p": d["p"].withColumn("fam", F.when(F.col("id") == 1, F.col("fam")).otherwise("Орлов"))},
    "link": lambda s, d: d | {"n": d["n"].withColumn("p_id", F.when(F.col("id") == 7, 700).otherwise(F.col("p_id")))},
    "leak": lambda s, d: d | {"n": d["n"].crossJoin(s["p"].where("id = 9").select(F.col("inn").alias("old"))).withColumn("body", F.when(F.col("id") == 3, F.concat(F.lit("12 "), "old")).otherwise(F.col("body"))).drop("old")},
    "canaries": lambda s, d: d | {"n": d["n"].withColumn("body", F.when(F.col("id") == 3, "тайный знак").otherwise(F.col("body")))},
    "consistency": lambda s, d: d | {"n": d["n"].withColumn("body", F.regexp_replace("body", "[А-Я][а-я]+ [А-Я][.]", "Некто."))},
    "preserved": lambda s, d: d | {"n": d["n"].withColumn("body", F.replace("body", F.lit("\\n"), F.lit("\n")))},
    "soft link": lambda s, d: d | {"n": d["n"].withColumn("inn", F.concat(F.lit("9"), F.substring("inn", 2, 9)))},
    "correlation": lambda s, d: d | {"n": d["n"].withColumn("paid", F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double"))},
}


@pytest.mark.parametrize("name", FAULTS)
def test_each_fault_is_found(spark, both, name):
    source, copy = both
    assert name in _failed(spark, source, FAULTS[name](source, copy))


def test_absent_probes_and_tables_do_not_pass(spark, both):
    source, copy = both
    assert {"consistency", "preserved", "soft link"} <= _failed(spark, source, copy, manifest={})
    assert "volume" in {x.name for x in verify.verify(source, {"p": copy["p"]}, PLAN, KEYS) if x.result == "failed"}
    assert "key" in {x.name for x in verify.verify(source, copy, PLAN, {"p": ["id"]}) if x.result == "failed"}


WORDS = st.sampled_from(["слово", "a.b@mail.ru", "+7 (903) 123-45-67", "8 903 123 45 67", "4501 123456", "серия", "112-233-445 95", "7707083893", "Иванов", "Анна", "Петровна", "Смирнова Е.И.", "12", "\t", "№ 5", "C:\\x"])


@settings(max_examples=200, deadline=None)
@given(st.lists(WORDS, max_size=12).map(" ".join))
def test_text_pass_hides_and_keeps(x):
    s = text.Sanitizer("s", CORPORA)
    out, notes = s.sanitize(x)
    assert s.sanitize(x) == (out, notes)
    for secret in ("a.b@mail.ru", "123-45-67", "112-233-445 95", "7707083893"):
        assert secret not in out
    # what is no entity stays as it is, in order
    kept = re.findall(r"слово|C:\\x|\t|№ 5", x)
    assert re.findall(r"слово|C:\\x|\t|№ 5", out) == kept


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_any_text_survives(x):
    out, notes = text.Sanitizer("s", CORPORA).sanitize(x)
    if not notes:
        assert out == x
    assert [m[0] for m in notation.identifiers(x)] == [x[m.start() : m.end()] for m in notation.identifiers(x)]


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 9_999_999), st.sampled_from(["+7 {0} {1}-{2}-{3}", "8({0}){1}{2}{3}", "7 {0} {1} {2} {3}", "+7-{0}-{1}-{2}-{3}"]))
def test_one_phone_has_one_replacement(n, form):
    d = f"{n:07d}"
    written = form.format("912", d[:3], d[3:5], d[5:])
    s = text.Sanitizer("s", CORPORA)
    digits = lambda t: re.sub(r"\D", "", t)[1:]
    plain, marked = s.sanitize(f"+7 (912) {d[:3]}-{d[3:5]}-{d[5:]}")[0], s.sanitize(written)[0]
    assert digits(marked) == digits(plain) != f"912{d}" and re.sub(r"\d", "0", marked) == re.sub(r"\d", "0", written)
