import re

from pyspark.sql import functions as F

from palimpsest.functions import columns as c
from palimpsest.operators import text
from palimpsest.plans.plan import Plan, PlanColumn
from palimpsest.sources import corpus

CORPORA = corpus.build(corpus.COMPONENTS)


def test_lemma_and_marks():
    assert {text.family_lemma(x) for x in ("Смирнов", "Смирнова", "Смирновой", "Смирновым")} == {"смирнов"}
    assert text.family_lemma("Достоевскую") == "достоевский"
    assert text.is_patronymic("Петровичем") and not text.is_family("Петрович") and text.is_family("Шевченко")
    assert text.in_names("Анной", {"анна"}) and not text.in_names("Столом", {"анна"})


def test_names_in_text_agree_with_columns(spark):
    df = spark.createDataFrame([("Смирнова", "Елена", "Игоревна")], "f string, n string, p string")
    row = df.select(c.fake_fio("s", CORPORA, "f", "n", "p").alias("x")).first()["x"]
    out, notes = text.Sanitizer("s", CORPORA).sanitize("Звонила Смирнова Елена Игоревна, потом Смирнова Е.И. ушла")
    assert f"{row['family']} {row['name']} {row['patronymic']}" in out
    assert notes == ["person", "initials"] and "Смирнова" not in out
    assert re.search(rf"{row['family']} \w\.\w\. ушла", out)
    short = df.select(c.fake_initials("s", CORPORA, "f", "n", "p").alias("x")).first()["x"].split()
    assert f"{short[0]} {short[1]}{short[2]} ушла" in out


def test_half_known_words_wait_for_a_verdict(spark):
    df = spark.createDataFrame([("Пришёл Смирнов Казимир вчера",), ("Красная Площадь",), (None,), ("",)], "t string")
    assert [r["fragment"] for r in text.undecided(df, "t", CORPORA).collect()] == ["смирнов казимир"]
    run = lambda verdicts: [r["x"] for r in df.select(text.sanitize_text(F.col("t"), "s", CORPORA, verdicts=verdicts).alias("x")).collect()]
    none, yes, no = run({}), run({"смирнов казимир": True}), run({"смирнов казимир": False})
    assert none[0]["text"] == "Пришёл Смирнов Казимир вчера" and none[0]["notes"] == [text.LOW_CONFIDENCE]
    assert "Казимир" not in yes[0]["text"] and yes[0]["notes"] == ["person"] and no[0]["notes"] == []
    assert none[1]["text"] == "Красная Площадь" and none[2]["text"] is None and none[3]["text"] == ""


def test_table_pass_cuts_addresses_and_notes(spark):
    df = spark.createDataFrame([(1, "пишите a.b@mail.ru", "где-то на углу"), (2, None, None)], "id long, t string, a string")
    plan = Plan("", [PlanColumn("x", "id", "technical", "keep"), PlanColumn("x", "t", "free_text", "freetext", length_policy="truncate", max_length=10), PlanColumn("x", "a", "address", "freetext")])
    rows = text.sanitize_table(df, plan, "x", "s", CORPORA).orderBy("id").collect()
    assert len(rows[0]["t"]) == 10 and rows[0]["_notes"] == ["t:email", "t:truncated"] and "ул." in rows[0]["a"]
    assert rows[1]["t"] is None and rows[1]["a"] is None and rows[1]["_notes"] == []
