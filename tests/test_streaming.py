import pytest

from palimpsest.operators import dataset
from palimpsest.plans.plan import Plan, PlanColumn
from palimpsest.sources import corpus
from palimpsest.streaming.apply import pseudonymise_stream, sanitise_stream

CORPORA = corpus.build(corpus.COMPONENTS)


def test_stream_equals_batch_and_refuses_shuffles(spark, tmp_path):
    spark.createDataFrame([(1, "5551234567"), (2, None)], "id long, tel string").write.parquet(str(tmp_path / "in"))
    plan = Plan("", [PlanColumn("t", "id", "technical", "keep"), PlanColumn("t", "tel", "phone", "fake")])
    stream = spark.readStream.schema("id long, tel string").parquet(str(tmp_path / "in"))
    q = pseudonymise_stream(stream, plan, "t", "s", CORPORA).writeStream.format("memory").queryName("fakes").start()
    q.processAllAvailable()
    q.stop()
    rows = {r["id"]: r["tel"] for r in spark.sql("select * from fakes").collect()}
    assert rows[2] is None and rows[1].startswith("+7") and rows[1] != "+75551234567"
    plan.columns[0].strategy = "shuffle"
    with pytest.raises(ValueError):
        pseudonymise_stream(stream, plan, "t", "s", CORPORA)


def test_maps_and_texts_on_a_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "АО Север", "тел. +7 (903) 123-45-67"), (2, "ООО Юг", None)], "id long, firm string, note string")
    df.write.parquet(str(tmp_path / "in"))
    plan = Plan("", [PlanColumn("t", "id", "technical", "keep"), PlanColumn("t", "firm", "org_name", "direct"), PlanColumn("t", "note", "free_text", "freetext")])
    firms = dataset.direct_map(df, "firm", CORPORA["org"], "s")
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = sanitise_stream(stream, plan, "t", "s", CORPORA, maps={"firm": firms}).writeStream.format("memory").queryName("both").start()
    q.processAllAvailable()
    q.stop()
    rows = {r["id"]: r for r in spark.sql("select * from both").collect()}
    assert {r["firm"] for r in rows.values()} == {r["fake"] for r in firms.collect()} and rows[1]["_notes"] == ["note:phone"] and "123-45-67" not in rows[1]["note"] and rows[2]["note"] is None
    with pytest.raises(ValueError):
        sanitise_stream(stream, plan, "t", "s", CORPORA)
