"""A relational data set of fourteen tables with hostile cases, made from row numbers alone.

Natural and composite keys, links that no schema declares, identifiers inside json
and text, dirty addresses, wide personnel numbers, backslashes, nulls, empty and
long texts, and canaries: values that no copy may hold.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import columns as c
from palimpsest.sources.corpus import COMPONENTS, build

SEED = "demo"
KEYS = {
    "region": ["id"], "department": ["id"], "position": ["id"], "person": ["id"], "address": ["id"], "document": ["id"], "contractor": ["id"], "contract": ["id"],
    "contract_item": ["contract_id", "item_no"], "shipment": ["id"], "ticket": ["id"], "comment": ["id"], "payroll": ["id"], "audit": ["id"],
}
#: Columns beside the keys whose values are all different.
UNIQUE = ["person.tab_no", "person.inn", "person.email"]
LINKS = [
    ("department", ["region_id"], "region", ["id"]), ("person", ["department_id"], "department", ["id"]), ("person", ["position_id"], "position", ["id"]),
    *[(t, ["person_id"], "person", ["id"]) for t in ("address", "document", "contract", "ticket", "payroll", "audit")],
    ("contract_item", ["contract_id"], "contract", ["id"]), ("shipment", ["contract_id", "item_no"], "contract_item", ["contract_id", "item_no"]),
    ("comment", ["ticket_id"], "ticket", ["id"]), ("comment", ["person_id"], "person", ["id"]),
]
#: A link of values that nothing declares: a contractor's tax id in its contracts.
SOFT = [("contractor", "inn", "contract", "contractor_inn")]
#: Texts that no copy may hold.
CANARIES = ["Ястребинский", "canary.person@secret-host.ru", "+7 999 000-11-22", "4501 123456", "Домофон Ястребинского"]
#: What is no personal data and must come through as it is.
PRESERVED = "C:\\share\\new\\table.pdf"
#: Types and strategies that the rules can't tell from values alone.
OVERRIDES = {
    "region.title": {"sem_type": "region", "strategy": "keep"}, "department.title": {"sem_type": "category", "strategy": "keep"}, "position.title": {"sem_type": "category", "strategy": "keep"}, "position.grade": {"sem_type": "category", "strategy": "keep"},
    "person.tab_no": {"sem_type": "person_id", "strategy": "generate"}, "person.last_name": {"sem_type": "family", "strategy": "fake"}, "person.first_name": {"sem_type": "name", "strategy": "fake"},
    "person.middle_name": {"sem_type": "patronymic", "strategy": "fake"}, "person.inn": {"sem_type": "inn", "strategy": "generate"}, "person.snils": {"sem_type": "snils", "strategy": "generate"},
    "person.passport_series": {"sem_type": "passport", "strategy": "generate"}, "person.passport_number": {"sem_type": "passport", "strategy": "generate"}, "person.phone": {"sem_type": "phone", "strategy": "fake"},
    "person.email": {"sem_type": "email", "strategy": "generate"}, "person.birth_date": {"sem_type": "birth_date", "strategy": "generalize"}, "person.salary": {"sem_type": "salary", "strategy": "shuffle"},
    "person.attrs": {"sem_type": "free_text", "strategy": "jsonb", "json_fields": {"phone": "phone", "emergency": "fio_full", "snils": "snils", "level": "keep"}},
    "address.line": {"sem_type": "address", "strategy": "freetext"}, "document.number": {"sem_type": "passport", "strategy": "generate"}, "document.kind": {"sem_type": "category", "strategy": "keep"},
    "contractor.title": {"sem_type": "org_name", "strategy": "direct"}, "contractor.inn": {"sem_type": "inn", "strategy": "generate"}, "contractor.ogrn": {"sem_type": "ogrn", "strategy": "generate"}, "contractor.kpp": {"sem_type": "kpp", "strategy": "keep"},
    "contract.contractor_inn": {"sem_type": "inn", "strategy": "generate"}, "contract.code": {"sem_type": "technical", "strategy": "keep"}, "contract_item.title": {"sem_type": "category", "strategy": "keep"},
    "ticket.title": {"sem_type": "free_text", "strategy": "freetext"}, "ticket.body": {"sem_type": "free_text", "strategy": "freetext"}, "comment.body": {"sem_type": "free_text", "strategy": "freetext"},
    "payroll.amount": {"sem_type": "salary", "strategy": "shuffle"}, "audit.action": {"sem_type": "category", "strategy": "keep"},
}


def _below(label: str, n: int, key: str = "id") -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), F.lit(label), key), F.lit(n))


def _number(label: str, width: int) -> Column:
    return F.lpad(_below(label, 10**width).cast("string"), width, "0")


def _entry(values: list[str], label: str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in values]), _below(label, len(values)).cast("int") + 1)


def tables(spark: SparkSession, n: int = 1000) -> dict[str, DataFrame]:
    """n people and what belongs to them; person 1 is the canary."""
    corpora = build(COMPONENTS)
    ids = lambda m: spark.range(1, m + 1)
    word = lambda corpus, label: F.initcap(_entry(corpora[corpus], label))
    first, female = F.col("id") == 1, F.col("id") % 2 == 0
    family = lambda label: F.initcap(F.when(female, c.feminine(F.lower(word("family", label)))).otherwise(F.lower(word("family", label))))
    given = lambda label: F.when(female, word("name_f", label)).otherwise(word("name_m", label))
    snils = lambda label: c.gen_snils(f"{SEED}{label}", "concat(lpad(cast(id as string), 9, '0'), '00')")
    owner = lambda label: (_below(label, n) + 1).alias("person_id")
    day = lambda start, span, label: F.date_add(F.lit(start).cast("date"), _below(label, span).cast("int"))
    phone = F.concat(F.lit("+7 912 "), _number("t3", 3), F.lit("-"), _number("t2", 2), F.lit("-"), _number("t4", 2))
    attrs = F.to_json(F.struct(F.when(first, CANARIES[2]).otherwise(phone).alias("phone"), F.concat_ws(" ", family("e"), given("e")).alias("emergency"), (F.col("id") % 7).alias("level"), F.when(F.col("id") % 5 == 0, snils("js")).alias("snils"), F.lit("x").alias("note")))
    salary = (_below("pay", 90000) + 30000).cast("double")
    person = ids(n).select(
        "id", F.when(F.col("id") % 20 == 3, F.col("id") + 1_000_000).otherwise(F.col("id") + 100_000).alias("tab_no"),
        (F.col("id") % 10 + 1).alias("department_id"), (_below("pos", 12) + 1).alias("position_id"),
        F.when(first, CANARIES[0]).when(F.col("id") % 97 == 0, F.lit(None)).otherwise(family("f")).alias("last_name"), given("n").alias("first_name"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).when(female, word("patronymic_f", "p")).otherwise(word("patronymic_m", "p")).alias("middle_name"),
        c.gen_inn(f"{SEED}p", "rpad(lpad(cast(id as string), 10, '0'), 12, '0')").alias("inn"), snils("p").alias("snils"),
        F.when(first, "4501").otherwise(_number("s", 4)).alias("passport_series"), F.when(first, "123456").otherwise(_number("m", 6)).alias("passport_number"),
        F.when(first, CANARIES[2]).otherwise(phone).alias("phone"), F.when(first, CANARIES[1]).otherwise(F.concat(F.lit("user"), F.col("id"), F.lit("@mail.ru"))).alias("email"),
        day("1960-01-01", 15000, "b").alias("birth_date"), salary.alias("salary"), attrs.alias("attrs"),
    )
    line = F.concat(word("region", "r"), F.lit(", г. "), word("city", "c"), F.lit(", ул. "), word("street", "s"), F.lit(", д. "), (_below("d", 99) + 1).cast("string"))
    address = ids(n).select("id", F.col("id").alias("person_id"), F.when(first, F.concat(line, F.lit(f", {CANARIES[4]}"))).when(F.col("id") % 10 == 4, F.concat(F.lit("мск, "), word("street", "s"), F.lit(" 5, спросить "), family("a"))).otherwise(line).alias("line"))
    document = ids(n).select("id", F.col("id").alias("person_id"), F.lit("passport").alias("kind"), F.when(first, CANARIES[3]).otherwise(F.concat(_number("ds", 4), F.lit(" "), _number("dn", 6))).alias("number"))
    firms = 60
    company = F.concat(F.initcap(_entry(corpora["org"], "org")), F.lit(" "), F.col("id"))
    inn = lambda key: F.when(F.col(key) % 2 == 0, c.gen_inn(f"{SEED}c", f"rpad(lpad(cast({key} as string), 9, '0'), 10, '0')")).otherwise(c.gen_inn(f"{SEED}c", f"rpad(lpad(cast({key} as string), 10, '0'), 12, '0')"))
    contractor = ids(firms).select("id", company.alias("title"), inn("id").alias("inn"), F.lpad((F.lit(770101001) + F.col("id")).cast("string"), 9, "0").alias("kpp"), c.gen_ogrn(SEED, "rpad(lpad(cast(id as string), 8, '0'), 13, '0')").alias("ogrn"))
    deals = max(200, n // 10)
    contract = ids(deals).withColumn("firm", _below("firm", firms) + 1).select("id", F.concat(F.lit("Д-"), (_below("y", 9) + 2018).cast("string"), F.lit("/"), F.col("id")).alias("code"), inn("firm").alias("contractor_inn"), owner("sign"), (_below("sum", 90000) * 1000).cast("double").alias("total"), day("2018-01-01", 3000, "cd").alias("signed"))
    items = ids(deals).select(F.col("id").alias("contract_id"), F.explode(F.sequence(F.lit(1).cast("long"), _below("items", 3) + 1)).alias("item_no"))
    contract_item = items.select("contract_id", "item_no", F.concat(F.lit("Позиция "), F.col("item_no")).alias("title"), F.pmod(F.xxhash64("contract_id", "item_no"), F.lit(500)).alias("quantity"))
    shipment = items.where("item_no = 1").select(F.col("contract_id").alias("id"), "contract_id", "item_no", F.date_add(F.lit("2019-01-01").cast("date"), F.pmod(F.xxhash64("contract_id"), F.lit(2700)).cast("int")).alias("shipped"))
    said = F.when(first, F.concat(F.lit(f"Обращение от {CANARIES[0]} А.Б., пишите на {CANARIES[1]}, паспорт {CANARIES[3]}. Файл {PRESERVED}"))).when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 7 == 1, F.lit("")).when(F.col("id") % 100 == 2, F.repeat(F.lit("Плановое обслуживание станка без замечаний. "), 500))
    said = said.when(F.col("id") % 3 == 0, F.concat(F.lit("Сверьте СНИЛС "), snils("t"), F.lit(" в личном деле.")))
    ticket = ids(2 * n).select("id", owner("ticket"), F.lit("Заявка на обслуживание станка в цехе").alias("title"), said.otherwise(F.concat(F.lit("Звонил клиент "), family("t"), F.lit(" А.Б., просил перезвонить. Файл C:\\share\\акт.pdf"))).alias("body"))
    comment = ids(4 * n).select("id", ((F.col("id") - 1) % (2 * n) + 1).alias("ticket_id"), owner("comment"), F.when(first, f"Тел. {CANARIES[2]}, {CANARIES[0]} В.П.").when(F.col("id") % 3 == 0, F.concat(F.lit("Согласовано, направил "), given("g"), F.lit(" "), family("g"))).otherwise(F.lit("Принято в работу.")).alias("body"))
    paid = ids(n).select("id", salary.alias("salary"), F.explode(F.sequence(F.lit(1).cast("long"), F.lit(4).cast("long"))).alias("month"))
    payroll = paid.select(((F.col("id") - 1) * 4 + F.col("month")).alias("id"), F.col("id").alias("person_id"), F.col("month"), (F.round(F.col("salary") / 12) + F.pmod(F.xxhash64("id", "month"), F.lit(5)) * 100).alias("amount"))
    audit = ids(min(2 * n, 10_000)).select("id", owner("audit"), _entry(["login", "update", "export"], "act").alias("action"))
    towns = ["Тверская область", "Калужская область", "Рязанская область", "Тульская область", "Московская область", "Орловская область", "Липецкая область", "Псковская область"]
    region = ids(len(towns)).select("id", F.element_at(F.array(*map(F.lit, towns)), F.col("id").cast("int")).alias("title"))
    department = ids(10).select("id", F.concat(F.lit("Отдел "), F.col("id")).alias("title"), (_below("reg", len(towns)) + 1).alias("region_id"))
    position = ids(12).select("id", F.concat(F.lit("Должность "), F.col("id")).alias("title"), (F.col("id") % 7 + 1).alias("grade"))
    return {
        "region": region, "department": department, "position": position, "person": person, "address": address, "document": document, "contractor": contractor, "contract": contract,
        "contract_item": contract_item, "shipment": shipment, "ticket": ticket, "comment": comment, "payroll": payroll, "audit": audit,
    }


def manifest() -> dict:
    """Probes of a copy: one person's surname in column and texts, a text that must stay, and a soft link's two sides."""
    return {
        "canaries": CANARIES,
        "identity": {"table": "person", "key": "id", "value": 1, "column": "last_name"},
        "occurrences": [{"table": "ticket", "column": "body"}, {"table": "comment", "column": "body"}],
        "preserved": [{"table": "ticket", "columns": ["body"], "fragment": PRESERVED}],
        "soft_links": [{"left": a, "a": x, "right": b, "b": y} for a, x, b, y in SOFT],
        "correlated": [{"left": "person", "key": "id", "a": "salary", "right": "payroll", "by": "person_id", "b": "amount"}],
    }


def write(spark: SparkSession, folder: str, n: int = 1000) -> None:
    """The tables as Parquet folders, and the probes as one JSON line in ``_manifest``."""
    for name, df in tables(spark, n).items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    spark.createDataFrame([(json.dumps(manifest(), ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/_manifest")
