"""Queries over the driver's tables, each made by the library's own operators; ``oracle`` has them in SQL that shares no code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import columns as c
from palimpsest.operators import dataset, detect, text, verify
from palimpsest.plans.oracle import ORACLE as ORACLE
from palimpsest.plans.oracle import SALT
from palimpsest.plans.plan import Plan, PlanColumn, assign, compile_table, inherit, schema_fingerprint, validate_plan
from palimpsest.sources.corpus import COMPONENTS, build

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
CORPORA = build(COMPONENTS)
FLAGSHIP = "fpe_join_preserved"

Tables = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """f takes a function from a table's name to its DataFrame."""
    QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
    return f


def _card(key: str, n: int) -> str:
    """A number of n digits that starts with the key."""
    return f"rpad(lpad(cast({key} as string), 8, '0'), {n}, '7')"


def _plan(df: DataFrame, table: str, **strategies: tuple) -> Plan:
    """A plan of one table: column = (sem_type, strategy[, json fields]); the rest is kept."""
    columns = []
    for n in df.columns:
        sem, strategy, *more = strategies.get(n, ("technical", "keep"))
        columns.append(PlanColumn(table, n, sem, strategy, json_fields=more[0] if more else {}, confirmed=strategy == "null"))
    return Plan(schema_fingerprint([(table, f.name, f.dataType.simpleString()) for f in df.schema]), columns)


def _copied(df: DataFrame, table: str, maps: dict | None = None, **strategies: tuple) -> DataFrame:
    return compile_table(df, _plan(df, table, **strategies), table, SALT, CORPORA, maps)


# -- keys and identifiers


@query
def fpe_customer_keys(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", c.fpe(SALT, "customer", "c_custkey", 9).alias("fake_key"))


@query
def fpe_join_preserved(t: Tables) -> DataFrame:
    """Keys of both tables are replaced on their own; the join and its totals survive."""
    customer = t("customer").select(c.fpe(SALT, "customer", "c_custkey", 9).alias("fake_key"))
    orders = t("orders").select(c.fpe(SALT, "customer", "o_custkey", 9).alias("fake_key"), "o_totalprice")
    return customer.join(orders, "fake_key").groupBy("fake_key").agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query
def fpe_distinct_preserved(t: Tables) -> DataFrame:
    return t("orders").agg(F.count_distinct("o_orderkey").alias("n_source"), F.count_distinct(c.fpe(SALT, "k", "o_orderkey", 9)).alias("n_fake"))


@query
def gen_inn10(t: Tables) -> DataFrame:
    made = t("supplier").select("s_suppkey", c.gen_inn(SALT, _card("s_suppkey", 10)).alias("inn"))
    return made.withColumn("valid", c.valid_inn("inn"))


@query
def gen_inn12(t: Tables) -> DataFrame:
    made = t("customer").select("c_custkey", c.gen_inn(SALT, _card("c_custkey", 12)).alias("inn"))
    return made.withColumn("valid", c.valid_inn("inn"))


@query
def gen_snils(t: Tables) -> DataFrame:
    made = t("customer").select("c_custkey", c.gen_snils(SALT, _card("c_custkey", 11)).alias("snils"))
    return made.withColumn("valid", c.valid_snils("snils"))


@query
def gen_ogrn(t: Tables) -> DataFrame:
    made = t("supplier").select("s_suppkey", c.gen_ogrn(SALT, _card("s_suppkey", 13)).alias("ogrn"))
    return made.withColumn("valid", c.valid_ogrn("ogrn"))


@query
def gen_luhn_like(t: Tables) -> DataFrame:
    made = t("customer").select("c_custkey", c.gen_luhn_like(SALT, _card("c_custkey", 16)).alias("card"))
    return made.withColumn("valid", c.luhn_ok("card"))


@query
def gen_digits_like_names(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", c.gen_digits_like(SALT, "c_name").alias("fake_name"))


@query
def gen_int_like_keys(t: Tables) -> DataFrame:
    """Whole numbers stay whole numbers of their width, one to one, whatever the width."""
    return t("orders").where("o_custkey is not null").select(F.col("o_custkey").alias("k")).distinct().select("k", c.gen_int_like(SALT, "k").alias("fake"))


@query
def passport_pair(t: Tables) -> DataFrame:
    """Series and number of one document are one ten-digit permutation."""
    ten = "lpad(cast(c_custkey as string), 10, '0')"
    df = t("customer").selectExpr("c_custkey", f"substr({ten}, 1, 4) as doc_series", f"substr({ten}, 5, 6) as doc_number")
    out = _copied(df, "customer", doc_series=("passport", "generate"), doc_number=("passport", "generate"))
    return out.select("c_custkey", F.col("doc_series").alias("series"), F.col("doc_number").alias("number"))


@query
def checksum_flags(t: Tables) -> DataFrame:
    """Digit runs of 10 to 19 in texts and the checksum that they satisfy first."""
    runs = t("documents").select(F.explode(F.regexp_extract_all("text", F.lit("[0-9]+"), 0)).alias("x")).where("length(x) between 10 and 19")
    kind = F.when(c.valid_snils("x"), "snils").when(c.valid_inn("x"), "inn").when(c.valid_ogrn("x"), "ogrn").when(c.luhn_ok("x"), "luhn").otherwise("none")
    return runs.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


# -- identity keys and fakes


def _found(t: Tables, pattern: str) -> DataFrame:
    return t("documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(pattern), 0)).alias("x"))


@query
def normalize_phone(t: Tables) -> DataFrame:
    return _found(t, r"\+[0-9] \([0-9]{3}\) [0-9]{3}-[0-9]{4}").select("doc_id", F.col("x").alias("phone"), c.normalize_phone("x").alias("key"), c.fake_phone(SALT, CORPORA, "x").alias("fake"))


@query
def normalize_email(t: Tables) -> DataFrame:
    return _found(t, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}").select("doc_id", F.col("x").alias("email"), c.normalize_email("x").alias("key"), c.fake_email(SALT, CORPORA, "x").alias("fake"))


@query
def normalize_digits(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", c.normalize_digits("c_name").alias("digits"))


def _people(t: Tables) -> DataFrame:
    """A person for each customer, a woman where the key is even, a fifth without a patronymic, in mixed case."""
    at = lambda corpus: F.element_at(F.array(*[F.lit(x) for x in CORPORA[corpus]]), (F.col("c_custkey") % len(CORPORA[corpus]) + 1).cast("int"))
    female = F.col("c_custkey") % 2 == 0
    df = dataset.dealt(t("customer").select("c_custkey")).select(
        "c_custkey",
        F.initcap(F.when(female, c.feminine(at("family"))).otherwise(at("family"))).alias("family"),
        F.upper(F.when(female, at("name_f")).otherwise(at("name_m"))).alias("name"),
        F.when(F.col("c_custkey") % 5 != 0, F.concat(F.lit(" "), F.when(female, at("patronymic_f")).otherwise(at("patronymic_m")))).alias("patronymic"),
    )
    return df


@query
def fake_fio(t: Tables) -> DataFrame:
    """Names are replaced part by part, the gender kept, by the lemma of the surname."""
    people = _people(t)
    key, out = c.normalize_fio("family", "name", "patronymic"), _copied(people, "p", family=("family", "fake"), name=("name", "fake"), patronymic=("patronymic", "fake"))
    return out.join(people.select("c_custkey", key["family"].alias("lemma"), key["gender"].alias("gender")), "c_custkey")


@query
def fake_pick_name(t: Tables) -> DataFrame:
    df = t("customer").select("c_custkey", F.col("c_name").alias("city"))
    return _copied(df, "customer", city=("city", "fake"))


@query
def fake_address(t: Tables) -> DataFrame:
    df = t("supplier").select("s_suppkey", F.col("s_name").alias("address"))
    return _copied(df, "supplier", address=("address", "fake"))


@query
def fake_email(t: Tables) -> DataFrame:
    df = t("customer").select("c_custkey", F.col("c_name").alias("email"))
    return _copied(df, "customer", email=("email", "generate"))


# -- one-to-one maps and shuffles


@query
def direct_map_segments(t: Tables) -> DataFrame:
    return dataset.direct_map(t("customer"), "c_mktsegment", CORPORA["org"], SALT)


@query
def direct_map_suppliers(t: Tables) -> DataFrame:
    df = t("supplier").select("s_suppkey", F.col("s_name").alias("fake"))
    return _copied(df, "supplier", {"fake": dataset.direct_map(df, "fake", CORPORA["org"], SALT, limit=10**9)}, fake=("org_name", "direct"))


@query
def shuffle_acctbal(t: Tables) -> DataFrame:
    return dataset.shuffle_column(t("customer"), "c_custkey", "c_custkey", "c_acctbal", SALT, "g")


@query
def shuffle_linked_totals(t: Tables) -> DataFrame:
    """Row i of an entity gets its donor's row i mod the donor's count."""
    return dataset.shuffle_column(t("orders"), "o_orderkey", "o_custkey", "o_totalprice", SALT, "g")


@query
def shuffle_corr_preserved(t: Tables) -> DataFrame:
    """Two tables that are linked by a person keep their correlation, shuffled apart by one group."""
    left = t("customer").select("c_custkey", "c_acctbal")
    right = t("customer").select((F.col("c_custkey") + 10**9).alias("id"), F.col("c_custkey").alias("owner"), (F.col("c_acctbal") * 2 + F.col("c_custkey") % 7).alias("paid"))
    classes = [{"left.c_custkey", "right.owner"}]
    found = [verify.correlation(a, b, "c_custkey", "owner", "c_acctbal", "paid") for a, b in ((left, right), (dataset.shuffled(left, ["c_custkey"], ["c_acctbal"], "left", classes, SALT), dataset.shuffled(right, ["id"], ["paid"], "right", classes, SALT)))]
    return left.sparkSession.createDataFrame([(round(found[0], 6), round(found[1], 6))], "before double, after double")


# -- column strategies


@query
def plan_projection(t: Tables) -> DataFrame:
    """A whole table by its plan: kept key, digits in place, one-to-one segments, balances nulled."""
    df = t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", F.col("c_acctbal").cast("double").alias("c_acctbal"))
    maps = {"c_mktsegment": dataset.direct_map(df, "c_mktsegment", CORPORA["org"], SALT)}
    return _copied(df, "customer", maps, c_name=("passport", "generate"), c_mktsegment=("org_name", "direct"), c_acctbal=("salary", "null"))


@query
def generalize_order_year(t: Tables) -> DataFrame:
    df = t("orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"))
    return _copied(df, "orders", o_orderdate=("birth_date", "generalize"))


@query
def json_keys(t: Tables) -> DataFrame:
    events = t("events")
    return events.sparkSession.createDataFrame([(k,) for k in dataset.json_keys(events, "props")], "k string")


@query
def json_rewrite(t: Tables) -> DataFrame:
    """Typed fields by their column's generator, kept ones with their types, unknown ones null, nulls null."""
    js = F.concat(F.lit('{"inn":"'), F.expr(_card("c_custkey", 10)), F.lit('","n":'), (F.col("c_custkey") % 5).cast("string"), F.lit(',"drop":"x","none":null,"o":{"a":[1,true]}}'))
    df = t("customer").select("c_custkey", js.alias("js"))
    return _copied(df, "customer", js=("free_text", "jsonb", {"inn": "inn", "n": "keep", "o": "keep", "none": "email"}))


# -- profiling and planning


def _profiles(t: Tables, columns: dict[str, list[str]]) -> DataFrame:
    out = None
    for table, names in columns.items():
        one = dataset.profile(t(table).select(*names), table)
        out = one if out is None else out.unionByName(one)
    return out


@query
def profile_columns(t: Tables) -> DataFrame:
    found = _profiles(t, {"customer": ["c_custkey", "c_name", "c_mktsegment"], "orders": ["o_custkey", "o_orderstatus"], "nation": ["n_name"]})
    return found.select("tbl", "col", "n", "n_distinct", F.round("null_share", 6).alias("null_share"))


@query
def sample_values(t: Tables) -> DataFrame:
    return _profiles(t, {"customer": ["c_name"]}).select(F.concat_ws(".", "tbl", "col").alias("col"), F.explode("samples").alias("v"))


def _hr(t: Tables) -> DataFrame:
    """Customers as people, with identifiers of every kind."""
    key = lambda n: _card("c_custkey", n)
    return _people(t).select(
        "c_custkey", c.gen_inn("x", key(12)).alias("inn"), c.gen_snils("x", key(11)).alias("snils"), c.fake_email("x", CORPORA, "cast(c_custkey as string)").alias("email"),
        c.fake_phone("x", CORPORA, "cast(c_custkey as string)").alias("phone"), F.date_add(F.lit("1970-01-01").cast("date"), F.col("c_custkey").cast("int") % 9000).alias("birth_date"), F.col("family").alias("fam"),
        F.concat(F.lit("note "), F.col("c_custkey")).alias("note"),
    )


@query
def rule_votes(t: Tables) -> DataFrame:
    """The rules' types of columns, by names and samples."""
    hr = _hr(t)
    rows = dataset.profile(hr.drop("c_custkey"), "hr").collect()
    return hr.sparkSession.createDataFrame([(r["col"], detect.detect(r["col"], r["type"], r["samples"], r["n_distinct"])[0]) for r in rows], "col string, sem_type string")


@query
def addr_parse_ratio(t: Tables) -> DataFrame:
    """Share of texts whose parts between commas are all words or numbers."""
    ok = F.forall(F.split("text", ","), lambda p: p.rlike("^ *([A-Za-z. ]+|[0-9]+) *$"))
    return t("documents").where("text is not null").agg(F.round(F.avg(ok.cast("int")), 6).alias("ratio"))


@query
def soft_links(t: Tables) -> DataFrame:
    columns = [("customer", "c_custkey"), ("orders", "o_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("supplier", "s_suppkey"), ("lineitem", "l_suppkey")]
    return dataset.soft_links({name: t(table).select(name) for table, name in columns}).withColumn("containment", F.round("containment", 6))


@query
def plan_assign(t: Tables) -> DataFrame:
    """Strategies out of types, keys, cardinalities and classes of linked columns."""
    spark = t("customer").sparkSession
    given = {
        "c_custkey": ("technical", {"unique": True, "primary_key": True, "cardinality": 1500}), "c_name": ("phone", {"unique": True, "primary_key": False, "cardinality": 1500}), "tax": ("inn", {"unique": True, "primary_key": False, "cardinality": 1500}),
        "town": ("city", {"unique": False, "primary_key": False, "cardinality": 20}), "birth": ("birth_date", {"unique": False, "primary_key": False, "cardinality": 900}), "mail": ("email", {"unique": False, "primary_key": False, "cardinality": 900}),
    }
    columns = inherit([PlanColumn("customer", n, sem, assign({}, sem, **kw)[0]) for n, (sem, kw) in given.items()], [{"customer.c_custkey", "customer.tax"}])
    return spark.createDataFrame([(f"{x.table}.{x.column}", x.strategy) for x in columns], "col string, strategy string")


@query
def plan_faults(t: Tables) -> DataFrame:
    """How many faults validation finds in a plan that has eight."""
    df = t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")
    plan = _plan(df, "customer", c_custkey=("phone", "generate"), c_name=("family", "direct"), c_mktsegment=("colour", "nonsense"), c_acctbal=(None, "unresolved"))
    plan.columns[2].llm_mode, plan.columns[2].length_policy = "psychic", "stretch"
    schema = [("customer", f.name, f.dataType.simpleString()) for f in df.schema]
    found = validate_plan(plan, [*schema, ("customer", "later", "string")], {"customer.c_custkey"})
    return df.sparkSession.createDataFrame([(len(found) - 1,)], "n_faults int")  # the fingerprint's fault is the new column's


# -- verification


def _masked(t: Tables) -> tuple[DataFrame, DataFrame]:
    source = t("customer").select("c_custkey", "c_nationkey", "c_name")
    return source, _copied(source, "customer", c_name=("passport", "generate"))


@query
def volume_check(t: Tables) -> DataFrame:
    names = ("customer", "orders", "lineitem", "supplier", "part")
    both = {n: t(n) for n in names}
    return t("customer").sparkSession.createDataFrame([(n, a, b) for n, (a, b) in dataset.volume(both, both).items()], "tbl string, n_source long, n_copy long")


@query
def fake_ne_rowwise(t: Tables) -> DataFrame:
    source, copy = _masked(t)
    return dataset.unchanged(source, copy, ["c_custkey"], "c_name").select(F.lit(source.count()).alias("compared"), "equal_values", "missing")


@query
def fake_ne_multiset(t: Tables) -> DataFrame:
    source, copy = _masked(t)
    return dataset.shared_values(source, copy, "c_name").agg(F.count(F.lit(1)).alias("shared"))


@query
def fk_violations(t: Tables) -> DataFrame:
    out = None
    for child, a, parent, b in (("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("customer", "c_nationkey", "nation", "n_nationkey"), ("nation", "n_regionkey", "region", "r_regionkey")):
        one = dataset.orphans(t(child), [a], t(parent), [b]).agg(F.lit(f"{child}.{a}").alias("fk"), F.count(F.lit(1)).alias("missing"))
        out = one if out is None else out.unionByName(one)
    return out


@query
def unique_violations(t: Tables) -> DataFrame:
    out = None
    for table, key in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("supplier", "s_name")):
        one = t(table).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.lit(f"{table}.{key}").alias("key"), F.count(F.lit(1)).alias("repeated"))
        out = one if out is None else out.unionByName(one)
    return out


@query
def entropy_columns(t: Tables) -> DataFrame:
    rows = []
    for table, names in (("events", ["event_type"]), ("customer", ["c_mktsegment", "c_nationkey"]), ("orders", ["o_orderstatus"])):
        rows += [(f"{table}.{n}", round(bits, 6)) for n, (bits, _) in dataset.entropies(t(table), names).items()]
    return t("events").sparkSession.createDataFrame(rows, "col string, bits double")


@query
def corpus_ceiling(t: Tables) -> DataFrame:
    """Bits that the customers' fakes can reach by the corpora's sizes."""
    n = t("customer").count()
    return t("customer").sparkSession.createDataFrame([(k, len(v), round(verify.ceiling(len(v), n), 6)) for k, v in CORPORA.items()], "name string, m int, bits double")


@query
def canary_search(t: Tables) -> DataFrame:
    """Benchmark items that stand in a document as they are, case aside."""
    items = t("benchmark")
    found = dataset.canaries(items.select(F.col("text").alias("x")), t("documents"), ["text"], limit=100_000)
    return items.join(found, F.col("text") == F.col("x"), "left_semi").select("item_id")


@query
def identifier_leak(t: Tables) -> DataFrame:
    """Customers' numbers that stand in the digit runs of documents or conversations, at any place of a run."""
    ids = t("customer").select(c.normalize_digits("c_name").alias("x")).where("x <> ''").distinct()
    texts = t("documents").select("text").unionByName(t("conversations").select("text"))
    return dataset.leaked_identifiers(ids, texts, "text").agg(F.count(F.lit(1)).alias("leaked"))


@query
def column_checksums(t: Tables) -> DataFrame:
    """Checksums don't hang on the order of rows, and show a changed value and a null."""
    source, copy = _masked(t)
    one = lambda df: dataset.checksums(df, ["c_custkey"], ["c_name"]).first()["c_name"]
    first = one(source)
    nulled = source.withColumn("c_name", F.when(F.col("c_custkey") != 1, F.col("c_name")))
    return source.sparkSession.createDataFrame([(one(source.repartition(7, "c_name")) == first, one(copy) != first, one(nulled) != first)], "same_in_any_order boolean, changed_shows boolean, null_shows boolean")


@query
def runlog_publishable(t: Tables) -> DataFrame:
    spark = t("customer").sparkSession
    logs = {
        "all done": [("pass1", "a", "failed"), ("pass1", "a", "done"), ("pass1", "b", "done"), ("verify", "*", "done")], "verify failed": [("pass1", "a", "done"), ("verify", "*", "done"), ("verify", "*", "failed")],
        "table failed": [("pass1", "a", "done"), ("pass1", "b", "failed"), ("verify", "*", "done")], "no verify": [("pass1", "a", "done")],
    }
    rows = [(name, dataset.publishable(spark.createDataFrame([(i, *r) for i, r in enumerate(log)], "seq long, stage string, tbl string, status string"))) for name, log in logs.items()]
    return spark.createDataFrame(rows, "log string, publishable boolean")


# -- free text


@query
def sanitize_planted(t: Tables) -> DataFrame:
    """An e-mail, a phone, a passport and a tax id in one text each become what their columns would."""
    key = F.lpad(F.col("c_custkey").cast("string"), 7, "0")
    tax = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    check = F.expr(c.g.inn_check("lpad(cast(c_custkey as string), 9, '0')", c.g.INN10))
    passport = (F.lit(4500000000) + F.col("c_custkey")).cast("string")
    said = F.concat(
        F.lit("Пишите user"), F.col("c_custkey"), F.lit("@mail.ru, тел. +7 (903) "), F.substring(key, 1, 3), F.lit("-"), F.substring(key, 4, 2), F.lit("-"), F.substring(key, 6, 2),
        F.lit(", паспорт "), F.substring(passport, 1, 4), F.lit(" "), F.substring(passport, 5, 6), F.lit(", ИНН "), tax, check, F.lit("."),
    )
    return dataset.dealt(t("customer").select("c_custkey")).select("c_custkey", text.sanitize_text(said, SALT, CORPORA)["text"].alias("text"))


@query
def sanitize_names(t: Tables) -> DataFrame:
    """A full name in running text becomes what its columns would. Two given names that look like surnames are left out."""
    people = _people(t).where("patronymic is not null and lower(name) not in ('ирина', 'полина')")
    said = F.concat(F.lit("Звонил "), F.col("family"), F.lit(" "), F.initcap("name"), F.initcap("patronymic"), F.lit(" вчера"))
    return people.select("c_custkey", text.sanitize_text(said, SALT, CORPORA)["text"].alias("text"))


@query
def sanitize_documents(t: Tables) -> DataFrame:
    """The text pass over whole documents: notes and the new text's digest."""
    done = dataset.dealt(t("documents").select("doc_id", "text")).select("doc_id", text.sanitize_text(F.col("text"), SALT, CORPORA).alias("s"))
    return done.select("doc_id", F.size("s.notes").alias("n_notes"), F.sha2("s.text", 256).alias("sha256"))


@query
def degradation_summary(t: Tables) -> DataFrame:
    """Notes and undecided fragments of the conversations' text pass."""
    return text.notes_summary(dataset.dealt(t("conversations")).select(text.sanitize_text(F.col("text"), SALT, CORPORA).alias("s")), "s", "conversations")
