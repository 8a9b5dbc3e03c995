"""Transforms of whole columns: one-to-one maps, shuffles, profiles and checks of a copy against its source."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions import sqlgen as g
from palimpsest.functions.columns import bind_secret, quoted
from palimpsest.functions.sqlgen import SPARK

#: Pieces in which a ring is ordered: no task sorts all entities.
RING_PIECES = 64
#: Rows from which an entity is numbered in pieces, and how many.
HOT_ROWS, HOT_PIECES = 100_000, 1024
#: Cells from which a profile is made in pieces, and about how many a piece has; parts by which rows are dealt, of each piece.
CELLS, PARTS = 500_000, 8
#: Letters of the mark that makes a replacement a value's own: 60 bits.
MARK = 12
_LEAK_RUN = r"[0-9][0-9 .\-/()]*"


def dealt(df: DataFrame, pieces: int = 0) -> DataFrame:
    """The rows dealt out by their hash to ``pieces`` tasks; else to as many as the session shuffles to, and twice its cores at least.

    A row group of a file is one task, however many rows it has; a step that costs much a row should not wait
    for it. Rows go by their values, so a task that runs again sends them the same way; equal rows stay together.
    """
    spark = df.sparkSession
    n = pieces or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, *[F.col(quoted(name)) for name, kind in df.dtypes if not re.search(r"\b(map<|variant\b)", kind)])


def direct_map(df: DataFrame, column: str, corpus: list[str], salt: str, limit: int = 10_000, answers: dict[str, str] | None = None) -> DataFrame:
    """(v, fake): an own replacement for every distinct value; more than ``limit`` values raise.

    A replacement is a corpus entry and a mark out of the value's own hash, so it
    doesn't depend on which other values there are. ``answers`` of a model are taken
    where the source is known and the answer is new, not empty and not the source;
    the generated ones never meet them, for they bear a mark. Two values with one
    replacement (a collision of 60 bits) raise.
    """
    values = df.select(F.col(quoted(column)).cast("string").alias("v")).where("v is not null").distinct()
    if values.limit(limit + 1).count() > limit:
        raise ValueError(f"{column} has more than {limit} values")
    bound, secret = bind_secret(values, salt)
    base = f"substr(upper({g.pick(SPARK, secret, 'org', corpus, g.norm_word(SPARK, 'v'))}), 1, 140)"
    made = bound.select("v", F.expr(f"concat({base}, '-', upper({g.base32(SPARK, secret, MARK, g.lit('direct'), 'v')}))").alias("fake"))
    usable, used = [], set()
    for old, new in sorted((answers or {}).items()):
        if new and new.strip() and new != old and new not in used and not re.search(rf"-[A-Z2-7]{{{MARK}}}$", new):
            usable.append((old, new))
            used.add(new)
    if usable:
        given = df.sparkSession.createDataFrame(usable, "v string, given string")
        made = made.join(F.broadcast(given), "v", "left").select("v", F.coalesce("given", "fake").alias("fake"))
    if made.count() != made.select("fake").distinct().count():
        raise ValueError(f"{column}: two values got one replacement; take another salt generation")
    return made


def entity_column(classes: list[set[str]], table: str, key: str) -> tuple[str, str]:
    """(column, group) by which a table's values are shuffled: its key with the class of linked columns that holds it, else its
    first linked column, else its key alone. Tables of one group move together."""
    own = next((x for x in classes if f"{table}.{key}" in x), None)
    if own is not None:
        return key, "|".join(sorted(own))
    for names in sorted(map(sorted, classes)):
        for name in names:
            if name.rpartition(".")[0] == table:
                return name.rpartition(".")[2], "|".join(names)
    return key, f"{table}.{key}"


def ring(ids: DataFrame, salt: str, group: str = "shuffle") -> DataFrame:
    """(id, donor): the next id in the group's salted hash order, the last one's donor being the first. ids: column id, null ids dropped.

    The order depends on the group and the id's text alone: restricted to the ids of
    one table it is the same ring without the others, so linked tables agree. It is
    cut into RING_PIECES ranges of the hash; each is ordered on its own, and its last
    id takes the first id of the next range that has one.
    """
    bound, secret = bind_secret(ids.where("id is not null").select("id").distinct(), salt)
    keyed = bound.withColumn("h", F.expr(g.h60(SPARK, secret, g.lit("shuffle"), g.lit(group), "id"))).drop("_secret")
    keyed = keyed.withColumn("piece", (F.col("h") / F.lit((1 << 60) // RING_PIECES + 1)).cast("int"))
    order = Window.partitionBy("piece").orderBy("h", "id")
    inner = keyed.withColumn("next", F.lead("id").over(order))
    firsts = keyed.groupBy("piece").agg(F.min_by("id", F.struct("h", "id")).alias("first"))  # RING_PIECES rows at most
    wrap = Window.orderBy("piece")
    ends = firsts.select("piece", F.coalesce(F.lead("first").over(wrap), F.first("first").over(wrap)).alias("after"))
    return inner.join(F.broadcast(ends), "piece").select("id", F.coalesce("next", "after").alias("donor"))


def numbered(rows: DataFrame) -> DataFrame:
    """rows (e, k, ...) with i, the number of each row within its entity e from 1, in order of k.

    An entity with more than HOT_ROWS rows and more than a five-hundredth of all (fewer
    than 500 are, which bounds what is broadcast) is numbered in HOT_PIECES pieces by
    the hash of k, piece after piece, so that no task holds all its rows.
    """
    counts = rows.groupBy("e").agg(F.count(F.lit(1)).alias("n"))
    all_ = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t"), F.coalesce(F.max("n"), F.lit(0)).alias("m")).first()
    limit = max(HOT_ROWS, all_["t"] // 500)
    if all_["m"] <= limit:
        return rows.withColumn("i", F.row_number().over(Window.partitionBy("e").orderBy("k")))
    hot = counts.where(F.col("n") > limit).select(F.col("e").alias("hot"))
    piece = F.when(F.col("hot").isNotNull(), F.pmod(F.xxhash64("k"), F.lit(HOT_PIECES))).otherwise(-1)
    parted = rows.join(F.broadcast(hot), F.col("e") == F.col("hot"), "left").withColumn("piece", piece).drop("hot")
    local = parted.withColumn("i", F.row_number().over(Window.partitionBy("e", "piece").orderBy("k")))
    sizes = parted.where("piece >= 0").groupBy("e", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("e").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("e", "piece", F.coalesce(before, F.lit(0)).alias("start"))
    return local.join(F.broadcast(starts), ["e", "piece"], "left").withColumn("i", F.col("i") + F.coalesce("start", F.lit(0))).drop("piece", "start")


def shuffle_column(df: DataFrame, key: str, entity: str, column: str, salt: str, group: str = "shuffle") -> DataFrame:
    """(key, value): row i of an entity gets its donor's row i mod the donor's count; the donor is the next entity of the group's ring that has values.

    Rows with a null entity or a null value take no part and get null. The values
    are kept as a multiset only if all entities have equally many rows.
    """
    rows = df.where(F.col(entity).isNotNull() & F.col(column).isNotNull()).select(F.col(key).alias("k"), F.col(entity).alias("e"), F.col(column).alias("x"))
    rows = numbered(rows)
    donors = ring(rows.select(F.col("e").alias("id")), salt, group)
    gives = rows.select(F.col("e").alias("donor"), F.col("i").alias("di"), F.col("x").alias("value"))
    counts = rows.groupBy(F.col("e").alias("donor")).agg(F.count(F.lit(1)).alias("dn"))
    taken = rows.join(donors, F.col("e") == F.col("id")).join(counts, "donor").withColumn("di", (F.col("i") - 1) % F.col("dn") + 1).join(gives, ["donor", "di"])
    return df.select(F.col(key)).join(taken.select(F.col("k").alias(key), "value"), key, "left")


def shuffled(df: DataFrame, key: list[str], columns: list[str], table: str, classes: list[set[str]], salt: str) -> DataFrame:
    """The table with the columns' values moved between entities. A key of several columns, or without one, raises."""
    if columns and len(key) != 1:
        raise ValueError(f"{table}: a shuffle needs a key of one column")
    for column in columns:
        entity, group = entity_column(classes, table, key[0])
        given = shuffle_column(df, key[0], entity, column, salt, group).select(F.col(key[0]).alias("palimpsest key"), F.col("value").alias("palimpsest value"))
        df = df.join(given, F.col(quoted(key[0])) == F.col("`palimpsest key`"), "left").select(*[F.col("`palimpsest value`").alias(n) if n == column else F.col(quoted(n)) for n in df.columns])
    return df


def profile(df: DataFrame, table: str, samples: int = 50) -> DataFrame:
    """(tbl, col, type, n, n_distinct, null_share, json_share, samples) of every column; samples: the smallest distinct values.

    One pass: cells become (column, value) rows, counted per distinct value before
    they are shuffled; statistics and samples read that one shuffle. A task holds the
    values that it counts, so both sides of the shuffle have as many tasks as there are
    CELLS; the samples are cut in each task before they meet.
    """
    pieces = math.ceil(df.count() * len(df.columns) / CELLS)
    kinds = df.sparkSession.createDataFrame([(i, table, n, df.schema[n].dataType.simpleString()) for i, n in enumerate(df.columns)], "i int, tbl string, col string, type string")
    if pieces > 1:
        values = [F.col(quoted(n)).cast("string").alias(str(i)) for i, n in enumerate(df.columns)]
        rows = df.select(*values).withColumn("p", F.pmod(F.xxhash64(*[quoted(str(i)) for i in range(len(values))]), F.lit(PARTS * pieces))).repartition(pieces, "p")
        cells = rows.select("p", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(quoted(str(i))).alias("v")) for i in range(len(values))])).alias("c")).select("p", "c.*")
        counted = cells.groupBy("p", "i", "v").agg(F.count(F.lit(1)).alias("k")).repartition(pieces, "i", "v").groupBy("i", "v").agg(F.sum("k").alias("k"))
    else:
        counted = _cells(df, df.columns).groupBy("i", "v").agg(F.count(F.lit(1)).alias("k"))
    json = F.when(F.col("v").startswith("{") & F.expr("json_object_keys(v) is not null"), F.col("k")).otherwise(0)
    stats = counted.groupBy("i").agg(F.sum("k").alias("n"), F.count("v").alias("n_distinct"), F.sum(F.when(F.col("v").isNull(), F.col("k")).otherwise(0)).alias("nulls"), F.sum(json).alias("json"))
    # nulls go last and the counts along, else the optimizer reads the cells a second time for the samples
    first = counted.withColumn("r", F.row_number().over(Window.partitionBy("i").orderBy(F.col("v").asc_nulls_last()))).where((F.col("r") <= samples) & F.col("v").isNotNull())
    some = first.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("v", "k"))).alias("s")).select("i", F.transform("s", lambda x: x["v"]).alias("samples"))
    n = F.coalesce("n", F.lit(0))
    share = lambda x: F.coalesce(F.try_divide(x, F.col("n")), F.lit(0.0))
    return (
        kinds.join(stats, "i", "left").join(some, "i", "left")
        .select("tbl", "col", "type", n.alias("n"), F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), share("nulls").alias("null_share"),
                F.coalesce(F.try_divide("json", F.col("n") - F.col("nulls")), F.lit(0.0)).alias("json_share"), F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))
    )


def json_keys(df: DataFrame, column: str, limit: int = 500) -> list[str]:
    """The keys of a column's JSON objects, in order; more than ``limit`` raise."""
    keys = df.select(F.explode(F.json_object_keys(F.col(quoted(column)).cast("string"))).alias("k")).distinct().orderBy("k").limit(limit + 1)
    found = [r["k"] for r in keys.collect()]
    if len(found) > limit:
        raise ValueError(f"{column}: more than {limit} json keys")
    return found


def candidate_keys(profiles: DataFrame) -> dict[str, list[str]]:
    """Columns of each table whose values are all there and all different, out of its profile."""
    out: dict[str, list[str]] = {}
    for r in profiles.where("n > 0 and n_distinct = n").orderBy("tbl", "col").collect():
        out.setdefault(r["tbl"], []).append(r["col"])
    return out


def links_found(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> list[tuple[str, list[str], str, list[str]]]:
    """(child, [column], parent, [key]) where every value of the child's column is a key of the parent and the column's name holds
    the parent's name: links of one column that no schema declares. Keys of several columns must be declared."""
    out = []
    for parent, key in keys.items():
        if len(key) != 1:
            continue
        there = tables[parent].select(F.col(quoted(key[0])).cast("string").alias("v")).distinct()
        for child, df in tables.items():
            for column in df.columns:
                if (child, column) != (parent, key[0]) and parent.rpartition(".")[2].rstrip("s") in column.lower():
                    mine = df.select(F.col(quoted(column)).cast("string").alias("v")).where("v is not null").distinct()
                    if not mine.isEmpty() and mine.join(there, "v", "left_anti").isEmpty():
                        out.append((child, [column], parent, list(key)))
    return sorted(out)


def equivalence_classes(links: list[tuple[str, str]]) -> list[set[str]]:
    """Columns joined by links, as classes of two or more; links are metadata."""
    parent: dict[str, str] = {}

    def root(x: str) -> str:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    groups: dict[str, set[str]] = {}
    for x in list(parent):
        groups.setdefault(root(x), set()).add(x)
    return [s for s in groups.values() if len(s) > 1]


def soft_links(columns: dict[str, DataFrame], threshold: float = 0.85) -> DataFrame:
    """(a, b, containment) of column pairs whose distinct values overlap; each frame has one column. Exact."""
    union = None
    for name, df in columns.items():
        part = df.select(F.lit(name).alias("col"), F.col(df.columns[0]).cast("string").alias("v")).where("v is not null").distinct()
        union = part if union is None else union.unionByName(part)
    sizes = union.groupBy("col").agg(F.count(F.lit(1)).alias("n"))
    a, b = union.select(F.col("col").alias("a"), "v"), union.select(F.col("col").alias("b"), "v")
    shared = a.join(b, "v").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("k"))
    x, y = sizes.select(F.col("col").alias("a"), F.col("n").alias("na")), sizes.select(F.col("col").alias("b"), F.col("n").alias("nb"))
    share = F.col("k") / F.least("na", "nb")
    return shared.join(x, "a").join(y, "b").select("a", "b", share.alias("containment")).where(F.col("containment") >= threshold)


def classify(name: str, rules: tuple[str | None, float], votes: tuple[str | None, float]) -> tuple[str | None, str]:
    """(type or None, reason) out of the rules' vote and a second one; (None, 0) is a blind vote."""
    (a, p), (b, q) = rules, votes
    if a is None and b is None:
        return ("technical", "surrogate") if name == "id" or name.endswith("_id") else (None, "both blind")
    if a == b:
        return a, "agreed"
    if a is not None and b is not None:
        return None, "disagreement"
    if a is not None and p >= 0.9:
        return a, "rules"
    if b is not None and q >= 0.8:
        return b, "second vote"
    return None, "weak"


# -- a copy against its source


def volume(source: dict[str, DataFrame], copy: dict[str, DataFrame]) -> dict[str, tuple[int, int]]:
    return {t: (df.count(), copy[t].count()) for t, df in source.items()}


def _keyed(key: list[str]):
    cond = None
    for k in key:
        one = F.col(quoted(k)).eqNullSafe(F.col(quoted(f"palimpsest k {k}")))
        cond = one if cond is None else cond & one
    return cond


def unchanged(source: DataFrame, copy: DataFrame, key: list[str], columns: str | list[str]) -> DataFrame:
    """One row: how many rows of each column have the source's value (equal_values; of a list: equal_0, equal_1 ...), and
    how many source keys the copy lacks (missing). One join for all columns."""
    names = [columns] if isinstance(columns, str) else list(columns)
    s = source.select(*[F.col(quoted(k)) for k in key], *[F.col(quoted(n)).alias(f"palimpsest s {i}") for i, n in enumerate(names)])
    d = copy.select(*[F.col(quoted(k)).alias(f"palimpsest k {k}") for k in key], *[F.col(quoted(n)).alias(f"palimpsest d {i}") for i, n in enumerate(names)], F.lit(True).alias("palimpsest there"))
    out = ["equal_values"] if isinstance(columns, str) else [f"equal_{i}" for i in range(len(names))]
    equal = [F.count_if(F.col(quoted(f"palimpsest s {i}")) == F.col(quoted(f"palimpsest d {i}"))).alias(n) for i, n in enumerate(out)]
    return s.join(d, _keyed(key), "left").agg(*equal, F.count_if(F.col("`palimpsest there`").isNull()).alias("missing"))


def _cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """(i, v): the columns' values as text, one row each."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(quoted(n)).cast("string").alias("v")) for i, n in enumerate(columns)])).alias("c")).select("c.*")


def shared_values(source: DataFrame, copy: DataFrame, columns: str | list[str]) -> DataFrame:
    """Values of a column (of a list: (i, v)) that are in both: none, if every value was replaced. One pass for all columns."""
    if isinstance(columns, str):
        return source.select(columns).where(F.col(columns).isNotNull()).intersect(copy.select(columns))
    return _cells(source, columns).where("v is not null").intersect(_cells(copy, columns))


def leaked_identifiers(ids: DataFrame, copy: DataFrame, column: str) -> DataFrame:
    """(x, n): identifiers (column x, digits only) that stand in digit runs of a copy's column, at any place of a run.

    Every piece of a run that has an identifier's width is held against them, so
    that numbers side by side don't hide each other; a run may have any length. The
    copy is read once for all widths.
    """
    widths = sorted(r["w"] for r in ids.select(F.length("x").alias("w")).where("w > 0").distinct().collect())
    if not widths:
        return ids.select("x", F.lit(0).cast("long").alias("n")).limit(0)
    runs = copy.select(F.explode(F.regexp_extract_all(F.col(column).cast("string"), F.lit(_LEAK_RUN), 0)).alias("r")).select(F.regexp_replace("r", "[^0-9]", "").alias("r")).where(F.length("r") >= widths[0])
    pieces = F.expr(f"flatten(transform(array({', '.join(map(str, widths))}), w -> case when length(r) >= w then transform(sequence(1, length(r) - w + 1), i -> substr(r, i, w)) else array() end))")
    return runs.select(F.explode(pieces).alias("x")).join(ids.select("x").distinct(), "x").groupBy("x").agg(F.count(F.lit(1)).alias("n"))


def entropy(df: DataFrame, column: str) -> float:
    """Shannon entropy in bits; null counts as a value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    p = F.col("n") / F.col("t")
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("t")))).agg(F.coalesce(-F.sum(p * F.log2(p)), F.lit(0.0)).alias("bits")).first()["bits"]


def entropies(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, int]]:
    """Entropy in bits and number of distinct values of each column, null counting as a value; one pass."""
    if not columns:
        return {}
    counts = _cells(df, columns).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    # sum of p log p out of sums of n and of n log n: no second look at the total
    rows = counts.groupBy("i").agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.log2("n")).alias("nl"), F.count(F.lit(1)).alias("d")).collect()
    found = {r["i"]: (max(0.0, math.log2(r["t"]) - r["nl"] / r["t"]), r["d"]) for r in rows}
    return {n: found.get(i, (0.0, 0)) for i, n in enumerate(columns)}


def canaries(needles: DataFrame, df: DataFrame, columns: list[str], limit: int = 1000) -> DataFrame:
    """The needles (column x, at most ``limit``: more raise) that stand literally, case aside, in any column.

    One automaton of all needles reads each text once; its size is bounded by the limit.
    """
    found = sorted({r["x"] for r in needles.select("x").where("x <> ''").distinct().limit(limit + 1).collect()})
    if len(found) > limit:
        raise ValueError(f"more than {limit} canaries")
    text = F.lower(F.concat_ws("\u0001", *[F.col(quoted(c)).cast("string") for c in columns]))

    @F.pandas_udf("array<int>")
    def hits(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = ahocorasick.Automaton()
        for i, x in enumerate(found):
            low = x.lower()
            automaton.add_word(low, [*automaton.get(low, []), i])
        automaton.make_automaton()
        for part in parts:
            yield part.map(lambda t: sorted({i for _, which in automaton.iter(t) for i in which}) if found else [])

    where = F.array(*[F.lit(x) for x in found]).cast("array<string>")
    if len(found) > 1000:  # a table of needles rather than a plan full of them
        names = needles.sparkSession.createDataFrame(list(enumerate(found)), "i int, x string")
        return df.select(F.explode(hits(text)).alias("i")).distinct().join(F.broadcast(names), "i").select("x")
    return df.select(F.explode(hits(text)).alias("i")).distinct().select(F.element_at(where, F.col("i") + 1).alias("x"))


def orphans(child: DataFrame, columns: list[str], parent: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of child, without null keys, whose key the parent lacks."""
    there = parent.select(*[F.col(k).alias(c) for k, c in zip(keys, columns, strict=True)]).distinct()
    return child.dropna(subset=columns).join(there, columns, "left_anti")


def checksum(df: DataFrame, key: list[str], column: str) -> int:
    """Order-free checksum of (key, column) pairs; null has a mark of its own."""
    return checksums(df, key, [column]).first()[column]


def checksums(df: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """One row: the checksum of each column. Rows that are equal cancel out in pairs, so the key should be one."""
    one = lambda n: F.coalesce(F.bit_xor(F.xxhash64(*[F.col(quoted(k)) for k in key], F.coalesce(F.col(quoted(n)).cast("string"), F.lit("\u0000null")))), F.lit(0))
    return df.agg(*[one(n).alias(n) for n in columns])


def publishable(log: DataFrame) -> bool:
    """log: seq, stage, tbl, status. Latest row of every stage and table is done, and pass1 and verify are there."""
    last = log.groupBy("stage", "tbl").agg(F.max_by("status", "seq").alias("status"))
    row = last.agg(F.coalesce(F.bool_and(F.col("status") == "done"), F.lit(False)).alias("done"), F.collect_set("stage").alias("stages")).first()
    return bool(row["done"]) and {"pass1", "verify"} <= set(row["stages"])
