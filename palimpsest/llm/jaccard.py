"""N-gram Jaccard join by vertical partitioning.

Every document is its set of 5-word shingles. The global shingle order puts rare
shingles first. Two sets of similarity 0.75 or more must share a shingle in their
prefixes under that order, so only prefixes meet. The order is cut into vertical
fragments; for the pairs that met, the overlap is counted in each fragment
separately and the partial counts are summed per pair.

What keeps it whole and linear in a group of thousands of near copies:

* a shingle that no other document has can't be shared: the fingerprint exchange
  counts each document's shared shingles, and only documents with 75 % of them go on;
* equal sets are one class, represented by the smallest doc_id;
* in the first rounds each class meets one centre per prefix shingle, of another
  component than its own, and the best centres are verified. The first centre is the
  class whose shingles are the most common ones: the text that a group's near copies
  were made of. Pairs that the links found already connect need no test; across
  components a pair is made only if the sets' signatures still allow a link.

A class is the 128-bit hash of its shingle hashes; those that go on are numbered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, NULL_ID, beside, blocks, checkpoint, components, counted, documents, HOT_ROWS, hot_keys, n_buckets, real_id, release, repeated_marks, shingle_sets, total_bytes, with_group_value

#: 100 * intersection >= SIMILARITY * union.
SIMILARITY = 75
#: Where the global order is cut into vertical fragments: at these numbers of classes that hold a shingle.
PIVOTS = [2, 3, 5, 9, 33, 257]
#: Rounds in which a class is held against centres, and centres in a round.
ROUNDS, CENTRES = 3, 2
#: Bits of a class's signature, a power of two.
BITS = 1024


def _marks(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    sets = shingle_sets(texts)
    lens = np.array([len(s) for s in sets], np.int64)
    return np.concatenate(sets), lens, counted(lens), [xxhash.xxh3_128_digest(s) for s in sets]


def _sets(docs: DataFrame) -> DataFrame:
    """(rid, n, tokens, sig) of the documents given as (doc_id, th, text), doc_id a class's number; sig: a bit for each of BITS remainders that a token has."""

    def run(batches):
        for ids, _, texts, _ in blocks(batches):
            sets = [s.view(np.int64) for s in shingle_sets(texts)]
            offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            bits = np.zeros((len(sets), BITS), np.uint8)
            bits[np.repeat(np.arange(len(sets)), np.diff(offsets)), flat & (BITS - 1)] = 1
            sig = pa.array(list(np.packbits(bits, axis=1).view(np.int64)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.diff(offsets).astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), sig], names=["rid", "n", "tokens", "sig"])

    sets = docs.mapInArrow(run, "rid long, n long, tokens array<long>, sig array<long>")
    return sets.select("rid", "n", "tokens", F.struct(*[F.col("sig")[i].alias(f"s{i}") for i in range(BITS // 64)]).alias("sig"))


def _least(n: Column) -> Column:
    """The smallest overlap that any partner of a set of n shingles needs."""
    return F.ceil(n * F.lit(SIMILARITY) / F.lit(100)).cast("long")


def _needed(n: Column, m: Column) -> Column:
    """The smallest overlap that links sets of n and m shingles."""
    return F.ceil(F.lit(SIMILARITY) * (n + m) / F.lit(100 + SIMILARITY))


def _count_within(low: int, high: int) -> Column:
    return F.size(F.filter("t", lambda x: (x["df"] >= low) & (x["df"] < high)))


def _segments(ordered: DataFrame) -> DataFrame:
    """(rid, n, f, seg): the shingles of each class in each vertical fragment."""
    cut = ordered.select("rid", "n", "hs", "sizes", F.posexplode("sizes").alias("f", "size")).where("size > 0")
    start = F.aggregate(F.slice("sizes", F.lit(1), F.col("f")), F.lit(1), lambda a, x: a + x)
    return cut.select("rid", "n", "f", F.slice("hs", start, F.col("size")).alias("seg"))


def _alone(x: str, y: str) -> Column:
    """Shingles of x that y lacks, at least: bits that only x's signature has."""
    out = F.lit(0)
    for i in range(BITS // 64):
        out = out + F.bit_count(F.col(f"{x}.s{i}").bitwiseAND(F.bitwise_not(F.col(f"{y}.s{i}"))))
    return out


def _possible(n: str, sig: str, m: str, sig_m: str) -> Column:
    """Whether signatures allow sets of n and m shingles to link."""
    return F.least(F.col(n) - _alone(sig, sig_m), F.col(m) - _alone(sig_m, sig)) >= _needed(F.col(n), F.col(m))


def _verified(pairs: DataFrame, ordered: DataFrame) -> DataFrame:
    """The pairs (a, b) that link: overlaps counted in each fragment, then summed per pair."""
    segments = _segments(ordered)
    left = segments.select(F.col("rid").alias("a"), "f", F.col("seg").alias("sa"), F.col("n").alias("na"))
    right = segments.select(F.col("rid").alias("b"), "f", F.col("seg").alias("sb"), F.col("n").alias("nb"))
    met = pairs.join(left, "a").join(right, ["b", "f"])
    partial = met.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).cast("long").alias("c"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c"))
    return total.where(F.lit(100) * F.col("c") >= F.lit(SIMILARITY) * (F.col("na") + F.col("nb") - F.col("c"))).select("a", "b")


def links_of(reps: DataFrame) -> DataFrame:
    """(node, comp) of the classes that have a link. reps: (rid, n, tokens, sig) as a checkpoint, sets pairwise different, rid unique."""
    spark = reps.sparkSession
    release(spark)
    # the global order: number of classes that hold the shingle, then its hash; a shingle of one class alone links nothing
    tokens = reps.select("rid", F.explode("tokens").alias("h")).repartition("h")  # one exchange, counted and joined
    df = tokens.groupBy("h").agg(F.count(F.lit(1)).cast("int").alias("df")).where("df > 1")
    t = F.array_sort(F.collect_list(F.struct("df", "h")))
    shared = tokens.join(df, "h").groupBy("rid").agg(t.alias("t"), F.sum(F.log2("df")).alias("common")).join(reps.select("rid", "n", "sig"), "rid")
    need = _least(F.col("n"))
    within = [_count_within(a, b) for a, b in zip(PIVOTS, [*PIVOTS[1:], 2**31 - 1], strict=True)]
    ordered = checkpoint(shared.where(F.size("t") >= need).select("rid", "n", "sig", (F.col("common") / F.col("n")).alias("weight"), F.transform("t", lambda x: x["h"]).alias("hs"), F.array(*within).alias("sizes")))
    del tokens, df, shared, reps
    release(spark)
    nothing = spark.createDataFrame([], "node long, comp long")
    if ordered.isEmpty():
        return nothing
    # a posting knows how many shared shingles follow it: the overlap of a pair that meets here first can't be larger
    prefix = F.slice("hs", F.lit(1), (F.size("hs") - need + 1).cast("int"))
    postings = checkpoint(ordered.select("rid", "n", "weight", F.size("hs").alias("m"), F.posexplode(prefix).alias("pos", "h")).select("h", "rid", "n", "weight", (F.col("m") - F.col("pos")).alias("rest")))

    hot = hot_keys(postings, "h", HOT_ROWS)

    def may_link(n, rest, m, rest_m) -> Column:
        return F.least(F.col(rest), F.col(rest_m)) >= _needed(F.col(n), F.col(m))

    links, comp = None, None
    for turn in range(ROUNDS):
        lists = _mixed(postings, comp, hot)
        found = None
        for seed in range(turn * CENTRES, (turn + 1) * CENTRES):
            # the centre of a list: of its largest component the member with the most common shingles, or with the least hash
            order = F.xxhash64("rid", F.lit(seed)) if seed % CENTRES else F.struct(-F.col("weight"), F.xxhash64("rid", F.lit(seed)))
            centre = lists.where("comp = major").groupBy("h").agg(F.min_by(F.struct("rid", "n", "rest", "comp"), order).alias("c"))
            near = beside(lists, centre, "h", hot).where(F.col("comp") != F.col("c.comp")).where(may_link("n", "rest", "c.n", "c.rest"))
            near = near.groupBy("rid", F.col("c.rid").alias("hub")).agg(F.count(F.lit(1)).alias("k"))
            best = near.groupBy("rid").agg(F.max_by("hub", F.struct("k", "hub")).alias("hub"))
            best = best.select(F.least("rid", "hub").alias("a"), F.greatest("rid", "hub").alias("b"))
            found = best if found is None else found.unionByName(best)
        more = checkpoint(_verified(found.distinct(), ordered))
        if more.isEmpty():
            break
        links = more if links is None else links.unionByName(more)
        comp = checkpoint(components(links))
        del lists, found, centre, near, best, more
        release(spark)

    # all pairs across components. In each list the members of its largest component need no pairs among themselves
    lists = _mixed(postings, comp, hot).join(ordered.select("rid", "sig"), "rid")
    other = lists.where("comp <> major").select("h", F.col("rid").alias("x"), F.col("n").alias("nx"), F.col("rest").alias("rx"), F.col("comp").alias("cx"), F.col("sig").alias("gx"))
    every = lists.select("h", F.col("rid").alias("y"), F.col("n").alias("ny"), F.col("rest").alias("ry"), F.col("comp").alias("cy"), F.col("sig").alias("gy"), "major")
    across = (F.col("cx") != F.col("cy")) & ((F.col("cy") == F.col("major")) | (F.col("x") < F.col("y")))
    cross = other.join(every, "h").where(across & may_link("nx", "rx", "ny", "ry") & _possible("nx", "gx", "ny", "gy"))
    cross = cross.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    more = checkpoint(_verified(cross, ordered))
    if more.isEmpty():
        return nothing if comp is None else comp
    return components(more if links is None else links.unionByName(more))


def _mixed(postings: DataFrame, comp: DataFrame | None, hot: list[int]) -> DataFrame:
    """The postings of lists that hold several components, with their component and the list's largest one."""
    own = F.lit(None).cast("long") if comp is None else F.col("comp")
    named = postings if comp is None else postings.join(comp, F.col("rid") == F.col("node"), "left")
    labelled = checkpoint(named.select("h", "rid", "n", "weight", "rest", F.coalesce(own, "rid").alias("comp")))
    per = labelled.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("k"))
    major = per.groupBy("h").agg(F.max_by("comp", F.struct("k", "comp")).alias("major"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    return checkpoint(beside(labelled, major, "h", hot).drop("comps"))


def _assigned(body: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(meta, ids): every row's doc_id, th, class gk (null without words) and n; each class's cnt, component_id and the
    (doc_id, th) that stands for its component."""
    marked = repeated_marks(body, _marks, n_buckets(total_bytes(body)), want_places=False, width=3)
    meta = checkpoint(marked.select("doc_id", "th", F.col("payload").alias("gk"), F.col("n_marks").alias("n"), "n_hits"))
    del marked
    release(body.sparkSession)
    classes = meta.where("n > 0").groupBy("gk").agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.count(F.lit(1)).alias("cnt"), F.max("n").alias("n"), F.max("n_hits").alias("n_hits"))
    # a class of several documents shares every shingle; its own copies don't count as partners, the exact join sorts that out
    going = classes.where(F.col("n_hits") >= _least(F.col("n"))).select(F.col("rep.doc_id").alias("doc_id"), F.col("rep.th").alias("th"), "gk")
    # a doc_id may stand for several texts: classes go by a number of their own, settled once it is written
    going = checkpoint(going.withColumn("rid", F.monotonically_increasing_id()))
    comp = links_of(checkpoint(_sets(body.join(going.drop("gk"), KEY).dropDuplicates(KEY).select(F.col("rid").alias("doc_id"), "th", "text"))))
    linked = going.select("gk", "rid").join(comp, F.col("rid") == F.col("node")).select("gk", "comp")
    joined = classes.select("gk", "rep", "cnt").join(linked, "gk", "left")
    least = joined.where("comp is not null").groupBy("comp").agg(F.min("rep").alias("least"))
    named = joined.join(least, "comp", "left").withColumn("least", F.coalesce("least", "rep"))
    return meta, checkpoint(named.select("gk", "cnt", F.col("least.doc_id").alias("component_id"), "least"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id of every row.

    component_id is the smallest doc_id reachable by links, itself included. A
    document without words, or with a null text, has an empty set and links with
    nothing. Rows that repeat a doc_id are documents of their own; a null doc_id
    takes part as the smallest id and gives component_id null where it is the
    smallest reached. Empty input: no rows. Extra columns are ignored.
    """
    meta, ids = _assigned(documents(docs, text, key))
    full = with_group_value(meta.where("n > 0").select("doc_id", "gk", "n"), ids, "gk", "cnt").select("doc_id", "n", "component_id")
    alone = meta.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return full.unionByName(alone).select(real_id("doc_id"), F.col("n").cast("long").alias("n_shingles"), real_id("component_id"))


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of docs, all columns, for each component: of its smallest doc_id, and of that id's texts the one with the least hash.

    Rows that are equal in doc_id and text are one document, of which one row
    stays. Rows without words, or with a null text, belong to no component and all
    stay. Columns may have any names. Empty input: no rows.
    """
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text_, key_ = (F.col(f"c{docs.columns.index(c)}") for c in (text, key))
    body = F.coalesce(text_.cast("string"), F.lit(""))
    keyed = named.select("*", F.coalesce(key_.cast("long"), F.lit(NULL_ID)).alias("k_id"), F.xxhash64(body).alias("k_th"), body.rlike(r"[^ \t-\r]").alias("k_words"))
    _, ids = _assigned(documents(docs, text, key))
    kept = ids.select(F.col("least.doc_id").alias("k_id"), F.col("least.th").alias("k_th")).distinct()
    one = keyed.where("k_words").dropDuplicates(["k_id", "k_th"]).join(kept, ["k_id", "k_th"], "left_semi")
    return one.select(*named.columns).unionByName(keyed.where("not k_words").select(*named.columns)).toDF(*docs.columns)
