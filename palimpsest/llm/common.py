"""What the corpus operators share: shared scratch space, skew-safe joins, the
fingerprint exchange and connected components.

Row identity. ``doc_id`` may be null or repeated, so a document is keyed by
``(doc_id, th)`` with ``th = xxhash64(text)``; a null doc_id stands as NULL_ID
inside the operators. Rows equal in both are the same document written twice:
every operator gives both the same answer.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import pickle
import re
import tempfile
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that ``[A-Z]`` become; used with bytes.translate.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Text bytes that one block of an exchange holds, one bucket of it stands for, and one Arrow batch holds.
BLOCK_BYTES, BUCKET_BYTES, BATCH_BYTES = 4 << 20, 8 << 20, 8 << 20
#: Rows from which a key may be hot: below, one task takes them all and a broadcast costs more exchanges than it spares.
HOT_ROWS = 100_000
#: Stands for a null doc_id, before all others.
NULL_ID = -(2**63)
KEY = ["doc_id", "th"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a folder of our own on a single
    machine (tests); a cluster raises, for its executors would not share that."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
    global _OWN
    if not _OWN:
        _OWN = "file://" + tempfile.mkdtemp(prefix="palimpsest-")
    return _OWN


_OWN = ""


def checkpoint(df: DataFrame) -> DataFrame:
    """Writes df once to the shared folder and cuts its lineage; a lost executor loses nothing of it."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop the shuffle files of rounds that are over: it acts when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def trim(*caches: dict) -> None:
    """Empties caches at a task's end and hands memory back: workers live on and serve other operators."""
    for cache in caches:
        cache.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a libc without it
        ctypes.CDLL(None).malloc_trim(0)


def bounded_batches(spark: SparkSession) -> None:
    """Texts may be long: an Arrow batch that goes to a Python worker is bounded by its bytes."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def documents(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, th, text) with a null text as the empty text; all other columns are dropped, so none can clash."""
    bounded_batches(docs.sparkSession)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.xxhash64(body).alias("th"), body.alias("text"))


def total_bytes(docs: DataFrame) -> int:
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]


def n_buckets(size: int) -> int:
    return int(min(max(64, size // BUCKET_BYTES), 200_000))


def real_id(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(NULL_ID)).alias(column)


def with_group_value(rows: DataFrame, groups: DataFrame, key: str, count: str, hot_share: int = 500) -> DataFrame:
    """Left join of rows with one row per key of ``groups``, safe when one key holds a third of all rows.

    Keys with more than 1/hot_share of all rows number fewer than hot_share, so
    they are broadcast under that bound; the rest meet in a shuffle, where no key
    is large. ``count`` is the groups' column of rows per key.
    """
    n = groups.agg(F.coalesce(F.sum(count), F.lit(0)).alias("n")).first()["n"]
    limit = max(1, n // hot_share)
    hot = groups.where(F.col(count) > limit)
    cold = groups.where(F.col(count) <= limit)
    hot_keys = hot.select(F.col(key).alias("_hot"))
    flagged = rows.join(F.broadcast(hot_keys.withColumn("_is_hot", F.lit(True))), F.col(key) == F.col("_hot"), "left").drop("_hot")
    one = flagged.where(F.col("_is_hot")).drop("_is_hot").join(F.broadcast(hot), key, "left")
    two = flagged.where(F.col("_is_hot").isNull()).drop("_is_hot").join(cold, key, "left")
    return one.unionByName(two)


def pack(*arrays) -> bytes:
    return pickle.dumps(arrays, protocol=5)


def unpack(data) -> tuple:
    return pickle.loads(data if isinstance(data, bytes) else data.as_py())


class WordHashes(dict):
    """64-bit hash of a word (bytes); emptied when it has grown to ``limit`` words, which bounds memory."""

    limit = 250_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = WordHashes()
#: Odd multipliers of the places in a shingle.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Of each text, lower-cased in A-Z, the sorted distinct hashes of its 5-word shingles; with fewer words the whole sequence is one."""
    words = [t.encode().translate(LOWER).split() for t in texts]
    size, n = [len(w) for w in words], len(PLACES)
    h = np.fromiter(map(_WORDS.__getitem__, chain.from_iterable(words)), np.uint64, sum(size))
    wide = max(len(h) - n + 1, 0)
    s = np.zeros(wide, np.uint64)
    for j in range(n):
        s += h[j : wide + j] * PLACES[j]
    s = mix(s)
    out, at = [], 0
    for w, k in zip(words, size, strict=True):
        if k >= n:
            own = np.sort(s[at : at + k - n + 1])
            out.append(own[np.r_[True, own[1:] != own[:-1]]])
        else:
            out.append(np.array([xxhash.xxh3_64_intdigest(b"\x00".join(w), seed=k)] if w else [], np.uint64))
        at += k
    return out


def shingles(text: str) -> np.ndarray:
    return shingle_sets([text])[0]


def blocks(batches: Iterator[pa.RecordBatch], extra: str | None = None, limit: int = BLOCK_BYTES) -> Iterator[tuple[list, list, list, list]]:
    """Lists (doc_id, th, text, extra) of about ``limit`` bytes of text; a longer text makes a block of its own."""
    ids: list = []
    ths: list = []
    texts: list = []
    extras: list = []
    size = 0
    for batch in batches:
        also = batch[extra] if extra else batch["th"]
        for i, h, t, x in zip(batch["doc_id"].to_pylist(), batch["th"].to_pylist(), batch["text"], also, strict=True):
            t = t.as_py()
            ids.append(i), ths.append(h), texts.append(t), extras.append(x.as_py())
            size += len(t)
            if size >= limit:
                yield ids, ths, texts, extras
                ids, ths, texts, extras, size = [], [], [], [], 0
    if ids:
        yield ids, ths, texts, extras


#: Of a block's texts (and what else a column holds of each): all hashes, how many each text has, their places, a payload of each.
Marks = Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray, list]]


def each(marks: Callable[[str], np.ndarray]) -> Marks:
    """Marks of a block's texts, one by one; places count from 0 in each text."""

    def run(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        got = [marks(t) for t in texts]
        lens = np.array([len(g) for g in got], np.int64)
        return np.concatenate(got) if got else np.empty(0, np.uint64), lens, counted(lens), [b""] * len(got)

    return run


def counted(lens: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... for each length, one after the other."""
    return np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)


def _first_of_runs(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys begin a new run of equal ones."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def ordered(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): places in the order of the tuples of keys, and whether a new tuple begins. A key is looked at only where those before it tie."""
    order = np.argsort(keys[0])
    first = keys[0][order]
    new = np.r_[True, first[1:] != first[:-1]][: len(order)]
    for key in keys[1:]:
        at = np.flatnonzero(~(new & np.r_[new[1:], True][: len(new)]))
        if not len(at):
            break
        group = (np.cumsum(new) - 1)[at]
        mine = order[at]
        value = key[mine]
        by = np.argsort(value)
        up = value[by]
        rank = np.empty(len(at), np.int64)
        rank[by] = np.cumsum(np.r_[False, up[1:] != up[:-1]])
        both = group << 32 | rank
        by = np.argsort(both)
        order[at], both = mine[by], both[by]
        new[at] = np.r_[True, both[1:] != both[:-1]]
    return order, new


def packed(*fields: np.ndarray) -> list[np.ndarray]:
    """Keys that order as the tuples of non-negative fields do: one number, if that holds them all."""
    bits = [int(f.max(initial=0)).bit_length() for f in fields]
    if sum(bits) > 63:
        return list(fields)
    out = np.zeros(len(fields[0]), np.int64)
    for f, n in zip(fields, bits, strict=True):
        out = out << n | f.astype(np.int64)
    return [out]


def _cut(h: np.ndarray, width: int) -> np.ndarray:
    """The fingerprints of ``width`` bytes, as bytes."""
    return np.ascontiguousarray((h >> np.uint64(32)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width]).reshape(-1)


def _small(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _whole(cut: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(cut) // width, 4), np.uint8)
    out[:, :width] = cut.reshape(-1, width)
    return out.view("<u4").reshape(-1)


def repeated_marks(docs: DataFrame, marks: Marks, buckets: int, want_places: bool, later: bool = False, extra: str | None = None, width: int = 4, through: bool = False, hot: int = 0) -> DataFrame:
    """Which marks of each document occur anywhere else, or (later) anywhere before.

    ``marks(texts)``, or ``marks(texts, extra column)``, gives the 64-bit marks of a
    block's documents, the marks' places and a payload that is carried through. Result:
    doc_id, th, payload, n_marks, n_hits and hits (with want_places: packed
    uint32 places of the marks that were met). A mark that stands twice in one
    document counts as repeated.

    Marks are dealt out to hash buckets that stand for 8 MB of text each, as
    fingerprints of ``width`` bytes there, so about 0.02 % (3 bytes: 5 %) of the lone
    marks are reported too: callers verify. With ``later`` full hashes travel, and
    32 bits more that marks gives as a fifth array (of 10^13 marks no two then fall
    together by chance), each with its document's
    id, and every mark but the first in order of (doc_id, th, place) is a hit. A
    block of documents sends each distinct mark once, whatever its frequency, so
    a mark in a third of all documents costs its bucket one entry per block. What a
    block keeps to itself waits in the first exchange; with ``through`` it travels
    with the answers instead, for inputs out of joins, where Spark would not use the
    exchange again but read and mark the documents twice. With ``hot`` a column of
    that name has the places of the marks that so many blocks or more hold.
    """

    def emit(batches):
        for ids, ths, texts, extras in blocks(batches, extra):
            allm, lens, place, payload, *check = marks(texts, extras) if extra else marks(texts)
            row, place = np.repeat(np.arange(len(ids), dtype=np.uint32), lens), place.astype(np.uint32)
            if later:
                where = np.lexsort((np.array(ths), np.array(ids)))  # documents in order; equal keys are one document
                i, t = np.array(ids)[where], np.array(ths)[where]
                rank = np.empty(len(ids), np.int64)
                rank[where] = np.cumsum(_first_of_runs(i, t))
                spot = rank[row] << 32 | place
                order, _ = ordered([allm, check[0], spot])
                spot = spot[order]
                new = _first_of_runs(allm[order], check[0][order])
                run = np.cumsum(new) - 1
                local = np.zeros(len(spot), bool)
                local[order] = spot > spot[new][run] if len(spot) else False
                alone = np.ones(int(new.sum()), bool)
            else:
                order = np.argsort(allm)
                new = _first_of_runs(allm[order])
                last = np.r_[new[1:], True][: len(new)]
                local = np.zeros(len(allm), bool)
                local[order] = ~(new & last)
                alone = (new & last)[new]
            first = order[new]
            h = allm[first]
            bucket = (h % np.uint64(buckets)).astype(np.int32)
            block = xxhash.xxh3_64_intdigest(repr((ids, ths)).encode()) >> 1
            here = np.flatnonzero(local)
            known = pack(ids, ths, payload, lens, row[here], place[here] if want_places else None)
            out_k, out_b, out_d = [-1 - block], [None], [known]  # buckets count from 0, blocks from -1 down
            # marks that need no answer stand last in their bucket
            by, _ = ordered(packed(bucket, ~alone, row[first], place[first]))
            cut = np.flatnonzero(_first_of_runs(bucket[by])).tolist()
            if hot:  # where the marks that a bucket may call hot stand
                known = pack(*unpack(known), (row[order], place[order], np.flatnonzero(new), by, dict(zip(bucket[by[cut]].tolist(), cut, strict=True))))
                out_d[0] = known
            for a, z in zip(cut, [*cut, len(by)][1:], strict=False):  # no marks: no cuts
                pick = by[a:z]
                r = row[first[pick]]
                if later:
                    used, own = np.unique(r, return_inverse=True)
                    body = pack(h[pick], _small(own), _small(place[first[pick]]), used, np.array(ids)[used], np.array(ths)[used], check[0][first[pick]])
                else:
                    r = r[: int(alone[pick].sum())]
                    step = np.diff(r, prepend=np.uint32(0))  # small numbers compress well
                    body = pack(_cut(h[pick], width), step.astype(np.min_scalar_type(int(step.max(initial=0)))), place[first[pick]][: len(r)] if want_places else None)
                out_k.append(int(bucket[pick[0]])), out_b.append(-1 - block), out_d.append(body)
            yield pa.RecordBatch.from_arrays([pa.array(out_k, pa.int64()), pa.array(out_b, pa.int64()), pa.array(out_d, pa.binary())], names=["key", "block", "data"])

    def meet(group: pa.Table) -> pa.Table:
        rest = [(b, unpack(d)) for b, d in zip(group["block"].to_pylist(), group["data"], strict=True) if b is not None]
        out = [(k, None, d.as_py()) for k, b, d in zip(group["key"].to_pylist(), group["block"], group["data"], strict=True) if through and not b.is_valid]
        if rest:
            mark = np.concatenate([x[0] if later else _whole(x[0], width) for _, x in rest])
            hit = np.zeros(len(mark), bool)
            if later:
                ids, ths = (np.concatenate([x[j][x[1]] for _, x in rest]) for j in (4, 5))
                places = np.concatenate([x[2].astype(np.uint32) for _, x in rest])
                more = np.concatenate([x[6] for _, x in rest])
                order, _ = ordered([mark, more, ids, ths, places])
                new = _first_of_runs(mark[order], more[order])
                fresh = _first_of_runs(mark[order], more[order], ids[order], ths[order], places[order])
                step = np.cumsum(fresh)
                hit[order] = step > step[new][np.cumsum(new) - 1]
            else:
                order = np.argsort(mark)
                new = _first_of_runs(mark[order])
                hit[order] = ~(new & np.r_[new[1:], True])
                if hot:
                    often = np.zeros(len(mark), bool)
                    often[order] = np.repeat(np.diff(np.r_[np.flatnonzero(new), len(mark)]) >= hot, np.diff(np.r_[np.flatnonzero(new), len(mark)]))
            at = 0
            for b, x in rest:
                r = x[3][x[1]] if later else np.cumsum(x[1], dtype=np.uint32)
                h = hit[at : at + len(r)]
                n = len(x[0]) // (1 if later else width)
                called = np.flatnonzero(often[at : at + n]).astype(np.uint32) if hot else None
                at += n
                if h.any() or (hot and len(called)):
                    out.append((b, group["key"][0].as_py(), pack(r[h], x[2][h].astype(np.uint32) if want_places else None, called)))
        return pa.table([pa.array([x[j] for x in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.binary()))], names=["block", "bucket", "data"])

    def answer(asked: pa.Table, answers: pa.Table) -> pa.Table:
        known = [unpack(d) for b, d in zip(asked["block"], asked["data"], strict=True) if not b.is_valid]
        return laid(known, dict(zip(answers["bucket"].to_pylist(), answers["data"], strict=True)))

    def answer_alone(group: pa.Table) -> pa.Table:
        rows = list(zip(group["bucket"].to_pylist(), group["data"], strict=True))
        return laid([unpack(d) for b, d in rows if b is None], {b: d for b, d in rows if b is not None})

    def laid(known: list, answers: dict) -> pa.Table:
        if not known:  # a bucket's marks
            return out_schema.empty_table()
        ids, ths, payload, lens, row, place, *where = known[0]
        hits = [unpack(d) for d in answers.values()]  # one for each bucket, though a block that was read twice is answered twice
        rows = np.concatenate([row, *[x[0] for x in hits]]).astype(np.int64)
        count = np.bincount(rows, minlength=len(ids))
        got: list = [None] * len(ids)
        if want_places:
            places = np.concatenate([place, *[x[1] for x in hits]])
            order, _ = ordered(packed(rows, places))
            got = [pack(x) for x in np.split(places[order], np.cumsum(count)[:-1])]
        times = len(known)  # a block that was read twice has its documents twice
        cols = [pa.array(ids * times, pa.int64()), pa.array(ths * times, pa.int64()), pa.array(payload * times, pa.binary()), pa.array(list(lens) * times, pa.int64()), pa.array(list(count) * times, pa.int64()), pa.array(got * times, pa.binary())]
        if hot:
            rows_of, places_of, start, by, cut = where[0]
            size = np.diff(np.r_[start, len(rows_of)])
            marks_ = np.concatenate([np.empty(0, np.int64), *[by[cut[b] + unpack(d)[2]] for b, d in answers.items()]])
            at = np.repeat(start[marks_], size[marks_]) + counted(size[marks_])
            order, _ = ordered(packed(rows_of[at], places_of[at]))
            own = np.split(places_of[at][order], np.cumsum(np.bincount(rows_of[at], minlength=len(ids)))[:-1])
            cols.append(pa.array([pack(x) for x in own] * times, pa.binary()))
        return pa.table(cols, names=out_schema.names)

    columns = [*KEY, "text", *([extra] if extra else [])]
    out_schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("payload", pa.binary()), ("n_marks", pa.int64()), ("n_hits", pa.int64()), ("hits", pa.binary()), ("hot", pa.binary())][: 7 if hot else 6])
    sent = docs.select(*columns).mapInArrow(emit, "key long, block long, data binary")
    met = sent.groupBy("key").applyInArrow(meet, "block long, bucket long, data binary")
    ddl = "doc_id long, th long, payload binary, n_marks long, n_hits long, hits binary" + ", hot binary" * bool(hot)
    if through:
        return met.groupBy("block").applyInArrow(answer_alone, ddl)
    # what a block keeps stays in the partitions of the first exchange, which serves both sides
    return sent.groupBy("key").cogroup(met.groupBy("block")).applyInArrow(answer, ddl)


def hot_keys(rows: DataFrame, key: str, least: int = 1) -> list[int]:
    """The keys that over a five-hundredth of the rows have, and over ``least``: fewer than 500."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("k"))
    n = rows.count()
    return [r[key] for r in counts.where(F.col("k") > max(least, n // 500)).select(key).collect()]


def beside(rows: DataFrame, one: DataFrame, key: str, hot: list[int]) -> DataFrame:
    """Rows with their key's only row of ``one``, which is broadcast for the hot keys, so that no task gets all rows of one."""
    if not hot:
        return rows.join(one, key)
    is_hot = F.col(key).isin(hot)
    return rows.where(is_hot).join(F.broadcast(one.where(is_hot)), key).unionByName(rows.where(~is_hot).join(one.where(~is_hot), key))


def components(links: DataFrame) -> DataFrame:
    """Connected components of (a, b) links: (node, comp) with comp the smallest node reachable.

    Alternating large-star and small-star rounds; each round is two shuffles with
    partial aggregation and is checkpointed. Rounds grow with the logarithm of
    the components' size. A star's centre is never gathered into one row or task: the
    rounds use joins with the aggregated minimum, broadcast for the largest stars.
    """
    edges = checkpoint(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        # large star: every neighbour above u is linked to u's smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hot = hot_keys(both, "u", HOT_ROWS)
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = beside(both, low, "u", hot).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small star: every smaller neighbour, and u itself, is linked to the smallest
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = beside(large, low, "u", hot).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = checkpoint(small)
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        del both, low, large, small
        release(edges.sparkSession)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def hex_sha256(column: Column) -> Column:
    return F.sha2(column, 256)
