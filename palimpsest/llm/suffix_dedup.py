"""Exact substring dedup with suffix arrays built blockwise over a difference cover.

A 400-byte string that occurs twice has, in both places, the same anchors: the
32-byte grams that are the least in a 256-byte window. The fingerprint exchange
tells which anchors occur elsewhere; only strings whose anchors all do can repeat.
Their suffixes are dealt out by the anchor that comes first, so equal strings meet;
where many blocks hold an anchor, by it and the text before or behind it that the
string must have, so that no anchor's suffixes all go to one task.

A task then sorts the suffixes of its texts bucket by bucket. Ranks of the cover
sample, the places whose offset modulo V is in a difference cover, are computed
first, by doubling. A bucket holds the suffixes with one first byte range; it is
sorted by the first V bytes, and ties are resolved by the sample ranks at the
places at which both suffixes meet the cover. Neighbours in the order are then
compared at their full 400 bytes, again by ranks. Memory is bounded by the bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import KEY, NULL_ID, documents, each, n_buckets, ordered, real_id, repeated_marks, total_bytes, unpack

#: Bytes of a string that counts as a repeat, of an anchor's gram, and places in an anchor's window.
LENGTH, GRAM, WINDOW = 400, 32, 256
#: Bytes of a repeated passage of over 50 words: 51 words of 5 bytes, or fewer of longer ones, and their blanks. From 287 on the anchors serve any length up to LENGTH.
PASSAGE = 300
#: Period of the cover, and a difference cover modulo it (fixed values).
V = 32
COVER = [0, 1, 2, 4, 8, 13, 18, 24]
#: Bytes that the sample's ranks compare.
DEPTH = 256
#: Blocks that make an anchor hot.
HOT = 32
#: Suffixes that one bucket of a task sorts at a time.
BUCKET_SUFFIXES = 1 << 20

_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _meeting(start: int) -> np.ndarray:
    """meet[r, s]: the least d >= start with (r + d) % V and (s + d) % V both in the cover; d < start + V."""
    has = np.zeros(V, bool)
    has[COVER] = True
    r, s, d = np.ogrid[:V, :V, start : start + V]
    both = has[(r + d) % V] & has[(s + d) % V]
    if not both.any(axis=2).all():
        raise ValueError("not a difference cover")
    return both.argmax(axis=2) + start


#: Where two suffixes meet the cover: within the first V bytes; so that DEPTH bytes reach LENGTH; by length, so that they end V bytes before it at the earliest, and in it.
MEET, MEET_LATE, MEET_LAST = _meeting(0), _meeting(LENGTH - DEPTH), {n: _meeting(n - DEPTH - V + 1) for n in (LENGTH, PASSAGE)}


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each place on."""
    h, k = _BYTES[b], 1
    for c in _STEPS:
        if len(h) <= k:
            return np.empty(0, np.uint64)
        x = h[:-k] * c
        x ^= x >> np.uint64(29)
        x += h[k:]
        h, k = x, k * 2
    h *= _STEPS[0]
    return h ^ (h >> np.uint64(32))


def _slide(h: np.ndarray, f) -> np.ndarray:
    """f over the WINDOW values from each place on."""
    k = 1
    while k < WINDOW:
        if len(h) <= k:
            return np.empty(0, np.uint64)
        h = f(h[:-k], h[k:])
        k *= 2
    return h


def _anchor_runs(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, values) of the runs of places whose window has the same least gram; gram hashes and window minima."""
    h = gram_hashes(np.frombuffer(text, np.uint8))
    m = _slide(h, np.minimum)
    if not len(m):
        return np.empty(0, np.int64), m, h, m
    at = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
    return at, m[at], h, m


def _marks(text: str) -> np.ndarray:
    """The values of a text's runs. A value that two places within one run have is sent twice: periodic text repeats itself.
    Places WINDOW apart share no window but are seen by adjacent ones, whose equal minima are one run."""
    _, values, h, m = _anchor_runs(text.encode())
    if not len(m):
        return m
    edge = np.zeros(WINDOW - 1, np.uint64)
    at = np.flatnonzero(h == _slide(np.concatenate((edge, m, edge)), np.maximum))
    twice = (h[at[1:]] == h[at[:-1]]) & (at[1:] - at[:-1] <= WINDOW)
    return np.concatenate((values, h[at[1:][twice]]))


def _parted(text: bytes, value: int, places: np.ndarray, a: int, z: int, length: int) -> list[tuple[int, int, int]]:
    """The starts [a, z) parted by what their strings have beside the anchor, at the first of ``places`` from the start on:
    the ``side`` bytes before it, or where a start is nearer to it than that, the bytes behind it."""
    side = (length - GRAM) // 2
    out, at = [], a
    for p in places[np.searchsorted(places, a) :].tolist():
        for end, beside, seed in ((p - side + 1, text[max(0, p - side) : p], 1), (p + 1, text[p + GRAM : p + GRAM + side], 2)):
            end = min(end, z)
            if at < end:
                out.append(((value ^ xxhash.xxh3_64_intdigest(beside, seed=seed)) & (2**64 - 1), at, end))
                at = end
        if at >= z:
            break
    return out


def candidates(text: bytes, hits: np.ndarray, length: int = LENGTH, hot: np.ndarray = ()) -> list[tuple[int, int, int]]:
    """(value to deal by, first start, end of starts) of the strings of ``length`` bytes that may repeat, given the runs whose
    anchors do, and those whose anchors are hot."""
    n = len(text) - length + 1
    if n <= 0 or not len(hits):
        return []
    at, values, grams, _ = _anchor_runs(text)
    hits, hot = hits[hits < len(at)], set(np.asarray(hot, np.int64).tolist())
    total = len(text) - GRAM - WINDOW + 2
    bad = np.ones(len(at), bool)
    bad[hits] = False
    ends = np.r_[at[1:], total]
    # a string sees this many windows; a run of lone anchors spoils every string that sees it
    inside = length - GRAM - WINDOW + 2
    spoil = np.zeros(n + 1, np.int64)
    np.add.at(spoil, np.clip(at[bad] - inside + 1, 0, n), 1)
    np.add.at(spoil, np.clip(ends[bad], 0, n), -1)
    good = np.cumsum(spoil[:n]) == 0
    out = []
    for k in np.flatnonzero(~bad):
        a, z = int(at[k]), int(min(ends[k], n))
        if a >= z or not good[a:z].any():
            continue
        edge = np.flatnonzero(np.diff(np.r_[False, good[a:z], False].astype(np.int8)))
        mine = [(int(values[k]), a + int(p), a + int(q)) for p, q in edge.reshape(-1, 2)]
        if int(k) in hot:
            places = a + np.flatnonzero(grams[a : int(ends[k]) + WINDOW - 1] == values[k])
            mine = [x for v, p, q in mine for x in _parted(text, v, places, p, q, length)]
        out += mine
    return out


def _words(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as a big-endian number."""
    w = text.astype(np.uint64)
    for k in (1, 2, 4):
        w = (w[:-k] << np.uint64(8 * k)) | w[k:]
    return w


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks from 1 of the tuples of keys, equal for equal tuples."""
    order, new = ordered(list(keys))
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


class SuffixSorter:
    """Sorts suffixes of a text, zero bytes after its end, by their first LENGTH bytes."""

    def __init__(self, text: bytes):
        self.size = len(text)
        padded = np.zeros(self.size + 2 * LENGTH + 4 * V, np.uint8)
        padded[: self.size] = np.frombuffer(text, np.uint8)
        self.word = _words(padded)
        # ranks of the sample's suffixes by their first V, 2V ... DEPTH bytes
        places = np.arange(self.size + LENGTH)
        own = np.zeros(V, bool)
        own[COVER] = True
        sample = places[own[places % V]]
        slot = np.full(self.size + 2 * LENGTH, -1, np.int64)
        slot[sample] = np.arange(len(sample))
        rank = _dense(*(self.word[sample + 8 * j] for j in range(V // 8)))
        depth = V
        while depth < DEPTH:
            there = slot[sample + depth]
            rank = _dense((rank << 32) | np.where(there >= 0, rank[there], 0))
            depth *= 2
        self.rank_at = np.zeros(len(slot), np.int64)
        self.rank_at[sample] = rank

    def _compare(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Sign of the suffixes' order past their first V bytes, by sample ranks; i and j agree in those bytes.
        0: LENGTH bytes are equal, at least."""
        r, s = i % V, j % V
        d = MEET[r, s]
        sign = np.sign(self.rank_at[i + d] - self.rank_at[j + d])
        tied = np.flatnonzero(sign == 0)
        i, j, e = i[tied], j[tied], MEET_LATE[r[tied], s[tied]]
        sign[tied] = np.sign(self.rank_at[i + e] - self.rank_at[j + e])
        return sign

    def buckets(self, starts: np.ndarray):
        """The suffixes at ``starts``, one bucket at a time, by their first two bytes."""
        first = (self.word[starts] >> np.uint64(48)).astype(np.int64)
        counts = np.bincount(first, minlength=65536)
        group = np.cumsum(counts) // BUCKET_SUFFIXES
        for g in np.unique(group[first]) if len(starts) else []:
            yield starts[group[first] == g]

    def sort(self, starts: np.ndarray) -> np.ndarray:
        """The suffixes of one bucket in order: by V bytes, then by quicksort rounds on the sample ranks."""
        order, new = ordered([self.word[starts + 8 * j] for j in range(V // 8)])
        starts = starts[order]
        group = np.cumsum(new)
        open_ = np.arange(len(starts))  # places of the order that belong to ties
        while len(open_):
            g = group[open_]
            cut = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            size = np.diff(np.r_[cut, len(g)])
            tied = np.repeat(size > 1, size)
            open_, g = open_[tied], g[tied]
            if not len(open_):
                break
            cut = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            size = np.diff(np.r_[cut, len(g)])
            pivot = np.repeat(starts[open_][cut + size // 2], size)
            sign = self._compare(starts[open_], pivot)
            again = np.lexsort((sign, g))
            starts[open_] = starts[open_][again]
            sign, g = sign[again], g[again]
            fresh = np.r_[True, (g[1:] != g[:-1]) | (sign[1:] != sign[:-1])]
            group[open_] = open_[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
            open_ = open_[sign != 0]  # equal to the pivot: in place for good
        return starts

    def equal(self, i: np.ndarray, j: np.ndarray, length: int = LENGTH) -> np.ndarray:
        """Whether ``length`` bytes are equal: the first V, those that two sample ranks vouch for, and the last V."""
        same = np.ones(len(i), bool)
        for k in (*range(0, V, 8), *range(length - V, length, 8)):
            same &= self.word[i + k] == self.word[j + k]
        r, s = i % V, j % V
        for d in (MEET[r, s], MEET_LAST[length][r, s]):
            same &= self.rank_at[i + d] == self.rank_at[j + d]
        return same


def repeats(pieces: list[bytes], starts: list[int], weight: list[int], lengths: tuple[int, ...] = (LENGTH,)) -> list[list[np.ndarray]]:
    """For each length and piece, whether each of the piece's first ``starts`` suffixes repeats: that many bytes, all in
    the piece, equal to another suffix's, or to those of a further copy of the piece itself (weight over 1)."""
    base = np.cumsum([0, *map(len, pieces)])
    sorter = SuffixSorter(b"".join(pieces))
    n = np.array(starts, np.int64)
    owner = np.repeat(np.arange(len(pieces)), n)
    at = base[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    room = np.zeros(sorter.size + 1, np.int64)
    room[at] = base[owner + 1] - at
    copied = np.array(weight)[owner] > 1
    flags = [np.zeros(sorter.size + 1, bool) for _ in lengths]
    for flag, length in zip(flags, lengths, strict=True):
        flag[at] = copied & (room[at] >= length)
    for bucket in sorter.buckets(at):
        order = sorter.sort(bucket)
        for flag, length in zip(flags, lengths, strict=True):
            whole = order[room[order] >= length]  # in order still: equal ones stand side by side
            same = sorter.equal(whole[:-1], whole[1:], length)
            flag[whole[:-1][same]] = True
            flag[whole[1:][same]] = True
    return [[flag[b : b + k] for b, k in zip(base, starts, strict=False)] for flag in flags]


def _runs(flags: np.ndarray) -> np.ndarray:
    """(first, end) of the runs of set flags."""
    return np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8))).reshape(-1, 2)


def repeated_spans(docs: DataFrame, lengths: tuple[int, ...] = (LENGTH,)) -> DataFrame:
    """(doc_id, th, spans, spans1 ...) with the spans [first, end) that repeated strings of each length cover; docs: doc_id, th, text.

    Lengths of PASSAGE or LENGTH. One plan without a cut, so that the shuffle of the
    texts to their anchors is used again where the caller joins the texts to their spans.
    """
    buckets = n_buckets(total_bytes(docs))
    least = min(lengths)
    marked = repeated_marks(docs, each(_marks), buckets, want_places=True, hot=HOT)
    hits = marked.where("n_hits > 0").select("doc_id", "th", "hits", "hot").dropDuplicates(KEY)
    fields = [("bucket", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("th", pa.int64()), ("first", pa.int64()), ("piece", pa.binary()), ("size", pa.int64()), ("starts", pa.int64())]

    def cut(batches):
        """Pieces of text for the sorters; what repeats within the block is known at once."""
        for batch in batches:
            rows = list(zip(batch["doc_id"].to_pylist(), batch["th"].to_pylist(), batch["text"], batch["hits"], batch["hot"], strict=True))
            at = 0
            while at < len(rows):
                pieces: dict[tuple[int, bytes, int], list] = {}
                size = 0
                while at < len(rows) and size < (8 << 20):
                    doc_id, th, text, hit, hot = rows[at]
                    data = text.as_py().encode()
                    size += len(data)
                    at += 1
                    for value, a, z in candidates(data, unpack(hit)[0], least, unpack(hot)[0]):
                        pieces.setdefault((value, data[a : z - 1 + LENGTH], z - a), []).append((doc_id, th, a))
                out: dict[str, list] = {name: [] for name, _ in fields}

                def put(*row):
                    for column, x in zip(out.values(), row, strict=True):  # noqa: B023
                        column.append(x)

                for (value, piece, starts), owners in pieces.items():
                    alone = len(owners) == 1
                    for doc_id, th, a in owners:
                        # what is known already needs no meeting and goes to any bucket
                        put((value if alone else th) % buckets, 0 if alone else 1, doc_id, th, a, piece if alone else None, len(piece), starts)
                    if not alone:  # a witness for other blocks
                        put(value % buckets, 2, None, None, None, piece, len(piece), starts)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema(fields))

    def sort(group: pa.Table) -> pa.Table:
        distinct: dict[tuple[bytes, int], int] = {}
        weight: list[int] = []
        owners, rows = [], []
        for piece, kind, doc_id, th, first, size, starts in zip(*(group[c].to_pylist() for c in ("piece", "kind", "doc_id", "th", "first", "size", "starts")), strict=True):
            if kind == 1:
                rows += [(doc_id, th, first, min(starts, size - n + 1), n) for n in lengths if size >= n]
                continue
            k = distinct.setdefault((piece, starts), len(distinct))
            if k == len(weight):
                weight.append(0)
            weight[k] += 2 if kind == 2 else 1
            if kind == 0:
                owners.append((k, doc_id, th, first))
        found = repeats([p for p, _ in distinct], [n for _, n in distinct], weight, lengths)
        for n, flags in zip(lengths, found, strict=True):
            runs = [_runs(f) for f in flags]
            rows += [(doc_id, th, first + int(p), int(q - p), n) for k, doc_id, th, first in owners for p, q in runs[k]]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "th", "first", "starts", "length"])

    pieces = docs.join(hits, KEY).select(*KEY, "text", "hits", "hot").mapInArrow(cut, "bucket long, kind int, doc_id long, th long, first long, piece binary, size long, starts long")
    found = pieces.groupBy("bucket").applyInArrow(sort, "doc_id long, th long, first long, starts long, length long")
    span = F.struct("first", (F.col("first") + F.col("starts") + F.col("length") - 1).alias("end"))
    return found.groupBy(*KEY).agg(*[F.array_sort(F.collect_set(F.when(F.col("length") == n, span))).alias(f"spans{i or ''}") for i, n in enumerate(lengths)])


def merged(spans: list) -> np.ndarray:
    """Maximal runs of the union of spans."""
    if not spans:
        return np.empty((0, 2), np.int64)
    s = np.array([(x["first"], x["end"]) for x in spans], np.int64)
    top = np.maximum.accumulate(s[:, 1])
    new = np.flatnonzero(np.r_[True, s[1:, 0] > top[:-1]])
    return np.c_[s[new, 0], top[np.r_[new[1:] - 1, len(s) - 1]]]


def _without(data: bytes, cut: np.ndarray) -> bytes:
    edges = [0, *cut.ravel().tolist(), len(data)]
    return b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True))


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, kept, n_bytes, n_removed, spans, n_passage_bytes) of every row; kept holds the remaining bytes.

    Each byte covered by a 400-byte string that also starts anywhere else, in any
    row, is removed; strings are judged on the input. n_passage_bytes counts the
    bytes that repeated strings of PASSAGE bytes cover: passages of over 50 words
    that may be too short to be removed. A null text is empty; texts of under 400
    bytes stay. Rows that repeat a document make its strings repeat. Empty input:
    no rows. Extra columns are ignored.
    """
    body = documents(docs, text, key)
    spans = repeated_spans(body, (LENGTH, PASSAGE))

    def run(batches):
        for batch in batches:
            kept, n, gone, runs, passages = [], [], [], [], []
            for text_, spans_, more in zip(batch["text"], batch["spans"].to_pylist(), batch["spans1"].to_pylist(), strict=True):
                data = text_.as_py().encode()
                cut, wide = merged(spans_ or []), merged(more or [])
                kept.append(_without(data, cut))
                n.append(len(data)), gone.append(len(data) - len(kept[-1]))
                runs.append([{"first": int(a), "end": int(z)} for a, z in cut])
                passages.append(int((wide[:, 1] - wide[:, 0]).sum()))
            kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            cols = [batch["doc_id"], batch["th"], pa.array(kept, pa.binary()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, kind), pa.array(passages, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "th", "kept", "n_bytes", "n_removed", "spans", "n_passage_bytes"])

    joined = body.join(spans, KEY, "left").select(*KEY, "text", "spans", "spans1")
    return joined.mapInArrow(run, "doc_id long, th long, kept binary, n_bytes long, n_removed long, spans array<struct<first:long,end:long>>, n_passage_bytes long").withColumn("doc_id", real_id("doc_id"))


def cut_documents(docs: DataFrame, length: int = PASSAGE) -> DataFrame:
    """The rows of docs, all columns, with the repeats of ``length`` bytes cut out of ``text`` and n_chars (if there is one) set anew.

    Cases as in ``remove_repeats``. A character that is cut through goes as a
    whole; a null text stays null. Columns may have any names.
    """
    names, schema = docs.columns, docs.schema
    spans = repeated_spans(documents(docs), (length,)).select(F.col("doc_id").alias("k_id"), F.col("th").alias("k_th"), F.col("spans").alias("k_spans"))
    named = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_, text_ = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text"))
    keyed = named.select("*", F.coalesce(id_.cast("long"), F.lit(NULL_ID)).alias("k_id"), F.xxhash64(F.coalesce(text_.cast("string"), F.lit(""))).alias("k_th"))
    place, counted = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def run(batches):
        for batch in batches:
            texts = []
            for t, spans_ in zip(batch[f"c{place}"].to_pylist(), batch["k_spans"].to_pylist(), strict=True):
                if spans_ and t:
                    t = _without(t.encode(), merged(spans_)).decode(errors="ignore")
                texts.append(t)
            cols = [batch[f"c{i}"] for i in range(len(names))]
            cols[place] = pa.array(texts, cols[place].type)
            if counted >= 0:
                cols[counted] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(cols[counted].type)
            yield pa.RecordBatch.from_arrays(cols, names=[f"c{i}" for i in range(len(names))])

    out = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])
    return keyed.join(spans, ["k_id", "k_th"], "left").mapInArrow(run, out).toDF(*names)


def summary(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "n_passage_bytes")
