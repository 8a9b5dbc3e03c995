"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A block of documents sends each of its distinct words (pattern matches) once, to
the bucket of the word's hash. A bucket so holds its share of the corpus's distinct
words. There an inverted index from token pair to word positions replays the merges
in rank order over all of them together, once for the corpus; a merge touches only
its neighbours, whose new pairs join the index. Each block gets its words' ids back
and lays them out along its documents.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, n_buckets, pack, unpack

#: Characters of text in a block, and bytes of distinct words in one inverted index: what bounds a task's memory.
BLOCK_CHARS, INDEX_BYTES = 4_000_000, 16 << 20


class Vocabulary:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.n = max(self.ranks.values()) + 1
        self.tokens = [b""] * self.n
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.bytes = [self.ranks.get(bytes([b]), -1) for b in range(256)]
        self.lens = np.array([len(t) for t in self.tokens], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.pair: dict[int, int] = {}

    def merged(self, a: int, b: int) -> int:
        """Rank of the pair's token, or -1."""
        key = a * self.n + b
        r = self.pair.get(key)
        if r is None:
            if len(self.pair) > 300_000:
                self.pair.clear()
            r = self.pair[key] = self.ranks.get(self.tokens[a] + self.tokens[b], -1)
        return r

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word."""
        sym: list[int] = []
        nxt: list[int] = []
        prv: list[int] = []
        starts: list[int] = []
        whole: list[int] = []
        get, single, at = self.ranks.get, self.bytes.__getitem__, 0
        for w in words:
            r = get(w, -1)
            whole.append(r)
            starts.append(at)
            if r < 0 and w:
                sym += map(single, w)
                to = at + len(w)
                nxt += range(at + 1, to + 1)
                prv += range(at - 1, to - 1)
                nxt[-1], prv[at] = -1, -1
                at = to
        if not sym:
            return [[r] for r in whole]
        # the index of the first pairs: each distinct pair is looked up once
        own, follow = np.array(sym, np.int64), np.array(nxt, np.int64)
        at = np.flatnonzero(follow >= 0)
        pairs, which = np.unique(own[at] * self.n + own[follow[at]], return_inverse=True)
        ranks = np.array([self.merged(*divmod(int(k), self.n)) for k in pairs], np.int64)[which]
        at, ranks = at[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        at, ranks = at[order], ranks[order]
        cut = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]]) if len(ranks) else []
        index = {int(ranks[a]): at[a:z].tolist() for a, z in zip(cut, [*cut[1:], len(at)], strict=True)}
        heap = list(index)
        heapq.heapify(heap)
        pair, n, merged = self.pair, self.n, self.merged
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank, None)
            if places is None:
                continue
            places.sort()
            for k, i in enumerate(places):
                j = nxt[i]
                left = sym[i]
                if left < 0 or j < 0:
                    continue
                r = pair.get(left * n + sym[j])
                if r is None:
                    r = merged(left, sym[j])
                if r != rank:
                    continue
                after, before = nxt[j], prv[i]
                sym[i], sym[j], nxt[i] = rank, -1, after
                lower = False
                if after >= 0:
                    prv[after] = i
                    r = pair.get(rank * n + sym[after])
                    if r is None:
                        r = merged(rank, sym[after])
                    if r >= 0:
                        if r in index:
                            index[r].append(i)
                        else:
                            index[r] = [i]
                            heapq.heappush(heap, r)
                            lower = r < rank
                if before >= 0:
                    r = pair.get(sym[before] * n + rank)
                    if r is None:
                        r = merged(sym[before], rank)
                    if r >= 0:
                        if r in index:
                            index[r].append(before)
                        else:
                            index[r] = [before]
                            heapq.heappush(heap, r)
                            lower |= r < rank
                if lower:  # a word's lower rank goes first: the rest of this rank waits
                    if rank in index:
                        index[rank] += places[k + 1 :]
                    else:
                        index[rank] = places[k + 1 :]
                        heapq.heappush(heap, rank)
                    break
        ends = [*starts[1:], len(sym)]
        return [[r] if r >= 0 else [s for s in sym[a:z] if s >= 0] for r, a, z in zip(whole, starts, ends, strict=True)]

    def decode(self, ids: np.ndarray) -> bytes:
        lens = self.lens[ids]
        out = np.repeat(self.starts[ids] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
        return self.blob[out].tobytes()


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def _squeeze(x: np.ndarray) -> tuple[str, int, bytes]:
    """An array of small numbers, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()
    return x.dtype.str, len(x), zstandard.compress(planes, 1)


def _swell(packed: tuple[str, int, bytes]) -> np.ndarray:
    kind, n, data = packed
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(n)


def _strings(lens: np.ndarray, blob: bytes) -> pa.Array:
    offsets = np.zeros(len(lens) + 1, np.int32)
    np.cumsum(lens, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lens), [None, pa.py_buffer(offsets), pa.py_buffer(blob)])


def _spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1 ... of lens[i] each, one after the other."""
    ends = np.cumsum(lens)
    return np.repeat(starts - ends + lens, lens) + np.arange(int(ends[-1]) if len(ends) else 0)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(keys, texts) of about BLOCK_CHARS characters; a longer text makes a block of its own."""
    keys: list = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for k, t in zip(batch["k"], batch["t"], strict=True):
            text = t.as_py() or ""
            if texts and size + len(text) > BLOCK_CHARS:
                yield keys, texts
                keys, texts, size = [], [], 0
            keys.append(k.as_py()), texts.append(text)
            size += len(text)
    if texts:
        yield keys, texts


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", key: str = "doc_id", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """(key, ids array<int>), and with ``decoded`` the bytes that the ids decode to: each pattern match encoded separately, no special tokens.

    path is a .tiktoken rank file, present on every machine. A null or empty
    text has no ids; a null key stays null; each row gives one row, repeated rows
    too. Empty input: no rows. Raises if a byte has no token of its own. Extra
    columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[key].dataType
    body = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    buckets = n_buckets(body.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("n")).first()["n"])

    def emit(batches):
        """For each bucket (its number is the key) a block's distinct words; for the block itself (its name is the key) what it keeps till they come back."""
        find = regex.compile(pattern).findall
        for keys, texts in _blocks(batches):
            pieces = [find(t) for t in texts]
            counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
            coded = pa.array(list(chain.from_iterable(pieces)), pa.string()).dictionary_encode()
            del pieces
            words, index = coded.dictionary.cast(pa.binary()), coded.indices.to_numpy(zero_copy_only=False)
            listed = words.to_pylist()
            bucket = np.fromiter(map(xxhash.xxh3_64_intdigest, listed), np.uint64, len(listed)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            name = xxhash.xxh3_128(repr(keys))
            for t in texts:
                name.update(xxhash.xxh3_128_digest(t))
            block = name.digest()
            lens, sorted_bucket = pc.binary_length(words).to_numpy(zero_copy_only=False)[order], bucket[order]
            cut = np.flatnonzero(np.r_[True, sorted_bucket[1:] != sorted_bucket[:-1]][: len(order)]).tolist()
            narrow = index.astype(np.min_scalar_type(max(len(listed) - 1, 0)))
            out_k, out_b, out_d = [block], [None], [pack(keys, counts, _squeeze(narrow), _squeeze(order.astype(np.uint32)))]
            for a, z in zip(cut, [*cut, len(order)][1:], strict=False):
                mine = lens[a:z]
                out_k.append(int(sorted_bucket[a]).to_bytes(4)), out_b.append(block)
                out_d.append(pack(mine.astype(np.min_scalar_type(int(mine.max()))), b"".join([listed[i] for i in order[a:z].tolist()])))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in (out_k, out_b, out_d)], names=["key", "block", "data"])

    def meet(group: pa.Table) -> pa.Table:
        """The ids of a bucket's words, for each block that sent some."""
        vocab = vocabulary(path)
        if min(vocab.bytes) < 0:
            raise ValueError(f"{path} lacks single bytes")
        asked = [(b, unpack(d)) for b, d in zip(group["block"].to_pylist(), group["data"], strict=True) if b is not None]
        out = []
        if asked:
            coded = pa.chunked_array([_strings(*x) for _, x in asked]).dictionary_encode().combine_chunks()
            words = (coded.dictionary if isinstance(coded, pa.DictionaryArray) else coded.chunk(0).dictionary).to_pylist()
            index = (coded.indices if isinstance(coded, pa.DictionaryArray) else coded.chunk(0).indices).to_numpy(zero_copy_only=False)
            ids: list[list[int]] = []
            while len(ids) < len(words):
                at, size = len(ids), 0
                to = at
                while to < len(words) and (to == at or size < INDEX_BYTES):
                    size += len(words[to])
                    to += 1
                ids += vocab.replay(words[at:to])
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.min_scalar_type(vocab.n), int(n.sum()))
            start, at = np.cumsum(n) - n, 0
            for b, (lens, _) in asked:
                mine = index[at : at + len(lens)]
                at += len(lens)
                out.append((b, group["key"][0].as_py(), pack(_squeeze(n[mine].astype(np.min_scalar_type(int(n[mine].max())))), _squeeze(flat[_spread(start[mine], n[mine])]))))
        return pa.table([pa.array([x[j] for x in out], pa.binary()) for j in range(3)], names=["block", "bucket", "data"])

    def answer(asked: pa.Table, answers: pa.Table) -> pa.Table:
        known = [d for b, d in zip(asked["block"], asked["data"], strict=True) if not b.is_valid]
        if not known:  # a bucket's words
            return out_schema.empty_table()
        keys, counts, index, order = unpack(known[0])
        index, order = _swell(index).astype(np.int64), _swell(order)
        got = dict(zip(answers["bucket"].to_pylist(), answers["data"], strict=True))  # a block that was read twice is answered twice
        parts = [[_swell(y) for y in unpack(got[b])] for b in sorted(got)]
        n, flat = np.zeros(len(order), np.int64), np.empty(0, np.int32)
        start = n.copy()
        if parts:
            flat = np.concatenate([x[1] for x in parts]).astype(np.int32)
            lens = np.concatenate([x[0] for x in parts]).astype(np.int64)
            n[order], start[order] = lens, np.cumsum(lens) - lens
        of_doc = np.cumsum(n[index])[np.cumsum(counts) - 1] if len(index) else np.zeros(len(keys), np.int64)
        of_doc = np.where(np.cumsum(counts) > 0, of_doc, 0)
        offsets = np.r_[0, of_doc].astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[_spread(start[index], n[index])]))
        vocab, times = vocabulary(path), len(known)  # a block that was read twice has its rows twice
        cols = [pa.array(keys * times, pa_kind), pa.concat_arrays([lists] * times)]
        if decoded is not None:
            own = lists.values.to_numpy()
            cols.append(pa.array([vocab.decode(own[a:z]) for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)] * times, pa.binary()))
        return pa.table(cols, names=out_schema.names)

    pa_kind = _arrow_type(docs, key)
    out_schema = pa.schema([("k", pa_kind), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())][: 2 + (decoded is not None)])
    # what a block keeps stays in the partitions of the first exchange, which serves both sides
    sent = body.mapInArrow(emit, "key binary, block binary, data binary")
    met = sent.groupBy("key").applyInArrow(meet, "block binary, bucket binary, data binary")
    return sent.groupBy("key").cogroup(met.groupBy("block")).applyInArrow(answer, f"k {kind.simpleString()}, ids array<int>" + ", decoded binary" * (decoded is not None)).select(F.col("k").alias(key), F.col("ids").alias(ids), *([F.col("decoded").alias(decoded)] if decoded is not None else []))


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def decode(tokens: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and ``out``, the bytes of the ids; null ids give empty bytes. Raises on an id outside the vocabulary."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema if f.name != out) + f", `{out}` binary"
    names = [c for c in tokens.columns if c != out]

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            col = batch[ids]
            got = [vocab.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid and len(x) else b"" for x in col]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], pa.array(got, pa.binary())], names=[*names, out])

    return tokens.select(*names).mapInArrow(run, schema)


def digests(tokens: DataFrame, key: str = "doc_id", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    joined = F.array_join(F.col(ids).cast("array<string>"), " ")
    return tokens.select(key, F.size(ids).cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2(F.col(decoded), 256).alias("decoded_sha256"))
