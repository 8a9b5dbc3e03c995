"""Sharding by bytes: minimax contiguous partition of ordered atomic groups.

Documents with equal texts are one atomic group; groups are ordered by their
smallest doc_id. The smallest feasible shard capacity is found by binary search,
each capacity being checked greedily, and the groups are cut there. The driver
holds only bounded range sums: it starts from equal-width ranges of the order
and splits just those that a cut can fall into, until the capacity is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint, with_group_value

#: What a row takes besides its text.
ROW_BYTES = 8
FIRST_RANGES, SPLIT = 8192, 16
LOWEST = -(2**63)
SLOT_BINS = 1024


def _sums(groups: DataFrame, lows: np.ndarray, highs: np.ndarray, parts: int) -> list[tuple]:
    """(min, max, bytes) of the groups in each of ``parts`` equal pieces of each range [low, high]."""
    widths = np.array([(int(h) - int(a)) // parts + 1 for a, h in zip(lows, highs, strict=True)], np.uint64)

    def add(batches):
        for b in batches:
            first, size = b["first"].to_numpy(zero_copy_only=False), b["gsize"].to_numpy(zero_copy_only=False)
            at = np.searchsorted(lows, first, "right") - 1
            keep = (at >= 0) & (first <= highs[np.maximum(at, 0)])
            at, first, size = at[keep], first[keep], size[keep]
            if not len(at):
                continue
            part = (first.astype(np.uint64) - lows[at].astype(np.uint64)) // widths[at]
            key = at * parts + part.astype(np.int64)
            order = np.argsort(key, kind="stable")
            key, first, size = key[order], first[order], size[order]
            cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            yield pa.RecordBatch.from_arrays([pa.array(key[cut]), pa.array(np.minimum.reduceat(first, cut)), pa.array(np.maximum.reduceat(first, cut)), pa.array(np.add.reduceat(size, cut))], names=["k", "lo", "hi", "s"])

    rows = groups.select("first", "gsize").mapInArrow(add, "k long, lo long, hi long, s long").groupBy("k").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("s").alias("s"))
    return sorted((r["lo"], r["hi"], r["s"]) for r in rows.collect())  # one row per range: bounded


def _reach(cum: np.ndarray, start: int, capacity: int) -> int:
    """Greedy: the end of the longest run of whole ranges from ``start`` within the capacity."""
    base = int(cum[start - 1]) if start else 0
    return int(np.searchsorted(cum, base + capacity, "right"))


def _whole_cuts(sums: np.ndarray, n: int, capacity: int) -> list[int] | None:
    """Ends of greedy shards of whole ranges, or None if n don't suffice."""
    cum, at, ends = np.cumsum(sums), 0, []
    for _ in range(n):
        at = _reach(cum, at, capacity)
        ends.append(at)
    return ends if at == len(sums) else None


def _fluid(cum: np.ndarray, atomic: np.ndarray, n: int, capacity: int) -> list[int]:
    """Bytes that greedy shards reach if ranges not yet split could be cut anywhere: never less than the truth."""
    x, ends = 0, []
    for _ in range(n):
        x = min(x + capacity, int(cum[-1]))
        i = int(np.searchsorted(cum, x, "right"))
        if i < len(cum) and atomic[i]:
            x = max(int(cum[i - 1]) if i else 0, ends[-1] if ends else 0)
        ends.append(x)
    return ends


def _smallest(feasible, low: int, high: int) -> int:
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if feasible(mid) else (mid + 1, high)
    return low


def minimax_cuts(groups: DataFrame, n_shards: int) -> tuple[list[int], int]:
    """(cuts, capacity): shard k holds the groups whose order value is in [cuts[k-1], cuts[k])."""
    ends = groups.agg(F.min("first").alias("a"), F.max("first").alias("b")).first()
    if ends["a"] is None:
        return [], 0
    bins = _sums(groups, np.array([ends["a"]], np.int64), np.array([ends["b"]], np.int64), FIRST_RANGES)
    while True:
        lo, hi = (np.array([b[i] for b in bins], np.int64) for i in (0, 1))
        sums = np.array([b[2] for b in bins], np.int64)
        atomic, cum, total = lo == hi, np.cumsum(sums), int(sums.sum())
        least = max(-(-total // n_shards), int(sums[atomic].max(initial=0)))
        low = _smallest(lambda c: _fluid(cum, atomic, n_shards, c)[-1] >= total, least, total)  # noqa: B023
        high = _smallest(lambda c: _whole_cuts(sums, n_shards, c) is not None, least, total)  # noqa: B023
        if low == high:
            break
        late = _fluid(cum, atomic, n_shards, high)
        split, at = np.zeros(len(bins), bool), 0
        for k in range(n_shards):
            at = _reach(cum, at, low)
            split[at : int(np.searchsorted(cum, late[k], "left")) + 1] = True
        split &= ~atomic
        split |= ~atomic & (sums > low)
        if not split.any():
            split = ~atomic
        finer = _sums(groups, lo[split], hi[split], SPLIT)
        bins = sorted([b for b, s in zip(bins, split, strict=True) if not s] + finer)
    # the capacity is settled; within it, each cut is put nearest to an even share
    need, back = [], len(sums)
    base = np.r_[0, cum]
    for _ in range(n_shards):
        need.append(back)
        back = int(np.searchsorted(base, base[back] - high, "left"))
    need = need[::-1]  # need[k]: the least end of shard k with which the rest still fits
    cuts, at = [], 0
    for k in range(n_shards - 1):
        most = _reach(cum, at, high)
        ideal = total * (k + 1) // n_shards
        near = int(np.searchsorted(base, ideal))
        near -= int(near > 0 and ideal - base[near - 1] < base[min(near, len(sums))] - ideal)
        at = min(max(near, need[k], at), most)
        cuts.append(int(lo[at]) if at < len(lo) else None)
    return cuts, high


def shard_by_bytes(docs: DataFrame, n_shards: int = 24, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    Equal texts share a shard (null texts are equal to each other; so are, in
    order, texts whose smallest doc_id is the same). A null doc_id comes first
    in the order. A null text has no bytes: size 8, crc32 0. Repeated rows are
    rows of their own. Empty input: no rows. Extra columns are ignored. Slots
    count from 0 without gaps in each shard.
    """
    meta = checkpoint(
        docs.select(
            F.col(key).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2(F.col(text).cast("binary"), 256)), F.lit(b"\x00")).alias("gk"),
        )
    )
    groups = checkpoint(meta.groupBy("gk").agg(F.coalesce(F.min("doc_id"), F.lit(LOWEST)).alias("first"), F.sum("size").alias("gsize"), F.count(F.lit(1)).alias("cnt")))
    cuts, _ = minimax_cuts(groups, n_shards)
    placed = with_group_value(meta, groups.where("cnt > 1").select("gk", "first", "cnt"), "gk", "cnt")
    order = F.coalesce("first", "doc_id", F.lit(LOWEST))
    points = [c for c in cuts if c is not None]
    shard = F.size(F.filter(F.array(*[F.lit(c) for c in points]), lambda c: c <= order)) if points else F.lit(0)
    placed = placed.select("doc_id", "size", "text_crc32", "gk", shard.cast("int").alias("shard"), F.pmod(F.xxhash64("doc_id", "gk"), F.lit(SLOT_BINS)).cast("int").alias("bin"))
    counts = placed.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))
    over = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bin", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))  # n_shards * SLOT_BINS rows at most
    inside = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("doc_id", "gk"))
    numbered = placed.withColumn("rn", inside).join(F.broadcast(offsets), ["shard", "bin"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("rn") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
