"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle set, [2^j, 2^(j+1)). A
partition's items are indexed by the smallest b hash values of their set under
one min-wise hash, with b = the partition's largest size less what containment
asks for, plus 1: a text that holds the asked share of an item cannot miss all
b of them, so the search loses no item however long the text. Every document's
shingles probe the index; each hit is verified by exact shingle containment.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, checkpoint, documents, real_id, shingles

#: Shingle width, and the share of an item's shingles that a document must hold.
WIDTH, CONTAINMENT = 5, 0.75
#: Item text bytes in one broadcast index; more items are searched in further blocks.
BLOCK_BYTES = 32 << 20


def _runs(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word runs, for items of fewer than five words."""
    words = text.encode().translate(LOWER).split()
    if len(words) < width:
        return np.empty(0, np.uint64)
    return np.unique(np.array([xxhash.xxh3_64_intdigest(b"\x00".join(words[i : i + width]), seed=width) for i in range(len(words) - width + 1)], np.uint64))


class Index:
    """One block of items."""

    def __init__(self, items: list[tuple[int | None, str]], containment: float):
        self.ids, self.sets, self.widths, self.need = [], [], [], []
        hashes, owners = [], []
        for item_id, text in items:
            words = len((text or "").encode().split())
            if not words:
                continue
            s = shingles(text)
            self.ids.append(item_id), self.sets.append(s), self.widths.append(min(words, WIDTH))
            self.need.append(max(1, math.ceil(containment * len(s) - 1e-9)))
            upper = (1 << len(s).bit_length()) - 1
            sketch = s[: upper - max(1, math.ceil(containment * upper - 1e-9)) + 1]
            hashes.append(sketch), owners.append(np.full(len(sketch), len(self.sets) - 1))
        h, o = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((hashes, np.uint64), (owners, np.int64)))
        order = np.argsort(h, kind="stable")
        self.hashes, self.owners = h[order], o[order]
        self.short = sorted({w for w in self.widths if w < WIDTH})

    def search(self, text: str) -> list[tuple[int, int]]:
        """(item, shingles in common) of the items that the text contains."""
        found = []
        for width in (WIDTH, *self.short):
            s = shingles(text) if width == WIDTH else _runs(text, width)
            if width == WIDTH and len(text.encode().split(None, WIDTH)) < WIDTH:
                continue
            a, z = np.searchsorted(self.hashes, s, "left"), np.searchsorted(self.hashes, s, "right")
            hit = a < z
            if not hit.any():
                continue
            for k in sorted({int(o) for i, j in zip(a[hit], z[hit], strict=True) for o in self.owners[i:j]}):
                if self.widths[k] != width:
                    continue
                own = self.sets[k]
                at = np.searchsorted(s, own)
                common = int((s[np.minimum(at, len(s) - 1)] == own).sum())
                if common >= self.need[k]:
                    found.append((k, common))
        return found


def _item_blocks(items: DataFrame, block_bytes: int):
    """Lists (item_id, text) of bounded size, one after the other, and whether a list is the only one."""
    block: list[tuple[int | None, str]] = []
    size, first = 0, True
    for row in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        if size >= block_bytes:
            yield block, False
            block, size, first = [], 0, False
        block.append((row["item_id"], row["text"] or ""))
        size += len((row["text"] or "").encode())
    if block:
        yield block, first


def contained_items(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, doc_id, n_item_shingles, n_common, containment) of every item in every document.

    docs: doc_id, text; items: item_id, text. A null or empty text holds nothing
    and is held by nothing. An item of fewer than five words is one shingle,
    found where its words stand consecutively. Repeated rows answer each for
    itself. Items are searched in blocks of ``block_bytes`` of text, each a
    bounded broadcast and one scan. Empty tables give no rows.
    """
    schema = "item_id long, doc_id long, n_item_shingles long, n_common long, containment double"
    spark = docs.sparkSession
    body = documents(docs)

    def scan(shared) -> DataFrame:
        def run(batches):
            index = Index(shared.value, containment)
            for batch in batches:
                rows = []
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                    rows += [(index.ids[k], doc_id, len(index.sets[k]), n, n / len(index.sets[k])) for k, n in index.search(text.as_py())]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["item_id", "doc_id", "n_item_shingles", "n_common", "containment"])

        return body.mapInArrow(run, schema)

    out = None
    for block, alone in _item_blocks(items, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        found = scan(shared)
        if not alone:  # one block at a time is held by the executors
            found = checkpoint(found)
            shared.destroy()
        out = found if out is None else out.unionByName(found)
    out = spark.createDataFrame([], schema) if out is None else out
    return out.withColumn("doc_id", real_id("doc_id"))


def keep_clean(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, all columns, that hold no item. Cases as in ``contained_items``; no shuffle."""
    for block, alone in _item_blocks(items, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            index = Index(shared.value, containment)
            for batch in batches:
                yield batch.filter(pa.array([not index.search(t.as_py() or "") for t in batch["text"]], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if not alone:
            docs = checkpoint(docs)
            shared.destroy()
    return docs
