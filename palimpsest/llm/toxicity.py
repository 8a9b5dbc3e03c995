"""Toxicity by nearest labelled examples.

A bounded sample of labelled documents is indexed. Texts are TF-IDF vectors over
the terms that tell the sample's labels apart (a term's frequency enters as
further terms: present twice, three times); document frequencies are counted
over all documents. The index is an inverted index cut into blocks of examples,
with the largest weight of each term in each block. For a text, the blocks'
bounds are summed; blocks are scored exactly in the order of their bounds until
no bound exceeds the K-th best cosine, so the neighbours are exact. Their votes,
weighted by distance, are calibrated on the sample (each example scored without
itself) and returned with the neighbours as evidence.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import trim

#: Bounds: labelled examples taken of each class, terms of the vectors, neighbours, examples in a block.
EXAMPLES, TERMS, NEIGHBOURS, BLOCK = 2000, 4096, 9, 64
#: Bound on the examples' text, in bytes in all; it is what the driver gathers.
EXAMPLE_BYTES = 128 << 20
#: Shares of rows: a remainder of crc32(doc_id) that is held out.
FOLDS, HELD_OUT = 5, 0
#: A term tells labels apart from this chi-square on (p about 8e-6, as many terms are tried).
CHI_SQUARE = 20.0
#: Lengths of the beginnings of words that are terms too: they hold for inflected words.
STEMS = (4, 5)
#: Times a term may stand in a text and make further terms.
LEVELS = 3
#: Words that a worker's cache holds before it is emptied.
CACHE_WORDS = 200_000
_WORD = re.compile(r"[^\W\d_]+")
SCORED = "doc_id long, score double, evidence array<struct<doc_id:long,toxic:int,cosine:double>>"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def features(word: str) -> list[str]:
    """A word as terms: itself, and its beginnings marked by ^."""
    return [word, *("^" + word[:k] for k in STEMS if len(word) >= k)]


def leveled(count: Counter) -> set[str]:
    """Terms of a text: a term that stands twice or more is a term of its own (marked #2, #3)."""
    return {t if k == 1 else f"{t}#{k}" for t, n in count.items() for k in range(1, min(n, LEVELS) + 1)}


def terms(text: str) -> set[str]:
    count: Counter = Counter()
    for w, n in Counter(words(text)).items():
        for f in features(w):
            count[f] += n
    return leveled(count)


class TermsOf(dict):
    """Selected terms of a word, by the place of their first level; bounded."""

    def __init__(self, vocabulary: list[str]):
        super().__init__()
        self.vocabulary = vocabulary
        self.base: dict[str, int] = {}
        self.levels: list[list[int]] = []
        for i, term in enumerate(vocabulary):
            name, _, level = term.partition("#")
            k = self.base.setdefault(name, len(self.base))
            if k == len(self.levels):
                self.levels.append([-1] * LEVELS)
            self.levels[k][int(level or 1) - 1] = i

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        got = self[word] = tuple(self.base[f] for f in features(word) if f in self.base)
        return got

    def __reduce__(self):
        return TermsOf, (self.vocabulary,)

    def places(self, text: str) -> list[int]:
        """Places in the vocabulary of a text's terms, ascending."""
        count = Counter(chain.from_iterable(map(self.__getitem__, words(text))))
        return sorted(i for k, n in count.items() for i in self.levels[k][:n] if i >= 0)


def held_out(key: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


class Index:
    """Block-max inverted index of the examples' unit vectors."""

    def __init__(self, vocabulary: list[str], idf: np.ndarray, texts: list[str], ids: list, toxic: list[int], base_rate: float):
        self.terms_of = TermsOf(vocabulary)
        self.idf = idf
        vectors = [self.vector(t) for t in texts]
        keep = [k for k, (t, _) in enumerate(vectors) if len(t)]
        # examples with like terms come together, which keeps the blocks' bounds low
        keep.sort(key=lambda k: (toxic[k], vectors[k][0].tolist()))
        self.ids, self.toxic = [ids[k] for k in keep], np.array([toxic[k] for k in keep], np.int64)
        self.n = len(keep)
        self.blocks = -(-self.n // BLOCK)
        t = np.concatenate([vectors[k][0] for k in keep]) if keep else np.empty(0, np.int64)
        w = np.concatenate([vectors[k][1] for k in keep]) if keep else np.empty(0)
        doc = np.repeat(np.arange(self.n), [len(vectors[k][0]) for k in keep])
        self.top = np.zeros((len(vocabulary), max(1, self.blocks)))
        np.maximum.at(self.top, (t, doc // BLOCK), w)
        order = np.lexsort((doc, t, doc // BLOCK))
        t, w, doc = t[order], w[order], doc[order]
        self.posting_doc, self.posting_weight = doc, w
        key = (doc // BLOCK) * len(vocabulary) + t
        grid = np.arange(max(1, self.blocks) * len(vocabulary) + 1)
        self.starts = np.searchsorted(key, grid)  # postings of (block, term)
        self.width = len(vocabulary)
        self.prior = base_rate
        empty = [toxic[k] for k, (t, _) in enumerate(vectors) if not len(t)]
        self.slope, self.shift = 1.0, 0.0
        votes = np.array([self.vote(self.nearest(*vectors[k], skip=j)) for j, k in enumerate(keep)])
        self._calibrate(votes, self.toxic, toxic, base_rate)
        rates = (sum(empty) / max(1, sum(toxic)), (len(empty) - sum(empty)) / max(1, len(toxic) - sum(toxic)))
        a, b = rates[0] * base_rate, rates[1] * (1 - base_rate)
        self.empty_score = (a + 1e-6) / (a + b + 2e-6) if a + b else base_rate

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of the unit TF-IDF vector, terms ascending."""
        t = np.array(self.terms_of.places(text), np.int64)
        w = self.idf[t]
        return t, w / np.sqrt((w * w).sum()) if len(t) else w

    def nearest(self, t: np.ndarray, w: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the NEIGHBOURS nearest with a cosine over 0, best first, ties to the smaller place."""
        if not len(t) or not self.n:
            return np.empty(0, np.int64), np.empty(0)
        bound = w @ self.top[t]
        found_d, found_s, worst = np.empty(0, np.int64), np.empty(0), 0.0
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] <= 0 or (len(found_d) >= NEIGHBOURS and bound[b] < worst - 1e-12):
                break
            a, z = self.starts[b * self.width + t], self.starts[b * self.width + t + 1]
            n = z - a
            at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
            score = np.bincount(self.posting_doc[at] - b * BLOCK, self.posting_weight[at] * np.repeat(w, n), BLOCK)
            hit = np.flatnonzero(score > 0)
            docs = hit + b * BLOCK
            own = docs != skip
            found_d, found_s = np.r_[found_d, docs[own]], np.r_[found_s, score[hit][own]]
            order = np.lexsort((found_d, -found_s))[:NEIGHBOURS]
            found_d, found_s = found_d[order], found_s[order]
            worst = found_s[-1] if len(found_s) else 0.0
        return found_d, found_s

    def vote(self, near: tuple[np.ndarray, np.ndarray]) -> float:
        """Share of toxic neighbours, weighted by the inverse of the cosine distance."""
        d, s = near
        if not len(d):
            return 0.5
        w = 1 / (1.05 - np.minimum(s, 1.0))
        return float((w * self.toxic[d]).sum() / w.sum())

    def _calibrate(self, votes: np.ndarray, y: np.ndarray, all_y: list[int], rate: float) -> None:
        """Logistic curve of the votes, the classes weighted as in the corpus (Newton steps, slightly damped)."""
        if not len(votes) or len(set(y.tolist())) < 2:
            self.slope, self.shift = 4.0, math.log(max(rate, 1e-6) / max(1 - rate, 1e-6))
            return
        n1, n0 = max(1, sum(all_y)), max(1, len(all_y) - sum(all_y))
        weight = np.where(y == 1, rate / n1, (1 - rate) / n0)
        weight = weight / weight.sum() * len(y)
        x = np.c_[votes - 0.5, np.ones(len(votes))]
        beta = np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            grad = x.T @ (weight * (y - p)) - 0.01 * beta
            hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
            step = np.linalg.solve(hess, grad)
            beta += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        self.slope, self.shift = float(beta[0]), float(beta[1])

    def score(self, text: str) -> tuple[float, list[tuple]]:
        t, w = self.vector(text)
        near = self.nearest(t, w)
        evidence = [(self.ids[d], int(self.toxic[d]), float(s)) for d, s in zip(*near, strict=True)]
        if not len(near[0]):
            return self.empty_score, evidence
        x = self.slope * (self.vote(near) - 0.5) + self.shift
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x)))), evidence


def select_terms(texts: list[str], toxic: list[int], limit: int = TERMS) -> list[str]:
    """Terms whose presence depends on the label by the chi-square test, the strongest first. A word whose beginning was chosen before it adds nothing."""
    n1, n0 = sum(toxic), len(toxic) - sum(toxic)
    with_, without = Counter(), Counter()
    for text, y in zip(texts, toxic, strict=True):
        (with_ if y else without).update(terms(text))
    n, ranked = n1 + n0, []
    for term in set(with_) | set(without):
        a, b = with_[term], without[term]
        if a + b < 3 or a + b == n or not n1 or not n0:
            continue
        chi = n * (a * (n0 - b) - b * (n1 - a)) ** 2 / ((a + b) * (n - a - b) * n1 * n0)
        if chi >= CHI_SQUARE:
            ranked.append((-chi, term))
    chosen: list[str] = []
    stems: set[str] = set()
    for _, t in sorted(ranked):
        if t[0] == "^":
            stems.add(t)
        elif any(f in stems for f in features(t.partition("#")[0])[1:]):
            continue  # its stem says it
        chosen.append(t)
    return chosen[:limit]


def sample(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES) -> tuple[list, float, int]:
    """Up to per_class training rows of each label, least hash first, one text an id (that of the least hash) and at most
    EXAMPLE_BYTES of text in all; the training rows' share of toxic ones, and their number."""
    marks = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(~held_out())
    counts = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    chosen = None
    for y in (0, 1):  # a top-k by hash: bounded by per_class on the driver
        part = marks.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = F.min_by("text", F.xxhash64("text"))
    mine = body.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(own.alias("text"))
    rows, size = [], 0
    for r in mine.orderBy(F.xxhash64("doc_id"), "doc_id").toLocalIterator():
        size += len(r["text"].encode())
        if size > EXAMPLE_BYTES:
            break
        rows.append((r["doc_id"], r["toxic"], r["text"]))
    rows.sort()
    return rows, counts.get(1, 0) / total if total else 0.0, total


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and documents, over the whole table."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches):
        terms_of, found, n = TermsOf(shared.value), np.zeros(len(shared.value), np.int64), 0
        for batch in batches:
            for text in batch["text"]:
                n += 1
                found[terms_of.places(text.as_py() or "")] += 1
        some = np.flatnonzero(found)
        trim(terms_of)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[some, -1]), pa.array(np.r_[found[some], n])], names=["i", "n"])

    df, total = np.zeros(len(vocabulary), np.int64), 0
    for r in docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():  # a row per term
        if r["i"] < 0:
            total = r["n"]
        else:
            df[r["i"]] = r["n"]
    return df, total


def learn(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES):
    """The broadcast index of the examples; its size is bounded by per_class and TERMS."""
    rows, rate, _ = sample(docs, labels, per_class)
    texts, toxic, ids = [r[2] for r in rows], [r[1] for r in rows], [r[0] for r in rows]
    vocabulary = select_terms(texts, toxic)
    df, total = document_frequencies(docs, vocabulary)
    idf = np.log((1 + total) / (1 + df)) + 1.0
    return docs.sparkSession.sparkContext.broadcast(Index(vocabulary, idf, texts, ids, toxic, rate))


def score(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES) -> DataFrame:
    """doc_id, score (0 to 1) and evidence (the nearest examples: doc_id, toxic, cosine) of every row of docs.

    Learns from labels (doc_id, toxic) outside the held-out fold, at most
    ``per_class`` examples of each label. Whole texts are scored; an empty or null
    text, like any without a telling term, gets the share of toxic documents
    among such. Without any label every score is 0. A doc_id labelled twice is
    toxic if any label says so; null labels and ids teach nothing. Repeated rows
    are scored each for itself. Empty input: no rows. Extra columns are ignored.
    """
    shared = learn(docs, labels, per_class)

    def run(batches):
        index = shared.value
        kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())]))
        for batch in batches:
            scored = [index.score(t.as_py() or "") for t in batch["text"]]
            evidence = [[{"doc_id": d, "toxic": y, "cosine": c} for d, y, c in e] for _, e in scored]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([s for s, _ in scored], pa.float64()), pa.array(evidence, kind)], names=["doc_id", "score", "evidence"])
        trim(index.terms_of)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCORED)


def keep_clean(docs: DataFrame, labels: DataFrame, per_class: int = EXAMPLES) -> DataFrame:
    """The rows of docs, all columns, with a score under 0.5. Rows and cases as in ``score``; no shuffle."""
    shared = learn(docs, labels, per_class)

    def run(batches):
        index = shared.value
        for batch in batches:
            yield batch.filter(pa.array([index.score(t.as_py() or "")[0] < 0.5 for t in batch["text"]], pa.bool_()))
        trim(index.terms_of)

    return docs.mapInArrow(run, docs.schema)


def summary(scored: DataFrame) -> DataFrame:
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
