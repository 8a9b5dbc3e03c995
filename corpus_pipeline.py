"""A training corpus out of raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and read again as the next stage's docs. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm import bpe, decontaminate, jaccard, suffix_dedup, toxicity
from palimpsest.llm.common import shared_dir, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5; the examples' texts come from ``docs``."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates, and all that are in none."""
    return jaccard.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of repeated passages of over 50 words, as strings of PASSAGE bytes; n_chars follows the text."""
    return suffix_dedup.cut_documents(docs, suffix_dedup.PASSAGE)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the token ids and of their decoding."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.encode(docs, path, public_tokenizers.PATTERN, decoded="decoded"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("tokens", tokenize),
]

#: SQL can't express a classifier that is learnt, nor BPE; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; what each keeps is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL}
