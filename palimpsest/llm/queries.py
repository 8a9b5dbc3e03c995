"""The contract queries of the corpus operators, and SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, decontaminate, jaccard, license_scan, recompression, sharding, suffix_dedup, toxicity, warc
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.summary(toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.summary(suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.summary(recompression.remove_later_copies(table(spark, sf_dir, "documents")))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where(f"vec_id % {ann.EVERY} = 0"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(table(spark, sf_dir, "documents")))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decoded="decoded"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_warc": op4_warc,
    "op5_recompression": op5_recompression,
    "op6_ann": op6_ann,
    "op7_license_scan": op7_license_scan,
    "op8_bpe": op8_bpe,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_sharding": op10_sharding,
}

#: Shingle sets in SQL: A-Z lower-cased, words between blanks, tabs and line ends, five-word runs.
_SETS = """
 {name}_w AS (SELECT {key}, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM {source}),
 {name}_s AS (SELECT DISTINCT {key}, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM {name}_w WHERE len(w) > 0))"""

ORACLE = {
    "op2_decontamination": "WITH" + _SETS.format(name="d", key="doc_id", source="documents") + "," + _SETS.format(name="b", key="item_id", source="benchmark") + """,
 n AS (SELECT item_id, count(*) AS n_item_shingles FROM b_s GROUP BY item_id)
SELECT b_s.item_id, d_s.doc_id, n.n_item_shingles, count(*) AS n_common, count(*) / n.n_item_shingles::DOUBLE AS containment
FROM b_s JOIN d_s USING (g) JOIN n ON n.item_id = b_s.item_id
GROUP BY b_s.item_id, d_s.doc_id, n.n_item_shingles HAVING 100 * count(*) >= 75 * n.n_item_shingles""",
}
