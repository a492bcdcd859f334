"""The registered queries of this subpackage, with production parameters.

Each is thin: it reads its table, applies its operator to every row, and
returns the operator's columns in the form that was agreed for the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import (anchor_dedup, decontaminate, fertility, filter_audit, ftrl, hash_tree, hilbert_pack, pii_tagger, rff_quality,
                          simhash, suffix_dedup, vector_codes, warc)
from loadlens.llm.common import read


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.measure(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"),
                             tokenizer_path("piece_bpe_32k.model"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove(read(spark, sf_dir, "documents"), length=200)


def op3_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_dedup.remove(read(spark, sf_dir, "documents"), length=35)


def op4_rff_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rff_quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), folds=5, threshold=0.3)


def op5_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ftrl.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), folds=3, held_fold=1, threshold=0.7)


def op6_seed_align_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_pii_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii_tagger.personal_data(docs, pii_tagger.train(docs))


def op8_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, radius=4)


def op9_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = hash_tree.even_tree(2, 2, 2)
    return hash_tree.assign(read(spark, sf_dir, "documents"), tree, hash_tree.with_shard(tree, 8))


def op10_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_pack.pack(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), length=2048)


def op11_resident_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = vector_codes.compress(read(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)
    return rows.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.round_trip(read(spark, sf_dir, "pages"), key="page_id", target="url", payload="html", least_bytes=1000)
    return rows.withColumnRenamed("key", "page_id")


QUERIES = {f.__name__: f for f in (
    op1_fertility_rules, op2_suffix_dedup, op3_anchor_dedup, op4_rff_quality, op5_ftrl_toxicity, op6_seed_align_decontamination,
    op7_pii_tagger, op8_covering_simhash, op9_hash_tree_shards, op10_hilbert_packing, op11_resident_lloyd, op12_filter_audit, op13_warc)}
