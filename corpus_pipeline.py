"""Corpus pipeline: from ``documents`` to packed training sequences.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of documents; every
stage works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loadlens.llm import decontaminate, hilbert_pack, pii_tagger, rff_quality, simhash
from loadlens.llm.common import cut, read
from loadlens.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return rff_quality.accepted(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.representatives(docs)


def benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy or edited copy of a benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    return pii_tagger.masked(docs, pii_tagger.train(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences along the Hilbert curve."""
    return hilbert_pack.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_copies),
    ("PII", personal_data),
    ("packing", packing),
]

#: SQL can't express the trained stages; tests hold run() against the stages' plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all stages applied to documents; each stage's rows are written to the shared folder and reread."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
