"""From raw documents to training tokens: the stages of the corpus pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fairlead.llm.bpe import encode_documents
from fairlead.llm.classifier import fit, keep_good
from fairlead.llm.common import documents
from fairlead.llm.line_dedup import drop_repeated_lines
from fairlead.llm.minhash import drop_near_duplicates
from fairlead.llm.mixing import mixed_documents
from fairlead.llm.stages import Stages


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled ones, does not reject."""
    return keep_good(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many repeat."""
    return drop_repeated_lines(docs, Stages(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs, Stages(spark))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and as far, as the mix of sources takes them."""
    return mixed_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and what they decode to: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded."""
    return encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

#: Training a classifier and sketching have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each to the written result of the one before."""
    store = Stages(spark)
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store.keep(docs, name)
    return docs
