"""Named queries of the text operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairlead.llm import bpe, classifier, conversation_repair, embedding_dedup, filter_audit, fingerprint, line_dedup, lm_scoring, minhash, mixing, quality_rules, sharding, substring_dedup
from fairlead.llm.common import documents, sha256_hex
from fairlead.llm.stages import Stages


def op1_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = sharding.build_tree(8)
    placed = sharding.assign_shards(documents(spark, sf_dir), tree, sharding.grow(tree, 8))
    return placed.withColumn("law", F.lit("key"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid backoff of order two, every count kept."""
    return rounded_scores(lm_scoring.score_documents(documents(spark, sf_dir), Stages(spark)))


def op3_lm_all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores by the form for documents that were all counted."""
    return rounded_scores(lm_scoring.score_with_all_counts(documents(spark, sf_dir), Stages(spark)))


def rounded_scores(scored: DataFrame) -> DataFrame:
    return scored.select(
        "doc_id",
        "n_words",
        F.round("log_score", 6).alias("log_score"),
        F.round("mean_log_score", 9).alias("mean_log_score"),
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "source", "size", "source_size", "target", "taken"
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_documents(documents(spark, sf_dir), path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"),
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(documents(spark, sf_dir), Stages(spark))
    return cut.select(
        "doc_id", "n_words", "n_removed", sha256_hex(F.col("kept")).alias("kept_sha256")
    )


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir), Stages(spark))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return classifier.score(docs, model).select(
        "doc_id",
        classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(documents(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        sha256_hex(F.col("edited")).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    joined = line_dedup.with_bitmaps(docs, line_dedup.keep_bitmaps(docs, Stages(spark)), "doc_id", "text")
    return joined.select(
        F.col("left_id").alias("doc_id"),
        "n_lines",
        "n_dropped",
        sha256_hex(line_dedup.kept_text(F.col("whole"), F.col("kept_runs"))).alias("kept_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows of conversations with faults drawn from conversation and turn (the query's test input)."""

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = (
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.translate(plain("text"), ".!?", ""))
        .otherwise(plain("text"))
    )
    role = F.when(F.col("fault") == 4, "user").otherwise(plain("role"))
    times = F.when(F.col("fault") == 3, 2).otherwise(1)
    return (
        rows.select("conv_id", "turn", "role", "text", fault.alias("fault"))
        .where("fault <> 0")
        .select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.sequence(F.lit(1), times)))
        .drop("col")
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation after the contract's damage; a row per conversation."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = conversation_repair.repair(damaged(rows), Stages(spark))
    digests = conversation_repair.joined_sha256(found.turns)
    ids = rows.select("conv_id").distinct()
    joined = (
        ids.join(found.report.withColumnRenamed("conv", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left")
        .drop("of")
        .join(digests.withColumnRenamed("conv", "of"), F.col("conv_id").eqNullSafe(F.col("of")), "left")
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", sha256_hex(F.lit(""))).alias("repaired_sha256"),
    )


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors among all embeddings, a row per vector."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return embedding_dedup.near_duplicate_vectors(rows, Stages(spark))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of filters A to E over all documents, by source."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return filter_audit.audit_documents(documents(spark, sf_dir), labels, Stages(spark))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_hash_tree_sharding,
        op2_quality_rules,
        op3_lm_scoring,
        op3_lm_all_pairs,
        op4_source_mixing,
        op5_bpe,
        op6_substring_dedup,
        op7_minhash_dedup,
        op8_quality_classifier,
        op9_fingerprints,
        op10_line_dedup,
        op11_conversation_repair,
        op12_embedding_dedup,
        op13_filter_audit,
    )
    return {query.__name__: query for query in named}
