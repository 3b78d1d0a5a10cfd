"""One query per operator (opN_<name>) with production parameters over whole tables, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplens.llm import (chat_format, class_lm, decontaminate, language_id, line_dedup, mixing, near_dedup, orchard,
                          quality_rules, sharding, source_audit, token_counts, vector_topk)
from shoplens.llm.common import remainder, table

#: A conversation of control strings, formatted beside those of the table.
CONTROL = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def _held_out(modulus: int):
    return F.coalesce(remainder(F.col("doc_id"), modulus) == 2, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", _held_out(4))
    learned = language_id.learn(docs.where(~F.col("held_out")).select("doc_id", "text", "lang"))
    return language_id.identify(docs.select("doc_id", "held_out", "text"), learned)


def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _held_out(7).alias("held_out"), "text")
    return class_lm.score_documents(docs, ~F.col("held_out"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, keep_text=False)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_digest(docs).select("doc_id", "size", "source_size", "target", "taken")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(docs, table(spark, sf_dir, "benchmark"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(CONTROL, "conv_id long, turn long, role string, text string")
    return chat_format.digest(chat_format.format_conversations(turns.unionByName(control)))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op12_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster(table(spark, sf_dir, "embeddings"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # the repository's top module, which is part of this subpackage

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_language_id, op2_class_lm, op3_token_counts, op4_sharding, op5_mixing, op6_decontaminate, op7_near_dedup,
    op8_line_dedup, op9_chat_format, op10_quality_rules, op11_vector_topk, op12_orchard, op13_source_audit, pipeline)}
ORACLE: dict[str, str] = {"op4_sharding": sharding.ORACLE, "op8_line_dedup": line_dedup.ORACLE, "op9_chat_format": chat_format.ORACLE,
                          "op11_vector_topk": vector_topk.ORACLE, "op12_orchard": orchard.ORACLE, "op13_source_audit": source_audit.ORACLE}
