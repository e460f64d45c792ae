"""The queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm import ann, bpe, conversations, hard_negatives, jaccard, licenses, line_rules, merge_queue, mixing, pii, quality_model, token_store, toxicity
from loomgraph.llm.common import new_path, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learn=fold != 1)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted", "flagged")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_store.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_store.read_documents(spark, path)


def op4_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_additive_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 20 == 0, k=20)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf_dir, "documents"), jaccard.Measure(words=3, percent=90))


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    settings = quality_model.Settings()
    scored = quality_model.score(docs, quality_model.fit(docs, settings=settings))
    return scored.select("doc_id", "score", (F.col("score") >= settings.threshold).alias("kept"))


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.private_values(table(spark, sf_dir, "documents"), key=pii.key_of(spark))


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.quality(table(spark, sf_dir, "documents")).drop("text_hash")


def op11_merge_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_queue.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, dropped = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair_report(kept, known=dropped)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mine(vectors, is_anchor=F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_license_scan": op2_license_scan,
    "op3_token_store": op3_token_store,
    "op4_byte_level_bpe": op4_byte_level_bpe,
    "op5_additive_quantisation": op5_additive_quantisation,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_quality_model": op7_quality_model,
    "op8_pseudonyms": op8_pseudonyms,
    "op9_pareto_mix": op9_pareto_mix,
    "op10_line_frequency": op10_line_frequency,
    "op11_merge_queue": op11_merge_queue,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL: dict[str, str] = {
    "op2_license_scan": licenses.report_sql(),
    "op6_jaccard_join": jaccard.components_sql(jaccard.Measure(words=3, percent=90)),
    "op9_pareto_mix": mixing.mix_sql(),
    "op10_line_frequency": line_rules.quality_sql(),
    "op12_conversation_repair": conversations.report_sql(),
    "op13_hard_negatives": hard_negatives.mine_sql(),
}
