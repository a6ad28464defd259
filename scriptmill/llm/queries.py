"""The registered queries of the training-data operators: each applies its
operator with production parameters to its whole table and returns the digest
columns of its result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptmill.llm import (chat_format, decontam, importance, line_dedup, quality, secret_ledger, sharding, simhash_gray, spm_wfst, surrogates,
                            token_files, toxicity, whitening)
from scriptmill.llm.common import materialize, read_table
from scriptmill.llm.oracle import ORACLE  # noqa: F401  read by the entry point


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"  # template and escape characters inside a text
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                                  "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select(*extra.columns).unionByName(extra)
    formatted = chat_format.format_conversations(turns, public_tokenizers.path("byte_bpe_50k.json"))
    return chat_format.read_back(materialize(formatted, "chats"))


def op2_knn_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.assess(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted", F.col("evidence.doc_id").alias("nearest"))


def op3_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(read_table(spark, sf_dir, "documents"))


def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "n_matched", "n_windows", "coverage", "reparameterised")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    cut = F.aggregate("__runs", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])
    return out.select("doc_id", "text", F.coalesce(cut, F.lit(0)).alias("n_lines_cut"),
                      F.coalesce(F.size("__runs").cast("long"), F.lit(0)).alias("n_runs_cut"))


def op6_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.assess(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "content_share")


def op7_sentencepiece_wfst(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = public_tokenizers.path("piece_bpe_32k.model")
    out = spm_wfst.encode_and_decode(docs, model)
    return out.select("doc_id", (F.length("__ids") / 4).cast("long").alias("n_ids"), F.crc32("__ids").alias("ids_crc32"),
                      F.crc32(F.col("__decoded").cast("binary")).alias("decoded_crc32"),
                      spm_wfst.round_trip().alias("round_trip"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = surrogates.replace_entities(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", F.col("__n_entities").alias("n_entities"))


def op9_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_gray.near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash_gray.fingerprint_hex().alias("fingerprint"), "component_id")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = token_files.new_store(spark)
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), store,
                                  public_tokenizers.path("word_bpe_49k.json"))
    out = token_files.read_token_files(spark, store)
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_ledger.digest(secret_ledger.scan(docs, secret_ledger.new_ledger(spark)))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_knn_toxicity": op2_knn_toxicity,
    "op3_minimax_shards": op3_minimax_shards,
    "op4_template_decontamination": op4_template_decontamination,
    "op5_line_dedup": op5_line_dedup,
    "op6_quality_crf": op6_quality_crf,
    "op7_sentencepiece_wfst": op7_sentencepiece_wfst,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_simhash_gray": op9_simhash_gray,
    "op10_token_files": op10_token_files,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_secret_ledger": op13_secret_ledger,
}
