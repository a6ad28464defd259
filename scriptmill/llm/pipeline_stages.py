"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

Every stage but the last returns the columns of ``documents`` unchanged in
name and type; rows or text change by the stage's decisions, and each stage
works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptmill.llm import decontam, line_dedup, quality, simhash_gray, spm_wfst
from scriptmill.llm.common import doc_key, materialize, read_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line labels reject go."""
    return quality.reject_boilerplate(docs, read_table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are cut out of the texts; ``n_chars``
    follows the text; no row goes."""
    return (line_dedup.dedup_lines(docs)
            .withColumn("n_chars", F.when(F.col("__runs").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
            .select(*docs.columns))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest doc_id (null
    last), ties by text hash; rows equal in doc_id and text stay once."""
    keyed = docs.withColumn("__key", doc_key())
    groups = simhash_gray.near_duplicates(keyed, carry=("__key",))
    stay = (groups.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "__key")).alias("first"))
            .select(F.col("first.__key").alias("__stays")))
    # as many survivors as groups: merged at every size, never broadcast
    return (keyed.join(materialize(stay, "survivors").hint("merge"), F.col("__key") == F.col("__stays"), "left_semi")
            .dropDuplicates(["__key"]).select(*docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, the ids of the text, their number, and whether decoding them
    gives the text back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    out = spm_wfst.encode_and_decode(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.col("__ids").alias("ids"), (F.length("__ids") / 4).cast("long").alias("n_ids"),
                      spm_wfst.round_trip().alias("round_trip"))
