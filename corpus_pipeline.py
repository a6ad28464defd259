"""The corpus pipeline: documents through five filtering and encoding stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scriptmill.llm import pipeline_stages as stages
from scriptmill.llm.common import materialize, read_table

STAGES = [
    ("quality_rules", stages.quality_rules),
    ("line_dedup", stages.line_dedup_stage),
    ("simhash_near_dedup", stages.simhash_near_dedup),
    ("benchmark_decontamination", stages.benchmark_decontamination),
    ("sentencepiece", stages.sentencepiece),
]

#: the CRF, the suffix array, Hamming components and BPE are not SQL; tested
#: stage by stage against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
