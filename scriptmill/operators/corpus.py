"""Raw corpus and CLM documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed import SKIP_DIRS
from ..functions.text import is_blank, line_count, path_parts, relative_path
from .categories import category_by_prefix


def raw_corpus(scripts: DataFrame, root: str | None = None, skip_dirs=SKIP_DIRS) -> DataFrame:
    """``text, path, category, lines`` for every non-blank script.

    Paths are made relative to ``root``; a file is skipped when any part of
    its path (the file name too) is a skip directory.
    """
    rel = scripts.withColumn("path", relative_path("path", root))
    skip = F.array(*[F.lit(s) for s in skip_dirs])
    return (rel.where(~F.arrays_overlap(path_parts("path"), skip))
               .where(~is_blank("text"))
               .select("text", "path", category_by_prefix("path").alias("category"),
                       line_count("text").alias("lines")))


def clm_documents(corpus: DataFrame) -> DataFrame:
    """Each corpus file as one causal-LM document with a path/category header."""
    return corpus.select(F.concat(F.lit("# File: "), "path", F.lit("\n# Category: "), "category",
                                  F.lit("\n\n"), "text").alias("text"))
