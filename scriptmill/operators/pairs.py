"""Instruction pairs from structured blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import DEFAULT_TEMPLATES, DESC_FALLBACK, INSTRUCTION_TEMPLATES, SEED, SYSTEM_SCRIPT
from ..functions.hashing import keyed_hash
from ..functions.text import col_of, fill_template
from .localization import descriptions


def template_list(category) -> Column:
    """The category's templates, else the default pair (a literal map)."""
    m = F.create_map(*[x for cat, ts in INSTRUCTION_TEMPLATES.items()
                       for x in (F.lit(cat), F.array(*[F.lit(t) for t in ts]))])
    return F.coalesce(F.element_at(m, col_of(category)), F.array(*[F.lit(t) for t in DEFAULT_TEMPLATES]))


def draw_template(category, key, seed=SEED) -> Column:
    """One template per row, drawn by a keyed hash of the row's key."""
    ts = template_list(category)
    idx = F.pmod(keyed_hash(seed, key), F.size(ts).cast("long"))
    return F.element_at(ts, (idx + 1).cast("int"))


def instruction_pairs(blocks: DataFrame, loc: DataFrame | None, min_lines: int = 3,
                      seed=SEED) -> DataFrame:
    """``system, instruction, completion, category, source_file, name``.

    ``blocks`` are structured blocks (``name, category, source_file, code,
    lines, ln``); ``loc`` the last-key-wins localization map (``key, value``).
    Blocks under ``min_lines`` lines are dropped before the lookup.  The
    description table is keyed by base name, so the lookup is one equi-join
    whose strategy (broadcast or shuffle) AQE picks from measured sizes.
    """
    b = blocks.where(F.col("lines") >= min_lines)
    if loc is not None:
        d = descriptions(loc)
        b = b.join(d, b["name"] == d["base"], "left").drop("base")
    else:
        b = b.withColumn("loc_desc", F.lit(None).cast("string"))
    desc = F.coalesce(F.col("loc_desc"), F.replace(F.lit(DESC_FALLBACK), F.lit("{category}"), F.col("category")))
    key = F.concat_ws("|", F.col("source_file"), F.col("ln").cast("string"), F.col("category"))
    tmpl = draw_template("category", key, seed)
    return b.select(
        F.lit(SYSTEM_SCRIPT).alias("system"),
        fill_template(tmpl, name=F.col("name"), category=F.col("category"), loc_desc=desc).alias("instruction"),
        F.col("code").alias("completion"), "category", "source_file", "name")
